"""Layout blocks as lists of typed contents, in two versions, and whole documents in four forms."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from docpool.functions import schema as S
from docpool.functions.layout import Policy, inner, markdown, span_text, spans, title_level

FORMS = ("mm_markdown", "nlp_markdown", "content_list", "content_list_v2")
#: Kinds that are text alone, besides titles.
_PLAIN = (S.TEXT, S.REF_TEXT, S.PHONETIC, S.HEADER, S.FOOTER, S.PAGE_NUMBER, S.ASIDE_TEXT, S.PAGE_FOOTNOTE)
# Fixed values of the second version: names of page parts.
PAGE_PARTS = {S.HEADER: "page_header", S.FOOTER: "page_footer", S.ASIDE_TEXT: "page_aside_text", S.PAGE_NUMBER: "page_number", S.PAGE_FOOTNOTE: "page_footnote"}
# Fixed values of the second version: kinds of spans.
SPAN_KINDS = ("text", "phonetic", "equation_inline", "md", "code_inline")


def scaled_box(block: dict, page_size: list | None) -> list[int] | None:
    """The block's box in thousandths of the page."""
    if not block.get("bbox") or not page_size:
        return None
    return [int(v * 1000 / page_size[k % 2]) for k, v in enumerate(block["bbox"])]


def _texts(block: dict, kind: str) -> list[str]:
    return [span_text(b) for b in inner(block, kind)]


def _last(block: dict, body: str, span_kind: str, field: str) -> str:
    found = [s[field] for b in inner(block, body) for s, _ in spans(b) if s.get("type") == span_kind and s.get(field)]
    return found[-1] if found else ""


def _path(folder: str, name: str) -> str:
    return f"{folder}/{name}" if name else ""


def content(block: dict, page_idx: int, page_size: list | None, folder: str = "") -> dict:
    """A block in the first version; kinds that are unknown have only a box and a page."""
    kind, out = block.get("type"), {}
    if kind in _PLAIN:
        out = {"type": kind, "text": span_text(block)}
    elif kind == S.LIST:
        out = {"type": kind, "sub_type": block.get("sub_type", ""), "list_items": [t for t in map(span_text, block.get("blocks") or []) if t.strip()]}
    elif kind == S.TITLE:
        level = title_level(block.get("level"))
        out = {"type": S.TEXT, "text": span_text(block)} | ({"text_level": level} if level else {})
    elif kind == S.INTERLINE_EQUATION:
        out = {"type": "equation", "text": span_text(block), "text_format": "latex"}
    elif kind == S.IMAGE_BLOCK:
        out = {"type": kind, "img_path": _path(folder, _last(block, S.IMAGE_BODY, S.IMAGE_BLOCK, "image_path")), **{k: _texts(block, k) for k in (S.IMAGE_CAPTION, S.IMAGE_FOOTNOTE)}}
    elif kind == S.TABLE:
        out = {"type": kind, "img_path": _path(folder, _last(block, S.TABLE_BODY, S.TABLE, "image_path")), **{k: _texts(block, k) for k in (S.TABLE_CAPTION, S.TABLE_FOOTNOTE)}}
        if html := _last(block, S.TABLE_BODY, S.TABLE, "html"):
            out[S.TABLE_BODY] = html
    elif kind == S.CODE:
        out = {"type": kind, "sub_type": block.get("sub_type"), S.CODE_CAPTION: _texts(block, S.CODE_CAPTION)}
        if bodies := _texts(block, S.CODE_BODY):
            out[S.CODE_BODY] = bodies[-1]
            if block.get("sub_type") == S.CODE:
                out["guess_lang"] = block.get("guess_lang")
    box = scaled_box(block, page_size)
    return out | ({"bbox": box} if box else {}) | {"page_idx": page_idx}


def typed_spans(block: dict) -> list[dict]:
    """Spans with text, by the second version's kinds; others are left out."""
    out = []
    for span, _ in spans(block):
        kind = span.get("type")
        if block.get("type") == S.PHONETIC and kind == "text":
            kind = "phonetic"
        kind = "equation_inline" if kind == S.INLINE_EQUATION else kind
        if (span.get("content") or "").strip() and kind in SPAN_KINDS:
            out.append({"type": kind, "content": span["content"]})
    return out


def body(block: dict) -> tuple[str, str]:
    """Image path and content (HTML, LaTeX or text) of the first span that has either kind."""

    def of(holder: dict) -> tuple[str, str]:
        for s, _ in spans(holder):
            kind = s.get("type")
            if kind in (S.TABLE, S.IMAGE_BLOCK, S.INTERLINE_EQUATION, S.TEXT):
                other = {S.TABLE: "html", S.IMAGE_BLOCK: ""}.get(kind, "content")
                return "" if kind == S.TEXT else s.get("image_path", ""), s.get(other, "") if other else ""
        return "", ""

    if "blocks" not in block:
        return of(block)
    found = (of(b) for b in block["blocks"] if b.get("type") in (S.IMAGE_BODY, S.TABLE_BODY, S.CODE_BODY))
    return next((f for f in found if f != ("", "")), ("", ""))


def content_v2(block: dict, page_size: list | None, folder: str = "") -> dict:
    """A block in the second version; unknown kinds of code and of lists raise ValueError."""
    kind, sub = block.get("type"), block.get("sub_type")

    def all_spans(part: str) -> list[dict]:
        return [s for b in inner(block, part) for s in typed_spans(b)]

    def made(name: str, **fields: object) -> dict:
        return {"type": name, "content": fields}

    out: dict = {}
    if kind in PAGE_PARTS:
        out = made(PAGE_PARTS[kind], **{f"{PAGE_PARTS[kind]}_content": typed_spans(block)})
    elif kind == S.TITLE and title_level(block.get("level")):
        out = made("title", title_content=typed_spans(block), level=title_level(block.get("level")))
    elif kind in (S.TITLE, S.TEXT, S.PHONETIC):
        out = made("paragraph", paragraph_content=typed_spans(block))
    elif kind in (S.INTERLINE_EQUATION, S.IMAGE_BLOCK, S.TABLE):
        image, text = body(block)
        source = {"path": f"{folder}/{image}"}
        if kind == S.INTERLINE_EQUATION:
            out = made("equation_interline", math_content=text, math_type="latex", image_source=source)
        elif kind == S.IMAGE_BLOCK:
            out = made("image", image_source=source, image_caption=all_spans(S.IMAGE_CAPTION), image_footnote=all_spans(S.IMAGE_FOOTNOTE))
        else:
            nested = 2 if text.count("<table") > 1 else 1
            shape = "complex_table" if nested > 1 or "colspan" in text or "rowspan" in text else "simple_table"
            out = made("table", image_source=source, table_caption=all_spans(S.TABLE_CAPTION), table_footnote=all_spans(S.TABLE_FOOTNOTE), html=text, table_type=shape, table_nest_level=nested)
    elif kind == S.CODE:
        bodies = inner(block, S.CODE_BODY)
        lines, caption = typed_spans(bodies[-1]) if bodies else [], all_spans(S.CODE_CAPTION)
        if sub == S.CODE:
            out = made("code", code_caption=caption, code_content=lines, code_language=block.get("guess_lang", "txt"))
        elif sub == S.ALGORITHM:
            out = made("algorithm", algorithm_caption=caption, algorithm_content=lines)
        else:
            raise ValueError(f"unknown kind of code: {sub}")
    elif kind in (S.REF_TEXT, S.LIST):
        if kind == S.LIST and "sub_type" in block and sub not in (S.REF_TEXT, S.TEXT):
            raise ValueError(f"unknown kind of list: {sub}")
        items = [typed_spans(block)] if kind == S.REF_TEXT else [s for b in block.get("blocks") or [] if (s := typed_spans(b))]
        name = "reference_list" if S.REF_TEXT in (kind, sub) else "text_list"
        out = made("list", list_type=name, list_items=[{"item_type": "text", "item_content": i} for i in items])
    box = scaled_box(block, page_size)
    return out | ({"bbox": box} if box else {})


def assemble(pages: list[dict], form: str, folder: str = "", policy: Policy = Policy()) -> str | list:
    """A whole document: markdown, with or without images, or a list of contents."""
    if form not in FORMS:
        raise ValueError(f"unknown form: {form}")
    if form.endswith("markdown"):
        texts = (markdown(b, policy, images=form == "mm_markdown", folder=folder) for p in pages for b in p.get("para_blocks") or [])
        return "\n\n".join(t for t in texts if t)
    blocks = [(p, (p.get("para_blocks") or []) + (p.get("discarded_blocks") or [])) for p in pages]
    if form == "content_list":
        return [content(b, p.get("page_idx"), p.get("page_size"), folder) for p, own in blocks for b in own]
    return [[content_v2(b, p.get("page_size"), folder) for b in own] for p, own in blocks]


def assembled(layout: Column, form: str, folder: str = "") -> Column:
    """`assemble` over layout documents (JSON text): text, or JSON of the list; null for broken text."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            try:
                out = assemble(json.loads(text)["pdf_info"], form, folder) if text is not None else None
            except (ValueError, KeyError, TypeError):
                return None
            return out if out is None or isinstance(out, str) else json.dumps(out, ensure_ascii=False)

        return texts.map(one)

    return run(layout)
