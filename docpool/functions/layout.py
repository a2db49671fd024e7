"""Layout documents: blocks to markdown, titles, image policy. Plain functions on one document.

A block is rendered once, by itself; what an interval of blocks holds is then a matter of sums.
"""

from __future__ import annotations

import copy
import re
from collections.abc import Iterator
from dataclasses import dataclass

from docpool.functions import schema as S

Position = tuple[int, int]
IMAGE_LINK = re.compile(r"!\[\]\(images/[a-f0-9]{64}\.jpg\)")
_PART = re.compile(r"(!\[\]\(images/[a-f0-9]{64}\.jpg\)|<table>.*?</table>)", re.DOTALL)
_REMAINS = re.compile(r"[#$\s]*")


@dataclass(frozen=True)
class Policy:
    """formula: display equations as LaTeX, else as images; table: tables as HTML, else as images."""

    formula: bool = True
    table: bool = True


def spans(block: dict) -> Iterator[tuple[dict, bool]]:
    """A block's spans, and whether each is its line's last."""
    for line in block.get("lines") or []:
        own = line.get("spans") or []
        for k, span in enumerate(own):
            yield span, k == len(own) - 1


def inner(block: dict, kind: str) -> list[dict]:
    return [b for b in block.get("blocks") or [] if b.get("type") == kind]


def span_text(block: dict, formula: bool = True, folder: str = "images") -> str:
    """Texts and inline equations, with a space after all but a line's last; display equations."""
    out = []
    for span, last in spans(block):
        kind, content = span.get("type"), span.get("content") or ""
        if kind == S.TEXT and content:
            out.append(content + ("" if last else " "))
        elif kind == S.INLINE_EQUATION:
            out.append(f"${content}$" + ("" if last else " "))
        elif kind == S.INTERLINE_EQUATION and formula:
            out.append(f"\n$$\n{content}\n$$\n")
        elif kind == S.INTERLINE_EQUATION and span.get("image_path"):
            out.append(f"![]({folder}/{span['image_path']})")
    return "".join(out)


def title_level(level: object) -> int:
    """1 to 4; 0 for less and for none, 4 for more."""
    return min(level, 4) if isinstance(level, int) and level >= 1 else 0


def _links(blocks: list[dict], kind: str, folder: str) -> str:
    return "".join(f"![]({folder}/{s['image_path']})" for b in blocks for s, _ in spans(b) if s.get("type") == kind and s.get("image_path"))


def _table_body(block: dict, as_html: bool, folder: str) -> str:
    out = ""
    for span, _ in spans(block):
        if span.get("type") != S.TABLE:
            continue
        if as_html and span.get("html"):
            out += f"\n{span['html']}\n"
        elif span.get("image_path"):
            out += f"![]({folder}/{span['image_path']})"
    return out


def markdown(block: dict, policy: Policy = Policy(), level: object = None, images: bool = True, folder: str = "images") -> str:
    """A block's markdown, stripped; empty for kinds that aren't rendered.

    level: a title's, instead of its own. images: False leaves images and tables out.
    """
    kind = block.get("type")
    text = ""
    if kind in (S.TEXT, S.INTERLINE_EQUATION, S.PHONETIC, S.REF_TEXT):
        text = span_text(block, policy.formula, folder)
    elif kind == S.LIST:
        text = "".join(span_text(b, policy.formula, folder) + "  \n" for b in block.get("blocks") or [])
    elif kind == S.TITLE:
        text = "#" * title_level(block.get("level") if level is None else level) + " " + span_text(block)
    elif kind == S.IMAGE_BLOCK and images:
        body, notes = _links(inner(block, S.IMAGE_BODY), S.IMAGE_BLOCK, folder), inner(block, S.IMAGE_FOOTNOTE)
        captions = [span_text(b) for b in inner(block, S.IMAGE_CAPTION)]
        if notes:
            text = "".join(c + "  \n" for c in captions) + body + "".join("  \n" + span_text(b) for b in notes)
        else:
            text = body + "".join("  \n" + c for c in captions)
    elif kind == S.TABLE and images:
        text = "".join(span_text(b) + "  \n" for b in inner(block, S.TABLE_CAPTION))
        text += "".join(_table_body(b, policy.table, folder) for b in inner(block, S.TABLE_BODY))
        text += "".join("\n" + span_text(b) + "  " for b in inner(block, S.TABLE_FOOTNOTE))
    elif kind == S.CODE:
        text = "".join(span_text(b) + "  \n" for b in inner(block, S.CODE_CAPTION))
        for b in inner(block, S.CODE_BODY):
            if block.get("sub_type") == S.CODE:
                text += f"```{block.get('guess_lang')}\n{span_text(b)}\n```"
            elif block.get("sub_type") == S.ALGORITHM:
                text += span_text(b)
    return text.strip()


def content_size(text: str) -> tuple[int, int]:
    """Image links of a rendered block, and characters of its other text, line by line without margins."""
    links = len(IMAGE_LINK.findall(text))
    return links, sum(len(line.strip()) for line in IMAGE_LINK.sub("", text).split("\n"))


def expected_images(block: dict) -> int:
    """Images that a layout says a block has."""
    return sum(bool(s.get("image_path")) for b in inner(block, S.IMAGE_BODY) for s, _ in spans(b) if s.get("type") == S.IMAGE_BLOCK) if block.get("type") == S.IMAGE_BLOCK else 0


def pages(layout: dict) -> list[dict]:
    return sorted(layout.get("pdf_info") or [], key=lambda p: p.get("page_idx", 0))


def titles(layout: dict) -> dict[int, Position]:
    """Positions of title blocks, numbered in reading order."""
    found = ((p.get("page_idx", 0), k) for p in pages(layout) for k, b in enumerate(p.get("para_blocks") or []) if b.get("type") == S.TITLE)
    return dict(enumerate(found))


def relevel(layout: dict, levels: dict[int, int] | None = None, fixed: int | None = None, places: dict[int, Position] | None = None) -> dict:
    """A copy of a layout with new levels on its titles: those of a map (0 where it has none), or one for all.

    places: of the numbered titles, where another layout numbers them; what is no title there stays as it is.
    ValueError unless either a map, not an empty one, or a fixed level is given.
    """
    if bool(levels) == (fixed is not None):
        raise ValueError("give either levels of titles or one fixed level")
    number = {place: n for n, place in (titles(layout) if places is None else places).items()}
    out = copy.deepcopy(layout)
    for page in pages(out):
        for k, block in enumerate(page.get("para_blocks") or []):
            n = number.get((page.get("page_idx", 0), k))
            if n is not None and block.get("type") == S.TITLE:
                block["level"] = levels.get(n, 0) if levels else fixed
    return out


def image_paths(layout: dict) -> dict[str, list[str]]:
    """Image paths by kind of block: images, tables and display equations."""
    out: dict[str, list[str]] = {S.IMAGE_BLOCK: [], S.TABLE: [], S.INTERLINE_EQUATION: []}
    for page in layout.get("pdf_info") or []:
        for block in page.get("para_blocks") or []:
            kind = block.get("type")
            if kind in out:
                holders = [block] if kind == S.INTERLINE_EQUATION else block.get("blocks") or []
                out[kind] += [s["image_path"] for b in holders for s, _ in spans(b) if s.get("image_path")]
    return out


def policy_of(has_images: bool, has_tables: bool, has_equations: bool) -> Policy:
    """Real images leave tables and equations as text; else table images serve, else equation images."""
    if has_images:
        return Policy()
    if has_tables:
        return Policy(table=False)
    return Policy(formula=False, table=False) if has_equations else Policy()


def slots(texts: list[str]) -> tuple[list[str | None], list[dict | None]]:
    """Rendered blocks as aligned slots: image links are image slots, all else text slots."""
    out_texts: list[str | None] = []
    out_images: list[dict | None] = []
    for text in texts:
        for part in map(str.strip, _PART.split(text.strip())):
            if _REMAINS.fullmatch(part):
                continue
            image = part.startswith("![](") and part.endswith(".jpg)")
            out_texts.append(None if image else part)
            out_images.append({"relative_img_path": part[4:-1]} if image else None)
    return out_texts, out_images
