"""Paragraphs from line geometry: lists and indexes are told from text, and pieces are joined.

Each text block's shape is measured from its lines; the measures decide what it is and where items
begin and end. Blocks between titles and display equations form a group; in each group pieces are then
joined from the last to the first, because a joined piece may be joined again.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# What ends a sentence, what ends a list item, what cuts groups, flags on lines and spans.
SENTENCE_ENDS = (".", "!", "?", "。", "！", "？", ")", "）", '"', "”", ":", "：", ";", "；")
ITEM_ENDS = (".", "。", ";", "；")
GROUP_CUTS = ("title", "interline_equation")
WIDE_SCRIPTS = ("zh", "ja", "ko")
STARTS, ENDS, CROSSED, EMPTIED = "is_list_start_line", "is_list_end_line", "cross_page", "lines_deleted"


def script_of(text: str) -> str:
    """A stand-in for a language model: which of the scripts without spaces most letters belong to."""
    counts = {"zh": 0, "ja": 0, "ko": 0, "": 0}
    for c in text:
        if c.isalpha():
            counts["ko" if "가" <= c <= "힣" else "ja" if "぀" <= c <= "ヿ" else "zh" if "一" <= c <= "鿿" else ""] += 1
    return max(counts, key=counts.get)


@dataclass
class Shape:
    """A block's lines against the box around them; margins are in page units."""

    texts: list[str]
    left: list[float]
    right: list[float]
    height: float
    width: float
    tall: float
    off_center: list[float]
    page_width: float
    wide_script: bool
    near_left: list[bool] = field(init=False)
    near_right: list[bool] = field(init=False)

    def __post_init__(self) -> None:
        self.near_left = [abs(x) < self.height / 2 for x in self.left]
        self.near_right = [abs(x) < self.height for x in self.right]

    def share(self, flags: list[bool]) -> float:
        return sum(flags) / len(flags)

    def ends_item(self, k: int) -> bool:
        return self.texts[k].endswith(ITEM_ENDS)

    @property
    def gap(self) -> float:
        """How far from the right edge a line must end to be cut short."""
        narrow = not self.wide_script and (self.width / self.page_width if self.page_width else 0) < 0.5
        return (0.36 if narrow else 0.26) * self.width


def outline(block: dict) -> list[float]:
    boxes = [line["bbox"] for line in block.get("lines") or []]
    return [f(b[k] for b in boxes) for k, f in enumerate((min, min, max, max))] if boxes else list(block["bbox"])


def measure(block: dict, language: Callable[[str], str]) -> Shape:
    box, lines = block["bbox_fs"], block["lines"]
    texts = ["".join(s["content"].strip() for s in line["spans"] if s["type"] == "text") for line in lines]
    boxes = [line["bbox"] for line in lines]
    return Shape(
        texts=texts,
        left=[b[0] - box[0] for b in boxes],
        right=[box[2] - b[2] for b in boxes],
        height=boxes[0][3] - boxes[0][1],
        width=box[2] - box[0],
        tall=box[3] - box[1],
        off_center=[abs((b[0] + b[2]) / 2 - (box[0] + box[2]) / 2) for b in boxes],
        page_width=block["page_size"][0],
        wide_script=language("".join(texts)) in WIDE_SCRIPTS,
    )


def kind_and_marks(s: Shape) -> tuple[str, set[int], set[int]]:
    """index, list or text; and the lines at which items begin and end."""
    every = set(range(len(s.texts)))
    digits_first = [t[:1].isdigit() for t in s.texts]
    digits_last = [t[-1:].isdigit() for t in s.texts]
    item_ends = [s.ends_item(k) for k in every]
    numbered = max(s.share(digits_first), s.share(digits_last)) >= 0.8
    if numbered and max(s.share(s.near_left), s.share(s.near_right)) >= 0.8:
        return "index", every, set()
    apart = [a > 0.7 * s.height and b > 0.7 * s.height for a, b in zip(s.left, s.right)]
    if sum(apart) >= 2 and s.share(apart) >= 0.5 and all(x < s.height / 2 for x in s.off_center) and s.width and s.tall / s.width > 0.4:
        return "list", every, set()
    indented = [x > s.height and not near for x, near in zip(s.left, s.near_left)]
    cut_short = [x > s.gap and not near for x, near in zip(s.right, s.near_right)]
    mostly_ended = s.share(item_ends) >= 0.8
    # an indented first line and a short last line at the margin: a paragraph after another
    two_paragraphs = s.left[0] > s.height / 2 and s.near_left[-1] and s.right[-1] > s.height
    if two_paragraphs or sum(s.near_left) < 2 or not (sum(cut_short) >= 2 or mostly_ended or sum(indented) >= 2):
        return "text", set(), set()
    if s.share(s.near_left) > 0.8:  # no indents: items are told by their ends
        if not any(item_ends) and s.share(s.near_right) < 0.5:
            return "list", {k for k in every if s.near_left[k]}, set()
        ends = {k for k in every if (item_ends[k] if mostly_ended else abs(s.right[k]) > 0.1 * s.width)}
        return "list", {k + 1 for k in ends} & every, ends
    if sum(digits_first) >= 2 and sum(digits_first) == sum(item_ends):
        return "list", {k for k in every if digits_first[k]}, {k for k in every if item_ends[k]}
    return "list", {k for k in every if s.near_left[k]}, {k for k in every if abs(s.right[k]) > s.height}


def groups(blocks: list[dict]) -> Iterator[list[dict]]:
    """Text blocks, cut where a title or a display equation comes next."""
    group: list[dict] = []
    for block, after in zip(blocks, [*blocks[1:], None]):
        if block["type"] == "text":
            group.append(block)
        if after is None or after["type"] in GROUP_CUTS:
            yield group
            group = []


def continues(later: dict, earlier: dict) -> bool:
    """Whether a text block goes on where the one before it stopped."""
    if not later["lines"] or not earlier["lines"]:
        return False
    first, last = later["lines"][0], earlier["lines"][-1]
    if not first["spans"] or not last["spans"]:
        return False
    begin, end = first["spans"][0]["content"], last["spans"][-1]["content"]
    widths = [b["bbox"][2] - b["bbox"][0] for b in (later, earlier)]
    flush_left = abs(later["bbox_fs"][0] - first["bbox"][0]) < (first["bbox"][3] - first["bbox"][1]) / 2
    flush_right = abs(earlier["bbox_fs"][2] - last["bbox"][2]) < last["bbox"][3] - last["bbox"][1]
    fresh = not begin or begin[0].isdigit() or begin[0].isupper()
    return flush_left and flush_right and not fresh and not end.endswith(SENTENCE_ENDS) and abs(widths[0] - widths[1]) < min(widths)


def move_lines(later: dict, earlier: dict) -> None:
    if later["page_num"] != earlier["page_num"]:
        for line in later["lines"]:
            for span in line["spans"]:
                span[CROSSED] = True
    earlier["lines"] += later["lines"]
    later["lines"], later[EMPTIED] = [], True


def split_paragraphs(pages: list[dict], language: Callable[[str], str] = script_of) -> list[dict]:
    """Pages with para_blocks made from preproc_blocks; the input stays as it is."""
    pages = copy.deepcopy(pages)
    blocks = [b | {"page_num": p["page_idx"], "page_size": p["page_size"]} for p in pages for b in copy.deepcopy(p["preproc_blocks"])]
    for group in groups(blocks):
        short = all(len(b["lines"]) <= 3 for b in group)
        for block in group:
            block["bbox_fs"] = outline(block)
            if len(block["lines"]) >= 2:
                block["type"], starts, ends = kind_and_marks(measure(block, language))
                for marks, name in ((starts, STARTS), (ends, ENDS)):
                    for k in marks:
                        block["lines"][k][name] = True
        for earlier, later in reversed(list(zip(group, group[1:]))):
            kinds = {earlier["type"], later["type"]}
            if kinds in ({"list"}, {"index"}) or (kinds == {"text"} and not short and continues(later, earlier)):
                move_lines(later, earlier)
    for page in pages:
        own = [b for b in blocks if b["page_num"] == page["page_idx"]]
        page["para_blocks"] = [{k: v for k, v in b.items() if k not in ("page_num", "page_size")} for b in own]
    return pages


def with_paragraphs(layout: Column, language: Callable[[str], str] = script_of) -> Column:
    """split_paragraphs over layout documents (JSON text); null for broken text."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        def one(text: str | None) -> str | None:
            try:
                document = json.loads(text) if text is not None else None
                return None if document is None else json.dumps(document | {"pdf_info": split_paragraphs(document["pdf_info"], language)}, ensure_ascii=False)
            except (ValueError, KeyError, TypeError):
                return None

        return texts.map(one)

    return run(layout)
