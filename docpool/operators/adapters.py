"""Which title each slot belongs to, from layout documents of unknown shape.

A function from (layout document, number of slots) to a title for each slot, or None, is all that
another adapter needs.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

Adapter = Callable[[dict, int], "list[int | None] | None"]

# Field names that are known to occur, in the order in which they are looked at.
TITLE_FIELDS = ("title_idx", "titleIndex", "title_id", "titleId", "heading_idx", "headingIndex", "heading_id", "headingId", "section_idx", "sectionIndex", "section_id", "sectionId", "chapter_idx", "chapterIndex", "chapter_id", "chapterId")
SLOT_FIELDS = ("slot_idx", "slotIndex", "interleave_idx", "interleaveIndex", "block_idx", "blockIndex", "content_idx", "contentIndex", "idx", "index", "position", "pos")
LIST_FIELDS = ("blocks", "block_list", "blockList", "paragraphs", "paragraph_list", "items", "item_list", "content_blocks", "contentBlocks", "text_blocks", "textBlocks", "middle_blocks", "middleBlocks", "elements", "element_list")


def _first_int(entry: dict, fields: tuple[str, ...], good: Callable[[int], bool] = lambda n: True) -> int | None:
    return next((entry[f] for f in fields if isinstance(entry.get(f), int) and good(entry[f])), None)


def _assign(entries: list, slots: int, explicit: bool) -> list[int | None] | None:
    """Titles by slot, or None if fewer than 3 or a twentieth of the slots get one."""
    out: list[int | None] = [None] * slots
    assigned = 0
    for place, entry in enumerate(entries):
        title = _first_int(entry, TITLE_FIELDS) if isinstance(entry, dict) else None
        if title is None:
            continue
        slot = _first_int(entry, SLOT_FIELDS, lambda n: 0 <= n < slots) if explicit else None
        if slot is None and (not explicit or len(entries) == slots):
            slot = place
        if slot is not None and slot < slots:
            out[slot] = title
            assigned += 1
    return out if assigned >= max(3, slots // 20) else None


def search_titles(document: dict, slots: int) -> list[int | None] | None:
    """Known lists as long as the slots first, then any list of objects that name their slots."""
    for field in LIST_FIELDS:
        entries = document.get(field)
        if isinstance(entries, list) and entries and len(entries) == slots and (found := _assign(entries, slots, False)):
            return found
    for entries in document.values():
        if isinstance(entries, list) and entries and isinstance(entries[0], dict) and (found := _assign(entries, slots, True)):
            return found
    return None


def title_of_slot(layout: Column, slots: Column, adapter: Adapter = search_titles) -> Column:
    """The adapter over layout documents (JSON text); null where it finds nothing or the text is broken."""

    @F.pandas_udf(ArrayType(IntegerType()))
    def run(text: pd.Series, n: pd.Series) -> pd.Series:
        out = []
        for t, k in zip(text, n):
            try:
                document = json.loads(t) if t is not None else None
            except ValueError:
                document = None
            out.append(adapter(document, int(k)) if isinstance(document, dict) and not pd.isna(k) else None)
        return pd.Series(out)

    return run(layout, slots)
