"""Open intervals of positions (page, block): splitting at titles, refining, merging.

Refining and merging depend on what came before: plain functions on one document's intervals, run in
Arrow batches. What needs no order is also there as DataFrame operators.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docpool.functions.layout import Position

LAST_LEVEL = 4
ROOT = "ROOT"


class Interval(NamedTuple):
    start: Position
    end: Position
    parent: str
    level: int


def titles_within(level: int, start: Position, end: Position, places: dict[int, Position], levels: dict[int, int]) -> list[int]:
    """Titles of a level strictly inside. A title that has a level but no place raises KeyError."""
    return sorted(t for t, own in levels.items() if own == level and start < places[t] < end)


def split(parent: str, level: int, start: Position, end: Position, places: dict[int, Position], levels: dict[int, int]) -> list[Interval]:
    """Cut before each title of the level; what is before the first stays as an interval of its own
    unless that title begins the document. Without titles the interval stays."""
    at = [places[t] for t in titles_within(level, start, end, places, levels)]
    if not at:
        return [Interval(start, end, parent, level)]
    lefts = [(page, block - 1) for page, block in at]
    if at[0] != (0, 0):
        lefts, rights = [start, *lefts], [*at, end]
    else:
        rights = [*at[1:], end]
    return [Interval(a, b, parent, level) for a, b in zip(lefts, rights)]


def refine(intervals: list[Interval], most_pages: int, places: dict[int, Position], levels: dict[int, int], deepest: int = LAST_LEVEL) -> list[Interval]:
    """Intervals over `most_pages` pages are split at the next level, down to the deepest."""
    out: list[Interval] = []
    for i in intervals:
        if i.level >= deepest or i.end[0] - i.start[0] <= most_pages:
            out.append(i)
        else:
            parent = "_".join(map(str, titles_within(i.level, i.start, i.end, places, levels)))
            out += refine(split(parent, i.level + 1, i.start, i.end, places, levels), most_pages, places, levels, deepest)
    return out


def unions(pairs: list) -> list[list]:
    """Unions of one document's overlapping intervals; intervals that only touch stay apart."""
    out: list[list[Position]] = []
    for start, end in sorted(pairs):
        if out and start < out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def merge(intervals: list[Interval], size: Callable[[Position, Position], tuple[int, int]], least_images: int, least_text: int, most_pages: int) -> list[Interval]:
    """Intervals with too little in them join their right neighbour, else the last one kept, if these
    have the same parent and level and the result isn't too long. size: images and characters inside."""
    rest = list(reversed(intervals))
    out: list[Interval] = []

    def joins(a: Interval, b: Interval) -> bool:
        return (a.parent, a.level) == (b.parent, b.level) and b.end[0] - a.start[0] + 1 <= most_pages

    while rest:
        now = rest.pop()
        images, text = size(now.start, now.end)
        if images >= least_images and text >= least_text:
            out.append(now)
        elif rest and joins(now, rest[-1]):
            rest.append(now._replace(end=rest.pop().end))
        elif out and joins(out[-1], now):
            out[-1] = out[-1]._replace(end=now.end)
        else:
            out.append(now)
    return out


# --- DataFrame operators -----------------------------------------------------------------------


def merge_overlapping(rows: DataFrame, by: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """Unions of overlapping intervals in each group; intervals that only touch stay apart."""
    order = Window.partitionBy(*by).orderBy(start, end)
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("_new", F.coalesce((F.col(start) >= before).cast("int"), F.lit(1)))
    numbered = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def position_runs(rows: DataFrame, by: list[str], page: str = "page", block: str = "block", page_size: str = "page_size") -> DataFrame:
    """Maximal runs of positions as open intervals (start_page, start_block, end_page, end_block).

    A run goes on at the next block, or from a page's last block to the next page's first. page_size:
    the blocks of the position's page.
    """
    order = Window.partitionBy(*by).orderBy(page, block)
    p, b, n = (F.lag(c).over(order) for c in (page, block, page_size))
    on = ((F.col(page) == p) & (F.col(block) == b + 1)) | ((F.col(page) == p + 1) & (F.col(block) == 0) & (b == n - 1))
    numbered = rows.withColumn("_new", F.when(F.coalesce(on, F.lit(False)), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(order))
    ends = numbered.groupBy(*by, "_run").agg(F.min(F.struct(page, block)).alias("s"), F.max(F.struct(page, block, page_size)).alias("e"))
    full = F.col(f"e.{block}") >= F.col(f"e.{page_size}") - 1
    return ends.select(
        *by,
        F.col(f"s.{page}").alias("start_page"),
        (F.col(f"s.{block}") - 1).alias("start_block"),
        (F.col(f"e.{page}") + full.cast("int")).alias("end_page"),
        F.when(full, 0).otherwise(F.col(f"e.{block}") + 1).alias("end_block"),
    )


def inside(page: Column, block: Column, start: Position, end: Position) -> Column:
    """Whether a position lies strictly inside."""
    at = F.struct(page.cast("int").alias("p"), block.cast("int").alias("b"))
    place = lambda x: F.struct(F.lit(x[0]).alias("p"), F.lit(x[1]).alias("b"))
    return (at > place(start)) & (at < place(end))


def number_titles(blocks: DataFrame, by: list[str], page: str = "page", block: str = "block") -> DataFrame:
    """Title blocks with `tid`: their number in reading order, from 0."""
    return blocks.withColumn("tid", F.row_number().over(Window.partitionBy(*by).orderBy(page, block)) - 1)


def start_level(levels: Column, wanted: Column) -> Column:
    """The lowest level from `wanted` on that a document has; null beyond the last level."""
    return F.array_min(F.filter(levels, lambda v: (v >= wanted) & (v <= LAST_LEVEL)))
