"""Strings as Python has them: white space is Unicode's, with the four separators 1C-1F."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IMAGE_LINK = r"!\[\]\(images/[a-f0-9]{64}\.jpg\)"
_MARK = "\u0001"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def word_count(c: Column) -> Column:
    """Words between white space; 0 for null and blank text."""
    bare = strip(F.coalesce(c, F.lit("")))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, r"(?U)[\s\x1c-\x1f]+", -1)))


def parts(c: Column) -> Column:
    """A block's text cut at image links and tables, which stay; blank parts and bare # and $ go."""
    cut = F.regexp_replace(F.replace(c, F.lit(_MARK), F.lit("")), rf"(?s)({IMAGE_LINK}|<table>.*?</table>)", f"{_MARK}$1{_MARK}")
    bare = F.transform(F.split(cut, _MARK, -1), strip)
    return F.filter(bare, lambda p: ~p.rlike(r"(?U)\A[#$\s\x1c-\x1f]*\z"))


def is_image_part(p: Column) -> Column:
    return p.startswith("![](") & p.endswith(".jpg)")


def image_path(p: Column) -> Column:
    return F.substring(p, F.lit(5), F.length(p) - 5)


def image_links(c: Column) -> Column:
    return F.size(F.regexp_extract_all(c, F.lit(f"({IMAGE_LINK})"), F.lit(1)))


def pure_length(c: Column) -> Column:
    """Characters of all lines, stripped, without image links."""
    lines = F.split(F.regexp_replace(c, IMAGE_LINK, ""), "\n", -1)
    return F.aggregate(lines, F.lit(0).cast("long"), lambda n, line: n + F.length(strip(line)))


def clamped_level(level: Column) -> Column:
    """A title's level, 1 to 4; 0 for less and for none."""
    return F.when(level >= 1, F.least(level, F.lit(4))).otherwise(F.lit(0)).cast("int")


def policy_flags(images: Column, tables: Column, equations: Column) -> Column:
    """Whether equations are LaTeX and tables HTML, by which images a layout has."""
    formula = images | tables | ~equations
    table = images | (~tables & ~equations)
    return F.struct(formula.alias("formula"), table.alias("table"))
