"""From a parsed record (struct column) to the flat columns that the operators take.

Typed parsing does the type tests: a float, a string or a boolean where an integer belongs reads as
null, and the next place is looked at. A path through null or through something that is no object is
null. A string field that holds a number or an object reads as its JSON text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpool.functions.schema import CATEGORY

CATEGORY_FIELD = "`category_cls_v1.3`"


def _field(r: str, path: str) -> Column:
    return F.col(f"{r}.{path}")


def image_num(r: str = "rec") -> Column:
    """From the statistics, else img_cnt, else the images that are not null."""
    images = _field(r, "images")
    counted = F.when(images.isNotNull(), F.size(F.filter(images, lambda x: x.isNotNull())).cast("long"))
    return F.coalesce(_field(r, "meta_info.statistics_info.clean_image_num"), _field(r, "statistics_info.clean_image_num"), _field(r, "img_cnt"), counted)


def token_total(r: str = "rec") -> Column:
    return F.coalesce(_field(r, "meta_info.statistics_info.clean_total_token"), _field(r, "statistics_info.clean_total_token"))


def verdict(r: str, name: str) -> tuple[Column, Column]:
    """Decision and score; a decision alone has score 0, a missing score and decision are both null."""
    decision, score = _field(r, f"meta_info.{name}.decision"), _field(r, f"meta_info.{name}.score")
    return decision, F.coalesce(score, F.when(decision.isNotNull(), F.lit(0.0)))


def language(r: str = "rec") -> Column:
    return F.coalesce(_field(r, "meta_info.language_fasttext.language"), _field(r, "language_fasttext.language"))


def best_category(items: Column) -> Column:
    """The entry of the highest score, the first of equals; entries without a score never win."""
    usable = lambda x: x["score"].isNotNull() & ~F.isnan(x["score"])
    better = lambda a, x: usable(x) & (a.isNull() | (x["score"] > a["score"]))
    return F.aggregate(items, F.lit(None).cast(CATEGORY), lambda a, x: F.when(better(a, x), x).otherwise(a))


def category(r: str = "rec") -> Column:
    """Struct of code, name and score: an object as it is, of a list the best entry."""
    raw = F.coalesce(_field(r, f"meta_info.{CATEGORY_FIELD}"), _field(r, CATEGORY_FIELD))
    kind = F.substring(F.ltrim(raw), 1, 1)
    best = best_category(F.filter(F.from_json(raw, f"ARRAY<{CATEGORY}>"), lambda x: x.isNotNull()))
    return F.when(kind == "{", F.from_json(raw, CATEGORY)).when(kind == "[", best)


def _object(c: Column) -> Column:
    return F.when(F.substring(F.ltrim(c), 1, 1) == "{", c)


def chapter_levels(r: str = "rec") -> Column:
    """The different levels of the chapter map; null without a map."""
    raw = F.coalesce(_object(_field(r, "meta_info.chapter_info")), _object(_field(r, "chapter_info")))
    values = F.map_values(F.from_json(raw, "MAP<STRING, STRING>"))
    return F.array_distinct(F.filter(F.transform(values, lambda v: F.trim(v).try_cast("int")), lambda v: v.isNotNull()))


def title_levels(r: str = "rec") -> Column:
    """Title number to level, of the entries where both are integers; only from meta_info."""
    entries = F.map_entries(F.from_json(_object(_field(r, "meta_info.chapter_info")), "MAP<STRING, STRING>"))
    pairs = F.transform(entries, lambda e: F.struct(F.trim(e["key"]).try_cast("int").alias("key"), F.trim(e["value"]).try_cast("int").alias("value")))
    return F.map_from_entries(F.filter(pairs, lambda e: e["key"].isNotNull() & e["value"].isNotNull()))


def canonical(parsed: DataFrame, r: str = "rec") -> DataFrame:
    """The parsed records with the flat columns beside them."""
    layout, nsfw = verdict(r, "origin_pdf_layout_score"), verdict(r, "origin_pdf_nsfw_score")
    best = category(r)
    flat = {
        "pdf_md5": _field(r, "pdf_md5"),
        "record_id": _field(r, "id"),
        "image_num": image_num(r),
        "token_total": token_total(r),
        "layout_decision": layout[0],
        "layout_score": layout[1],
        "nsfw_decision": nsfw[0],
        "nsfw_score": nsfw[1],
        "language": language(r),
        "category_code": best["category_code"],
        "category_name": best["category_name"],
        "levels": chapter_levels(r),
        "title_levels": title_levels(r),
    }
    return parsed.withColumns(flat)


def renamed_images(images: Column, folder: Column) -> Column:
    """Image paths as <folder>/<file name>; null slots stay null."""
    name = lambda x: F.element_at(F.split(x["relative_img_path"], "/"), -1)
    return F.transform(images, lambda x: F.when(x.isNotNull(), x.withField("relative_img_path", F.concat_ws("/", folder, name(x)))))


def backfilled_images(images: Column, known: Column) -> Column:
    """Image objects replaced by those of the same path in a map, where it has one."""
    return F.transform(images, lambda x: F.when(x.isNotNull(), F.coalesce(F.try_element_at(known, x["relative_img_path"]), x)))
