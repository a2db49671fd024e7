"""Records cut into chapters by their layout documents.

Records are joined to the two layout files they name (whole files, read in parallel, each once); what
depends on order inside one document - refining and merging intervals - is a plain function over Arrow
batches. The record that is cut passes through as raw JSON, so that unknown fields survive.
"""

from __future__ import annotations

import json
import os
from bisect import bisect_left, bisect_right
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpool.functions import layout as L
from docpool.operators.intervals import LAST_LEVEL, ROOT, merge, refine, split, unions
from docpool.sources.config import SliceParams
from docpool.sources.jsonl import layout_path


class Rendered:
    """A layout's blocks as markdown, with running sums of what they hold."""

    def __init__(self, layout: dict, levels: dict[L.Position, int], policy: L.Policy):
        self.at: list[L.Position] = []
        self.texts: list[str] = []
        for page in L.pages(layout):
            for k, block in enumerate(page.get("para_blocks") or []):
                place = (page.get("page_idx", 0), k)
                text = L.markdown(block, policy, levels.get(place))
                if text:
                    self.at.append(place)
                    self.texts.append(text)
        sizes = [L.content_size(t) for t in self.texts]
        self.images = [0, *accumulate(s[0] for s in sizes)]
        self.letters = [0, *accumulate(s[1] for s in sizes)]

    def range(self, start: L.Position, end: L.Position) -> tuple[int, int]:
        a = bisect_right(self.at, start)
        return a, max(a, bisect_left(self.at, end))

    def size(self, start: L.Position, end: L.Position) -> tuple[int, int]:
        a, b = self.range(start, end)
        return self.images[b] - self.images[a], self.letters[b] - self.letters[a]


def slice_document(raw: dict, cleaned: dict, levels: dict[int, int], folder: str, params: SliceParams, first_level: int = 1, last_level: int | None = None, deepest: int = LAST_LEVEL) -> list[dict]:
    """Chapters (texts, images, counts, page_location) of one document; none if it isn't to be cut.

    raw: the layout whose title blocks the levels number; cleaned: the one that is rendered. first_level
    and last_level: where to look for the top titles, at most down to `deepest`, which intervals aren't split beyond.
    """
    n_pages = len(cleaned.get("pdf_info") or [])
    if not levels or n_pages <= params.min_page_num:
        return []
    there = [v for v in levels.values() if first_level <= v <= min(deepest, last_level or deepest)]
    if first_level > deepest:  # a deeper level serves only if it is the one asked for
        there = [v for v in levels.values() if v == first_level]
    if not there:
        return []
    places = L.titles(raw)
    kinds = L.image_paths(raw)
    policy = L.policy_of(*(bool(kinds[k]) for k in ("image", "table", "interline_equation")))
    rendered = Rendered(cleaned, {places[t]: levels.get(t, 0) for t in places}, policy)
    tops = split(ROOT, min(there), (0, -1), (n_pages, 0), places, levels)
    cut = merge(refine(tops, params.max_page_num, places, levels, deepest), rendered.size, params.min_imgs_count, params.min_texts_len, params.max_page_num)
    out = []
    for index, interval in enumerate(cut):
        a, b = rendered.range(interval.start, interval.end)
        texts, images = L.slots(rendered.texts[a:b])
        if not texts:
            continue
        for image in images:
            if image is not None:
                image["relative_img_path"] = f"{folder}/{os.path.basename(image['relative_img_path'])}"
        n = sum(i is not None for i in images)
        out.append({"index": index, "texts": texts, "images": images, "text_cnt": len(texts) - n, "img_cnt": n, "page_location": [list(interval.start), list(interval.end)]})
    return out


def splittable() -> Column:
    """Records that name both layouts and have slots and counts."""
    r = "rec.meta_info.address"
    named = (F.coalesce(F.col(f"{r}.s3_parse_address"), F.lit("")) != "") & (F.coalesce(F.col(f"{r}.s3_clean_address"), F.lit("")) != "")
    return named & F.expr("rec.texts is not null and rec.images is not null and rec.img_cnt is not null and rec.text_cnt is not null")


def first_and_last_level(wanted: int | None) -> tuple[Column, Column]:
    """Without a level asked for: from 1 on. With one: that one and deeper if the record has it, else
    only the next one."""
    if wanted is None:
        return F.lit(1), F.lit(None).cast("int")
    has = F.array_contains("levels", wanted)
    unknown = F.coalesce(F.size("levels"), F.lit(0)) == 0
    return F.when(unknown, 1).when(has, wanted).otherwise(wanted + 1), F.when(unknown | has, F.lit(None)).otherwise(wanted + 1).cast("int")


def named_files() -> tuple[Column, Column]:
    """The layout and the cleaned layout that a record names."""
    a = "rec.meta_info.address"
    return layout_path(F.col(f"{a}.s3_parse_address"), suffix=".json"), layout_path(F.col(f"{a}.s3_clean_address"), suffix=".json")


CHAPTERS = "array<struct<index: int, value: string>>"


def with_chapters(records: DataFrame, layouts: DataFrame, params: SliceParams, wanted: int | None = None) -> DataFrame:
    """records with `chapters`, the lines of their chapters (empty: not cut), and `error`.

    layouts: (path, content), paths as jsonl.normal_path has them. Layouts that are missing or
    broken leave a record uncut, as do titles that have a level but no place; the latter is an error.
    `layout_missing` says whether a file that the record names isn't among the layouts.
    """
    first, last = first_and_last_level(wanted)
    raw = layouts.select(F.col("path").alias("_raw_path"), F.col("content").alias("_raw"))
    clean = layouts.select(F.col("path").alias("_clean_path"), F.col("content").alias("_clean"))
    raw_path, clean_path = named_files()
    joined = (
        records.withColumns({"_raw_path": raw_path, "_clean_path": clean_path, "_first": first, "_last": last, "_levels": F.to_json("title_levels")})
        .join(raw, "_raw_path", "left")
        .join(clean, "_clean_path", "left")
    )

    @F.pandas_udf(f"chapters {CHAPTERS}, error string")
    def cut(value: pd.Series, raw: pd.Series, clean: pd.Series, path: pd.Series, levels: pd.Series, first: pd.Series, last: pd.Series) -> pd.DataFrame:
        rows = []
        for line, r, c, p, v, lo, hi in zip(value, raw, clean, path, levels, first, last):
            found, error = [], None
            try:
                if r is not None and c is not None and v is not None:
                    own = {int(k): x for k, x in json.loads(v).items()}
                    folder = os.path.basename(os.path.dirname(p))
                    source = json.loads(line)
                    for n, chapter in enumerate(slice_document(json.loads(r), json.loads(c), own, folder, params, int(lo), None if pd.isna(hi) else int(hi))):
                        index = chapter.pop("index")
                        new = {**source, **chapter, "id": f"{source.get('id', '')}_chapter_{index}"}
                        if source.get("pdf_md5"):
                            new["pdf_md5"] = f"{source['pdf_md5']}_chapter_{n}"
                        found.append({"index": n, "value": json.dumps(new, ensure_ascii=False)})
            except (KeyError, ValueError, TypeError, AttributeError) as e:
                found, error = [], f"{type(e).__name__}: {e}"
            rows.append({"chapters": found, "error": error})
        return pd.DataFrame(rows, columns=["chapters", "error"])

    result = cut("value", "_raw", "_clean", "_clean_path", "_levels", "_first", "_last")
    return joined.withColumn("_cut", result).select(*records.columns, F.col("_cut.chapters").alias("chapters"), F.col("_cut.error").alias("error"), (F.col("_raw").isNull() | F.col("_clean").isNull()).alias("layout_missing"))


CHECKS = ("images_same", "texts_same", "img_cnt_same", "text_cnt_same", "location_same")


def slice_archived(items: DataFrame, layouts: DataFrame, params: SliceParams, deepest: int = LAST_LEVEL) -> DataFrame:
    """items of jsonl.read_archived with `chapters`, their `status` and CHECKS.

    Titles are looked for from level 1 to `deepest`, which intervals aren't split beyond. Images are those of
    the item's own list where it has the path. status: cut, no_levels, short, no_titles (or nothing in the
    intervals), layout_missing, or the error. CHECKS say whether the chapters, one after another, have the texts,
    images, counts and place of the item; null if it isn't cut, and for the place if the item has none.
    """
    raw = layouts.select(F.col("path").alias("raw_path"), F.col("content").alias("_raw"))
    clean = layouts.select(F.col("path").alias("clean_path"), F.col("content").alias("_clean"))
    joined = items.join(raw, "raw_path", "left").join(clean, "clean_path", "left")

    def one(line: str, raw: str | None, clean: str | None, path: str, levels: str | None) -> dict:
        own = {int(k): v for k, v in json.loads(levels or "{}").items()}
        if not own:
            return {"status": "no_levels"}
        if raw is None or clean is None:
            return {"status": "layout_missing"}
        source, cleaned = json.loads(line), json.loads(clean)
        if len(cleaned.get("pdf_info") or []) <= params.min_page_num:
            return {"status": "short"}
        cut = slice_document(json.loads(raw), cleaned, own, os.path.basename(os.path.dirname(path)), params, 1, deepest, deepest)
        if not cut:
            return {"status": "no_titles"}
        known = {i["relative_img_path"]: i for i in source["images"] if isinstance(i, dict) and i.get("relative_img_path")}
        for chapter in cut:
            chapter["images"] = [i and known.get(i["relative_img_path"], i) for i in chapter["images"]]
        same = {f"{k}_same": [x for c in cut for x in c[k]] == source[k] for k in ("images", "texts")}
        same |= {f"{k}_same": sum(c[k] for c in cut) == source[k] for k in ("img_cnt", "text_cnt")}
        if source.get("page_location") is not None:
            same["location_same"] = unions([c["page_location"] for c in cut]) == source["page_location"]
        lines = []
        for n, chapter in enumerate(cut):
            index = chapter.pop("index")
            lines.append({"index": n, "value": json.dumps({**source, **chapter, "id": f"{source['id']}_chapter_{index}"}, ensure_ascii=False)})
        return {"status": "cut", "chapters": lines, **same}

    @F.pandas_udf(f"chapters {CHAPTERS}, status string, " + ", ".join(f"{c} boolean" for c in CHECKS))
    def cut(value: pd.Series, raw: pd.Series, clean: pd.Series, path: pd.Series, levels: pd.Series) -> pd.DataFrame:
        rows = []
        for row in zip(value, raw, clean, path, levels):
            try:
                found = one(*row)
            except (KeyError, ValueError, TypeError, AttributeError) as e:
                found = {"status": f"{type(e).__name__}: {e}"}
            rows.append([found.get("chapters", []), found["status"], *(found.get(c) for c in CHECKS)])
        return pd.DataFrame(rows, columns=["chapters", "status", *CHECKS], dtype=object)

    result = cut("value", "_raw", "_clean", "clean_path", F.to_json("title_levels"))
    return joined.withColumn("_cut", result).select(*items.columns, "_cut.*")


def records_of_intervals(layout: dict, intervals: list[tuple[L.Position, L.Position]], folder: str, roots: tuple[str, str, str] | None = None, extra: dict | None = None) -> tuple[list[dict], list[tuple]]:
    """A record for each interval of a layout, and the intervals without content.

    folder: of the layout. roots: folders of originals, layouts and cleaned layouts, to say the record's
    addresses by; the folder's place below the second is the same below the others.
    """
    kinds = L.image_paths(layout)
    rendered = Rendered(layout, {}, L.policy_of(*(bool(kinds[k]) for k in ("image", "table", "interline_equation"))))
    found, empty = [], []
    for start, end in intervals:
        a, b = rendered.range(start, end)
        texts, images = L.slots(rendered.texts[a:b])
        if not texts:
            empty.append((start, end))
            continue
        n = sum(i is not None for i in images)
        record = {"texts": texts, "images": images, "text_cnt": len(texts) - n, "img_cnt": n, "md_dir": folder, "page_location": [list(start), list(end)], **(extra or {})}
        if roots:
            below = folder.removeprefix(roots[1])
            name = os.path.basename(below)
            # an original without a name is its folder's
            original = f"{roots[0]}{below}" if name.lower() == ".pdf" else f"{roots[0]}{below}.pdf"
            record["meta_info"] = {"address": {"s3_origin_address": original, "s3_parse_address": f"{folder}/{name}_middle.json", "s3_clean_address": f"{roots[2]}{below}/{name}_cleaned_middle.json"}}
        found.append(record)
    return found, empty
