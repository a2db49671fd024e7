"""Profiles of pools: counts for each dimension, ranges, shares, histograms, threshold sweeps."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpool.operators.gates import parsed_with_images, passes
from docpool.sources.config import GatesConfig

DIMENSIONS = {"layout_decisions_count": "layout_decision", "nsfw_decisions_count": "nsfw_decision", "language_count": "language", "category_code_count": "category_code", "category_name_count": "category_name"}
RANGES = {"token_total": "token_total", "clean_image_num": "image_num"}
SHARE = "img_nonzero_and_lang_zh_en_and_layout_parse"
#: In these an empty string is no value.
_NOT_EMPTY = ("category_code", "category_name")


def dimension_counts(records: DataFrame, by: list[str] | None = None, dimensions: dict[str, str] = DIMENSIONS) -> DataFrame:
    """(*by, metric, key, n): all dimensions in one pass; counts are combined before the shuffle."""
    pairs = [F.struct(F.lit(m).alias("metric"), (F.nullif(F.col(c), F.lit("")) if c in _NOT_EMPTY else F.col(c)).alias("key")) for m, c in dimensions.items()]
    by = by or []
    long = records.select(*by, F.explode(F.array(*pairs)).alias("p")).where("p.key is not null")
    return long.groupBy(*by, F.col("p.metric").alias("metric"), F.col("p.key").alias("key")).agg(F.count("*").alias("n"))


def share_columns() -> list[Column]:
    """Rows that meet the condition, their share, and all rows."""
    n = F.count_if(parsed_with_images())
    return [n.alias("count"), F.coalesce(F.try_divide(n, F.count("*")), F.lit(0.0)).alias("ratio"), F.count("*").alias("denominator")]


def summary(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Ranges and the share, a row for each group."""
    ranges = [f(c).alias(f"{m}_{f.__name__}") for m, c in RANGES.items() for f in (F.min, F.max)]
    return records.groupBy(*(by or [])).agg(*ranges, *share_columns())


def rollup(records: DataFrame, by: str = "dataset") -> DataFrame:
    """The summary of each group and, with a null group, of all."""
    ranges = [f(c).alias(f"{m}_{f.__name__}") for m, c in RANGES.items() for f in (F.min, F.max)]
    return records.rollup(by).agg(*ranges, *share_columns())


def sweep(records: DataFrame, cfg: GatesConfig, thresholds: list[int]) -> DataFrame:
    """(token_total_min, pass_cnt, size): records that pass under each lower bound, in one pass."""
    rest = passes(replace(cfg, token_total_min=-(10**18)))
    counts = [F.struct(F.lit(t).cast("long").alias("token_total_min"), F.count_if(rest & F.coalesce(F.col("token_total") >= t, F.lit(False))).alias("pass_cnt"), F.count("*").alias("size")) for t in thresholds]
    return records.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))


def histogram(records: DataFrame, column: str, bins: int = 60) -> DataFrame:
    """(bin, lower, n) of equal bins from minimum to maximum, the last one closed; empty bins too."""
    values = records.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    bounds = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo is not null")
    # one value alone: bins around it
    wide = bounds.select(F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"), F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    place = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    counted = values.join(F.broadcast(wide)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
    every = wide.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    return every.join(counted, "bin", "left").select("bin", (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins).alias("lower"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def top(counts: DataFrame, k: int = 30, key: str = "key") -> DataFrame:
    """The k largest counts; ties by key."""
    return counts.orderBy(F.desc("n"), key).limit(k)


def named_categories(counts: DataFrame, names: DataFrame) -> DataFrame:
    """Counts by category code with a label: name(code), or the code where there is no name."""
    label = F.coalesce(F.concat("category_name", F.lit("("), "key", F.lit(")")), F.col("key"))
    return counts.join(names.withColumnRenamed("category_code", "key"), "key", "left").select("key", label.alias("label"), "n")


# --- documents of counts -----------------------------------------------------------------------


def stats_document(records: DataFrame, dataset: str, sample: DataFrame | None = None) -> dict:
    """The profile of a dataset, as written for each dataset. Only counts reach the driver."""

    def block(rows: DataFrame) -> tuple[dict, dict]:
        counts: dict = {m: {} for m in DIMENSIONS}
        for r in dimension_counts(rows).toLocalIterator():
            counts[r["metric"]][r["key"]] = r["n"]
        s = summary(rows).first().asDict()
        return counts | {m: {"min": s[f"{m}_min"], "max": s[f"{m}_max"]} for m in RANGES}, s

    full, s = block(records)
    share = {SHARE: {k: s[k] for k in ("count", "ratio", "denominator")}}
    out = {"dataset_name": dataset, "records_seen": s["denominator"], "total_seen": s["denominator"], "overall_stats": {"records_seen": s["denominator"], "extra_stats": share}, "extra_stats": share, "full_stats": full}
    # older readers look for these at the top
    out |= {m: full[m] for m in DIMENSIONS} | {"token_total": full["token_total"], "image_num": full["clean_image_num"]}
    if sample is not None:
        drawn, d = block(sample)
        out |= {"reservoir_size": d["denominator"], "reservoir_sample": {"size": d["denominator"]} | drawn}
    return out


def merge_documents(documents: list[dict]) -> dict:
    """One profile from those of datasets, in either of the shapes that were written.

    What is no integer is left out of sums and ranges.
    """

    def whole(v: object) -> int | None:
        try:
            return int(v)  # type: ignore[call-overload]
        except (TypeError, ValueError):
            return None

    def seen(d: dict) -> int:
        places = (d.get("records_seen"), d.get("total_seen"), (d.get("overall_stats") or {}).get("records_seen"))
        return next((n for n in map(whole, places) if n is not None), 0)

    def full(d: dict) -> dict:
        if isinstance(d.get("full_stats"), dict):
            return d["full_stats"]
        return {m: d.get(m) or {} for m in DIMENSIONS} | {"token_total": d.get("token_total") or {}, "clean_image_num": d.get("clean_image_num") or d.get("image_num") or {}}

    total = sum(map(seen, documents))
    out: dict = {}
    for metric in DIMENSIONS:
        sums: dict[str, int] = {}
        for d in documents:
            for k, v in (full(d).get(metric) or {}).items():
                if (n := whole(v)) is not None:
                    sums[k] = sums.get(k, 0) + n
        out[metric] = sums
    for metric in RANGES:
        found: dict[str, list[int]] = {"min": [], "max": []}
        for d in documents:
            given = full(d).get(metric)
            given = given if isinstance(given, dict) else {}
            values = {side: given.get(side) for side in found}
            if any(v is not None and whole(v) is None for v in values.values()):
                continue  # a range of which one side can't be read counts for nothing
            for side, v in values.items():
                if v is not None:
                    found[side].append(whole(v))
        out[metric] = {"min": min(found["min"], default=None), "max": max(found["max"], default=None)}
    extras = [(d.get("overall_stats") or {}).get("extra_stats") or d.get("extra_stats") or {} for d in documents]
    hits = sum(whole((e.get(SHARE) or {}).get("count")) or 0 for e in extras if isinstance(e, dict) and isinstance(e.get(SHARE) or {}, dict))
    share = {SHARE: {"count": hits, "ratio": hits / total if total else 0.0, "denominator": total}}
    return {"records_seen": total, "extra_stats": share, "full_stats": out}
