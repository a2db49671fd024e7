"""The six commands: analyze, aggregate-stats, make-data, select, emit, chunk."""

from __future__ import annotations

import json
from multiprocessing.pool import ThreadPool

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpool.operators import chapters, dedupe, gates, sampling, slots, stats
from docpool.operators.adapters import Adapter, search_titles, title_of_slot
from docpool.sources import jsonl, sinks
from docpool.sources.config import GatesConfig, MakeDataConfig


def _json_files(spark: SparkSession, paths: list[str]) -> list[dict]:
    return [json.loads(r["value"]) for r in spark.read.text(paths, wholetext=True).orderBy("_metadata.file_path").collect()] if paths else []


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def analyze(spark: SparkSession, dataset_dir: str, dataset: str, out: str, *, sample_size: int = 200_000, seed: int = 1337, max_records: int | None = None, cfg: GatesConfig = GatesConfig(), thresholds: list[int] | None = None, shards: str = jsonl.SHARDS) -> dict:
    """Profiles a dataset: <out>/<dataset>/analysis/reservoir_stats.json, and the sweep beside it."""
    records = jsonl.read_records(spark, dataset_dir, shards)
    if max_records is not None:
        records = records.orderBy("place").limit(max_records)
    # a fingerprint of the line stands for it: what is kept between the passes is small
    line = F.md5(F.col("value").cast("binary")).alias("line_key")
    flat = records.select(line, "image_num", "token_total", *stats.DIMENSIONS.values(), "layout_score", "nsfw_score", "levels").persist()
    try:
        drawn = sampling.sample(flat, sample_size, seed, "line_key").persist()
        document = stats.stats_document(flat, dataset, drawn)
        folder = f"{out.rstrip('/')}/{dataset}/analysis"
        plots = {f"hist_{c}": [list(r) for r in stats.histogram(drawn, c).orderBy("bin").collect()] for c in ("token_total", "image_num")}
        plots |= {f"top_{m}": [list(r) for r in stats.top(stats.dimension_counts(drawn, dimensions={m: c}).select("key", "n")).collect()] for m, c in stats.DIMENSIONS.items()}
        sinks.write_json(spark, f"{folder}/reservoir_stats.json", document)
        sinks.write_json(spark, f"{folder}/plot_data.json", plots)
        if thresholds:
            rows = stats.sweep(drawn, cfg, thresholds).collect()
            sinks.write_json(spark, f"{folder}/sweep_token_total_min.json", [{"token_total_min": r[0], "pass_cnt": r[1], "reservoir_size": r[2]} for r in rows])
        drawn.unpersist()
    finally:
        flat.unpersist()
    return document


def analyze_all(spark: SparkSession, pool: str, out: str, *, redo: bool = False, retries: int = 1, folder: str = jsonl.FOLDER, parallel: int = 4, only: list[str] | None = None, lists: bool = False, **options) -> dict[str, str]:
    """Profiles every dataset of a pool, or those in `only`, that has none yet: dataset to ok, skipped or the error.

    `parallel` datasets are profiled at a time, as jobs of one session. lists: their names are written to
    <out>/started.list, ok.list and failed.list; the last is what a later run takes as `only`.
    """
    top = out.rstrip("/")

    def profile(name: str) -> str:
        if not redo and _exists(spark, f"{top}/{name}/analysis/reservoir_stats.json"):
            return "skipped"
        for attempt in range(retries + 1):
            try:
                analyze(spark, f"{pool.rstrip('/')}/{name}/{folder}", name, out, **options)
                return "ok"
            except Exception as e:  # noqa: BLE001  one dataset's failure is not another's
                if attempt == retries:
                    return f"failed: {e}"[:500]
        return "failed"

    there = set(jsonl.list_datasets(spark, pool, folder))
    names = sorted(there) if only is None else list(dict.fromkeys(only))
    with ThreadPool(max(1, parallel)) as workers:
        result = dict(zip(names, workers.map(lambda n: profile(n) if n in there else "failed: no such dataset", names)))
    if lists:
        of = {"started": [n for n, r in result.items() if r != "skipped"], "ok": [n for n, r in result.items() if r == "ok"], "failed": [n for n, r in result.items() if r.startswith("failed")]}
        for kind, found in of.items():
            sinks.write_text_file(spark, f"{top}/{kind}.list", "".join(f"{n}\n" for n in found))
    return result


def aggregate_stats(spark: SparkSession, out: str, output_json: str | None = None, datasets: list[str] | None = None) -> dict:
    """One profile of all datasets below `out`, or of those listed that have one."""
    root = out.rstrip("/")
    names = datasets
    if names is None:
        jvm = spark.sparkContext._jvm
        top = jvm.org.apache.hadoop.fs.Path(root)
        fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = sorted(s.getPath().getName() for s in fs.listStatus(top) if s.isDirectory())
    paths = [p for n in names if _exists(spark, p := f"{root}/{n}/analysis/reservoir_stats.json")]
    merged = stats.merge_documents(_json_files(spark, paths))
    merged["datasets"] = [p.split("/")[-3] for p in paths]
    sinks.write_json(spark, output_json or f"{root}/pooled_analysis_stats.json", merged)
    return merged


def read_name_list(text: str) -> list[str]:
    """Names, one a line; blank lines and those that begin with # are none."""
    return [x for line in text.splitlines() if (x := line.strip()) and not x.startswith("#")]


def select(spark: SparkSession, dataset_dir: str, quotas: dict[str, int], cfg: GatesConfig, seed: int, manifest: str | None = None) -> DataFrame:
    """(category_code, pdf_md5) of a quota sample of what passes the gates; written as a manifest."""
    records = jsonl.read_records(spark, dataset_dir)
    chosen = sampling.quota_sample(gates.eligible(records, cfg), quotas, seed)
    if manifest:
        rows = chosen.orderBy("category_code", "pdf_md5").collect()  # as many as the sample asked for
        counts = {c: sum(r[0] == c for r in rows) for c in quotas}
        described = {k: sorted(v) if isinstance(v, frozenset) else v for k, v in vars(cfg).items()}
        sinks.write_json(spark, manifest, {"seed": seed, "quotas": quotas, "selected_count_by_category": counts, "gates": described, "selected_pdf_md5": [r[1] for r in rows]})
    return chosen


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True).select(F.explode("selected_pdf_md5").alias("pdf_md5"))


def emit(spark: SparkSession, dataset_dir: str, selected: DataFrame, out: str, folder: str = "jsonl_res_sample") -> None:
    """The selected records, the first of each fingerprint, in shards of the input's names."""
    records = jsonl.read_records(spark, dataset_dir)
    sinks.write_shards(sampling.emit(records, selected), out, folder, empty=records.select("dataset", "shard"))


def chunk_files(records: DataFrame) -> DataFrame:
    """path of the layouts that records name."""
    return records.select(jsonl.layout_path(F.col("rec.meta_info.address.s3_parse_address")).alias("path"))


def chunk(records: DataFrame, layouts: DataFrame, level: int, *, image_tokens: int = 0, drop_empty: bool = True, adapter: Adapter = search_titles) -> tuple[DataFrame, DataFrame]:
    """Chunks of records at titles of a level, and the records that can't be cut.

    layouts: (path, content) of the files that records name. Records without a title of the level need
    no layout: only the others are joined.
    """
    titled = records.where(F.size(F.map_filter("title_levels", lambda _, v: v == level)) > 0)
    wanted = titled.withColumn("path", jsonl.layout_path(F.col("rec.meta_info.address.s3_parse_address")))
    joined = wanted.join(layouts, "path", "left").withColumns({"texts": F.col("rec.texts"), "images": F.col("rec.images")})
    mapped = joined.withColumn("title_of_slot", title_of_slot(F.col("content"), F.size("texts"), adapter)).drop("content", "path")
    return slots.split_by_title(mapped, level, image_tokens, drop_empty)


def chunk_lines(chunks: DataFrame) -> DataFrame:
    """Chunks as lines: the record's own fields, with those of the chunk over them.

    Fields that the schema knows are written from it; unknown ones are taken over from the raw line.
    """
    given = F.to_json(F.struct("texts", "images", "orig_id", "chunk_idx", "chunk_chapter_level", "chunk_title_idx", F.col("record_id").alias("id")), {"ignoreNullFields": "false"})

    @F.pandas_udf("string")
    def over(value: pd.Series, new: pd.Series, numbers: pd.Series) -> pd.Series:
        def one(v: str, n: str, s: str) -> str:
            record, fields = json.loads(v), json.loads(n)
            record |= fields | {"images": [None if i is None else {k: x for k, x in i.items() if x is not None} for i in fields["images"]]}
            if isinstance(record.get("meta_info"), dict):
                old = record["meta_info"].get("statistics_info")
                record["meta_info"]["statistics_info"] = (old if isinstance(old, dict) else {}) | json.loads(s)
            return json.dumps(record, ensure_ascii=False)

        return pd.Series([one(*x) for x in zip(value, new, numbers)])

    lines = over("value", given, F.to_json("statistics_info"))
    return chunks.select("dataset", "shard", F.struct("place", "chunk_idx").alias("place"), lines.alias("value"))


def make_data(records: DataFrame, layouts: DataFrame | None, cfg: MakeDataConfig) -> tuple[DataFrame, DataFrame]:
    """Output lines (dataset, shard, place, value) and the counters of each dataset.

    Gates, then first-seen over the whole pool, then chapters. Only records that can be cut are joined
    to layouts. A record that isn't cut is put out whole, or not, as the configuration says.
    """
    passes, splits = gates.passes(cfg.gates, cfg.split_enabled), cfg.split_enabled and cfg.split_records and layouts is not None
    marked = records.withColumn("_pass", passes)
    keep = F.col("_pass")
    if cfg.dedupe:
        # rows without a fingerprint meet no first place and stay
        marked = marked.join(dedupe.first_places(records.where(passes)), "pdf_md5", "left")
        keep = keep & F.coalesce(F.col("place") == F.col("first_place"), F.lit(True))
    marked = marked.withColumn("_keep", keep).withColumn("_cut", (chapters.splittable() if splits else F.lit(False)) & F.col("_keep"))
    out = marked.where("_keep and not _cut").select("dataset", "shard", F.struct("place", F.lit(0).alias("index")).alias("place"), "value")
    counts = marked.groupBy("dataset").agg(F.count("*").alias("lines_in"), F.count_if("_pass").alias("lines_pass_gate"), F.count_if(~F.col("_pass")).alias("skipped_gate"), F.count_if("_keep").alias("kept"), F.count_if(F.col("_keep") & ~F.col("_cut")).alias("whole"))
    if splits:
        cut = chapters.with_chapters(marked.where("_cut").select(records.columns), layouts, cfg.slices, cfg.gates.chapter_level)
        original = F.when(F.lit(cfg.emit_original_when_split_empty), F.array(F.struct(F.lit(0).alias("index"), F.col("value").alias("value")))).otherwise(F.array().cast(chapters.CHAPTERS))
        cut = cut.withColumn("lines", F.when(F.size("chapters") > 0, F.col("chapters")).otherwise(original))
        lines = cut.select("dataset", "shard", "place", F.explode("lines").alias("c"))
        out = out.union(lines.select("dataset", "shard", F.struct("place", F.col("c.index").alias("index")).alias("place"), F.col("c.value").alias("value")))
        counts = counts.join(cut.groupBy("dataset").agg(F.count("error").alias("errors"), F.count_if(F.size("chapters") > 0).alias("split_batches"), F.sum(F.size("lines")).alias("parts"), F.count_if("layout_missing").alias("layouts_missing")), "dataset", "left")
    else:
        counts = counts.withColumns({"errors": F.lit(0), "split_batches": F.lit(0), "parts": F.lit(0), "layouts_missing": F.lit(0)})
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    numbers = {n: zero(n) for n in ("lines_in", "lines_pass_gate", "skipped_gate", "errors", "split_batches", "layouts_missing")} | {"lines_out": F.col("whole") + zero("parts"), "dedupe_skipped": F.col("lines_pass_gate") - F.col("kept")}
    return out, counts.select("dataset", *[c.alias(n) for n, c in numbers.items()])


def make_data_pool(spark: SparkSession, pool: str, out: str, version: str, cfg: MakeDataConfig, layouts: DataFrame | None = None, dataset: str = "", folder: str = jsonl.FOLDER, shards: str = jsonl.SHARDS) -> dict:
    """make_data over a pool, or one dataset, to <out>/<version>/<dataset>/<folder>/<shard>.

    Shards without a line are not written. Without layouts given, the files that records name are read
    (jsonl.named_layouts): pass a DataFrame of (path, content) where they are many.
    """
    records = jsonl.read_records(spark, f"{pool.rstrip('/')}/{dataset}/{folder}", shards, strict=False) if dataset else jsonl.read_pool(spark, pool, folder, shards)
    if layouts is None and cfg.split_enabled and cfg.split_records:
        named = records.where(gates.passes(cfg.gates, True) & chapters.splittable())
        raw, clean = chapters.named_files()
        layouts = jsonl.named_layouts(spark, named.select(F.explode(F.array(raw, clean)).alias("path")))
    lines, counters = make_data(records, layouts, cfg)
    sinks.write_shards(lines, out, folder, version)
    rows = [r.asDict() for r in counters.orderBy("dataset").collect()]
    unique = records.where(gates.passes(cfg.gates, cfg.split_enabled) & (F.col("pdf_md5") != "")).agg(F.count_distinct("pdf_md5")).first()[0] if cfg.dedupe else 0
    summary = {"datasets": rows, "unique_pdf_md5": unique, "lines_out": sum(r["lines_out"] for r in rows), "dedupe_skipped": sum(r["dedupe_skipped"] for r in rows)}
    sinks.write_json(spark, f"{out.rstrip('/')}/{version}/make_data_summary.json", summary)
    return summary


