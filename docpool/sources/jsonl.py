"""Pools of sharded JSON lines: <pool>/<dataset>/<folder>/data_XXXX.jsonl.

Order is observable (the first of equal records stays): datasets and shards by name, lines as they
stand. `place` holds it: a struct that compares in this order. Nothing here lists files on the
driver except dataset folders of a pool.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from docpool.functions.accessors import canonical, title_levels
from docpool.functions.schema import RECORD

#: Layout files read by the addresses in records.
MOST_NAMED = 100_000
SHARDS = "data_*.jsonl"
FOLDER = "jsonl_res"


def read_lines(spark: SparkSession, paths: str | list[str], shards: str = SHARDS, folder_depth: int = 2) -> DataFrame:
    """value, dataset, shard, shard_idx (-1 where the name has none) and place of every line.

    folder_depth: how many folders above a shard its dataset's folder is. Raises FileNotFoundError
    where a path doesn't exist.
    """
    try:
        lines = spark.read.option("pathGlobFilter", shards).text(paths)
    except AnalysisException as e:
        raise FileNotFoundError(str(paths)) from e
    file = F.col("_metadata.file_path")
    named = lines.select(
        "value",
        F.element_at(F.split(file, "/"), -1 - folder_depth).alias("dataset"),
        F.col("_metadata.file_name").alias("shard"),
        F.coalesce(F.regexp_extract(F.col("_metadata.file_name"), r"^data_([0-9]+)\.", 1).try_cast("int"), F.lit(-1)).alias("shard_idx"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("mid"),
    )
    return named.withColumn("place", F.struct("dataset", "shard", "block", "mid")).drop("block", "mid")


def _is_object(c: Column) -> Column:
    return c.rlike(r"^\s*\{")


def _not_blank(c: Column) -> Column:
    return ~c.rlike(r"(?U)\A[\s\x1c-\x1f]*\z")


def parse_strict(lines: DataFrame) -> DataFrame:
    """Records as `rec`; blank lines and what is no object are skipped, broken JSON raises."""
    return lines.where(_not_blank(F.col("value")) & ~F.col("value").rlike(r'^\s*[\["0-9tfn-]')).withColumn("rec", F.from_json("value", RECORD, {"mode": "FAILFAST"}))


def parse_loose(lines: DataFrame) -> DataFrame:
    """Records as `rec`; broken lines are skipped too.

    Whether a line is broken is asked of a parse without fields: a field of another type breaks none.
    """
    broken = F.from_json("value", "`_none` STRING, `_broken` STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})["_broken"]
    return lines.where(_is_object(F.col("value")) & broken.isNull()).withColumn("rec", F.from_json("value", RECORD))


def read_records(spark: SparkSession, paths: str | list[str], shards: str = SHARDS, strict: bool = True, folder_depth: int = 2) -> DataFrame:
    """Lines, records and the flat columns that the operators take."""
    lines = read_lines(spark, paths, shards, folder_depth)
    return canonical(parse_strict(lines) if strict else parse_loose(lines))


def list_datasets(spark: SparkSession, pool: str, folder: str = FOLDER) -> list[str]:
    """Datasets of a pool, by name: folders that hold `folder` and don't begin with a dot."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(pool)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(root) if s.isDirectory()]
    return sorted(p.getName() for p in found if not p.getName().startswith(".") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, folder)))


def read_pool(spark: SparkSession, pool: str, folder: str = FOLDER, shards: str = SHARDS, strict: bool = False) -> DataFrame:
    """All datasets of a pool that have the folder, in one scan."""
    names = list_datasets(spark, pool, folder)
    if not names:
        raise FileNotFoundError(f"no dataset with {folder} in {pool}")
    return read_records(spark, [f"{pool.rstrip('/')}/{n}/{folder}" for n in names], shards, strict)


def normal_path(path: Column) -> Column:
    """A path as layouts and addresses are compared by: without file:, with single slashes, relative ones below the driver's folder."""
    here = F.when(path.startswith("./"), F.concat(F.lit(os.getcwd() + "/"), path)).otherwise(path)
    local = F.regexp_replace(F.regexp_replace(here, r"^file:/*", "/"), r"^s3[an]://", "s3://")
    return F.regexp_replace(F.regexp_replace(local, r"(?<!:)(?<!:/)/(\./)+", "/"), r"(?<![:/])/{2,}|^/{2,}", "/")


def read_layouts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, as normal_path has it, and content of whole layout files."""
    # file_path is a URI: a plus sign there is one, not a space
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return spark.read.text(paths, wholetext=True).select(normal_path(decoded).alias("path"), F.col("value").alias("content"))


def layout_path(address: Column, name: str = "middle.json", suffix: str | None = None) -> Column:
    """The file of an address, normalised: itself if it ends in `suffix` (the name), else the file in that folder; null for other schemes."""
    known = address.rlike(r"^(/|\./|s3[an]?://|obs://|file:|hdfs:|viewfs:)")
    file = F.when(address.endswith(suffix or name), address).otherwise(F.concat(F.regexp_replace(address, "/+$", ""), F.lit("/" + name)))
    return normal_path(F.when(known & (address != ""), file))


def named_layouts(spark: SparkSession, files: DataFrame) -> DataFrame:
    """path and content of the files (path) that records name and that are there.

    The names pass through the driver, MOST_NAMED at the most: beyond, ValueError says to give patterns of
    layout files, which Spark lists itself.
    """
    names = [r["path"] for r in files.where("path is not null").distinct().limit(MOST_NAMED + 1).collect()]
    if len(names) > MOST_NAMED:
        raise ValueError(f"records name more than {MOST_NAMED} layout files: give the files as patterns")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = []
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(name)
        if path.getFileSystem(conf).exists(path):
            there.append(re.sub(r"([\[\]{}*?\\])", r"\\\1", name))  # characters of patterns stand for themselves
    return read_layouts(spark, there) if there else spark.createDataFrame([], "path string, content string")


def read_archived(spark: SparkSession, paths: str | list[str], shards: str = SHARDS) -> tuple[DataFrame, DataFrame]:
    """Archived records as items, and the lines (value, place) that are none; blank lines are neither.

    An item has value, place, id, title_levels, raw_path and clean_path (its layouts), texts, images, img_cnt,
    text_cnt, page_location (as JSON, null without) and images_by_path: the last image of each path. A line is
    no item if it is broken or lacks, or has null for, an address, the id, texts, images or a count.
    """
    lines = read_lines(spark, paths, shards).where(_not_blank(F.col("value")))
    broken = F.from_json("value", "`_none` STRING, `_broken` STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})["_broken"]
    parsed = lines.withColumn("rec", F.when(_is_object(F.col("value")) & broken.isNull(), F.from_json("value", RECORD)))
    address = "rec.meta_info.address"
    needed = [f"{address}.s3_parse_address", f"{address}.s3_clean_address", *(f"rec.{n}" for n in ("id", "texts", "images", "img_cnt", "text_cnt"))]
    whole = F.lit(True)
    for name in needed:
        whole &= F.col(name).isNotNull()
    named = F.reverse(F.filter("rec.images", lambda x: x["relative_img_path"] != ""))
    paths_of = F.transform(named, lambda x: x["relative_img_path"])
    keys = F.array_distinct(paths_of)
    known = F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(named, F.array_position(paths_of, k).cast("int"))))
    items = parsed.where(whole).select(
        "value",
        "place",
        "rec.id",
        title_levels().alias("title_levels"),
        layout_path(F.col(needed[0]), suffix=".json").alias("raw_path"),
        layout_path(F.col(needed[1]), suffix=".json").alias("clean_path"),
        *(f"rec.{n}" for n in ("texts", "images", "img_cnt", "text_cnt")),
        F.get_json_object("value", "$.page_location").alias("page_location"),
        known.alias("images_by_path"),
    )
    return items, parsed.where(~whole).select("value", "place")


def category_names(spark: SparkSession, path: str) -> DataFrame:
    """code and name: the first two words of lines whose first is two to four digits; the last one counts.

    Lines may end in a carriage return alone. The file is a small dictionary, read as a whole.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("at", "line"))
    words = lines.select("at", F.split(F.trim(F.regexp_replace("line", r"(?U)\s+", " ")), " ").alias("w")).where((F.size("w") >= 2) & F.col("w")[0].rlike(r"^[0-9]{2,4}$"))
    return words.groupBy(F.col("w")[0].alias("category_code")).agg(F.max_by(F.col("w")[1], "at").alias("category_name"))


def read_model_levels(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Title levels that a model gave: (pdf_name, title_levels), and the lines that can't be read.

    A line holds turns; the assistant's must have one content, a map of title number to level, as JSON
    or with bare keys or single quotes. Levels outside 1 to 4 are left out.
    """
    turn = "STRUCT<pdf_name: STRING, data: ARRAY<STRUCT<role: STRING, content: ARRAY<STRUCT<text: STRUCT<string: STRING>>>>>>"
    lines = spark.read.text(paths).where(_not_blank(F.col("value"))).withColumn("r", F.from_json("value", turn))
    answer = F.try_element_at(F.filter("r.data", lambda t: t["role"] == "assistant"), F.lit(1))
    lenient = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}
    # numbers as keys are no field names, even unquoted ones
    quoted = F.regexp_replace(answer["content"][0]["text"]["string"], r"([{,]\s*)(\d+)(\s*:)", '$1"$2"$3')
    entries = F.map_entries(F.when(F.size(answer["content"]) == 1, F.from_json(quoted, "MAP<STRING, STRING>", lenient)))
    pairs = F.transform(entries, lambda e: F.struct(e["key"].try_cast("int").alias("key"), e["value"].try_cast("int").alias("value")))
    levels = F.map_from_entries(F.filter(pairs, lambda e: e["key"].isNotNull() & e["value"].between(1, 4)))
    read = lines.select(F.col("r.pdf_name").alias("pdf_name"), levels.alias("title_levels"), "value")
    return read.where("title_levels is not null").drop("value"), read.where("title_levels is null").select("value")
