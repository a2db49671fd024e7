"""New shards of a pool, gated and counted as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docpool.functions.accessors import canonical
from docpool.operators.gates import reject_reason
from docpool.sources import jsonl
from docpool.sources.config import GatesConfig


def read_stream(spark: SparkSession, path: str, shards: str = jsonl.SHARDS) -> DataFrame:
    """Records of shards as they appear in path, with flat columns and the shard's time."""
    lines = spark.readStream.option("pathGlobFilter", shards).option("recursiveFileLookup", "true").text(path)
    named = lines.select("value", F.col("_metadata.file_name").alias("shard"), F.col("_metadata.file_modification_time").alias("arrived"))
    return canonical(jsonl.parse_loose(named))


def gated_stream(records: DataFrame, cfg: GatesConfig, delay: str = "1 day") -> DataFrame:
    """What passes the gates, one record of each fingerprint within the delay. Records without a
    fingerprint would all be one: they are left out."""
    passed = records.where(reject_reason(cfg).isNull() & (F.col("pdf_md5") != ""))
    return passed.withWatermark("arrived", delay).dropDuplicatesWithinWatermark(["pdf_md5"])


def reason_counts(records: DataFrame, cfg: GatesConfig, window: str = "1 hour", delay: str = "1 day") -> DataFrame:
    """Records by arrival window and first failed gate (`pass` for none)."""
    reason = F.coalesce(reject_reason(cfg), F.lit("pass"))
    return records.withWatermark("arrived", delay).groupBy(F.window("arrived", window), reason.alias("reason")).count()
