"""First-seen deduplication by fingerprint.

The first row of each fingerprint comes from an aggregation, which combines rows before it shuffles,
so that one fingerprint with very many rows is no problem. The row goes through the aggregation itself:
places are computed once, and don't have to be the same in a second scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_places(records: DataFrame, key: str = "pdf_md5", place: str = "place") -> DataFrame:
    """key and the first place of each non-empty key."""
    return records.where(F.col(key) != "").groupBy(key).agg(F.min(place).alias("first_place"))


def first_seen(records: DataFrame, key: str = "pdf_md5", place: str = "place", keep_without_key: bool = True) -> DataFrame:
    """The first row of each key, in place order; rows without a key all stay, or none."""
    rows = records.where(F.col(key) != "").groupBy(F.col(key).alias("fingerprint")).agg(F.min_by(F.struct(*records.columns), place).alias("row"))
    keyed = rows.select("row.*")
    return keyed.unionByName(records.where(f"coalesce({key}, '') = ''")) if keep_without_key else keyed
