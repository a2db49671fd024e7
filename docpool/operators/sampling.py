"""Samples that depend on the seed and the keys alone: rows are ranked by md5(seed:key)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_key(seed: int, key: str | Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key) if isinstance(key, str) else key).cast("binary"))


def sample(records: DataFrame, size: int, seed: int, key: str | Column) -> DataFrame:
    """`size` rows: each task keeps as many, and one merges these."""
    return records.orderBy(rank_key(seed, key), key).limit(size)


def quota_table(ratios: DataFrame, total: int) -> DataFrame:
    """(code, quota) from (code, ratio) by largest remainder; ties go to the larger code."""

    used = ratios.where("ratio > 0")
    whole = used.agg(F.sum("ratio").alias("whole"))
    shares = used.join(F.broadcast(whole)).select("code", (F.col("ratio") / F.col("whole") * total).alias("raw"))
    floors = shares.withColumn("base", F.floor("raw").cast("long"))
    left = floors.agg((F.lit(total) - F.sum("base")).alias("left"))
    # one row for each category
    rank = F.row_number().over(Window.orderBy(F.desc(F.col("raw") - F.col("base")), F.desc("code")))
    ranked = floors.withColumn("rank", rank).join(F.broadcast(left))
    return ranked.select("code", (F.col("base") + (F.col("rank") <= F.col("left")).cast("long")).alias("quota")).where("quota > 0")


def quota_sample(records: DataFrame, quotas: dict[str, int] | DataFrame, seed: int, key: str = "pdf_md5", category: str = "category_code") -> DataFrame:
    """(category, key): of each category as many different keys as its quota, or all there are.

    Only keys are ranked. Before the shuffle every task drops what can't be among its category's
    quota, so that a category with most of the rows costs no more than its quota for each task.
    """
    spark = records.sparkSession
    table = quotas if isinstance(quotas, DataFrame) else spark.createDataFrame(sorted(quotas.items()), "code string, quota long")
    # a row for each category of a configuration
    wanted = F.broadcast(table.withColumnRenamed("code", category))
    most = table.agg(F.max("quota")).first()[0] or 0
    keys = records.where(F.col(key) != "").select(category, key).distinct()
    rank = F.row_number().over(Window.partitionBy(category).orderBy(rank_key(seed, key), key))
    best = keys.join(wanted, category).withColumn("rank", rank).where(F.col("rank") <= most)
    return best.where("rank <= quota").select(category, key)


def emit(records: DataFrame, selected: DataFrame, key: str = "pdf_md5") -> DataFrame:
    """Rows whose key was selected; the first of equals stays, in place order."""
    from docpool.operators.dedupe import first_seen

    if selected.isEmpty():
        raise RuntimeError("the manifest selects nothing")
    return first_seen(records.join(selected.select(key).distinct(), key, "left_semi"), key, keep_without_key=False)
