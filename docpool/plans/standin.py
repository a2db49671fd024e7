"""Records made from the tables documents and labels, for queries over those.

Lines are slots; a line whose length is a multiple of 7 stands for an image. Lines of less than 40
characters are titles, of level 1 to 4 in turn; five slots make a page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat columns of records; place is the document's number."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lines = F.split("text", "\n", -1)
    joined = docs.join(labels, "doc_id", "left")
    return joined.select(
        F.col("doc_id"),
        F.col("doc_id").alias("place"),
        F.col("source").alias("dataset"),
        F.lit("data_0000.jsonl").alias("shard"),
        F.col("doc_id").cast("string").alias("record_id"),
        F.col("text").alias("value"),
        F.when(F.col("n_chars") >= 200, F.md5(F.col("text").cast("binary"))).alias("pdf_md5"),
        F.size(F.filter(lines, lambda s: F.length(s) % 7 == 0)).cast("long").alias("image_num"),
        F.col("n_chars").alias("token_total"),
        F.when(F.col("quality") == 1, "PARSE").when(F.col("quality") == 0, "DROP").alias("layout_decision"),
        (F.col("n_chars") % 100).cast("double").alias("layout_score"),
        F.when(F.col("toxic") == 1, "DROP").when(F.col("toxic") == 0, "KEEP").alias("nsfw_decision"),
        ((F.col("doc_id") % 10) / 10).alias("nsfw_score"),
        F.col("lang").alias("language"),
        F.lpad((F.col("doc_id") % 5).cast("string"), 2, "0").alias("category_code"),
        F.lit(None).cast("string").alias("category_name"),
        F.lit(None).cast("array<int>").alias("levels"),
    )


def slot_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, record_id, pdf_md5, texts, images, title_of_slot and title_levels."""
    lines = F.split("text", "\n", -1)
    path = lambda i: F.struct(F.concat(F.lit("images/"), i.cast("string"), F.lit(".jpg")).alias("relative_img_path"))
    title = lambda s, i: F.when(F.length(s) < 40, i)
    numbered = F.filter(F.col("title_of_slot"), lambda t: t.isNotNull())
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", F.col("doc_id").cast("string").alias("record_id"), F.md5(F.col("text").cast("binary")).alias("pdf_md5"), lines.alias("lines"))
        .withColumn("texts", F.transform("lines", lambda s: F.when(F.length(s) % 7 != 0, s)))
        .withColumn("images", F.transform("lines", lambda s, i: F.when(F.length(s) % 7 == 0, path(i))))
        .withColumn("title_of_slot", F.transform("lines", title))
        .withColumn("title_levels", F.map_from_entries(F.transform(numbered, lambda t: F.struct(t.alias("key"), (t % 4 + 1).alias("value")))))
    )


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, slot, page, block, page_size, n (length) and title (whether the slot is one)."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.split("text", "\n", -1).alias("lines"))
    rows = lines.select("doc_id", F.size("lines").alias("total"), F.posexplode("lines").alias("slot", "line"))
    page = F.floor(F.col("slot") / 5).cast("int")
    return rows.select("doc_id", "slot", page.alias("page"), (F.col("slot") % 5).alias("block"), F.least(F.lit(5), F.col("total") - page * 5).alias("page_size"), F.length("line").alias("n"), (F.length("line") < 40).alias("title"))


#: Common table expressions that say the same in SQL.
RECORDS_SQL = """
rec AS (
  SELECT d.doc_id, d.source AS dataset, CASE WHEN d.n_chars >= 200 THEN md5(d.text) END AS pdf_md5,
         len(list_filter(string_split(d.text, chr(10)), lambda s: length(s) % 7 = 0))::BIGINT AS image_num,
         d.n_chars AS token_total, CASE l.quality WHEN 1 THEN 'PARSE' WHEN 0 THEN 'DROP' END AS layout_decision,
         (d.n_chars % 100)::DOUBLE AS layout_score, CASE l.toxic WHEN 1 THEN 'DROP' WHEN 0 THEN 'KEEP' END AS nsfw_decision,
         (d.doc_id % 10) / 10.0 AS nsfw_score, d.lang AS language, lpad((d.doc_id % 5)::VARCHAR, 2, '0') AS category_code
  FROM documents d LEFT JOIN labels l USING (doc_id))"""

SLOTS_SQL = """
doc_lines AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
slot AS (SELECT doc_id, len(lines) AS total, unnest(range(0, len(lines))) AS slot, unnest(lines) AS line FROM doc_lines),
blk AS (
  SELECT doc_id, total, slot, line, slot // 5 AS page, slot % 5 AS block, least(5, total - slot // 5 * 5) AS page_size, length(line) AS n, length(line) < 40 AS title
  FROM slot)"""
