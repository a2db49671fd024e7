"""Records of aligned slots (texts[i] / images[i]) cut at titles of one level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpool.functions.text import word_count


def slot_slice(values: Column, start: Column, end: Column) -> Column:
    """values[start:end], bounds clamped to the array."""
    n = F.size(values)
    low = F.greatest(F.lit(0), F.least(start, n))
    high = F.greatest(low, F.least(end, n))
    return F.slice(values, low + 1, high - low)


def chunk_bounds(title_of_slot: Column, titles: Column) -> Column:
    """Array of (title, start, end): each title from its first slot to the next one's, the last to the end.

    title_of_slot: a title for each slot, or null; titles: those that count.
    """
    firsts = F.transform(F.array_distinct(titles), lambda t: F.struct((F.array_position(title_of_slot, t) - 1).cast("int").alias("start"), t.alias("title")))
    ordered = F.array_sort(F.filter(firsts, lambda x: x["start"] >= 0))
    n = F.size(title_of_slot)
    return F.transform(ordered, lambda x, i: F.struct(x["title"].alias("title"), x["start"].alias("start"), F.coalesce(F.get(ordered, i + 1)["start"], n).alias("end")))


def chunk_stats(texts: Column, images: Column, image_tokens: int = 0) -> Column:
    """Images, words of the texts, and both with `image_tokens` for each image."""
    n = F.size(F.filter(images, lambda x: x.isNotNull())).cast("long")
    words = F.aggregate(texts, F.lit(0).cast("long"), lambda a, t: a + word_count(t))
    return F.struct(n.alias("clean_image_num"), words.alias("clean_text_token"), (words + n * image_tokens).alias("clean_total_token"))


def has_content(texts: Column, images: Column) -> Column:
    return F.exists(texts, lambda t: F.coalesce(t != "", F.lit(False))) | F.exists(images, lambda x: x.isNotNull())


def aligned() -> Column:
    return F.coalesce(F.size("texts") == F.size("images"), F.lit(False))


def split_by_title(records: DataFrame, level: int, image_tokens: int = 0, drop_empty: bool = True) -> tuple[DataFrame, DataFrame]:
    """Chunks of records, and the records that can't be cut.

    records: record_id, pdf_md5, texts, images, title_levels (title to level) and title_of_slot. A
    record without a title of the level, or of which none is mapped to a slot, has no chunk. Slots
    before the first title go. Chunk numbers count empty chunks too, which go if drop_empty.
    """
    good, bad = records.where(aligned() & F.col("title_of_slot").isNotNull()), records.where(~aligned() | F.col("title_of_slot").isNull())
    titles = F.map_keys(F.map_filter("title_levels", lambda _, v: v == level))
    bounds = good.withColumn("bounds", chunk_bounds(F.col("title_of_slot"), F.coalesce(titles, F.array().cast("array<int>"))))
    chunks = bounds.select("*", F.posexplode("bounds").alias("chunk_idx", "bound")).drop("bounds")
    cut = chunks.withColumns({c: slot_slice(F.col(c), F.col("bound.start"), F.col("bound.end")) for c in ("texts", "images")})
    cut = cut.where(has_content(F.col("texts"), F.col("images"))) if drop_empty else cut
    name = F.coalesce(F.nullif(F.col("record_id"), F.lit("")), F.col("pdf_md5"), F.lit("unknown"))
    return (
        cut.withColumns(
            {
                "orig_id": F.coalesce("record_id", F.lit("")),
                "chunk_chapter_level": F.lit(level),
                "chunk_title_idx": F.col("bound.title"),
                "record_id": F.concat(name, F.lit("#"), F.col("chunk_idx").cast("string")),
                "statistics_info": chunk_stats(F.col("texts"), F.col("images"), image_tokens),
            }
        ).drop("bound"),
        bad,
    )
