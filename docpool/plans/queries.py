"""The operators over the given tables, each with the same query in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docpool.functions import accessors, text
from docpool.functions.schema import CATEGORY
from docpool.operators import adapters, chapters, content_list, dedupe, gates, intervals, paragraphs, sampling, slots, stats
from docpool.plans import commands, standin
from docpool.plans.standin import RECORDS_SQL, SLOTS_SQL
from docpool.sources import jsonl, sinks
from docpool.sources.config import GatesConfig, MakeDataConfig, SliceParams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The gates of the queries.
GATES = GatesConfig(min_image_num=1, token_total_min=200, token_total_max=20_000, layout_score_min=5.0, nsfw_score_max=0.8, languages_ok=frozenset({"en", "fr", "de"}))
SEED = 1337


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- lines -------------------------------------------------------------------------------------


@query(
    f"""WITH {RECORDS_SQL}
SELECT doc_id::VARCHAR AS record_id, rec.dataset, 'data_' || (doc_id // 5000)::VARCHAR || '.jsonl' AS shard, (doc_id // 5000)::INTEGER AS shard_idx,
       row_number() OVER (PARTITION BY rec.dataset, doc_id // 5000 ORDER BY doc_id) AS line_no, md5(d.text) AS text_md5, pdf_md5, image_num, token_total,
       layout_decision, CASE WHEN layout_decision IS NOT NULL THEN layout_score END AS layout_score, nsfw_decision,
       CASE WHEN nsfw_decision IS NOT NULL THEN 0.0 END::DOUBLE AS nsfw_score, rec.language, category_code, 'name of ' || category_code AS category_name,
       CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS n_levels, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS n_title_levels
FROM rec JOIN documents d USING (doc_id)"""
)
def pool_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as JSON lines in shards, among blank, broken and other lines, read again as a pool."""
    rows = standin.records(spark, sf_dir)
    best = F.struct("category_code", F.concat(F.lit("name of "), "category_code").alias("category_name"), F.lit(0.9).alias("score"))
    other = F.struct(F.lit("99").alias("category_code"), F.lit("other").alias("category_name"), F.lit(0.1).alias("score"))
    # statistics now in meta_info, now at the top; a category as an object or as a list
    nested = F.col("doc_id") % 2 == 0
    statistics = F.struct(F.col("image_num").alias("clean_image_num"), F.col("token_total").alias("clean_total_token"))
    first, second = F.struct(F.lit("1").alias("0"), F.lit(" 2 ").alias("4"), F.lit("x").alias("5")), F.struct(F.lit("1").alias("0"))
    meta = F.struct(
        F.when(nested, statistics).alias("statistics_info"),
        F.when(F.col("layout_decision").isNotNull(), F.struct(F.col("layout_decision").alias("decision"), F.col("layout_score").alias("score"))).alias("origin_pdf_layout_score"),
        F.when(F.col("nsfw_decision").isNotNull(), F.struct(F.col("nsfw_decision").alias("decision"))).alias("origin_pdf_nsfw_score"),
        F.when(nested, F.struct("language")).alias("language_fasttext"),
        F.lit(True).alias("more"),
    )
    record = F.struct("pdf_md5", F.col("record_id").alias("id"), F.array(F.col("value")).alias("texts"), F.when(~nested, statistics).alias("statistics_info"), F.when(~nested, F.struct("language")).alias("language_fasttext"), meta.alias("meta_info"))
    levels = F.when(F.col("doc_id") % 3 == 0, F.to_json(first)).otherwise(F.to_json(second))
    category = F.when(nested, F.to_json(best)).otherwise(F.to_json(F.array(other, best, other)))
    # meta_info comes last: what has no type of its own goes in before its end
    line = F.to_json(record)
    line = F.concat(line.substr(F.lit(1), F.length(line) - 2), F.lit(',"chapter_info":'), levels, F.lit(',"category_cls_v1.3":'), category, F.lit("}}"))
    junk = F.when(F.col("layout_decision") == "DROP", '{"pdf_md5": "broken"').when(F.col("nsfw_decision") == "DROP", "[1, 2]").otherwise(" ")
    index = F.floor(F.col("doc_id") / 5000).cast("int")
    lines = rows.select("dataset", F.concat(F.lit("data_"), index.cast("string"), F.lit(".jsonl")).alias("shard"), "doc_id", F.posexplode(F.array(line, junk)).alias("k", "value"))
    pool = sinks.shared_folder(spark)
    sinks.write_shards(lines.select("dataset", "shard", F.struct("doc_id", "k").alias("place"), "value"), pool, jsonl.FOLDER)
    read = jsonl.read_pool(spark, pool)
    number = F.row_number().over(Window.partitionBy("dataset", "shard").orderBy("place"))
    flat = ["pdf_md5", "image_num", "token_total", "layout_decision", "layout_score", "nsfw_decision", "nsfw_score", "language", "category_code", "category_name"]
    return read.select("record_id", "dataset", "shard", "shard_idx", number.alias("line_no"), F.md5(F.col("rec.texts")[0].cast("binary")).alias("text_md5"), *flat, F.size("levels").alias("n_levels"), F.size("title_levels").alias("n_title_levels"))


# --- gates -------------------------------------------------------------------------------------

_REASON = """
  CASE WHEN image_num IS NULL OR image_num < 1 THEN 'images'
       WHEN token_total IS NULL OR token_total < 200 OR token_total > 20000 THEN 'tokens'
       WHEN layout_decision IS NULL OR layout_decision = 'DROP' OR layout_score < 5 THEN 'layout'
       WHEN nsfw_decision IS NOT NULL AND (nsfw_decision = 'DROP' OR nsfw_score > 0.8) THEN 'nsfw'
       WHEN language IS NULL OR language NOT IN ('en', 'fr', 'de') THEN 'language' END"""
_JUDGED = f"WITH {RECORDS_SQL}, judged AS (SELECT *, {_REASON} AS reason FROM rec)"


@query(f"{_JUDGED} SELECT language, count(*) AS n FROM judged WHERE reason IS NULL GROUP BY language")
def gate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.gated(standin.records(spark, sf_dir), GATES).groupBy("language").agg(F.count("*").alias("n"))


@query(f"{_JUDGED} SELECT doc_id, coalesce(reason, 'pass') AS reason FROM judged")
def gate_reject_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin.records(spark, sf_dir).select("doc_id", F.coalesce(gates.reject_reason(GATES), F.lit("pass")).alias("reason"))


@query(f"WITH {RECORDS_SQL} SELECT count(*) FILTER (nsfw_decision IS NULL) AS missing, count(*) FILTER (nsfw_decision IS NULL OR (nsfw_decision <> 'DROP' AND nsfw_score <= 0.5)) AS pass_open, count(*) FILTER (nsfw_decision = 'KEEP' AND nsfw_score <= 0.5) AS pass_listed FROM rec")
def nsfw_missing_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = GatesConfig(nsfw_score_max=0.5, nsfw_decision_ok=frozenset({"KEEP"}))
    return standin.records(spark, sf_dir).agg(F.count_if(F.col("nsfw_decision").isNull()).alias("missing"), F.count_if(gates.nsfw_pass(GatesConfig(nsfw_score_max=0.5))).alias("pass_open"), F.count_if(gates.nsfw_pass(listed)).alias("pass_listed"))


@query(f"WITH {RECORDS_SQL} SELECT dataset, doc_id, category_code, pdf_md5 FROM rec WHERE image_num >= 1 AND layout_decision = 'PARSE' AND (nsfw_decision IS NULL OR nsfw_decision <> 'DROP') AND pdf_md5 IS NOT NULL")
def select_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.eligible(standin.records(spark, sf_dir), GatesConfig()).select("dataset", "doc_id", "category_code", "pdf_md5")


# --- profiles ----------------------------------------------------------------------------------


@query(
    f"""WITH {RECORDS_SQL}, long AS (
      SELECT dataset, 'layout_decisions_count' AS metric, layout_decision AS key FROM rec UNION ALL
      SELECT dataset, 'nsfw_decisions_count', nsfw_decision FROM rec UNION ALL
      SELECT dataset, 'language_count', language FROM rec UNION ALL
      SELECT dataset, 'category_code_count', category_code FROM rec)
    SELECT dataset, metric, key, count(*) AS n FROM long WHERE key IS NOT NULL GROUP BY dataset, metric, key"""
)
def language_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.dimension_counts(standin.records(spark, sf_dir), ["dataset"])


_SUMMARY = "min(token_total) AS token_total_min, max(token_total) AS token_total_max, min(image_num) AS clean_image_num_min, max(image_num) AS clean_image_num_max"
_SHARE = "count(*) FILTER (lower(language) IN ('zh', 'zh-cn', 'zh_cn', 'chinese', 'en', 'english') AND image_num > 0 AND upper(layout_decision) = 'PARSE')"


@query(f"WITH {RECORDS_SQL} SELECT dataset, {_SUMMARY} FROM rec GROUP BY dataset")
def minmax_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.summary(standin.records(spark, sf_dir), ["dataset"]).drop("count", "ratio", "denominator")


@query(f"WITH {RECORDS_SQL} SELECT {_SHARE} AS count, round({_SHARE} / count(*), 6) AS ratio, count(*) AS denominator FROM rec")
def cond_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.summary(standin.records(spark, sf_dir)).select("count", F.round("ratio", 6).alias("ratio"), "denominator")


@query(f"WITH {RECORDS_SQL} SELECT dataset, {_SUMMARY}, {_SHARE} AS count, round({_SHARE} / count(*), 6) AS ratio, count(*) AS denominator FROM rec GROUP BY ROLLUP (dataset)")
def pool_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.rollup(standin.records(spark, sf_dir)).withColumn("ratio", F.round("ratio", 6))


THRESHOLDS = [0, 500, 1000, 2000, 5000, 10_000]


@query(f"{_JUDGED.replace('token_total < 200', 'false')}, t AS (SELECT unnest([0, 500, 1000, 2000, 5000, 10000])::BIGINT AS token_total_min) SELECT token_total_min, count(*) FILTER (reason IS NULL AND token_total >= token_total_min) AS pass_cnt, count(*) AS size FROM judged, t GROUP BY token_total_min")
def token_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.sweep(standin.records(spark, sf_dir), GATES, THRESHOLDS)


@query(
    """WITH b AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi FROM documents),
    c AS (SELECT least(floor((n_chars - lo) / (hi - lo) * 60), 59)::INT AS bin, count(*) AS n FROM documents, b GROUP BY 1)
    SELECT g.bin::INT AS bin, round(lo + g.bin * (hi - lo) / 60, 6) AS lower, coalesce(n, 0) AS n FROM (SELECT unnest(range(0, 60)) AS bin) g CROSS JOIN b LEFT JOIN c USING (bin)"""
)
def histogram_60(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(standin.records(spark, sf_dir), "token_total").withColumn("lower", F.round("lower", 6))


@query("SELECT l_suppkey::VARCHAR AS key, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, key LIMIT 30")
def top30(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = standin.table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("key")).agg(F.count("*").alias("n"))
    return stats.top(counts)


@query("SELECT c_nationkey::VARCHAR AS key, coalesce(n_name || '(' || c_nationkey || ')', c_nationkey::VARCHAR) AS label, count(*) AS n FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON n_nationkey = c_nationkey GROUP BY c_nationkey, n_name")
def category_name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = standin.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").cast("string").alias("key")).agg(F.count("*").alias("n"))
    names = standin.table(spark, sf_dir, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").cast("string").alias("category_code"), F.col("n_name").alias("category_name"))
    return stats.named_categories(counts, names)


@query(
    """WITH c AS (SELECT doc_id, unnest(range(0, 5)) AS i FROM documents),
    s AS (SELECT doc_id, i, CASE WHEN (doc_id + i) % 6 > 0 THEN ((doc_id * 7 + i * 3) % 4)::DOUBLE END AS score FROM c)
    SELECT d.doc_id, lpad(b.i::VARCHAR, 2, '0') AS category_code, b.score FROM documents d LEFT JOIN (
      SELECT * FROM s WHERE score IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) = 1) b USING (doc_id)"""
)
def category_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    def entry(i):
        score = F.when((F.col("doc_id") + i) % 6 > 0, ((F.col("doc_id") * 7 + i * 3) % 4).cast("double"))
        return F.struct(F.lpad(i.cast("string"), 2, "0").alias("category_code"), F.lit("x").alias("category_name"), score.alias("score"))

    items = F.transform(F.sequence(F.lit(0), F.lit(4)), entry).cast(f"ARRAY<{CATEGORY}>")
    return standin.table(spark, sf_dir, "documents").select("doc_id", accessors.best_category(items).alias("c")).select("doc_id", "c.category_code", "c.score")


# --- samples and duplicates --------------------------------------------------------------------


@query(
    """WITH r AS (SELECT c_mktsegment AS code, count(*)::DOUBLE AS ratio FROM customer GROUP BY 1),
    s AS (SELECT code, ratio / sum(ratio) OVER () * 997 AS raw FROM r),
    f AS (SELECT code, raw, floor(raw)::BIGINT AS base FROM s),
    k AS (SELECT *, row_number() OVER (ORDER BY raw - base DESC, code DESC) AS rk, 997 - sum(base) OVER () AS remaining FROM f)
    SELECT code, base + CASE WHEN rk <= remaining THEN 1 ELSE 0 END AS quota FROM k"""
)
def largest_remainder(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratios = standin.table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("code")).agg(F.count("*").cast("double").alias("ratio"))
    return sampling.quota_table(ratios, 997)


@query(
    f"""WITH {RECORDS_SQL}, q AS (SELECT * FROM (VALUES ('00', 40), ('01', 25), ('02', 10), ('03', 1000000)) t(category_code, quota)),
    k AS (SELECT DISTINCT category_code, pdf_md5 FROM rec WHERE pdf_md5 IS NOT NULL)
    SELECT category_code, pdf_md5 FROM k JOIN q USING (category_code) QUALIFY row_number() OVER (PARTITION BY category_code ORDER BY md5('1337:' || pdf_md5), pdf_md5) <= quota"""
)
def quota_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.quota_sample(standin.records(spark, sf_dir), {"00": 40, "01": 25, "02": 10, "03": 1_000_000}, SEED)


@query("SELECT doc_id FROM documents ORDER BY md5('1337:' || doc_id), doc_id::VARCHAR LIMIT 100")
def sample_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample(standin.records(spark, sf_dir), 100, SEED, "record_id").select("doc_id")


@query(f"WITH {RECORDS_SQL} SELECT doc_id, pdf_md5 FROM rec WHERE pdf_md5 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pdf_md5 ORDER BY doc_id) = 1")
def dedupe_drop_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.first_seen(standin.records(spark, sf_dir), keep_without_key=False).select("doc_id", "pdf_md5")


@query(f"WITH {RECORDS_SQL} SELECT doc_id, pdf_md5 FROM rec WHERE pdf_md5 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pdf_md5 ORDER BY doc_id) = 1 UNION ALL SELECT doc_id, pdf_md5 FROM rec WHERE pdf_md5 IS NULL")
def dedupe_keep_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.first_seen(standin.records(spark, sf_dir)).select("doc_id", "pdf_md5")


@query(f"WITH {RECORDS_SQL} SELECT doc_id, pdf_md5 FROM rec WHERE pdf_md5 IN (SELECT pdf_md5 FROM rec WHERE layout_decision = 'PARSE') QUALIFY row_number() OVER (PARTITION BY pdf_md5 ORDER BY doc_id) = 1")
def emit_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.records(spark, sf_dir)
    return sampling.emit(rows, rows.where("layout_decision = 'PARSE'").select("pdf_md5")).select("doc_id", "pdf_md5")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def unlabelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin.table(spark, sf_dir, "documents").join(standin.table(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id", "lang")


@query(
    f"""{_JUDGED}, kept AS (
      SELECT dataset, doc_id FROM judged WHERE reason IS NULL AND pdf_md5 IS NULL UNION ALL
      SELECT dataset, doc_id FROM judged WHERE reason IS NULL AND pdf_md5 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY pdf_md5 ORDER BY doc_id) = 1)
    SELECT j.dataset, count(*) AS lines_in, count(*) FILTER (reason IS NULL) AS lines_pass_gate, count(*) FILTER (reason IS NOT NULL) AS skipped_gate, count(k.doc_id) AS lines_out,
           0::BIGINT AS errors, 0::BIGINT AS split_batches, count(*) FILTER (reason IS NULL) - count(k.doc_id) AS dedupe_skipped
    FROM judged j LEFT JOIN kept k USING (doc_id) GROUP BY j.dataset"""
)
def make_data_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commands.make_data(standin.records(spark, sf_dir), None, MakeDataConfig(gates=GATES))[1].drop("layouts_missing")


# --- slots -------------------------------------------------------------------------------------

_BOUNDS = f"""WITH {SLOTS_SQL}, firsts AS (SELECT doc_id, total, slot AS title FROM blk WHERE title AND slot % 4 = 0),
  bounds AS (SELECT doc_id, title, title AS start, lead(title, 1, total) OVER (PARTITION BY doc_id ORDER BY title) AS stop, row_number() OVER (PARTITION BY doc_id ORDER BY title) - 1 AS chunk_idx FROM firsts)"""


@query(f"WITH {SLOTS_SQL} SELECT doc_id, slot::INT AS slot, n % 7 = 0 AS is_image, CASE WHEN n % 7 <> 0 THEN n ELSE -1 END::INT AS n_text FROM blk")
def slot_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.slot_records(spark, sf_dir).select("doc_id", F.posexplode(F.arrays_zip("texts", "images")).alias("slot", "s"))
    return rows.select("doc_id", "slot", F.col("s.images").isNotNull().alias("is_image"), F.coalesce(F.length("s.texts"), F.lit(-1)).alias("n_text"))


@query(f"{_BOUNDS} SELECT doc_id, chunk_idx::INT AS chunk_idx, title::INT AS title, start::INT AS start, stop::INT AS stop FROM bounds")
def chunk_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = F.map_keys(F.map_filter("title_levels", lambda _, v: v == 1))
    rows = standin.slot_records(spark, sf_dir).select("doc_id", F.posexplode(slots.chunk_bounds(F.col("title_of_slot"), titles)).alias("chunk_idx", "b"))
    return rows.select("doc_id", "chunk_idx", "b.title", "b.start", F.col("b.end").alias("stop"))


_CHUNKS = f"""{_BOUNDS}, parts AS (
    SELECT b.doc_id, b.chunk_idx, b.title, count(*) AS n_slots, count(*) FILTER (n % 7 = 0) AS images,
           sum(CASE WHEN n % 7 <> 0 THEN len(regexp_extract_all(line, '[^\\s]+')) ELSE 0 END)::BIGINT AS words
    FROM bounds b JOIN blk s ON s.doc_id = b.doc_id AND s.slot >= b.start AND s.slot < b.stop GROUP BY b.doc_id, b.chunk_idx, b.title)"""


@query(f"{_CHUNKS} SELECT doc_id || '#' || chunk_idx AS id, doc_id::VARCHAR AS orig_id, title::INT AS chunk_title_idx, n_slots::INT AS n_texts, n_slots::INT AS n_images FROM parts")
def chunk_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks, _ = slots.split_by_title(standin.slot_records(spark, sf_dir), 1)
    return chunks.select(F.col("record_id").alias("id"), "orig_id", "chunk_title_idx", F.size("texts").alias("n_texts"), F.size("images").alias("n_images"))


@query(f"{_CHUNKS} SELECT doc_id, chunk_idx::INT AS chunk_idx, images AS clean_image_num, words AS clean_text_token, words + 10 * images AS clean_total_token FROM parts")
def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks, _ = slots.split_by_title(standin.slot_records(spark, sf_dir), 1, image_tokens=10)
    return chunks.select("doc_id", "chunk_idx", "statistics_info.*")


# --- layouts and intervals ---------------------------------------------------------------------


@query(f"WITH {SLOTS_SQL} SELECT doc_id, page::INT AS page, block::INT AS block, (row_number() OVER (PARTITION BY doc_id ORDER BY page, block) - 1)::INT AS tid FROM blk WHERE title")
def title_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.number_titles(standin.blocks(spark, sf_dir).where("title"), ["doc_id"]).select("doc_id", "page", "block", "tid")


@query(f"WITH {SLOTS_SQL} SELECT doc_id, page::INT AS page, block::INT AS block FROM blk WHERE title AND page * 5 + block > 7 AND page * 5 + block < 20")
def title_in_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.blocks(spark, sf_dir)
    return rows.where(F.col("title") & intervals.inside(F.col("page"), F.col("block"), (1, 2), (4, 0))).select("doc_id", "page", "block")


@query(f"WITH {SLOTS_SQL} SELECT doc_id, count(*) AS n_blocks, sum(n)::BIGINT AS n_chars FROM blk WHERE page * 5 + block > 1 AND page * 5 + block < 13 GROUP BY doc_id")
def block_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.blocks(spark, sf_dir).where(intervals.inside(F.col("page"), F.col("block"), (0, 1), (2, 3)))
    return rows.groupBy("doc_id").agg(F.count("*").alias("n_blocks"), F.sum("n").alias("n_chars"))


@query(
    f"""WITH {SLOTS_SQL}, i AS (SELECT doc_id, slot AS s, slot + 1 + n % 3 AS e FROM blk WHERE n % 4 > 0),
    m AS (SELECT *, CASE WHEN s < max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM i),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m)
    SELECT doc_id, min(s)::INT AS s, max(e)::INT AS e FROM g GROUP BY doc_id, island"""
)
def interval_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.blocks(spark, sf_dir).where("n % 4 > 0").select("doc_id", F.col("slot").alias("s"), (F.col("slot") + 1 + F.col("n") % 3).alias("e"))
    return intervals.merge_overlapping(rows, ["doc_id"], "s", "e")


@query(
    f"""WITH {SLOTS_SQL}, p AS (SELECT * FROM blk WHERE n % 3 > 0),
    m AS (SELECT *, CASE WHEN slot = lag(slot) OVER (PARTITION BY doc_id ORDER BY slot) + 1 THEN 0 ELSE 1 END AS fresh FROM p),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY slot ROWS UNBOUNDED PRECEDING) AS run FROM m),
    r AS (SELECT doc_id, run, min(slot) AS a, max(slot) AS b, max(total) AS total FROM g GROUP BY doc_id, run)
    SELECT doc_id, (a // 5)::INT AS start_page, (a % 5 - 1)::INT AS start_block, CASE WHEN b % 5 = 4 OR b = total - 1 THEN b // 5 + 1 ELSE b // 5 END::INT AS end_page,
           CASE WHEN b % 5 = 4 OR b = total - 1 THEN 0 ELSE b % 5 + 1 END::INT AS end_block FROM r"""
)
def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.position_runs(standin.blocks(spark, sf_dir).where("n % 3 > 0"), ["doc_id"])


#: Each document's first and last title, as slots.
_ENDS_SQL = f"{SLOTS_SQL}, ends AS (SELECT doc_id, min(slot) AS low, max(slot) AS high FROM blk WHERE title GROUP BY doc_id)"


def _between_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks strictly inside their own document's first and last title."""
    rows = standin.blocks(spark, sf_dir)
    at = F.struct("page", "block")
    ends = rows.where("title").groupBy("doc_id").agg(F.min(at).alias("low"), F.max(at).alias("high"))
    place = lambda c: (F.col(f"{c}.page"), F.col(f"{c}.block"))
    return rows.join(ends, "doc_id").where(intervals.inside(F.col("page"), F.col("block"), place("low"), place("high")))


@query(f"WITH {_ENDS_SQL} SELECT doc_id, page::INT AS page, block::INT AS block FROM blk JOIN ends USING (doc_id) WHERE title AND slot > low AND slot < high")
def title_in_own_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _between_titles(spark, sf_dir).where("title").select("doc_id", "page", "block")


@query(f"WITH {_ENDS_SQL} SELECT doc_id, count(*) AS n_blocks, sum(n)::BIGINT AS n_chars FROM blk JOIN ends USING (doc_id) WHERE slot > low AND slot < high GROUP BY doc_id")
def block_range_own_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _between_titles(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("n_blocks"), F.sum("n").alias("n_chars"))


@query(
    f"""WITH {SLOTS_SQL}, i AS (SELECT doc_id, slot AS s, slot + 1 + n % 3 AS e FROM blk WHERE NOT title),
    m AS (SELECT *, CASE WHEN s < max(e) OVER (PARTITION BY doc_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM i),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m)
    SELECT doc_id, min(s)::INT AS s, max(e)::INT AS e FROM g GROUP BY doc_id, island"""
)
def interval_merge_at_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.blocks(spark, sf_dir).where("not title").select("doc_id", F.col("slot").alias("s"), (F.col("slot") + 1 + F.col("n") % 3).alias("e"))
    return intervals.merge_overlapping(rows, ["doc_id"], "s", "e")


@query(
    f"""WITH {SLOTS_SQL}, p AS (SELECT * FROM blk WHERE NOT title),
    m AS (SELECT *, CASE WHEN slot = lag(slot) OVER (PARTITION BY doc_id ORDER BY slot) + 1 THEN 0 ELSE 1 END AS fresh FROM p),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY slot ROWS UNBOUNDED PRECEDING) AS run FROM m),
    r AS (SELECT doc_id, run, min(slot) AS a, max(slot) AS b, max(total) AS total FROM g GROUP BY doc_id, run)
    SELECT doc_id, (a // 5)::INT AS start_page, (a % 5 - 1)::INT AS start_block, CASE WHEN b % 5 = 4 OR b = total - 1 THEN b // 5 + 1 ELSE b // 5 END::INT AS end_page,
           CASE WHEN b % 5 = 4 OR b = total - 1 THEN 0 ELSE b % 5 + 1 END::INT AS end_block FROM r"""
)
def runs_at_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.position_runs(standin.blocks(spark, sf_dir).where("not title"), ["doc_id"])


_LINK = "'![](images/' || md5(text) || md5(lang) || '.jpg)'"


@query(
    f"""WITH p AS (SELECT doc_id, [trim(split_part(text, chr(10), 1)), {_LINK}, trim(split_part(text, chr(10), 2)), '<table>' || lang || '</table>'] AS parts FROM documents)
    SELECT doc_id, array_to_string(list_filter(parts, lambda x: NOT regexp_matches(x, '^[#$\\s]*$')), '|') AS parts FROM p"""
)
def text_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = lambda k: F.split_part(F.col("text"), F.lit("\n"), F.lit(k))
    link = F.concat(F.lit("![](images/"), F.md5(F.col("text").cast("binary")), F.md5(F.col("lang").cast("binary")), F.lit(".jpg)"))
    block = F.concat(line(1), F.lit(" "), link, line(2), F.lit("<table>"), F.col("lang"), F.lit("</table> # $"))
    return standin.table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.parts(block), "|").alias("parts"))


@query(
    f"""WITH p AS (SELECT doc_id, [trim(split_part(text, chr(10), 1)), {_LINK}, trim(split_part(text, chr(10), 2)), '<table>' || lang || '</table>'] AS parts FROM documents),
    f AS (SELECT doc_id, list_filter(parts, lambda x: NOT regexp_matches(x, '^[#$\\s]*$')) AS parts FROM p),
    u AS (SELECT doc_id, unnest(range(0, len(parts)))::INT AS slot, unnest(parts) AS part FROM f)
    SELECT doc_id, slot, part LIKE '![](%.jpg)' AS is_image, CASE WHEN part LIKE '![](%.jpg)' THEN part[5:-2] ELSE part END AS content FROM u"""
)
def text_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = lambda k: F.split_part(F.col("text"), F.lit("\n"), F.lit(k))
    link = F.concat(F.lit("![](images/"), F.md5(F.col("text").cast("binary")), F.md5(F.col("lang").cast("binary")), F.lit(".jpg)"))
    block = F.concat(line(1), F.lit(" "), link, line(2), F.lit("<table>"), F.col("lang"), F.lit("</table> # $"))
    rows = standin.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.parts(block)).alias("slot", "part"))
    image = text.is_image_part(F.col("part"))
    return rows.select("doc_id", "slot", image.alias("is_image"), F.when(image, text.image_path(F.col("part"))).otherwise(F.col("part")).alias("content"))


def _whole_block() -> Column:
    """All lines of the text: the first, an image link, the others, a table."""
    link = F.concat(F.lit("![](images/"), F.md5(F.col("text").cast("binary")), F.md5(F.col("lang").cast("binary")), F.lit(".jpg)"))
    first = F.split_part(F.col("text"), F.lit("\n"), F.lit(1))
    others = F.substring(F.col("text"), F.length(first) + 1, F.length("text"))
    return F.concat(first, F.lit(" "), link, others, F.lit("<table>"), F.col("lang"), F.lit("</table> # $"))


@query()
def text_parts_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of whole texts; text_parts takes two lines of each."""
    return standin.table(spark, sf_dir, "documents").select("doc_id", text.parts(_whole_block()).alias("parts"))


@query()
def text_slots_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of whole texts; text_slots takes two lines of each."""
    rows = standin.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.parts(_whole_block())).alias("slot", "part"))
    image = text.is_image_part(F.col("part"))
    return rows.select("doc_id", "slot", image.alias("is_image"), F.when(image, text.image_path(F.col("part"))).otherwise(F.col("part")).alias("content"))


@query(f"WITH {SLOTS_SQL} SELECT d.doc_id, slot::INT AS slot, lang || '/' || slot || '.jpg' AS path, CASE WHEN slot % 2 = 0 THEN slot ELSE -1 END::INT AS width FROM blk JOIN documents d USING (doc_id) WHERE n % 7 = 0")
def image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image objects taken over from a map by path, then named by folder."""
    kind = "array<struct<relative_img_path: string, width: int>>"
    rows = standin.slot_records(spark, sf_dir).join(standin.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    own = F.transform("images", lambda x: F.when(x.isNotNull(), F.struct(x["relative_img_path"].alias("relative_img_path"), F.lit(-1).alias("width")))).cast(kind)
    sized = F.transform("images", lambda x, i: F.when(x.isNotNull() & (i % 2 == 0), F.struct(x["relative_img_path"].alias("relative_img_path"), i.alias("width"))))
    known = F.map_from_entries(F.transform(F.filter(sized.cast(kind), lambda x: x.isNotNull()), lambda x: F.struct(x["relative_img_path"].alias("key"), x.alias("value"))))
    named = accessors.renamed_images(accessors.backfilled_images(own, known), F.col("lang"))
    exploded = rows.select("doc_id", F.posexplode(named).alias("slot", "i")).where("i is not null")
    return exploded.select("doc_id", "slot", F.col("i.relative_img_path").alias("path"), "i.width")


@query(f"WITH {SLOTS_SQL} SELECT doc_id, coalesce(min(slot % 4 + 1) FILTER (title AND slot % 4 + 1 >= 1 + doc_id % 4), 0)::INT AS level FROM blk GROUP BY doc_id")
def title_start_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.slot_records(spark, sf_dir)
    level = intervals.start_level(F.array_distinct(F.map_values("title_levels")), (1 + F.col("doc_id") % 4).cast("int"))
    return rows.select("doc_id", F.coalesce(level, F.lit(0)).alias("level"))


@query(
    f"""WITH b AS (SELECT doc_id, doc_id % 3 AS k, text FROM documents)
    SELECT doc_id, (doc_id % 3)::INT AS n_images, list_sum(list_transform(string_split(text, chr(10)), lambda s: length(trim(s))))::BIGINT AS n_chars FROM b"""
)
def content_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = F.concat(F.lit("![](images/"), F.md5(F.col("text").cast("binary")), F.md5(F.col("text").cast("binary")), F.lit(".jpg)"))
    block = F.concat(F.col("text"), F.lit("\n "), F.array_join(F.array_repeat(link, (F.col("doc_id") % 3).cast("int")), " "))
    return standin.table(spark, sf_dir, "documents").select("doc_id", text.image_links(block).alias("n_images"), text.pure_length(block).alias("n_chars"))


@query("SELECT doc_id, CASE WHEN doc_id % 8 - 2 > 4 THEN 4 WHEN doc_id % 8 - 2 < 1 THEN 0 ELSE doc_id % 8 - 2 END::INT AS level FROM documents")
def level_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin.table(spark, sf_dir, "documents").select("doc_id", text.clamped_level(F.col("doc_id") % 8 - 2).alias("level"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN true WHEN doc_id % 3 = 0 THEN true WHEN doc_id % 5 = 0 THEN false ELSE true END AS formula, CASE WHEN doc_id % 2 = 0 THEN true WHEN doc_id % 3 = 0 THEN false WHEN doc_id % 5 = 0 THEN false ELSE true END AS \"table\" FROM documents")
def image_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    return standin.table(spark, sf_dir, "documents").select("doc_id", text.policy_flags(d % 2 == 0, d % 3 == 0, d % 5 == 0).alias("p")).select("doc_id", "p.formula", "p.table")


@query(
    f"""WITH {SLOTS_SQL}, t AS (SELECT doc_id, total, count(*) FILTER (title) AS assigned, array_to_string(list(coalesce(CASE WHEN title THEN slot END::VARCHAR, '-') ORDER BY slot), ',') AS titles FROM blk GROUP BY doc_id, total)
    SELECT doc_id, CASE WHEN assigned >= greatest(3, total // 20) THEN titles END AS titles FROM t"""
)
def title_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.slot_records(spark, sf_dir)
    entries = F.transform("title_of_slot", lambda t: F.struct(t.alias("section_idx")))
    layout = F.to_json(F.struct(entries.alias("paragraphs")))
    found = adapters.title_of_slot(layout, F.size("lines"))
    return rows.select("doc_id", found.alias("t")).select("doc_id", F.array_join("t", ",", "-").alias("titles"))


def layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and a layout of each document: its lines as blocks, five a page."""
    lines = F.split("text", "\n", -1)

    def block(s):
        span = F.array(F.struct(F.array(F.struct(F.lit("text").alias("type"), s.alias("content"))).alias("spans")))
        return F.struct(F.when(F.length(s) < 40, "title").otherwise("text").alias("type"), span.alias("lines"))

    page = lambda i: F.struct(i.alias("page_idx"), F.transform(F.slice("lines", i * 5 + 1, F.lit(5)), block).alias("para_blocks"))
    pages = F.transform(F.sequence(F.lit(0), F.floor((F.size("lines") - 1) / 5).cast("int")), page)
    return standin.table(spark, sf_dir, "documents").select("doc_id", "n_chars", lines.alias("lines")).select("doc_id", "n_chars", F.to_json(F.struct(pages.alias("pdf_info"))).alias("content"))


def chapter_records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records that name the layouts above, with levels 1 to 4 in turn, and the layouts by path."""
    made = layouts(spark, sf_dir).withColumn("path", F.concat(F.lit("/pool/doc"), F.col("doc_id").cast("string"), F.lit("/middle.json")))
    rows = standin.slot_records(spark, sf_dir)
    address = F.concat(F.lit("/pool/doc"), F.col("doc_id").cast("string"), F.lit("/middle.json"))
    titles = F.filter("title_of_slot", lambda t: t.isNotNull())
    levels = F.map_from_entries(F.transform(titles, lambda t, i: F.struct(i.alias("key"), (i % 4 + 1).alias("value"))))
    rec = F.struct(F.struct(F.struct(address.alias("s3_parse_address"), address.alias("s3_clean_address")).alias("address")).alias("meta_info"))
    value = F.to_json(F.struct(F.col("record_id").alias("id"), "pdf_md5"))
    return rows.select("doc_id", value.alias("value"), rec.alias("rec"), levels.alias("title_levels"), F.array_distinct(F.map_values(levels)).alias("levels")), made.select("path", "content")


@query()
def chapter_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles, refinement, greedy merge and slots: doc_id, chapter, slots and pages of each chapter."""
    rows, made = chapter_records(spark, sf_dir)
    cut = chapters.with_chapters(rows, made, SliceParams(min_page_num=1, max_page_num=2, min_imgs_count=0, min_texts_len=200))
    chapter = cut.select("doc_id", F.explode("chapters").alias("c")).withColumn("r", F.from_json("c.value", "texts array<string>, page_location array<array<int>>, pdf_md5 string"))
    return chapter.select("doc_id", F.col("c.index").alias("chapter"), F.size("r.texts").alias("n_texts"), F.to_json("r.page_location").alias("page_location"), "r.pdf_md5")


@query(
    f"""WITH {SLOTS_SQL} SELECT doc_id, md5(string_agg(line2, chr(10) || chr(10) ORDER BY slot)) AS markdown FROM (SELECT doc_id, slot, trim(line) AS line2 FROM blk WHERE trim(line) <> '') GROUP BY doc_id"""
)
def layout_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = layouts(spark, sf_dir).select("doc_id", content_list.assembled(F.col("content"), "mm_markdown").alias("m"))
    return made.where("m <> ''").select("doc_id", F.md5(F.col("m").cast("binary")).alias("markdown"))


@query(f"WITH {SLOTS_SQL} SELECT doc_id, count(*) AS n_contents, max(page)::BIGINT AS last_page FROM blk GROUP BY doc_id")
def layout_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = layouts(spark, sf_dir).select("doc_id", F.from_json(content_list.assembled(F.col("content"), "content_list"), "array<struct<type: string, page_idx: long>>").alias("c"))
    return made.select("doc_id", F.size("c").cast("long").alias("n_contents"), F.array_max(F.transform("c", lambda x: x["page_idx"])).alias("last_page"))


@query()
def paragraph_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with made-up boxes: lines of a document's pages, joined to paragraphs."""
    lines = F.split("text", "\n", -1)

    def block(s, i):
        y = (i % 5) * 20
        box = F.array(*[x.cast("double") for x in (F.lit(10), y, F.least(F.lit(500), F.length(s)) + 10, y + 10)])
        span = F.array(F.struct(F.lit("text").alias("type"), s.alias("content")))
        return F.struct(F.lit("text").alias("type"), box.alias("bbox"), F.array(F.struct(box.alias("bbox"), span.alias("spans"))).alias("lines"))

    page = lambda i: F.struct(i.alias("page_idx"), F.array(F.lit(600.0), F.lit(800.0)).alias("page_size"), F.slice(F.transform("lines", block), i * 5 + 1, F.lit(5)).alias("preproc_blocks"))
    pages = F.transform(F.sequence(F.lit(0), F.floor((F.size("lines") - 1) / 5).cast("int")), page)
    made = standin.table(spark, sf_dir, "documents").select("doc_id", lines.alias("lines")).select("doc_id", F.to_json(F.struct(pages.alias("pdf_info"))).alias("c"))
    schema = "struct<pdf_info: array<struct<para_blocks: array<struct<type: string, lines_deleted: boolean>>>>>"
    done = made.select("doc_id", F.from_json(paragraphs.with_paragraphs(F.col("c")), schema).alias("d"))
    blocks = F.flatten(F.transform("d.pdf_info", lambda p: p["para_blocks"]))
    return done.select("doc_id", F.size(blocks).alias("n_blocks"), F.size(F.filter(blocks, lambda b: b["lines_deleted"])).alias("n_joined"))
