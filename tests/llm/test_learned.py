"""Language, toxicity and host reputation: held-out accuracy, and odd rows."""

import zlib

import pytest
from oracle import same
from pyspark.sql import functions as F

from docpool.llm import common, language_id, toxicity, url_filter
from docpool.llm import queries as Q

SF = "/root/testdata/sf0.01"
fold = lambda i, n: zlib.crc32(str(i).encode()) % n


def test_folds(spark):
    rows = spark.range(200).select("id", common.id_bucket(F.col("id"), 4).alias("b"), common.id_bucket(F.col("id"), 3).alias("c")).collect()
    assert all((r["b"], r["c"]) == (fold(r["id"], 4), fold(r["id"], 3)) for r in rows)


def test_language(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = Q.op6_language_id(spark, SF).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and all(r["held_out"] == (fold(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_language_of_mixed_and_odd_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.learn(docs, F.lit(True))
    text = {k: " ".join(r["text"] for r in docs.where(F.col("lang") == k).orderBy("doc_id").limit(12).collect())[:6000] for k in ("en", "de")}
    rows = [(1, None), (2, ""), (3, "123 !? ²½"), (4, text["en"]), (5, text["en"] + " " + text["de"]), (5, "日本"), (None, text["de"])]
    odd = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = [r.asDict() for r in language_id.predict(odd, model).collect()]
    assert [(r["lang_pred"], r["rejected"]) for r in got[:4]] == [("und", True)] * 3 + [("en", False)]
    assert set(got[4]["mixture"]) == {"en", "de"} and all(0.3 < v < 0.7 for v in got[4]["mixture"].values())
    assert got[5]["lang_pred"] in model.langs and got[6]["lang_pred"] == "de"
    kept = language_id.keep_known_languages(odd, model)
    assert kept.columns == odd.columns and {4, 5, None} == {r["doc_id"] for r in kept.collect()}
    nothing = language_id.learn(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r["lang_pred"] for r in language_id.predict(odd, nothing).collect()} == {"und"}
    assert language_id.predict(odd.limit(0), model).count() == 0


def test_toxicity(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    rows = Q.op5_toxicity(spark, "/root/testdata/sf0.1").collect()
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic = [p for t, p in held if t]
    clean = [p for t, p in held if not t]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.03 * len(clean)


def test_toxicity_of_odd_rows(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "x" * 100_000), (2, "a b")], "doc_id long, text string").withColumn("label", F.lit(1))
    for own in (labels, labels.where("toxic = 0"), labels.limit(0)):
        model = toxicity.learn(docs, own, F.lit(True))
        rows = toxicity.score(odd, model).collect()
        assert len(rows) == 4 and all(0 <= r["score"] <= 1 for r in rows) and rows[0]["score"] == rows[1]["score"]
    assert toxicity.score(odd.limit(0), model).count() == 0
    assert "".join(x.decode() for x in toxicity.windows(toxicity.folded("Ab  c" + "d" * 500 + " e"))) == " ab  c" + "d" * 500 + " e"


def test_urls_against_sql(spark, sf_dir):
    same(Q.op7_url_filter(spark, sf_dir), url_filter.ORACLE_SQL, sf_dir)
    same(Q.op7_url_filter(spark, SF), url_filter.ORACLE_SQL, SF)


@pytest.fixture(scope="module")
def urls(spark):
    given = [None, "no scheme/es/", "http://EXAMPLE.org/es/1", "http://a.Example.ORG/es/", "http://example.org/en/12?x", "http://example.org/en/2", "http://notexample.org/es/", "http://x.com/fr/", "http://x.com/de/#a", "http://x.com?/de/", "http://com/de/", "a://b://x.com/de/", "http://bad.net/1", "http://org"]
    return spark.createDataFrame([(i, u, "clash") for i, u in enumerate(given)], "page_id long, url string, host string")


def test_rules(spark, urls):
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {r["page_id"]: r for r in url_filter.judge_urls(urls, none).collect()}
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"]) for i in range(14)] == [
        ("", "", None), ("", "", None), ("example.org", "/es/1", "example.org/es/"), ("a.example.org", "/es/", "example.org/es/"), ("example.org", "/en/12", "example.org/en/1"), ("example.org", "/en/2", "org/"), ("notexample.org", "/es/", "org/"),
        ("x.com", "/fr/", "com/fr/"), ("x.com", "/de/", "com/de/"), ("x.com", "", None), ("com", "/de/", "com/de/"), ("b:", "//x.com/de/", None), ("bad.net", "/1", None), ("org", "", None),
    ]
    assert [got[i]["verdict"] for i in (2, 4, 5, 7, 8)] == ["block", "block", "allow", "allow", "block"]
    assert url_filter.judge_urls(urls.limit(0), none).count() == 0


def test_reputation(spark):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), (F.col("id") % 4).cast("string"), F.lit(".site"), (F.col("id") % 2).cast("string"), F.lit(".net/"), F.col("id").cast("string")).alias("url"))
    outcomes = spark.range(0, 400).select(F.col("id").alias("page_id"), (F.col("id") % 4 == 3).cast("int").alias("bad"))
    hosts = {r["host"]: r for r in url_filter.reputations(pages, outcomes.union(outcomes)).collect()}
    assert hosts["h3.site1.net"]["lower"] > 0.9 and hosts["h0.site0.net"]["mean"] < 0.05 and hosts["h3.site1.net"]["n"] == 100
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages, outcomes).collect()}
    assert all(v == ("block" if k % 4 == 3 else "allow") for k, v in got.items())
    few = url_filter.judge_urls(pages, outcomes.where("page_id = 3 or page_id % 4 <> 3")).collect()
    assert {r["verdict"] for r in few} == {"allow"}  # one bad page is not enough


def test_hosts_that_the_method_blocks_against_sql(spark, tmp_path):
    urls = [(i, f"http://{'bad' if i % 5 < 2 else 'good'}.site{i % 5}.net/{i}") for i in range(600)] + [(9000, None), (9001, "http://bad.site0.net/x")]
    spark.createDataFrame(urls, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    marks = [(i, int(i % 5 < 2), 1) for i in range(0, 600, 2)] + [(None, 1, 0), (7, None, None)]
    spark.createDataFrame(marks, "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["page_id"]: r["verdict"] for r in Q.op7_url_filter(spark, str(tmp_path)).collect()}
    assert all(got[i] == ("block" if i % 5 < 2 else "allow") for i in range(600)) and got[9000] == "allow" and got[9001] == "block"
    import duckdb

    con = duckdb.connect()
    for name in ("pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    rows = con.execute(url_filter.ORACLE_SQL).fetchall()
    assert {r[0]: r[4] for r in rows} == got


def test_windows_that_the_ordinary_dictionary_suits_better():
    model = toxicity.Detector(["bad scum here " * 9] * 5, ["all is well now"] * 5)
    model.gains = lambda data: [-3, -1]
    assert 0 <= model.score("x") <= 1
