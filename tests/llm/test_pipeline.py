"""The pipeline against the stages' own statements, and on odd tables."""

import hashlib

from brute import line_links, near_duplicates, roots, shingles
from pyspark.sql import functions as F

import corpus_pipeline


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontaminate", "byte_bpe"]


def test_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())  # all are in a learned language
    lines, links = line_links([t for _, t in rows], 1)
    number = {x: i for i, x in enumerate(lines)}
    root = roots(range(len(lines)), [(number[a], number[b]) for a, b in links])
    seen, left = set(), []
    for doc, text in rows:
        stay = []
        for x in text.split("\n"):
            c = root[number[x]] if x.strip() else None
            if c is None or c not in seen:
                stay.append(x)
            seen.add(c)
        if "\n".join(stay) == text or "\n".join(stay).strip():
            left.append((doc, "\n".join(stay)))
    kept = {i for i, (_, c) in near_duplicates(left).items() if i == c}
    items = [shingles(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {}
    for doc, text in left:
        own = shingles(text)
        if doc in kept and not any(s and 100 * len(s & own) >= 75 * len(s) for s in items):
            want[doc] = hashlib.sha256(text.encode()).hexdigest()
    got = {r["doc_id"]: r["decoded_sha256"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert got == want and len(want) < len(rows)


def test_odd_tables(spark, tmp_path, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, "une phrase", None, None, None), (900, None, "en", "s", 1), (901, "", "fr", "s", 0), (902, "12 34", "en", "s", 5)], docs.schema)
    some = docs.where("doc_id < 40")
    both = some.unionByName(some.where("doc_id < 3")).unionByName(odd).withColumn("kept", F.lit(1))
    for name, table in (("odd", both), ("empty", docs.limit(0))):
        table.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        ids = [r["doc_id"] for r in out.collect()]
        assert len(ids) == len(set(ids)) and not {900, 901, 902} & set(ids) and (name == "odd") == bool(ids)
