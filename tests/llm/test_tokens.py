"""Token counts, byte-level BPE and token files against the libraries."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docpool.llm import byte_bpe, common, token_counts, token_files
from docpool.llm import queries as Q

MODEL = P.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)
RANKS = P.path("byte_bpe_50k.tiktoken")
TIK = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
HF = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
TEXT = st.text(alphabet=st.one_of(st.sampled_from(list("ab the \n\t\r'séñ日本 \x1c\xa0　12½▁<s>|endoftext")), st.characters(codec="utf-8")), max_size=40)
ODD = ["", " ", "  ", "a  b ", "\n\n x", "foo \n bar", "x" * 3000, "<|endoftext|> a<|endoftext|>", "<s> </s>", "▁ ▁a", "é" * 50, "don't  DON'T 's", "日本語 テスト", None]


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_every_prefix(text):
    own = token_counts.counter(MODEL)
    want = [len(SP.encode(text[:k])) for k in range(len(text) + 1)]
    assert own.every_prefix(text) == want
    parts = own.words([text])[0]
    assert sum(parts) == want[-1]
    for limit in (0, 1, 3, 7):
        assert own.longest_within(text, limit, parts) == max(k for k, n in enumerate(want) if n <= limit)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_byte_level_ids(texts):
    codec = byte_bpe.Codec.from_json(byte_bpe.model_from_ranks(RANKS, P.PATTERN))
    for text, raw in zip(texts, codec.encode(texts)):
        ids = np.frombuffer(raw, "<u4")
        assert ids.tolist() == TIK.encode_ordinary(text)
        assert codec.decode(ids).tobytes() == text.encode()
        start, stop = codec.offsets(ids)
        for i, a, b in zip(ids, start, stop):  # a token's bytes lie in the characters it is said to touch
            assert TIK.decode_single_token_bytes(int(i)) in text[a:b].encode()
    files = byte_bpe.Codec.from_file(P.path("byte_bpe_50k.json"))
    assert [np.frombuffer(x, "<u4").tolist() for x in files.encode(texts)] == [HF.encode(t, add_special_tokens=False).ids for t in texts]


def test_alphabet():
    assert [byte_bpe.to_bytes(c) for c in byte_bpe.byte_letters()] == [bytes([b]) for b in range(256)]


def test_memory_of_chunks_is_bounded(monkeypatch):
    from docpool.llm import chunk_memo

    monkeypatch.setattr(chunk_memo, "MOST", 5)
    memo = chunk_memo.Memo(lambda words: [w.upper() for w in words])
    for k in range(20):
        assert memo.rows([[f"a{k}", "b", "c" * 60]]) == [[f"A{k}", "B", "C" * 60]]
        assert len(memo.known) <= 6 and "c" * 60 not in memo.known


def test_tables_go_when_another_operator_begins():
    from docpool.llm import line_dedup

    model = byte_bpe.model_from_ranks(RANKS, P.PATTERN)
    codec, counts = byte_bpe.Codec.from_json(model), token_counts.counter(MODEL)
    assert byte_bpe.Codec.from_json(model) is codec and token_counts.counter(MODEL) is counts
    assert list(line_dedup._whole_groups(iter([]))) == []
    assert byte_bpe.Codec.from_json(model) is not codec and token_counts.counter(MODEL) is not counts


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(1, " ", "again"), (None, "no id", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")


def test_counts(spark, odd, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {r["doc_id"]: (len(r["text"].encode()), len(SP.encode(r["text"]))) for r in docs.collect()}
    got = {r["doc_id"]: r for r in Q.op1_token_counts(spark, sf_dir).collect()}
    assert {k: (r["n_bytes"], r["n_tokens"]) for k, r in got.items()} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got.values())
    rows = token_counts.token_counts(odd, MODEL, limit=5).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        text = "no id" if r["doc_id"] is None else ODD[r["doc_id"]] or ""
        assert (r["n_tokens"], r["over_limit"]) == (len(SP.encode(text)), len(SP.encode(text)) > 5)
    assert token_counts.token_counts(odd.limit(0), MODEL).count() == 0
    table = {r["doc_id"]: r["prefix_tokens"] for r in token_counts.prefix_table(odd.where("doc_id < 4"), MODEL).collect()}
    assert table[3] == [len(SP.encode(ODD[3][:k])) for k in range(6)]


@pytest.mark.parametrize("limit", [1, 3, 7])
def test_truncation_from_stored_counts(spark, odd, limit):
    table = token_counts.prefix_counts(odd.where("doc_id is not null"), MODEL, limit)
    for wanted in (limit, 2 * limit):
        for r in token_counts.truncations(table, wanted).collect():
            text = " " if r["n_bytes"] == 1 and r["doc_id"] == 1 else ODD[r["doc_id"]] or ""
            counts = [len(SP.encode(text[:k])) for k in range(len(text) + 1)]
            assert r["n_tokens"] == counts[-1] and r["over_limit"] == (counts[-1] > wanted)
            if r["over_limit"]:
                assert counts[r["chars_within"]] <= wanted and r["chars_within"] == max(k for k, c in enumerate(counts) if c <= wanted)
            else:
                assert r["chars_within"] == len(text)
    if limit > 1:
        with pytest.raises(Exception, match="no multiple"):
            token_counts.truncations(table, limit + 1).collect()


def test_every_place_is_stored(spark, odd):
    docs = odd.where("doc_id is not null and n_tokens = 'clash'")
    table = token_counts.prefix_counts(docs, MODEL)
    for r in table.collect():
        text = ODD[r["doc_id"]] or ""
        steps = np.frombuffer(r["tokens"], f"<i{r['width']}")
        assert np.cumsum(steps).tolist() == [len(SP.encode(text[:k])) for k in range(1, len(text) + 1)]
    for wanted in (2, 5, 37, 201):  # any budget
        for r in token_counts.truncations(table, wanted).collect():
            text = ODD[r["doc_id"]] or ""
            assert r["chars_within"] == max(k for k in range(len(text) + 1) if len(SP.encode(text[:k])) <= wanted)


def test_steps_that_are_not_small():
    assert [token_counts._numbers(token_counts._stored(x)).tolist() for x in ([], [1, 0, -128], [1, 0, -129])] == [[], [1, 0, -128], [1, 0, -129]]
    wide, small = token_counts._stored([1, 1, -129]), token_counts._stored([1, 2])
    raw, width = token_counts.every_place([wide, small])
    assert np.frombuffer(raw, f"<i{width}").tolist() == [2, -129, 1, 2]
    assert token_counts.every_place([small, small]) == (bytes([3, 1, 2]), 1)


@pytest.mark.parametrize("pattern", [r"[A-Z]?[a-z]+|\s+|[^A-Za-z\s]+|[A-Z]", r" ?[^\s]+|\s+"])
def test_other_patterns(spark, pattern):
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})
    texts = ["JavaScript on YouTube, iPhone and eBay", " JavaScript  YouTube\n", "don't (stop) x2"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["ids"] for r in byte_bpe.encode(docs, RANKS, pattern).collect()} == {i: own.encode_ordinary(t) for i, t in enumerate(texts)}


def test_round_trip(spark, odd, sf_dir):
    digest = lambda ids: hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in Q.op4_byte_bpe(spark, sf_dir).collect():
        ids = TIK.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), digest(ids), hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest())
    coded = byte_bpe.encode(odd, RANKS, P.PATTERN)
    back = byte_bpe.decode(coded, RANKS, P.PATTERN).collect()
    assert sorted((r["text"] for r in back)) == sorted([t or "" for t in ODD] + [" ", "no id"])
    split = spark.createDataFrame([(1, TIK.encode_ordinary("日")[:1]), (2, None)], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in byte_bpe.decode(split, RANKS, P.PATTERN).collect()} == {1: "�", 2: ""}
    assert byte_bpe.round_trip(odd.limit(0), RANKS, P.PATTERN).count() == 0


def expected_index(rows):
    start, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*HF.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files(spark, odd, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    got = sorted((tuple(r) for r in Q.op10_token_files(spark, sf_dir).collect()), key=key)
    assert got == expected_index([tuple(r) for r in docs.select("doc_id", "text").collect()])
    path = common.new_path(spark, "odd-tokens")
    token_files.write_tokens(odd, path, P.path("byte_bpe_50k.json"), files=3)
    got = sorted((tuple(r) for r in token_files.token_index(spark, path).collect()), key=key)
    assert got == expected_index([tuple(r) for r in odd.select("doc_id", "text").collect()])
    one = token_files.read_tokens(spark, path).where("doc_id = 6")
    assert one.first()["ids"] == [*HF.encode(ODD[6], add_special_tokens=False).ids, 0]
    assert "EqualTo(doc_id,6)" in one._jdf.queryExecution().explainString(one._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    empty = common.new_path(spark, "no-tokens")
    token_files.write_tokens(odd.limit(0), empty, P.path("byte_bpe_50k.json"), files=3)
    assert token_files.token_index(spark, empty).count() == 0


def test_indexes_in_the_files(spark, tmp_path):
    docs = spark.range(0, 60_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    token_files.write_tokens(docs, f"{tmp_path}/t", P.path("byte_bpe_50k.json"), files=1)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    (file,) = (str(f) for f in (tmp_path / "t").glob("part-*.orc"))
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(file), jvm.org.apache.orc.OrcFile.readerOptions(conf))
    assert reader.getRowIndexStride() == 2000 and reader.getNumberOfRows() == 60_000
    rows = reader.rows()
    footer = rows.readStripeFooter(reader.getStripes()[0])
    kinds = [s.getKind().toString() for s in footer.getStreamsList()]
    assert "ROW_INDEX" in kinds and any(k.startswith("BLOOM_FILTER") for k in kinds)
    assert "DIRECT_V2" in [c.getKind().toString() for c in footer.getColumnsList()]
    rows.close()
    # row groups that can't hold the id aren't read
    plan = token_files.read_tokens(spark, f"{tmp_path}/t").where("doc_id = 31234")._jdf.queryExecution()
    assert plan.toRdd().count() == 1
    scan = plan.executedPlan().collectLeaves().head()
    assert 0 < scan.metrics().apply("numOutputRows").value() <= 4000
