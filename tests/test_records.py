"""Accessors, gates and readers on hand-written lines."""

import json
import math
import os

import pytest
from pyspark.sql import functions as F

from docpool.operators import gates
from docpool.sources import config, jsonl

GOOD = {
    "pdf_md5": "a",
    "id": "r1",
    "texts": ["x", None],
    "images": [None, {"relative_img_path": "images/1.jpg"}],
    "meta_info": {
        "statistics_info": {"clean_image_num": 3, "clean_total_token": 100},
        "origin_pdf_layout_score": {"decision": "PARSE", "score": 0.5},
        "origin_pdf_nsfw_score": {"decision": "KEEP", "score": 0.1},
        "language_fasttext": {"language": "en"},
        "category_cls_v1.3": {"category_code": "01", "category_name": "n", "score": 0.9},
        "chapter_info": {"0": 1, "1": "2", "2": "x"},
    },
}


def changed(**meta):
    return {**GOOD, "meta_info": {**GOOD["meta_info"], **meta}}


def pool(tmp_path, shards):
    for name, lines in shards.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n", encoding="utf-8")
    return str(tmp_path)


def read(spark, tmp_path, *records, strict=False):
    pool(tmp_path, {"ds/jsonl_res/data_0000.jsonl": list(records)})
    return jsonl.read_records(spark, f"{tmp_path}/ds/jsonl_res", strict=strict).orderBy("place")


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_image_number_falls_back(spark, tmp_path):
    no_meta = {k: v for k, v in GOOD.items() if k != "meta_info"}
    rows = read(spark, tmp_path, GOOD, {**changed(statistics_info={"clean_image_num": 3.0}), "statistics_info": {"clean_image_num": 7}}, {**changed(statistics_info=None), "img_cnt": 5}, no_meta, {"pdf_md5": "z"}, {**no_meta, "img_cnt": "5"})
    assert values(rows, "image_num") == [3, 7, 5, 1, None, 1]
    assert values(rows, "token_total") == [100, None, None, None, None, None]


def test_verdicts(spark, tmp_path):
    rows = read(spark, tmp_path, GOOD, changed(origin_pdf_layout_score={"decision": "PARSE"}, origin_pdf_nsfw_score={"score": 0.7}), changed(origin_pdf_layout_score=None, origin_pdf_nsfw_score={}))
    assert [tuple(r) for r in rows.select("layout_decision", "layout_score", "nsfw_decision", "nsfw_score").collect()] == [("PARSE", 0.5, "KEEP", 0.1), ("PARSE", 0.0, None, 0.7), (None, None, None, None)]


def test_category_of_object_and_list(spark, tmp_path):
    item = lambda c, s: {"category_code": c, "category_name": "n" + c, "score": s}
    lists = [[item("a", 0.2), item("b", 0.7), item("c", 0.7)], [item("a", None)], [], "x"]
    rows = read(spark, tmp_path, GOOD, *[changed(**{"category_cls_v1.3": x}) for x in lists], {**changed(**{"category_cls_v1.3": None}), "category_cls_v1.3": item("t", 1)})
    assert values(rows, "category_code") == ["01", "b", None, None, None, "t"]


def test_chapter_levels(spark, tmp_path):
    rows = read(spark, tmp_path, GOOD, {**changed(chapter_info=None), "chapter_info": {"5": 3}}, changed(chapter_info={}))
    assert [sorted(x) if x is not None else None for x in values(rows, "levels")] == [[1, 2], [3], []]
    assert values(rows, "title_levels") == [{0: 1, 1: 2}, None, {}]


CASES = [
    (GOOD, {}, None),
    (changed(statistics_info={"clean_image_num": 0, "clean_total_token": 5}), {}, "images"),
    (GOOD, {"token_total_min": 101}, "tokens"),
    (GOOD, {"token_total_max": 100}, None),
    (changed(origin_pdf_layout_score={"score": 1}), {}, "layout"),
    (changed(origin_pdf_layout_score={"decision": "DROP", "score": 1}), {}, "layout"),
    (GOOD, {"layout_decision_ok": frozenset({"KEEP"})}, "layout"),
    (GOOD, {"layout_decision_ok": frozenset()}, "layout"),
    (changed(origin_pdf_layout_score={"decision": "PARSE"}), {"layout_score_min": 0.1}, "layout"),
    (changed(origin_pdf_nsfw_score=None), {"nsfw_score_max": 0.0}, None),
    (changed(origin_pdf_nsfw_score={"score": 5}), {"nsfw_score_max": 0.0}, None),
    (changed(origin_pdf_nsfw_score=None), {"nsfw_decision_ok": frozenset({"KEEP"})}, "nsfw"),
    (changed(origin_pdf_nsfw_score={"decision": "DROP"}), {}, "nsfw"),
    (changed(origin_pdf_nsfw_score={"decision": "DROP"}), {"nsfw_gate_enabled": False}, None),
    (changed(origin_pdf_nsfw_score={"decision": "KEEP", "score": math.nan}), {"nsfw_score_max": 0.0}, None),
    (GOOD, {"languages_ok": frozenset({"EN"})}, "language"),
    (changed(language_fasttext=None), {"languages_ok": frozenset({"en"})}, "language"),
    (GOOD, {"chapter_level": 2}, None),
    (GOOD, {"chapter_level": 3}, "chapter"),
    (changed(chapter_info=None), {"chapter_level": 3}, "chapter"),
]


def test_gates_truth_table(spark, tmp_path):
    rows = read(spark, tmp_path, *[c[0] for c in CASES])
    reasons = [gates.reject_reason(config.GatesConfig(**c[1])).alias(f"r{i}") for i, c in enumerate(CASES)]
    got = [row[i] for i, row in enumerate(rows.select(*reasons).collect())]
    assert got == [c[2] for c in CASES]
    lenient = rows.select(gates.passes(config.GatesConfig(chapter_level=3), True).alias("p")).collect()
    assert lenient[18][0] and lenient[19][0]


def test_loose_and_strict(spark, tmp_path):
    junk = ["", "   ", "[1, 2]", "3", '"s"', "{broken"]
    assert values(read(spark, tmp_path, GOOD, *junk, {"pdf_md5": "b"}), "pdf_md5") == ["a", "b"]
    with pytest.raises(Exception, match="(?i)malformed"):
        read(spark, tmp_path, GOOD, *junk, strict=True).select("pdf_md5").collect()
    assert values(read(spark, tmp_path, GOOD, *junk[:5], strict=True), "pdf_md5") == ["a"]


def test_order_of_shards_and_lines(spark, tmp_path):
    shards = {f"{d}/jsonl_res/data_{n}.jsonl": [{"pdf_md5": f"{d}{n}{k}"} for k in range(40)] for d in ("b", "a") for n in (10, 2)}
    pool(tmp_path, {**shards, ".hidden/jsonl_res/data_1.jsonl": [{"pdf_md5": "h"}], "c/other/data_1.jsonl": [{"pdf_md5": "o"}]})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        rows = jsonl.read_pool(spark, str(tmp_path))
        assert values(rows.orderBy("place"), "pdf_md5") == [f"{d}{n}{k}" for d in "ab" for n in (10, 2) for k in range(40)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {tuple(r) for r in rows.select("dataset", "shard", "shard_idx").distinct().collect()} == {(d, f"data_{n}.jsonl", n) for d in "ab" for n in (2, 10)}
    assert jsonl.list_datasets(spark, str(tmp_path)) == ["a", "b"]
    with pytest.raises(FileNotFoundError):
        jsonl.read_lines(spark, f"{tmp_path}/nowhere")


def test_layout_addresses(spark):
    given = ["/a/b", "/a/b/", "/a/b/middle.json", "./x", "s3://k/d", "ftp://x", ""]
    df = spark.createDataFrame([(x,) for x in given], "a string").select(jsonl.layout_path(F.col("a")).alias("p"))
    assert values(df, "p") == ["/a/b/middle.json", "/a/b/middle.json", "/a/b/middle.json", f"{os.getcwd()}/x/middle.json", "s3://k/d/middle.json", None, None]


def test_category_names_with_carriage_returns(spark, tmp_path):
    path = tmp_path / "codes.txt"
    path.write_bytes("head\r01 Arts x\r0101 No\r1 short\r01 Letters\r\n12345 long\n22　Wide".encode())
    got = {tuple(r) for r in jsonl.category_names(spark, str(path)).collect()}
    assert got == {("01", "Letters"), ("0101", "No"), ("22", "Wide")}


def test_model_levels(spark, tmp_path):
    turn = lambda *c: {"pdf_name": "p", "data": [{"role": "user", "content": []}, {"role": "assistant", "content": [{"text": {"string": x}} for x in c]}]}
    lines = [turn('{"0": 1, "1": 5}'), turn("{0: 1, 1: 2}"), turn("a", "b"), turn("nonsense")]
    path = tmp_path / "m.jsonl"
    path.write_text("\n".join(map(json.dumps, lines)))
    good, bad = jsonl.read_model_levels(spark, str(path))
    assert sorted(map(str, values(good, "title_levels"))) == ["{0: 1, 1: 2}", "{0: 1}"] and bad.count() == 2


def test_config():
    made = config.make_config_from_dict({"gates": {"layout_decision_ok": ["PARSE"], "languages_ok": [], "layout_score_min": None, "nsfw_decision_ok": ""}, "chapter_split": {"enabled": True, "min_page_num": 3}})
    assert made.gates.layout_decision_ok == {"PARSE"} and made.gates.languages_ok == frozenset() and made.gates.nsfw_decision_ok is None
    assert made.gates.layout_score_min == -math.inf and made.split_enabled and made.slices.min_page_num == 3 and made.slices.max_page_num == 100
    assert config.load_make_config(None) == config.MakeDataConfig()


def test_quotas(tmp_path):
    assert config.quotas({"a": 1, "b": 1, "c": 1, "d": -2}, 10) == {"a": 3, "b": 3, "c": 4}
    assert config.quotas({"a": 0.4, "b": 0.6}, 1) == {"b": 1}
    for ratios, total in (({"a": 1}, 0), ({"a": 0}, 5)):
        with pytest.raises(ValueError):
            config.quotas(ratios, total)
    assert config.parse_ratios('{"a": 1, "b": "x"}') == {"a": 1.0}
    (tmp_path / "r.json").write_text('{"z": 2}')
    assert config.parse_ratios(str(tmp_path / "r.json")) == {"z": 2.0}
    with pytest.raises(ValueError):
        config.parse_ratios('{"b": "x"}')
