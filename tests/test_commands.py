"""Commands on small pools."""

import json

import pytest
from pyspark.sql import functions as F
from test_records import GOOD, changed, pool

from docpool import cli
from docpool.operators import chapters, stats
from docpool.plans import commands
from docpool.sources import config, jsonl, sinks
from docpool.streaming import shards as streaming


def lines_of(path):
    return [json.loads(x) for x in path.read_text().splitlines()]


def record(md5, cat="01", **more):
    return {**GOOD, "pdf_md5": md5, "meta_info": {**GOOD["meta_info"], "category_cls_v1.3": {"category_code": cat, "score": 1}}, "unknown": {"kept": [1.50, None]}, **more}


def test_make_data_first_seen_over_the_pool(spark, tmp_path):
    bad = changed(statistics_info={"clean_image_num": 0})
    pool(tmp_path / "in", {"a/jsonl_res/data_0002.jsonl": [record("x", id="late"), record("y")], "a/jsonl_res/data_0010.jsonl": [record("x", id="first?"), bad], "b/jsonl_res/data_0000.jsonl": [record("y"), record("", id="n1"), record(None, id="n2"), record("z")], "c/jsonl_res/data_0000.jsonl": [bad]})
    (tmp_path / "cfg.json").write_text(json.dumps({"gates": {"languages_ok": ["en"]}}))
    assert cli.main(["make-data", "--pool_root", f"{tmp_path}/in", "--out_root", f"{tmp_path}/out", "--output_version", "v1", "--config", f"{tmp_path}/cfg.json"]) == 0
    out = tmp_path / "out/v1"
    assert [r["id"] for r in lines_of(out / "a/jsonl_res/data_0002.jsonl")] == ["late", "r1"]  # data_0002 < data_0010
    assert not (out / "a/jsonl_res/data_0010.jsonl").exists() and not (out / "c").exists()
    assert [r["pdf_md5"] for r in lines_of(out / "b/jsonl_res/data_0000.jsonl")] == ["", None, "z"]
    assert lines_of(out / "b/jsonl_res/data_0000.jsonl")[2]["unknown"] == {"kept": [1.5, None]}
    summary = json.loads((out / "make_data_summary.json").read_text())
    assert summary["unique_pdf_md5"] == 3 and summary["lines_out"] == 5 and summary["dedupe_skipped"] == 2
    assert [d["skipped_gate"] for d in summary["datasets"]] == [1, 0, 1]


def test_select_and_emit(spark, tmp_path):
    pool(tmp_path, {"d/jsonl_res/data_0000.jsonl": [record(f"m{k % 30}", "01" if k % 3 else "02") for k in range(60)], "d/jsonl_res/data_0001.jsonl": [record("")]})
    args = ["--root", str(tmp_path), "--dataset_name", "d"]
    cli.main(["select", *args, "--output_dir", f"{tmp_path}/sel", "--sample_total", "12", "--category_ratio_json", '{"01": 2, "02": 1, "09": 1}'])
    manifest = json.loads((tmp_path / "sel/selected_manifest.json").read_text())
    assert manifest["selected_count_by_category"] == {"01": 6, "02": 3, "09": 0} and len(set(manifest["selected_pdf_md5"])) == 9
    cli.main(["emit", *args, "--selected_manifest", f"{tmp_path}/sel/selected_manifest.json", "--output_dir", f"{tmp_path}/emit"])
    got = [r["pdf_md5"] for r in lines_of(tmp_path / "emit/d/jsonl_res_sample/data_0000.jsonl")]
    assert sorted(got) == sorted(manifest["selected_pdf_md5"]) and got == sorted(got, key=lambda m: int(m[1:]))
    assert (tmp_path / "emit/d/jsonl_res_sample/data_0001.jsonl").read_text() == ""
    with pytest.raises(RuntimeError):
        commands.emit(spark, f"{tmp_path}/d/jsonl_res", spark.createDataFrame([], "pdf_md5 string"), f"{tmp_path}/e2")


def test_analyze_and_aggregate(spark, tmp_path):
    pool(tmp_path / "in", {"a/jsonl_res/data_0.jsonl": [record("x"), record("y", "02"), {"pdf_md5": "q", "meta_info": None}], "b/jsonl_res/data_0.jsonl": [record("z", "02")]})
    assert commands.analyze_all(spark, f"{tmp_path}/in", f"{tmp_path}/out", thresholds=[0, 101], sample_size=10) == {"a": "ok", "b": "ok"}
    assert commands.analyze_all(spark, f"{tmp_path}/in", f"{tmp_path}/out")["a"] == "skipped"
    a = json.loads((tmp_path / "out/a/analysis/reservoir_stats.json").read_text())
    assert a["records_seen"] == 3 and a["full_stats"]["category_code_count"] == {"01": 1, "02": 1} and a["reservoir_sample"]["size"] == 3
    assert a["extra_stats"][stats.SHARE] == {"count": 2, "ratio": 2 / 3, "denominator": 3}
    assert json.loads((tmp_path / "out/a/analysis/sweep_token_total_min.json").read_text()) == [{"token_total_min": 0, "pass_cnt": 2, "reservoir_size": 3}, {"token_total_min": 101, "pass_cnt": 0, "reservoir_size": 3}]
    legacy = {"total_seen": "4", "category_code_count": {"02": "3", "03": "x"}, "image_num": {"min": 1, "max": 9}, "token_total": {"min": None, "max": 7}}
    (tmp_path / "out/old/analysis").mkdir(parents=True)
    (tmp_path / "out/old/analysis/reservoir_stats.json").write_text(json.dumps(legacy))
    cli.main(["aggregate-stats", "--out_root", f"{tmp_path}/out"])
    pooled = json.loads((tmp_path / "out/pooled_analysis_stats.json").read_text())
    assert pooled["records_seen"] == 8 and pooled["datasets"] == ["a", "b", "old"]
    assert pooled["full_stats"]["category_code_count"] == {"01": 1, "02": 5}
    assert pooled["full_stats"]["clean_image_num"] == {"min": 1, "max": 9} and pooled["full_stats"]["token_total"] == {"min": 100, "max": 100}
    assert commands.read_name_list("a\n\n# no\n b \n") == ["a", "b"]


def test_chunk_of_records(spark, tmp_path):
    image = {"relative_img_path": "images/1.jpg"}
    base = record("m", id="", texts=["a", "b b", "c c c", None, ""], images=[None, None, None, image, None])
    base["meta_info"] |= {"chapter_info": {"0": 2, "1": 1, "2": 1}, "address": {"s3_parse_address": "/p"}}
    pool(tmp_path, {"d/jsonl_res_sample/data_0000.jsonl": [base, {**base, "images": [None]}, record("other")]})
    records = jsonl.read_records(spark, f"{tmp_path}/d/jsonl_res_sample")
    layouts = spark.createDataFrame([("/p/middle.json", json.dumps({"blocks": [{"title_idx": t} for t in (0, 0, 1, 2, 2)]}))], "path string, content string")
    chunks, bad = commands.chunk(records, layouts, 1, image_tokens=100)
    rows = [json.loads(r["value"]) for r in commands.chunk_lines(chunks).orderBy("place").collect()]
    assert [r["id"] for r in rows] == ["m#0", "m#1"] and [r["texts"] for r in rows] == [["c c c"], [None, ""]]
    assert rows[1]["meta_info"]["statistics_info"] == {"clean_image_num": 1, "clean_total_token": 100, "clean_text_token": 0}
    assert rows[0]["meta_info"]["statistics_info"]["clean_total_token"] == 3 and rows[1]["images"] == [image, None]
    assert rows[0]["unknown"] == {"kept": [1.5, None]} and rows[0]["orig_id"] == "" and rows[0]["chunk_title_idx"] == 1
    assert bad.count() == 2  # misaligned slots, and a layout that isn't there


def test_tars(spark, tmp_path):
    import tarfile

    rows = spark.createDataFrame([([("a.jpg",), None, ("b.jpg",)],), ([("a.jpg",)],)], "images array<struct<relative_img_path: string>>")
    files = spark.createDataFrame([("a.jpg", bytearray(b"1")), ("b.jpg", bytearray(b"22")), ("c.jpg", bytearray(b"3"))], "path string, content binary")
    made = sinks.write_tars(rows, files, str(tmp_path / "t")).collect()
    names = sorted(n for t in {r["tar"] for r in made} for n in tarfile.open(t).getnames())
    assert names == ["a.jpg", "b.jpg"]


def test_stream(spark, tmp_path):
    pool(tmp_path, {"d/jsonl_res/data_0000.jsonl": [record("x"), record("x"), record("y"), changed(language_fasttext=None), "{broken"]})
    cfg = config.GatesConfig(languages_ok=frozenset({"en"}))
    stream = streaming.gated_stream(streaming.read_stream(spark, str(tmp_path)), cfg).select("pdf_md5")
    q = stream.writeStream.format("memory").queryName("gated").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r[0] for r in spark.table("gated").collect()) == ["x", "y"]
    counts = streaming.reason_counts(streaming.read_stream(spark, str(tmp_path)), cfg)
    q = counts.writeStream.format("memory").queryName("reasons").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert {r["reason"]: r["count"] for r in spark.table("reasons").collect()} == {"pass": 3, "language": 1}


def test_results_do_not_depend_on_partitions(spark, sf_dir):
    from docpool.operators import dedupe, sampling
    from docpool.plans import standin

    rows = standin.records(spark, sf_dir)
    for f in (lambda d: dedupe.first_seen(d).select("doc_id"), lambda d: sampling.quota_sample(d, {"00": 5, "03": 9}, 1), lambda d: sampling.sample(d, 17, 5, "record_id").select("doc_id")):
        a, b = ({tuple(r) for r in f(d).collect()} for d in (rows, rows.repartition(7, F.rand(3))))
        assert a == b


def test_make_data_with_chapters(spark, tmp_path):
    page = lambda p: {"page_idx": p, "para_blocks": [{"type": "title", "lines": [{"spans": [{"type": "text", "content": f"t{p}"}]}]}, {"type": "text", "lines": [{"spans": [{"type": "text", "content": "w" * 200}]}]}]}
    layout = json.dumps({"pdf_info": [page(p) for p in range(4)]})
    cut = record("m", id="r", img_cnt=0, text_cnt=2)
    cut["meta_info"] |= {"chapter_info": {"0": 1, "2": 1}, "address": {"s3_parse_address": "/p/raw.json", "s3_clean_address": "/p/doc/clean.json"}}
    lost = json.loads(json.dumps(cut)) | {"pdf_md5": "lost"}
    lost["meta_info"]["chapter_info"] = {"77": 1}
    pool(tmp_path, {"d/jsonl_res/data_0000.jsonl": [cut, cut, lost, record("plain")]})
    layouts = spark.createDataFrame([("/p/raw.json", layout), ("/p/doc/clean.json", layout)], "path string, content string")
    cfg = config.make_config_from_dict({"gates": {"chapter_level": 1}, "chapter_split": {"enabled": True, "min_page_num": 2, "min_imgs_count": 0}})
    records = jsonl.read_pool(spark, str(tmp_path))
    out, counters = commands.make_data(records, layouts, cfg)
    rows = [json.loads(r["value"]) for r in out.orderBy("place").collect()]
    assert [(r["pdf_md5"], r["id"]) for r in rows] == [("m_chapter_0", "r_chapter_0"), ("m_chapter_1", "r_chapter_1"), ("lost", "r"), ("plain", "r1")]
    assert rows[0]["texts"] == ["# t0", "w" * 200, "t1", "w" * 200] and rows[0]["page_location"] == [[0, -1], [2, 0]] and rows[0]["unknown"] == {"kept": [1.5, None]}
    got = counters.first().asDict()
    assert {k: got[k] for k in ("lines_in", "lines_out", "errors", "split_batches", "dedupe_skipped")} == {"lines_in": 4, "lines_out": 4, "errors": 1, "split_batches": 1, "dedupe_skipped": 1}


def test_layouts_by_address(spark, tmp_path):
    page = lambda p: {"page_idx": p, "para_blocks": [{"type": "title", "lines": [{"spans": [{"type": "text", "content": f"t{p}"}]}]}, {"type": "text", "lines": [{"spans": [{"type": "text", "content": "w" * 200}]}]}]}
    layout = json.dumps({"pdf_info": [page(p) for p in range(4)]})
    for where in ("one two+", "b"):
        (tmp_path / "l" / where).mkdir(parents=True)
        (tmp_path / "l" / where / "middle.json").write_text(layout)
    cut = record("m", id="r", img_cnt=0, text_cnt=2)
    cut["meta_info"] |= {"chapter_info": {"0": 1, "2": 1}, "address": {"s3_parse_address": f"{tmp_path}/l/one two+/", "s3_clean_address": f"file:{tmp_path}//l/b/middle.json"}}
    lost = json.loads(json.dumps(cut)) | {"pdf_md5": "lost"}
    lost["meta_info"]["address"]["s3_clean_address"] = f"{tmp_path}/none"
    pool(tmp_path / "in", {"d/jsonl_res/data_0000.jsonl": [cut, lost]})
    (tmp_path / "cfg.json").write_text(json.dumps({"gates": {"chapter_level": 1}, "chapter_split": {"enabled": True, "min_page_num": 2, "min_imgs_count": 0}}))
    args = ["make-data", "--pool_root", f"{tmp_path}/in", "--output_version", "v", "--config", f"{tmp_path}/cfg.json"]
    for out, more in (("named", []), ("given", ["--layouts", f"{tmp_path}/l/*/middle.json"])):
        assert cli.main([*args, "--out_root", f"{tmp_path}/{out}", *more]) == 0
        assert [r["id"] for r in lines_of(tmp_path / out / "v/d/jsonl_res/data_0000.jsonl")] == ["r_chapter_0", "r_chapter_1", "r"]
        summary = json.loads((tmp_path / out / "v/make_data_summary.json").read_text())
        assert [d["layouts_missing"] for d in summary["datasets"]] == [1]
    base = record("m", id="", texts=["a", "b b", "c c c"], images=[None, None, None])
    base["meta_info"] |= {"chapter_info": {"0": 2, "1": 1, "2": 1}, "address": {"s3_parse_address": f"{tmp_path}/c"}}
    (tmp_path / "c").mkdir()
    (tmp_path / "c/middle.json").write_text(json.dumps({"blocks": [{"title_idx": t} for t in (0, 1, 2)]}))
    pool(tmp_path, {"d/jsonl_res_sample/data_0000.jsonl": [base]})
    assert cli.main(["chunk", "--root", str(tmp_path), "--dataset_name", "d", "--input_dir", f"{tmp_path}/d", "--output_dir", f"{tmp_path}/chunks", "--chapter_level", "1"]) == 0
    assert [r["texts"] for r in lines_of(next((tmp_path / "chunks").rglob("data_0000.jsonl")))] == [["b b"], ["c c c"]]


def test_names_that_the_writer_escapes(spark, tmp_path):
    rows = spark.createDataFrame([("set#1:a b%", "data_0001.jsonl", 2, "y"), ("set#1:a b%", "data_0001.jsonl", 1, "x")], "dataset string, shard string, place int, value string")
    sinks.write_shards(rows, f"{tmp_path}/out", "jsonl_res")
    assert (tmp_path / "out/set#1:a b%/jsonl_res/data_0001.jsonl").read_text() == "x\ny\n"


def test_analyze_all_and_rerun(spark, tmp_path):
    pool(tmp_path / "in", {"a/jsonl_res/data_0.jsonl": [record("x")], "b/jsonl_res/data_0.jsonl": [record("z")]})
    args = ["--pool_root", f"{tmp_path}/in", "--out_root", f"{tmp_path}/out"]
    assert cli.main(["analyze-all", *args, "--parallel", "2"]) == 0
    assert (tmp_path / "out/ok.list").read_text() == "a\nb\n" and (tmp_path / "out/failed.list").read_text() == ""
    (tmp_path / "again").write_text("b\ngone\n")
    assert cli.main(["rerun-failed", *args, "--failed_list", f"{tmp_path}/again", "--redo"]) == 1
    assert (tmp_path / "out/failed.list").read_text() == "gone\n" and (tmp_path / "out/ok.list").read_text() == "b\n"


def test_archived_records(spark, tmp_path):
    page = lambda p: {"page_idx": p, "para_blocks": [{"type": "title", "lines": [{"spans": [{"type": "text", "content": f"t{p}"}]}]}, {"type": "text", "lines": [{"spans": [{"type": "text", "content": f"{p}" * 200}]}]}, {"type": "image", "blocks": [{"type": "image_body", "lines": [{"spans": [{"type": "image", "image_path": f"{p:064x}.jpg"}]}]}]}]}
    layout = json.dumps({"pdf_info": [page(p) for p in range(4)]})
    levels = {"0": 1, "1": 2, "2": 1, "3": "2", "x": 1}
    images = [x for p in range(4) for x in (None, {"relative_img_path": f"doc/{p:064x}.jpg", "width": p})]
    base = {"id": "r", "texts": [], "images": images, "img_cnt": 4, "text_cnt": 4, "more": [1.5], "meta_info": {"chapter_info": levels, "address": {"s3_parse_address": "/p/raw.json", "s3_clean_address": "/p/doc/clean.json"}}}
    at = {n: {**base, "id": n} for n in ("whole", "flat", "lost", "short")}
    at["flat"] |= {"meta_info": {**base["meta_info"], "chapter_info": {}}}
    at["lost"] |= {"meta_info": {**base["meta_info"], "address": {"s3_parse_address": "/p/none.json", "s3_clean_address": "/p/doc/clean.json"}}}
    at["short"] |= {"meta_info": {**base["meta_info"], "address": {"s3_parse_address": "/p/raw.json", "s3_clean_address": "/p/doc/one.json"}}}
    at["whole"]["page_location"] = [[[0, -1], [4, 0]]]
    at["twice"] = {**base, "id": "twice", "images": [{"relative_img_path": "a", "width": 1}, None, {"relative_img_path": "a", "width": 2}, {"relative_img_path": ""}]}
    (tmp_path / "d/jsonl_res").mkdir(parents=True)
    bad = [{k: v for k, v in base.items() if k != "img_cnt"}, [1], {**base, "texts": None}]
    (tmp_path / "d/jsonl_res/data_0000.jsonl").write_text("\n".join([*map(json.dumps, at.values()), "", *map(json.dumps, bad), "{broken"]))
    items, broken = jsonl.read_archived(spark, f"{tmp_path}/d/jsonl_res")
    assert broken.count() == 4
    read = {r["id"]: r for r in items.collect()}
    assert set(read) == set(at) and read["whole"]["title_levels"] == {0: 1, 1: 2, 2: 1, 3: 2} and read["lost"]["page_location"] is None
    assert {k: v["width"] for k, v in read["twice"]["images_by_path"].items()} == {"a": 2} and json.loads(read["whole"]["page_location"]) == at["whole"]["page_location"]

    files = [("/p/raw.json", layout), ("/p/doc/clean.json", layout), ("/p/doc/one.json", json.dumps({"pdf_info": [page(0)]}))]
    layouts = spark.createDataFrame(files, "path string, content string")
    params = config.SliceParams(min_page_num=1, max_page_num=1, min_imgs_count=0, min_texts_len=1)
    cut = {r["id"]: r for r in chapters.slice_archived(items, layouts, params).collect()}
    assert {n: r["status"] for n, r in cut.items()} == {"whole": "cut", "twice": "cut", "flat": "no_levels", "lost": "layout_missing", "short": "short"}
    lines = [json.loads(c["value"]) for c in cut["whole"]["chapters"]]
    assert [x["id"] for x in lines] == [f"whole_chapter_{n}" for n in range(len(lines))] and len(lines) > 2
    assert [i for x in lines for i in x["images"] if i] == [i for i in images if i]  # with the widths of the record
    assert all(x["more"] == [1.5] and "index" not in x for x in lines)
    checks = cut["whole"]
    assert (checks["img_cnt_same"], checks["texts_same"], checks["location_same"]) == (True, False, True)
    assert cut["twice"]["location_same"] is None and cut["flat"]["texts_same"] is None and cut["flat"]["chapters"] == []
    top = {r["id"]: r for r in chapters.slice_archived(items, layouts, params, deepest=1).collect()}
    assert len(top["whole"]["chapters"]) == 2  # not split below the first level
    none = chapters.slice_archived(items.where("false"), layouts, params)
    assert none.count() == 0
