"""Every registered query that SQL can say, against DuckDB; the others against plain Python."""

import hashlib
import json
import re

import pytest
from oracle import duck, same

import __spark_entry__
from docpool.functions import layout as L
from docpool.operators.chapters import slice_document
from docpool.plans import queries as Q
from docpool.sources.config import SliceParams


def test_entry_runs():
    assert set(Q.ORACLES) <= set(Q.QUERIES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_against_sql(spark, sf_dir, name):
    same(Q.QUERIES[name](spark, sf_dir), Q.ORACLES[name], sf_dir)


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["language", "n"]


def test_chapter_slices_against_one_document_at_a_time(spark, sf_dir):
    params = SliceParams(min_page_num=1, max_page_num=2, min_imgs_count=0, min_texts_len=200)
    want = set()
    for doc, text in duck(sf_dir).sql("select doc_id, text from documents").fetchall():
        lines = text.split("\n")
        blocks = [{"type": "title" if len(s) < 40 else "text", "lines": [{"spans": [{"type": "text", "content": s}]}]} for s in lines]
        document = {"pdf_info": [{"page_idx": p, "para_blocks": blocks[5 * p : 5 * p + 5]} for p in range((len(blocks) + 4) // 5)]}
        levels = {t: t % 4 + 1 for t in L.titles(document)}
        for n, c in enumerate(slice_document(document, document, levels, f"doc{doc}", params)):
            want.add((doc, n, len(c["texts"]), json.dumps(c["page_location"], separators=(",", ":"))))
    got = Q.chapter_slices(spark, sf_dir).select("doc_id", "chapter", "n_texts", "page_location").collect()
    assert {tuple(r) for r in got} == want and len(want) > 50


def test_parts_of_whole_texts(spark, sf_dir):
    want = {}
    for doc, text, lang in duck(sf_dir).sql("select doc_id, text, lang from documents").fetchall():
        link = "![](images/" + hashlib.md5(text.encode()).hexdigest() + hashlib.md5(lang.encode()).hexdigest() + ".jpg)"
        first, newline, others = text.partition("\n")
        cut = re.split(r"(!\[\]\(images/[0-9a-f]{64}\.jpg\)|<table>.*?</table>)", f"{first} {link}{newline}{others}<table>{lang}</table> # $", flags=re.S)
        want[doc] = [p.strip() for p in cut if not re.fullmatch(r"[#$\s]*", p)]
    assert {r["doc_id"]: r["parts"] for r in Q.text_parts_whole(spark, sf_dir).collect()} == want
    slots = {(d, n, p.startswith("![](") and p.endswith(".jpg)"), p[4:-1] if p.startswith("![](") and p.endswith(".jpg)") else p) for d, own in want.items() for n, p in enumerate(own)}
    assert {tuple(r) for r in Q.text_slots_whole(spark, sf_dir).collect()} == slots and any(p.count("\n") > 5 for own in want.values() for p in own)


def test_later_blocks_are_in_bounds(spark, sf_dir):
    titles = {(r["doc_id"], 5 * r["page"] + r["block"]) for r in Q.title_in_own_bounds(spark, sf_dir).collect()}
    want = set()
    for doc, text in duck(sf_dir).sql("select doc_id, text from documents").fetchall():
        own = [n for n, s in enumerate(text.split("\n")) if len(s) < 40]
        want |= {(doc, n) for n in own[1:-1]}
    assert titles == want and any(n > 19 for _, n in want)
