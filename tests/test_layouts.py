"""Rendering, intervals, chapters, contents and paragraphs, against rules stated one by one."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docpool.functions import layout as L
from docpool.operators import adapters, content_list, intervals, paragraphs
from docpool.operators.chapters import Rendered, slice_document
from docpool.operators.intervals import Interval
from docpool.sources.config import SliceParams

HEX = "a" * 64


def span(content="x", kind="text", **more):
    return {"type": kind, "content": content, **more}


def block(kind, *spans, **more):
    return {"type": kind, "lines": [{"spans": list(spans)}], **more}


def image(name=f"{HEX}.jpg", *extra):
    return {"type": "image", "blocks": [block("image_body", {"type": "image", "image_path": name}), *extra]}


def test_text_and_equations():
    b = block("text", span("a"), span("b", "inline_equation"), span("c"))
    assert L.markdown(b) == "a $b$ c"
    e = block("interline_equation", span("q", "interline_equation", image_path="e.jpg"))
    assert L.markdown(e) == "$$\nq\n$$" and L.markdown(e, L.Policy(formula=False)) == "![](images/e.jpg)"
    assert L.markdown({"type": "list", "blocks": [block("text", span("1")), block("text", span("2"))]}) == "1  \n2"
    assert L.markdown({"type": "index", "lines": []}) == "" and L.markdown(block("header", span())) == ""


def test_titles_and_levels():
    assert [L.title_level(x) for x in (None, -1, 0, 1, 4, 9)] == [0, 0, 0, 1, 4, 4]
    assert L.markdown(block("title", span("T"), level=9)) == "#### T" and L.markdown(block("title", span("T"))) == "T"
    assert L.markdown(block("title", span("T"), level=1), level=2) == "## T"


def test_images_and_tables():
    link, caption, note = f"![](images/{HEX}.jpg)", block("image_caption", span("c")), block("image_footnote", span("n"))
    assert L.markdown(image(f"{HEX}.jpg", caption)) == f"{link}  \nc"
    assert L.markdown(image(f"{HEX}.jpg", caption, note)) == f"c  \n{link}  \nn"
    assert L.markdown(image(), images=False) == ""
    table = {"type": "table", "blocks": [block("table_caption", span("c")), block("table_body", {"type": "table", "html": "<table>1</table>", "image_path": "t.jpg"}), block("table_footnote", span("n"))]}
    assert L.markdown(table) == "c  \n\n<table>1</table>\n\nn" and L.markdown(table, L.Policy(table=False)) == "c  \n![](images/t.jpg)\nn"
    code = {"type": "code", "sub_type": "code", "guess_lang": "py", "blocks": [block("code_body", span("p"))]}
    assert L.markdown(code) == "```py\np\n```" and L.markdown({**code, "sub_type": "algorithm"}) == "p"


def test_policy():
    flags = lambda p: (p.formula, p.table)
    assert [flags(L.policy_of(*x)) for x in ((1, 1, 1), (0, 1, 1), (0, 0, 1), (0, 0, 0))] == [(True, True), (True, False), (False, False), (True, True)]
    pages = {"pdf_info": [{"page_idx": 0, "para_blocks": [image("i"), block("interline_equation", span("", "interline_equation", image_path="e"))]}]}
    assert L.image_paths(pages) == {"image": ["i"], "table": [], "interline_equation": ["e"]} and L.expected_images(image("i")) == 1


def test_slots_and_sizes():
    link = f"![](images/{HEX}.jpg)"
    texts, images = L.slots([f"a{link} b <table>\nx</table># $", " ## ", "![](z.jpg)", ""])
    assert texts == ["a", None, "b", "<table>\nx</table>", None]
    assert images == [None, {"relative_img_path": f"images/{HEX}.jpg"}, None, None, {"relative_img_path": "z.jpg"}]
    assert L.content_size(f" ab \n{link} c{link}") == (2, 3)


# --- intervals ---------------------------------------------------------------------------------


def made_document(rng, pages):
    blocks = [[rng.choice(["title", "text", "text"]) for _ in range(rng.randint(0, 4))] for _ in range(pages)]
    document = {"pdf_info": [{"page_idx": p, "para_blocks": [block(k, span("y" * rng.randint(1, 60))) for k in own]} for p, own in enumerate(blocks)]}
    places = L.titles(document)
    return document, places, {t: rng.randint(1, 5) for t in places if rng.random() < 0.9}


@pytest.mark.parametrize("seed", range(60))
def test_intervals_partition_the_document(seed):
    rng = random.Random(seed)
    document, places, levels = made_document(rng, rng.randint(1, 30))
    n = len(document["pdf_info"])
    start, end = (0, -1), (n, 0)
    tops = intervals.split("ROOT", 1, start, end, places, levels)
    fine = intervals.refine(tops, 3, places, levels)
    rendered = Rendered(document, {}, L.Policy())
    final = intervals.merge(fine, rendered.size, 0, 50, 6)
    every = [(p, k) for p, own in enumerate(document["pdf_info"]) for k in range(len(own["para_blocks"]))]
    for cut in (tops, fine, final):
        owners = [[i for i, v in enumerate(cut) if v.start < at < v.end] for at in every]
        assert all(len(o) == 1 for o in owners) and [o[0] for o in owners] == sorted(o[0] for o in owners)
    assert all(i.level >= 4 or i.end[0] - i.start[0] <= 3 for i in fine)
    for i in final:
        inside = [L.content_size(L.markdown(document["pdf_info"][p]["para_blocks"][k])) for p, k in every if i.start < (p, k) < i.end]
        assert rendered.size(i.start, i.end) == (sum(x[0] for x in inside), sum(x[1] for x in inside))


def test_merge_rules():
    i = lambda a, b, parent="P", level=2: Interval((a, -1), (b, 0), parent, level)
    size = lambda s, e: (1, 50 * (e[0] - s[0]))  # noqa: E731  50 characters a page
    assert intervals.merge([i(0, 1), i(1, 2), i(2, 4)], size, 1, 100, 10) == [i(0, 2), i(2, 4)]
    assert intervals.merge([i(0, 2), i(2, 3)], size, 1, 100, 10) == [i(0, 3)]  # left, when nothing is right
    assert intervals.merge([i(0, 2), i(2, 3, "Q")], size, 1, 100, 10) == [i(0, 2), i(2, 3, "Q")]
    assert intervals.merge([i(0, 1), i(1, 9)], size, 1, 100, 9) == [i(0, 1), i(1, 9)]


def test_split_keeps_what_is_before_the_first_title():
    places, levels = {0: (0, 0), 1: (2, 1), 2: (3, 0)}, {0: 1, 1: 1, 2: 2}
    assert intervals.split("R", 1, (0, -1), (5, 0), places, levels) == [Interval((0, -1), (2, 1), "R", 1), Interval((2, 0), (5, 0), "R", 1)]
    assert intervals.split("R", 2, (0, -1), (5, 0), places, levels) == [Interval((0, -1), (3, 0), "R", 2), Interval((3, -1), (5, 0), "R", 2)]
    assert intervals.split("R", 3, (0, -1), (5, 0), places, levels) == [Interval((0, -1), (5, 0), "R", 3)]
    with pytest.raises(KeyError):
        intervals.split("R", 1, (0, -1), (5, 0), places, {9: 1})


def test_slice_document():
    pages = [{"page_idx": p, "para_blocks": [block("title", span(f"t{p}")), block("text", span("w" * 200)), image()]} for p in range(16)]
    document, levels = {"pdf_info": pages}, {t: 1 for t in range(16)}
    out = slice_document(document, document, levels, "doc", SliceParams())
    assert len(out) == 16 and out[0]["texts"][0] == "# t0" and out[0]["images"][-1] == {"relative_img_path": f"doc/{HEX}.jpg"} and out[0]["img_cnt"] == 1
    assert [x for c in out for x in c["page_location"]][:3] == [[0, -1], [1, 0], [1, -1]]
    fewer = {"pdf_info": pages[:15]}
    assert slice_document(fewer, fewer, levels, "doc", SliceParams()) == []  # too short
    assert slice_document(document, document, {}, "doc", SliceParams()) == []
    assert slice_document(document, document, {0: 3}, "doc", SliceParams(), 1, 2) == [] and len(slice_document(document, document, {0: 3}, "doc", SliceParams(), 1)) == 1
    with pytest.raises(KeyError):
        slice_document(document, document, {99: 1}, "doc", SliceParams())
    text = [x for c in out for x in c["texts"] if x]
    assert sum(len(t) for t in text) == sum(len(f"# t{p}") + 200 for p in range(16))  # nothing is lost


# --- adapters ----------------------------------------------------------------------------------


def test_adapter():
    titles = lambda *ts, **k: [{"title_idx": t, **{n: v[i] for n, v in k.items()}} for i, t in enumerate(ts)]
    assert adapters.search_titles({"blocks": titles(0, 0, 1, 2)}, 4) == [0, 0, 1, 2]
    assert adapters.search_titles({"blocks": titles(0, 0)}, 4) is None
    assert adapters.search_titles({"other": titles(5, 6, 7, slot_idx=[3, 1, 0])}, 4) == [7, 6, None, 5]
    assert adapters.search_titles({"blocks": [{"a": 1}] * 4, "items": [{"sectionId": "x", "chapter_id": 2}] * 4}, 4) == [2, 2, 2, 2]
    assert adapters.search_titles({"n": 3, "empty": []}, 4) is None


# --- contents ----------------------------------------------------------------------------------


def test_contents():
    page = [100, 200]
    assert content_list.content(block("title", span("T"), level=2, bbox=[10, 20, 50, 100]), 3, page) == {"type": "text", "text": "T", "text_level": 2, "bbox": [100, 100, 500, 500], "page_idx": 3}
    assert content_list.content(image("i.jpg", block("image_caption", span("c"))), 0, page, "f") == {"type": "image", "img_path": "f/i.jpg", "image_caption": ["c"], "image_footnote": [], "page_idx": 0}
    assert content_list.content_v2(block("title", span("T")), page) == {"type": "paragraph", "content": {"paragraph_content": [{"type": "text", "content": "T"}]}}
    assert content_list.content_v2(block("header", span("h"), span(" ")), page)["content"] == {"page_header_content": [{"type": "text", "content": "h"}]}
    table = {"type": "table", "blocks": [block("table_body", {"type": "table", "html": "<table colspan=2></table>", "image_path": "t"})]}
    got = content_list.content_v2(table, page, "f")["content"]
    assert got["table_type"] == "complex_table" and got["table_nest_level"] == 1 and got["image_source"] == {"path": "f/t"}
    assert content_list.content_v2(block("ref_text", span("r")), page)["content"]["list_type"] == "reference_list"
    assert content_list.body(image("i")) == ("i", "") and content_list.body({"blocks": []}) == ("", "")
    for wrong in ({"type": "code", "sub_type": "?", "blocks": []}, {"type": "list", "sub_type": "?", "blocks": []}):
        with pytest.raises(ValueError):
            content_list.content_v2(wrong, page)
    pages = [{"page_idx": 0, "page_size": page, "para_blocks": [block("text", span("a")), image()], "discarded_blocks": [block("footer", span("f"))]}]
    assert content_list.assemble(pages, "nlp_markdown") == "a" and len(content_list.assemble(pages, "content_list")) == 3
    assert [len(p) for p in content_list.assemble(pages, "content_list_v2")] == [3]
    with pytest.raises(ValueError):
        content_list.assemble(pages, "x")


# --- paragraphs --------------------------------------------------------------------------------


def text_block(*lines, kind="text"):
    """lines: (x0, x1, content); ten units high, twelve apart."""
    made = [{"bbox": [a, 12 * k, b, 12 * k + 10], "spans": [span(c)]} for k, (a, b, c) in enumerate(lines)]
    return {"type": kind, "bbox": [0, 0, 400, 12 * len(lines)], "lines": made}


def split(*blocks, pages=1):
    size = -(-len(blocks) // pages)
    given = [{"page_idx": p, "page_size": [600, 800], "preproc_blocks": list(blocks[p * size : (p + 1) * size])} for p in range(pages)]
    return [b for p in paragraphs.split_paragraphs(given) for b in p["para_blocks"]]


def test_paragraphs():
    assert paragraphs.split_paragraphs([]) == []
    index = split(text_block(*[(0, 400, f"chapter {k}") for k in range(5)]))[0]
    assert index["type"] == "index" and all(line["is_list_start_line"] for line in index["lines"])
    items = split(text_block((0, 300, "one;"), (0, 290, "two;"), (0, 400, "three;")))[0]
    assert items["type"] == "list" and [line.get("is_list_end_line", False) for line in items["lines"]] == [True] * 3
    prose = text_block(*[(0, 400, "words and") for _ in range(4)])
    first, second = split(prose, text_block(*[(0, 400, "more words") for _ in range(4)]), pages=2)
    assert len(first["lines"]) == 8 and second["lines_deleted"] and first["lines"][-1]["spans"][0]["cross_page"]
    apart = split(prose, text_block(kind="title", *[(0, 100, "T")]), text_block(*[(0, 400, "more") for _ in range(4)]))
    assert [len(b["lines"]) for b in apart] == [4, 1, 4]
    capital = split(prose, text_block(*[(0, 400, "More words") for _ in range(4)]))
    assert [len(b["lines"]) for b in capital] == [4, 4]
    short = split(text_block((0, 400, "a b")), text_block((0, 400, "c d")))
    assert [len(b["lines"]) for b in short] == [1, 1]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 60), st.integers(200, 400), st.sampled_from(["a", "1 x", "B.", "end;", ""])), min_size=1, max_size=6), max_size=5))
def test_paragraphs_lose_no_line(blocks):
    out = split(*[text_block(*b) for b in blocks])
    assert sum(len(b["lines"]) for b in out) == sum(map(len, blocks)) and len(out) == len(blocks)
    json.dumps(out)


# --- images and records of intervals -----------------------------------------------------------


def test_image_sizes(spark):
    import struct

    from pyspark.sql import functions as F

    from docpool.functions.images import image_size, size_of

    png = b"\x89PNG\r\n\x1a\n" + b"\0" * 8 + struct.pack(">II", 3, 4)
    jpeg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 7, 5)
    assert [image_size(x) for x in (png, b"GIF89a" + struct.pack("<HH", 1, 2), jpeg, b"", None, b"\xff\xd8\xff", b"text")] == [(3, 4), (1, 2), (5, 7)] + [(-1, -1)] * 4
    rows = spark.createDataFrame([(bytearray(png),), (None,)], "c binary").select(size_of(F.col("c")).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in rows] == [(3, 4), (-1, -1)]


def test_records_of_intervals():
    from docpool.operators.chapters import records_of_intervals

    document = {"pdf_info": [{"page_idx": 0, "para_blocks": [block("title", span("T")), image()]}, {"page_idx": 1, "para_blocks": [block("header", span("h"))]}]}
    found, empty = records_of_intervals(document, [((0, -1), (1, 0)), ((1, -1), (2, 0))], "/m/d/x", ("/o", "/m", "/c"), {"k": 1})
    assert empty == [((1, -1), (2, 0))] and found[0]["texts"] == ["T", None] and found[0]["img_cnt"] == 1 and found[0]["k"] == 1
    assert found[0]["meta_info"]["address"] == {"s3_origin_address": "/o/d/x.pdf", "s3_parse_address": "/m/d/x/x_middle.json", "s3_clean_address": "/c/d/x/x_cleaned_middle.json"}


def test_relevel():
    layout = {"pdf_info": [{"page_idx": p, "para_blocks": [block("title", span("a"), level=3), block("text", span("b"))]} for p in range(3)]}
    of = lambda x: [b.get("level") for p in x["pdf_info"] for b in p["para_blocks"]]
    assert of(L.relevel(layout, {0: 1, 2: 4})) == [1, None, 0, None, 4, None]
    assert of(L.relevel(layout, fixed=2)) == [2, None] * 3 and of(L.relevel(layout, {}, fixed=0)) == [0, None] * 3
    assert of(L.relevel(layout, fixed=2, places={0: (1, 0), 1: (2, 1), 2: (9, 0)})) == [3, None, 2, None, 3, None]
    assert of(layout) == [3, None] * 3
    for wrong in ({}, {"levels": {}}, {"levels": {0: 1}, "fixed": 1}):
        with pytest.raises(ValueError):
            L.relevel(layout, **wrong)


def test_unions_of_intervals():
    assert intervals.unions([[[2, 0], [3, 0]], [[0, -1], [1, 2]], [[1, 1], [2, 0]]]) == [[[0, -1], [2, 0]], [[2, 0], [3, 0]]]
    assert intervals.unions([]) == []
