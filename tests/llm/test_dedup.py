"""Near duplicates, lines and benchmark items against brute force."""

import random
from pathlib import Path

import numpy as np
import pytest
from brute import distance, line_links, lines_linked, near_duplicates, roots, shingles
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import same
from pyspark.sql import functions as F

from docpool.llm import common, decontaminate, line_dedup, near_dedup
from docpool.llm import queries as Q

WORDS = [f"w{i}" for i in range(400)]


def edited(rng, words, share):
    return [rng.choice(WORDS) if rng.random() < share else w for w in words]


def made_texts(seed, n=150):
    """Groups of copies and of near copies, texts that share a passage, short and empty ones."""
    rng = random.Random(seed)
    passage = [rng.choice(WORDS) for _ in range(60)]
    out = [None, "", " \n", "one", "One", "a b c d", "A b c d", "a b c d e"]
    for _ in range(n // 5):
        base = [rng.choice(WORDS) for _ in range(rng.randint(20, 200))]
        out += [" ".join(base), " ".join(base).upper(), " ".join(edited(rng, base, 0.02)), " ".join(edited(rng, base, 0.06)), " ".join(passage + base)]
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" abAB\n\t\x0b\xa0é", max_size=30), max_size=5))
def test_shingles(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([0] + [len(t.encode()) for t in texts])
    values, at = common.distinct_per_row(*common.shingle_hashes(data, ends))
    every = {}
    for i, t in enumerate(texts):
        own = shingles(t)
        assert at[i + 1] - at[i] == len(own)
        every.update(dict.fromkeys(own))
        assert {len(shingles(t)) for t in texts if set(values[at[i] : at[i + 1]]) == set()} <= {0, len(own)} | {len(shingles(t)) for t in texts}
    assert len(np.unique(values)) == len(every)


def test_registers_merge_and_estimate():
    rng = np.random.RandomState(1)
    a, b = rng.randint(0, 1 << 62, 3000).astype(np.uint64), rng.randint(0, 1 << 62, 3000).astype(np.uint64)
    one = lambda x: near_dedup.registers(x, np.array([0, len(x)]))
    assert (one(np.concatenate((a, b))) == np.maximum(one(a), one(b))).all()
    for shared in (0, 1500, 2400, 2900):
        other = np.concatenate((a[:shared], b[: 3000 - shared]))
        true = shared / (6000 - shared)
        score, near = near_dedup.estimate(one(a), np.array([3000]), one(other), np.array([3000]))
        assert abs(score[0] - true) < 0.2 and near[0] == (true > 0.6)
    assert (near_dedup.registers(np.empty(0, np.uint64), np.array([0, 0])) == 0).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, seed):
    texts = made_texts(seed)
    want = near_duplicates(list(enumerate(texts)))
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_shingles string")
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs).collect()}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items()) and len({w[1] for w in want.values()}) < len(want) - 20
    kept = near_dedup.drop_near_duplicates(docs.union(docs))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, w in want.items() if i == w[1]) and kept.columns == docs.columns


def test_large_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 20)
    rng = random.Random(4)
    base = [rng.choice(WORDS) for _ in range(120)]
    texts = [" ".join(edited(rng, base, rng.choice([0.01, 0.03, 0.05]))) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == near_duplicates(list(enumerate(texts)))


def test_near_duplicates_of_nothing(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (5, "x y z q r s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in near_dedup.near_duplicates(docs).collect())
    assert got == [("1", "1", True), ("1", "1", True), ("5", "5", True), ("None", "None", True)]
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_ids_with_several_texts(spark):
    rng = random.Random(11)
    base = {k: [rng.choice(WORDS) for _ in range(60)] for k in "ABCD"}
    text = {k: " ".join(v) for k, v in base.items()} | {"a": " ".join(base["A"][:-1] + ["other"]), "": "", "null": None}
    rows = [(5, "A"), (9, "A"), (9, "B"), (12, "B"), (13, "a"), (13, "C"), (20, "C"), (21, "D"), (21, "D"), (22, ""), (22, "D"), (23, ""), (23, "null"), (24, "null")]
    docs = spark.createDataFrame([(i, text[k], k, 1, 2) for i, k in rows], "doc_id long, text string, name string, same int, rank int")
    near = lambda x, y: 100 * len(shingles(x) & shingles(y)) >= 75 * len(shingles(x) | shingles(y)) > 0
    links = [(i, j) for i, k in rows for j, m in rows if i != j and near(text[k], text[m])]
    root = roots({i for i, _ in rows}, links)
    got = near_dedup.near_duplicates(docs).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == sorted((i, len(shingles(text[k])), root[i], root[i] == i) for i, k in rows)
    left = near_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    kept = [(r["doc_id"], r["name"]) for r in left.collect()]
    # of every group of like texts one stays; empty texts are like nothing, but a repeated row goes
    groups = {"A": (5, {"A", "a"}), "B": (9, {"B"}), "C": (13, {"C"}), "D": (21, {"D"})}
    assert sorted(x for x in kept if x[1] not in ("", "null")) == sorted((i, next(k for d, k in rows if d == i and k in own)) for i, own in groups.values())
    assert sorted(x for x in kept if x[1] in ("", "null")) == [(22, ""), (23, ""), (23, "null"), (24, "null")]


def test_near_dedup_against_sql(spark, sf_dir):
    same(Q.op2_near_dedup(spark, sf_dir), Q.ORACLES["op2_near_dedup"], sf_dir)


@pytest.mark.parametrize("one_task", [0, 10**6])
def test_components(spark, one_task):
    rng = random.Random(7)
    edges = [(rng.randint(-200, 200), rng.randint(-200, 200)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1060)] + [(5000, i) for i in range(4000, 4100)] + [(9, 9)]
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(edges, "a long, b long"), one_task=one_task).collect()}
    proper = [e for e in edges if e[0] != e[1]]
    assert got == roots({x for e in proper for x in e}, proper)
    assert common.components(spark.createDataFrame([], "a long, b long"), one_task=one_task).count() == 0


# --- lines -------------------------------------------------------------------------------------


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="abé", max_size=16), st.text(alphabet="abé", max_size=16), st.integers(1, 4))
def test_edit_distance(a, b, most):
    assert line_dedup.within(a, b, most) == (distance(a, b, most) <= most)


@settings(max_examples=60, deadline=None)
@given(st.integers(33, 130), st.lists(st.tuples(st.floats(0, 0.99), st.sampled_from("+-x")), max_size=40), st.integers(0, 31), st.integers(0, 10**6))
def test_edit_distances_side_by_side(size, edits, most, seed):
    rng = random.Random(seed)
    a = [rng.choice("ab é") for _ in range(size)]
    b = list(a)
    for at, kind in edits:
        k = int(at * len(b))
        b[k : k + (kind != "+")] = [] if kind == "-" else [rng.choice("abz")]
    a, b = "".join(a), "".join(b)
    want = distance(a, b, most) <= most
    assert line_dedup.within_pairs([a, b, a, a], [b, a, a, ""], np.array([most, most, 0, most])).tolist() == [want, want, True, len(a) <= most]
    assert line_dedup.within(a, b, most) == want


def test_many_edits_side_by_side(monkeypatch):
    rng, one, two, least = random.Random(5), [], [], []
    for letters in ("ab", "abcdefgh é", "abcdefgh 日", "abcdefgh 😀"):
        for size, edits in ((650, 45), (900, 60)):
            a = "".join(rng.choice(letters) for _ in range(size))
            b = list(a)
            for _ in range(edits):
                k = rng.randint(0, len(b) - 1)
                b[k : k + rng.choice([0, 1, 1])] = rng.choice([[], ["x"], [rng.choice(letters)]])
            one, two, least = [*one, a], [*two, "".join(b)], [*least, distance(a, "".join(b), 100)]
    monkeypatch.setattr(line_dedup, "within", None)  # which takes one pair at a time
    assert min(least) > 15 and max(least) > 31
    for less in (1, 0):
        assert line_dedup.within_pairs(one + two, two + one, np.array(least * 2) - less).tolist() == [not less] * len(one) * 2


def test_lines_of_each_text(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n\n "), (4, "a\nb"), (4, "c")], "doc_id long, text string")
    rows = line_dedup.line_table(docs, line_dedup.EVERY).where("h1 is null").collect()
    assert sorted((r["doc_id"], r["line"], r["size"]) for r in rows) == [(1, -1, 0), (2, -1, 1), (3, -1, 3), (4, -1, 1), (4, -1, 2)]


def made_lines(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcde é日") for _ in range(rng.randint(20, 60))).replace("\n", " ") for _ in range(40)]
    texts = [None, "", "short", "\n\n"]
    for _ in range(60):
        lines = []
        for _ in range(rng.randint(1, 6)):
            x = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4])):
                k = rng.randint(0, len(x) - 1)
                rng.choice([lambda: x.insert(k, "z"), lambda: x.pop(k), lambda: x.__setitem__(k, "y")])()
            lines.append("".join(x))
        texts.append("\n".join(lines))
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lines(spark, seed):
    texts = made_lines(seed)
    docs = spark.createDataFrame([(i, t, "clash", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, line string, n_chars long")
    lines, links = line_links(texts, 24)
    assert len(links) > 30
    number = {x: i for i, x in enumerate(lines)}
    root = roots(range(len(lines)), [(number[a], number[b]) for a, b in links])
    seen, want, kept = set(), {}, {}
    for i, t in enumerate(texts):
        parts = [] if t is None else t.split("\n")
        stay = []
        for x in parts:
            c = root[number[x]] if x in number else None
            if c is None or c not in seen:
                stay.append(x)
            if c is not None:
                seen.add(c)
        degree = sum(sum(x in link for link in links) for x in {p for p in parts if p in number})
        want[i], kept[i] = (len(parts), len(parts) - len(stay), degree), "\n".join(stay)
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["n_links"]) for r in line_dedup.line_report(docs).collect()}
    assert got == want
    left = line_dedup.drop_repeated_lines(docs)
    assert left.columns == docs.columns and left.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    rows = {r["doc_id"]: r for r in left.collect()}
    changed = {i for i in kept if want[i][1]}
    assert {i: r["text"] or "" for i, r in rows.items()} == {i: t for i, t in kept.items() if i not in changed or t.strip()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values() if r["text"] is not None)


def test_lines_of_odd_rows(spark):
    line = "a line that is long enough to count"
    rows = [(None, line), (1, line), (1, line), (2, f"{line}\n{line}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as gone", "2 as _GONE")
    assert sorted((r["doc_id"] or -1, r["text"]) for r in line_dedup.drop_repeated_lines(docs).collect()) == [(-1, line), (1, line), (1, line)]
    assert line_dedup.line_report(docs.limit(0)).count() == 0 and line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_short_lines(spark, tmp_path):
    texts = ["All rights reserved.\nab\n\n \n", "x\nAll rights reserved.\nac", "\n \nx\nall rights reserved.", "ab\t\nab\n\xa0\n\xa0"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["n_links"]) for r in Q.op3_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {0: (5, 0, 0), 1: (3, 1, 0), 2: (4, 1, 0), 3: (4, 1, 0)}
    left = line_dedup.drop_repeated_lines(docs, shortest=line_dedup.EVERY)
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {0: texts[0], 1: "x\nac", 2: "\n \nall rights reserved.", 3: "ab\t\n\xa0\n\xa0"}


def test_line_classes(spark):
    long = "a line that is long enough to be compared with others"
    texts = [f"other\n{long}\nsame", f"same\n{long}!", "none of these", None, "same\nsame"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: ([tuple(c) for c in r["classes"]], r["n_removed"]) for r in line_dedup.line_report(docs, shortest=line_dedup.EVERY).collect()}
    assert got == {0: ([(1, 0, 1), (2, 0, 2)], 0), 1: ([(0, 0, 2), (1, 0, 1)], 2), 2: ([], 0), 3: ([], 0), 4: ([(0, 0, 2), (1, 0, 2)], 2)}


def made_long_lines(seed):
    """Lines of 55 to 400 characters, each with copies whose edits are spread evenly, in one word, or anywhere."""
    rng = random.Random(seed)
    out = []
    for size in (55, 59, 60, 61, 79, 80, 100, 119, 120, 250, 400):
        line = "".join(rng.choice("abcdefghij é日") for _ in range(size))
        out.append(line)
        for n in (size // 20 - 1, size // 20, size // 20 + 1):
            spread, gap = list(line), size / (n + 1)
            for k in range(1, n + 1):
                spread[round(k * gap) - 1] = "Z"
            at = rng.randint(0, size - 1)
            some = list(line)
            for _ in range(n):
                k = rng.randint(0, len(some) - 1)
                rng.choice([lambda: some.insert(k, "Y"), lambda: some.pop(k), lambda: some.__setitem__(k, "X")])()
            out += ["".join(spread), line[:at] + "w" * n + line[at:], "".join(some)]
    return out


@pytest.mark.parametrize(("seed", "small", "block"), [(1, 32, 400), (2, 32, 400), (3, 2, 5)])
def test_long_lines(spark, monkeypatch, seed, small, block):
    monkeypatch.setattr(line_dedup, "SMALL", small)
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    if seed == 3:  # every key is common, and so dealt to several tasks
        monkeypatch.setattr(line_dedup, "common_keys", lambda table: table.select(F.explode("keys").alias("key")).distinct())
    lines = sorted(set(made_long_lines(seed)))
    want = {(x, y) for i, x in enumerate(lines) for y in lines[i + 1 :] if lines_linked(x, y)}
    assert sum(distance(x, y, line_dedup.EDITS) > line_dedup.EDITS for x, y in want) > 20
    texts = line_dedup._texts(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string"), "doc_id", "text")
    places = line_dedup.line_table(texts)
    line_of = {r["h1"]: lines[r["doc_id"]] for r in places.collect()}
    links, degrees = line_dedup.line_links(texts, places, line_dedup.line_kinds(places))
    got = {tuple(sorted((line_of[r["a"]], line_of[r["b"]]))) for r in links.collect()}
    assert got <= want and roots(lines, got) == roots(lines, want)
    assert {line_of[r["h1"]]: r["degree"] for r in degrees.collect()} == {x: n for x in lines if (n := sum(x in link for link in want))}


@pytest.mark.parametrize(("seed", "small", "block"), [(1, 32, 400), (2, 2, 5)])
def test_edits_anywhere(spark, monkeypatch, tmp_path, seed, small, block):
    monkeypatch.setattr(line_dedup, "SMALL", small)
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    if seed == 2:  # every key is common
        monkeypatch.setattr(line_dedup, "SAMPLE", 1)
        monkeypatch.setattr(line_dedup, "common_keys", lambda table: table.select(F.explode("keys").alias("key")).distinct())
    lines = sorted(set(made_long_lines(seed)))
    most = lambda x, y: 2 if min(len(x), len(y)) < 60 else min(len(x), len(y)) // 20
    want = [(i, j) for i, x in enumerate(lines) for j, y in enumerate(lines[:i]) if distance(x, y, most(x, y)) <= most(x, y)]
    assert sum(not lines_linked(lines[i], lines[j]) for i, j in want) > 5  # of which no run of a third is left
    spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_links"], r["n_removed"]) for r in Q.op3_line_dedup(spark, str(tmp_path)).collect()}
    root = roots(range(len(lines)), want)
    assert got == {i: (sum(i in link for link in want), int(root[i] != i)) for i in range(len(lines))}
    kept = line_dedup.drop_repeated_lines(spark.read.parquet(f"{tmp_path}/documents.parquet"), places=line_dedup.ANYWHERE)
    assert {r["doc_id"] for r in kept.collect()} == set(root.values())


@settings(max_examples=150, deadline=None)
@given(st.integers(60, 700), st.integers(1, 3), st.integers(0, 10**6), st.sampled_from(["ab", "abcdefgh é日"]))
def test_lines_edited_anywhere_share_a_key(size, spread, seed, letters):
    rng = random.Random(seed)
    a = "".join(rng.choice(letters) for _ in range(size))
    b, gap = list(a), size / (size // 20 + 1)
    for k in range(size // 20, 0, -1):  # as far apart as they can be, or somewhat off
        at = min(size - 1, max(0, round(k * gap) - 1 + rng.randint(0, spread - 1)))
        b[at : at + rng.choice([0, 1, 1])] = rng.choice(["x", "y"])
    b = "".join(b)
    if a != b and line_dedup.linked(a, b, line_dedup.ANYWHERE):
        f = line_dedup.Fingerprints([a, b])
        rows, keys = f.keys(np.arange(2), line_dedup.ANYWHERE)
        shared = set(keys[rows == 0].view(np.int64).tolist()) & set(keys[rows == 1].view(np.int64).tolist())
        assert shared and line_dedup.least_shared_keys([a, b], [b, a], line_dedup.ANYWHERE).tolist() == [min(shared)] * 2
        x, y = f.sketches(np.arange(2))
        assert line_dedup.changes(x[None], y[None])[0] <= 4 * line_dedup.allowed(min(len(a), len(b)))


@settings(max_examples=150, deadline=None)
@given(st.integers(60, 700), st.integers(0, 10**6), st.sampled_from(["abcdefgh ", "ab     ", "abcdé  日本語文字列の"]), st.booleans())
def test_edited_words_share_a_key(size, seed, letters, at_spaces):
    rng = random.Random(seed)
    a = "".join(rng.choice(letters) for _ in range(size))
    b = list(a)
    for _ in range(size // 20):  # the spaces between words change two at once
        spaces = [k for k, c in enumerate(b) if c == " "] if at_spaces else []
        at = rng.choice(spaces) if spaces else rng.randint(0, len(b) - 1)
        b[at : at + rng.choice([0, 1, 1])] = rng.choice(["x", " ", ""])
    b = "".join(b)
    if a != b and min(len(a), len(b)) >= line_dedup.MIN_CHARS and line_dedup.linked(a, b, line_dedup.ANYWHERE):
        assert line_dedup.maybe_linked([a, b], [b, a]).all()
        f = line_dedup.Fingerprints(["other words", a, "words\nof other lines", b])
        rows, keys = f.keys(np.array([0, 1]), line_dedup.ANYWHERE)  # the two lines of MIN_CHARS or more
        shared = set(keys[rows == 0].view(np.int64).tolist()) & set(keys[rows == 1].view(np.int64).tolist())
        assert shared and line_dedup.least_shared_keys([a], [b], line_dedup.ANYWHERE).tolist() == [min(shared)]


def test_first_words_outlast_the_edits():
    rng = np.random.default_rng(4)
    count = np.array([0, 1, 7, 40, 200, 0, 90])
    line, most = np.repeat(np.arange(7), count), np.array([3, 0, 3, 10, 20, 3, 50])
    order = rng.integers(0, 60, len(line)).astype(np.uint32)  # some of the same rank
    head = np.cumsum(count) - count
    taken, few = line_dedup.first_words(line, order, head, count, most)
    for k in range(7):
        own = [w - head[k] for w in taken.tolist() if line[w] == k]
        apart, last = 0, -2
        for w in own:  # no two neighbours
            apart, last = (apart + 1, w) if w > last + 1 else (apart, last)
        assert (apart <= most[k]) == (k in few) and (k not in few or len(own) == count[k])
        if own:
            assert own == np.flatnonzero(order[line == k] <= max(order[line == k][own])).tolist()
    assert few.tolist() == [0, 5, 6]


def test_shuffles_are_freed(spark, tmp_path):
    name, ids = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", spark.range(100).repartition(3, "id")
    before, place = spark.conf.get(name), Path(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    files = lambda: {p for p in place.rglob("shuffle_*.data")}
    there = files()
    with common.shuffles_freed(spark):
        common.written(ids, "freed")
    assert not files() - there and spark.conf.get(name) == before
    common.written(ids.where("id > 1"), "kept")
    assert files() - there


def test_lines_of_words_have_few_keys():
    rng = random.Random(2)
    line = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(200))
    assert len(line_dedup.Fingerprints([line]).keys(np.arange(1), line_dedup.ANYWHERE)[1]) < len(line) / 6  # more than a third by grams alone


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=20), st.integers(0, 64))
def test_packed_numbers(values, bits):
    values = np.array([v >> bits for v in values], np.uint64)
    assert line_dedup.unpacked(line_dedup.packed(values), len(values)).tolist() == values.tolist()


@settings(max_examples=150, deadline=None)
@given(st.integers(60, 700), st.lists(st.tuples(st.floats(0, 1), st.sampled_from("+-x"), st.integers(1, 12)), max_size=3), st.integers(0, 10**6), st.sampled_from(["ab", "abcdefgh é日"]))
def test_linked_lines_share_a_key(size, edits, seed, letters):
    rng = random.Random(seed)
    a = "".join(rng.choice(letters) for _ in range(size))
    b = a
    for at, kind, n in edits:
        k = int(at * len(b))
        b = b[:k] + ("" if kind == "-" else "".join(rng.choice("xyz") for _ in range(n))) + b[k + (0 if kind == "+" else n) :]
    assert line_dedup.linked(a, b) == lines_linked(a, b)
    assert line_dedup.linked_pairs([a, b, a], [b, a, a[:70]]).tolist() == [line_dedup.linked(a, b)] * 2 + [line_dedup.linked(a, a[:70])]
    if a != b and line_dedup.linked(a, b):
        f = line_dedup.Fingerprints([a, b])
        rows, keys = f.keys(np.arange(2))
        shared = set(keys[rows == 0].view(np.int64).tolist()) & set(keys[rows == 1].view(np.int64).tolist())
        assert shared and line_dedup.least_shared_keys([a], [b]).tolist() == [min(shared)]
        assert line_dedup.changes(line_dedup.pair_counts([a]), line_dedup.pair_counts([b])[0])[0] <= 4 * line_dedup.allowed(min(len(a), len(b)))


# --- benchmark items ---------------------------------------------------------------------------


def test_decontamination_against_sql(spark, sf_dir):
    same(Q.op8_decontaminate(spark, sf_dir), Q.ORACLES["op8_decontaminate"], sf_dir)


@pytest.mark.parametrize("block", [10**6, 60])
def test_items(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", block)
    rng = random.Random(3)
    items = [None, "", "one two", "ONE two three", *(" ".join(rng.choice(WORDS[:60]) for _ in range(rng.randint(4, 40))) for _ in range(25))]
    texts = [None, "", "one two", "one two three", "one two three four five"]
    for _ in range(120):
        words = [rng.choice(WORDS) for _ in range(rng.randint(0, 300))]
        item = (rng.choice(items[4:])).split()
        texts.append(" ".join(words + edited(rng, item, rng.choice([0, 0.02, 0.05])) + words[:20]))
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, containment double")
    tests = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    sets = [shingles(t) for t in items]
    want = {(d, i, len(s), len(s & shingles(t))) for d, t in enumerate(texts) for i, s in enumerate(sets) if s and 100 * len(s & shingles(t)) >= 75 * len(s)}
    got = [tuple(r) for r in decontaminate.contained_items(docs, tests).drop("containment").collect()]
    assert set(got) == want and len(got) == len(want) > 40
    clean = {r["doc_id"] for r in decontaminate.drop_contaminated(docs, tests).collect()}
    assert clean == set(range(len(texts))) - {w[0] for w in want}
    assert decontaminate.contained_items(docs.limit(0), tests).count() == 0
    assert decontaminate.contained_items(docs, tests.limit(0)).count() == 0 and decontaminate.drop_contaminated(docs, tests.limit(0)).count() == len(texts)
