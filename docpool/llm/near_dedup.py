"""Near-duplicate groups from SetSketch registers.

Every document's set of distinct five-word shingles is condensed to SetSketch registers: minima of
exponential hashes, kept as truncated logarithms to a base near 1. Registers of a union are the
element-wise maxima of the parts' registers, and equal registers are as likely as the sets are
similar, so bands of registers serve as join keys. Candidates are tested by the likelihood of the
Jaccard similarity given how many registers are greater, smaller and equal; what passes is verified
on the full shingle sets.

Equal sets are one class from the start, so that copies are never paired. Links between classes are
then sought in two rounds: of each class with the most promising of its buckets' smallest members; and
between all members of a bucket that are still in different components, large buckets being dealt out
in pairs of blocks. Neither caps or drops candidates; pairs never leave the task that verifies them.

What is missed, of pairs at similarity 0.75: those that share none of 32 bands of 4 registers, 6e-6; those
with fewer than 64 of 128 registers equal, 4e-10; and those whose likelihood at 0.75 is below exp(-SLACK)
times the best, about 1e-6. More similar pairs are missed less often.

Defined results: null or wordless texts have an empty set and are linked with nothing; rows that
share a doc_id are one document: each row has the size of its own set, all have one component_id and kept,
and what is linked with any of them is linked with all; a null doc_id has null component_id and is kept;
an empty table gives an empty result; further columns are ignored. `drop_near_duplicates` looks at texts:
of each group of linked texts the row of least doc_id stays (of several with it the one of least
fingerprint and text), so that every text that goes is linked, by steps, with one that stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docpool.llm import common

ROWS, BANDS = 4, 32
REGISTERS = ROWS * BANDS
BASE, RATE, TOP = 1.001, 20.0, 65_534
#: Shared shingles, times 100, against all shingles times this.
PERCENT = 75
#: A candidate goes on if similarity 0.75 is no less likely than exp(-SLACK) times the best estimate.
SLACK = 12.0
#: Members of a bucket, and shingles of theirs, that make a block.
BLOCK, BLOCK_SHINGLES = 500, 4_000_000

_rng = np.random.RandomState(77)
_ODD = _rng.randint(0, 1 << 62, REGISTERS, dtype=np.uint64) * np.uint64(4) + np.uint64(1)
_ADD = _rng.randint(0, 1 << 62, REGISTERS, dtype=np.uint64) * np.uint64(4)


# --- registers ---------------------------------------------------------------------------------


def registers(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of 128 registers for each set; an empty set has zeros."""
    out = np.zeros((len(ends) - 1, REGISTERS), np.uint16)
    full = np.flatnonzero(np.diff(ends))
    if len(full) == 0:
        return out
    at = ends[:-1][full]
    least = np.empty((len(full), REGISTERS), np.uint64)
    for j in range(REGISTERS):
        least[:, j] = np.minimum.reduceat((values * _ODD[j] + _ADD[j]) >> np.uint64(32), at)
    x = -np.log1p(-(least + 0.5) / 4294967296.0) / RATE
    out[full] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)
    return out


def _chance(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def estimate(r1: np.ndarray, n1: np.ndarray, r2: np.ndarray, n2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joint likelihood of register pairs: the best similarity, and whether 0.75 or more is plausible."""
    more, less = (r1 > r2).sum(1), (r1 < r2).sum(1)
    same = REGISTERS - more - less
    u = n1 / (n1 + n2)
    v = 1 - u
    limit = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 41)[None, :] * limit[:, None]
    up = np.clip(_chance(u[:, None] - v[:, None] * grid), 1e-9, 1)
    down = np.clip(_chance(v[:, None] - u[:, None] * grid), 1e-9, 1)
    even = np.clip(1 - up - down, 1e-9, 1)
    like = more[:, None] * np.log(up) + less[:, None] * np.log(down) + same[:, None] * np.log(even)
    best = like.max(1)
    near = np.where(grid >= PERCENT / 100 - 0.02, like, -np.inf).max(1)
    return grid[np.arange(len(grid)), like.argmax(1)], near >= best - SLACK


def linked(shared: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    return 100 * shared >= PERCENT * (n1 + n2 - shared)


# --- sketches ----------------------------------------------------------------------------------


def fingerprints(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set, as two columns; an empty set has zeros."""
    mixed = common.mix64(values ^ np.uint64(0x5BF03635))
    a, full = np.zeros(len(ends) - 1, np.uint64), np.flatnonzero(np.diff(ends))
    b = a.copy()
    if len(full):
        a[full], b[full] = np.add.reduceat(values, ends[:-1][full]), np.add.reduceat(mixed, ends[:-1][full])
    return a.view(np.int64), b.view(np.int64)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, a 128-bit fingerprint of the set (set_a, set_b) and its registers."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.let_go()
        for batch in common.steps(batches, "text"):
            sh, ends = common.distinct_per_row(*common.shingle_hashes(*common.utf8(batch.column(1))))
            width = np.arange(len(ends), dtype=np.int64) * REGISTERS
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends)), *map(pa.array, fingerprints(sh, ends)), common.binary_slices(registers(sh, ends).ravel(), width)], ["doc_id", "n_shingles", "set_a", "set_b", "regs"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(sketch, "doc_id long, n_shingles long, set_a long, set_b long, regs binary")


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep and the sorted shingle hashes of the sets (doc_id, set_a, set_b) that are wanted as rep."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.let_go()
        for batch in common.steps(batches, "text"):
            sh, ends = common.distinct_per_row(*common.shingle_hashes(*common.utf8(batch.column(1))))
            a, b = fingerprints(sh, ends)
            own = (a == batch.column(3).to_numpy()) & (b == batch.column(4).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(2), common.binary_slices(sh, ends)], ["rep", "shingles"]).filter(pa.array(own))

    return docs.join(wanted.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "rep", "set_a", "set_b").mapInArrow(make, "rep long, shingles binary")


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                keep.append(bool(linked(np.count_nonzero(both[1:] == both[:-1]), len(x), len(y))))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(exact, "a long, b long").distinct()


# --- buckets -----------------------------------------------------------------------------------


def band_rows(classes: DataFrame) -> DataFrame:
    """(key, band, rep): a row for each band of each class."""
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("regs", 1 + i * ROWS * 2, ROWS * 2)) for i in range(BANDS)])
    return classes.select("rep", F.posexplode(keys).alias("band", "key"))


def plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b, score) of the pairs whose registers allow enough similarity."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            r1, r2 = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (3, 5))
            n1, n2 = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            score, near = estimate(r1, n1, r2, n2)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["a", "b", "score"]).filter(pa.array(near))

    one = classes.select(F.col("rep").alias("a"), F.col("n").alias("n1"), F.col("regs").alias("r1"))
    two = classes.select(F.col("rep").alias("b"), F.col("n").alias("n2"), F.col("regs").alias("r2"))
    fits = f"100 * least(n1, n2) >= {PERCENT} * greatest(n1, n2)"
    return pairs.join(one, "a").join(two, "b").where(fits).select("a", "b", "n1", "r1", "n2", "r2").mapInArrow(test, "a long, b long, score double")


class Group:
    """Members of a bucket, or of two blocks of it, that are compared in one go."""

    def __init__(self, held: list[pa.RecordBatch]):
        self.table = pa.Table.from_batches(held).combine_chunks()
        col = lambda name: self.table.column(name).to_numpy()
        self.ids, self.comp, self.n, self.own = col("rep"), col("comp"), col("n"), col("own")
        self.band = self.table.column("band")[0].as_py()
        self.halves = self.table.column("i")[0].as_py() != self.table.column("j")[0].as_py()
        self.regs = np.frombuffer(b"".join(self.table.column("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)

    def pairs(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(member, others, scores) of plausible pairs in different components.

        A pair that shares several bands is looked at in the first of them only.
        """
        for i in range(len(self.ids) - 1):
            rest = slice(i + 1, None)
            ok = (self.comp[rest] != self.comp[i]) & (100 * np.minimum(self.n[rest], self.n[i]) >= PERCENT * np.maximum(self.n[rest], self.n[i]))
            if self.halves:
                ok &= self.own[rest] != self.own[i]
            j = np.flatnonzero(ok) + i + 1
            if len(j) == 0:
                continue
            same = self.regs[j] == self.regs[i]
            first = same.reshape(-1, BANDS, ROWS).all(2).argmax(1)
            j = j[(same.sum(1) >= REGISTERS // 2) & (first == self.band)]
            if len(j) == 0:
                continue
            score, near = estimate(np.broadcast_to(self.regs[i], (len(j), REGISTERS)), np.full(len(j), self.n[i]), self.regs[j], self.n[j])
            yield i, j[near], score[near]


def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[Group]:
    """Groups of rows sorted by key, i and j."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, i, j = (batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in ("key", "i", "j"))
        cuts = (np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1).tolist()
        for s, e in zip([0, *cuts], [*cuts, batch.num_rows]):
            group = (key[s], i[s], j[s])
            if now is not None and group != now:
                yield Group(held)
                held = []
            now = group
            held.append(batch.slice(s, e - s))
    if held:
        yield Group(held)


def links_apart(bands: DataFrame, classes: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): links that join components which share a bucket.

    Of every bucket with several components, members are compared by their registers; those that are
    in a plausible pair come again with their sets, and the pairs are verified where they meet, the most
    similar first. Pairs that links found there have joined already need no more verification, so a
    bucket of m members gives less than m links.
    """
    named = bands.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").select("key", "band", "rep", F.coalesce("root", "rep").alias("comp"))
    active = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    active_rows = common.written(named.join(active, "key").join(classes.select("rep", "n", "regs"), "rep"), "active")
    # blocks of so many members and shingles that two of them, with their sets, fit in a task
    blocks = active_rows.groupBy("key").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    rows = active_rows.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # a block of a bucket meets every block: groups (own, j) for j from own on, and (i, own) below
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j")))
    dealt = rows.select("key", "band", "rep", "comp", "own", "n", "regs", F.explode(meet).alias("ij"))
    schema = "key long, band int, rep long, comp long, own int, i int, j int, n long, regs binary"
    names = [x.split()[0] for x in schema.split(", ")]
    n = int(bands.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def gathered(df: DataFrame) -> DataFrame:
        return df.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j", "rep")

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_group(batches):
            marked = np.zeros(len(group.ids), bool)
            for i, others, _ in group.pairs():
                marked[others] = True
                marked[i] |= len(others) > 0
            if marked.any():
                yield from group.table.filter(pa.array(marked)).to_batches()

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_group(batches):
            found = sorted(((s, i, int(k)) for i, others, scores in group.pairs() for k, s in zip(others, scores)), key=lambda f: -f[0])
            texts = group.table.column("shingles")
            own = [np.frombuffer(texts[i].as_buffer(), np.uint64) for i in range(len(texts))]
            top: dict[int, int] = {}

            def root(x: int) -> int:
                while x in top:
                    x = top[x]
                return x

            out = []
            for _, i, k in found:
                p, q = root(int(group.comp[i])), root(int(group.comp[k]))
                if p == q:
                    continue
                both = np.concatenate((own[i], own[k]))
                both.sort()
                if linked(np.count_nonzero(both[1:] == both[:-1]), len(own[i]), len(own[k])):
                    top[max(p, q)] = min(p, q)
                    out.append((int(group.ids[i]), int(group.ids[k])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    full = gathered(dealt.select("key", "band", "rep", "comp", "own", "ij.i", "ij.j", "n", "regs"))
    again = common.written(full.mapInArrow(promising, schema), "promising")
    met = again.join(sets, "rep").select(*names, "shingles")
    return common.written(gathered(met).mapInArrow(confirm, "a long, b long").distinct(), "links-apart", done=[active_rows, again])


# --- the operator ------------------------------------------------------------------------------


class Groups(NamedTuple):
    """What is known of all rows, classes of equal sets, and components of classes.

    every: doc_id, n_shingles, set_a, set_b. classes: set_a, set_b, rep (the class's name), least (its least
    doc_id), copies. roots: node and root of linked classes. several: ids of rows with different sets.
    """

    every: DataFrame
    classes: DataFrame
    roots: DataFrame
    several: DataFrame

    def members(self, roots: DataFrame) -> DataFrame:
        """set_a, set_b and component of the classes that are more than one row: its least doc_id."""
        named = self.classes.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").where("copies > 1 or root is not null")
        named = named.select("set_a", "set_b", "least", F.coalesce("root", "rep").alias("root"))
        return named.join(named.groupBy("root").agg(F.min("least").alias("component")), "root").select("set_a", "set_b", "component")


def linked_texts(docs: DataFrame) -> Groups:
    """Links between the texts of docs (doc_id, text)."""
    every = common.written(sketches(docs), "sketches")
    kinds = every.where("n_shingles > 0 and doc_id is not null")
    different = " or ".join(f"min_{c} <> max_{c}" for c in ("n_shingles", "set_a", "set_b"))
    sets_of = every.where("doc_id is not null").groupBy("doc_id").agg(*[f(c).alias(f"{n}_{c}") for c in ("n_shingles", "set_a", "set_b") for n, f in (("min", F.min), ("max", F.max))])
    several = common.written(sets_of.where(different).select("doc_id"), "several")
    classes = kinds.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("regs").alias("regs"), F.count("*").alias("copies"))
    # the least id names a class, unless it has several sets
    marked = classes.join(several.select(F.col("doc_id").alias("least"), F.lit(True).alias("shared")), "least", "left")
    classes = common.written(marked.withColumn("rep", F.when(F.col("shared"), F.xxhash64("set_a", "set_b")).otherwise(F.col("least"))).drop("shared"), "classes")
    # buckets of two or more classes
    bands = band_rows(classes)
    shared = bands.groupBy("key").agg(F.count("*").alias("size"), F.min("rep").alias("least")).where("size > 1")
    bands = common.written(bands.join(shared.hint("shuffle_hash"), "key").select("key", "band", "rep", "least"), "buckets")
    wanted = bands.select("rep").distinct().join(classes, "rep").select(F.col("least").alias("doc_id"), "rep", "set_a", "set_b")
    sets = common.written(shingle_sets(docs, wanted), "sets")
    # first round: the most promising of the buckets' smallest members
    stars = plausible(bands.where("rep <> least").select(F.col("least").alias("a"), F.col("rep").alias("b")).distinct(), classes)
    links = common.written(verify(stars.groupBy("b").agg(F.max_by("a", F.struct("score", -F.col("a"))).alias("a")), sets), "links")
    near = common.written(common.components(links), "near", done=[links])
    # second round: every pair that is still apart
    known = near.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    apart = links_apart(bands, classes, near, sets)
    roots = common.written(common.components(apart.union(known)), "roots", done=[apart, near, bands, sets])
    return Groups(every.drop("regs"), classes.drop("n", "regs"), roots, several)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of docs."""
    groups = linked_texts(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    every, classes, roots, several = groups
    repeated = not several.isEmpty()
    if repeated:  # rows that share an id are linked, too
        held = every.join(several, "doc_id").join(classes.select("set_a", "set_b", "rep"), ["set_a", "set_b"]).select("doc_id", "rep").distinct()
        by_id = held.join(held.groupBy("doc_id").agg(F.min("rep").alias("first")), "doc_id").select(F.col("rep").alias("a"), F.col("first").alias("b"))
        roots = common.components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(by_id))
    named = every.join(groups.members(roots), ["set_a", "set_b"], "left")
    named = named.select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))
    if repeated:  # an empty text of an id goes with its others
        least = named.join(several, "doc_id").groupBy("doc_id").agg(F.min("component_id").alias("least"))
        named = named.join(least, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("least", "component_id").alias("component_id"))
    return named.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs of which no like text stays elsewhere, one of each group; all columns stay."""
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    groups = linked_texts(own)
    named = groups.every.where("n_shingles > 0 and doc_id is not null").join(groups.members(groups.roots), ["set_a", "set_b"])
    mark, rank = common.fresh_name("same", docs.columns), common.fresh_name("rank", docs.columns)
    if groups.several.isEmpty():  # then an id is a text
        gone = named.where("doc_id <> component").select(F.col("doc_id").alias(mark)).distinct()
        left = docs.join(gone.hint("shuffle_hash"), docs[id_col].cast("long") == gone[mark], "left_anti")
        again = own.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1)
        if again.isEmpty():
            return left
        one = Window.partitionBy(id_col, text_col).orderBy(*[c for c in docs.columns if not docs.schema[c].dataType.typeName().startswith(("map", "variant"))])
    else:
        # of each group the least (id, fingerprint) stays; each row of docs finds its own
        first = named.groupBy("component").agg(F.min(F.struct("doc_id", "set_a", "set_b")).alias("first"))
        gone = named.join(first, "component").where(F.struct("doc_id", "set_a", "set_b") != F.col("first")).select(F.struct("doc_id", "set_a", "set_b").alias(mark)).distinct()
        at, schema = docs.columns.index(text_col), StructType([*docs.schema.fields, StructField(mark, StructType([StructField(c, LongType()) for c in ("doc_id", "set_a", "set_b")]))])
        key = docs.columns.index(id_col)

        def named_by_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in common.steps(batches, text_col):
                a, b = fingerprints(*common.distinct_per_row(*common.shingle_hashes(*common.utf8(batch.column(at)))))
                own = pa.StructArray.from_arrays([batch.column(key).cast(pa.int64()), pa.array(a), pa.array(b)], ["doc_id", "set_a", "set_b"])
                yield pa.RecordBatch.from_arrays([*batch.columns, own], [*batch.schema.names, mark])

        left = docs.mapInArrow(named_by_set, schema).join(gone, mark, "left_anti")
        # equal sets of one id are one text, but empty ones are told apart
        empty = F.when((F.col(mark)["set_a"] == 0) & (F.col(mark)["set_b"] == 0), F.col(text_col))
        one = Window.partitionBy(id_col, mark, empty).orderBy(text_col)
    alone = left.where(F.col(id_col).isNull())
    return alone.unionByName(left.where(F.col(id_col).isNotNull()).withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1).drop(rank)).select(*docs.columns)
