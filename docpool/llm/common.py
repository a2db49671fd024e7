"""What several operators share: Arrow helpers, shared-folder tables, word shingles, components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
#: Bytes of text that one numpy step takes in; longer texts make a step of their own.
STEP_BYTES = 1 << 20

M64 = (1 << 64) - 1
_RNG = np.random.RandomState(20240611)
_BYTE = _RNG.randint(0, 1 << 62, 256, dtype=np.uint64) * np.uint64(4) + _RNG.randint(0, 4, 256).astype(np.uint64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_Q = [pow(0xD6E8FEB86659FD93, k, 1 << 64) for k in range(SHINGLE_WORDS)]


# --- shared folder -----------------------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's setting, else on one machine a folder of our own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_docpool_checkpoints"
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/docpool/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, done: Iterable[DataFrame] = (), random: Iterable[str] = ()) -> DataFrame:
    """Writes a table to the shared folder and reads it again: cuts the lineage, survives lost executors.

    done: tables written before that nothing needs once this one is there; they are deleted. random: columns that
    hold hashes, for which no dictionaries are tried.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**{f"parquet.enable.dictionary#{c}": "false" for c in random}).parquet(path)
    discard(*done)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    _live.append((spark, path))
    return out


#: Sessions and folders of the tables written and not yet deleted.
_live: list[tuple[SparkSession, str]] = []


def mark() -> int:
    """For `sweep`: what is written from here on."""
    return len(_live)


def sweep(since: int, *keep: DataFrame) -> None:
    """Deletes the tables written since a mark but those to keep: once what was computed from them is stored."""
    kept = {t.written_to for t in keep}
    for spark, path in _live[since:]:
        if path not in kept:
            delete(spark, path)
    _live[since:] = [x for x in _live[since:] if x[1] in kept]


def discard(*tables: DataFrame) -> None:
    """Deletes tables that `written` gave."""
    for table in tables:
        delete(table.sparkSession, table.written_to)
        _live[:] = [x for x in _live if x[1] != table.written_to]


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, the files of an execution's shuffles are deleted when it ends: else they stay until the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def fresh_name(name: str, taken: Iterable[str]) -> str:
    """name, with underscores before it until no column is called so, in whatever case."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_bucket(col: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo buckets: the fold of a row."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(buckets))


# --- workers' memory ---------------------------------------------------------------------------

Loader = TypeVar("Loader", bound=Callable)
_loaders: list = []


def kept(loader: Loader) -> Loader:
    """A loader whose last result a worker process keeps for all of its tasks, until `let_go`."""
    cached = lru_cache(1)(loader)
    _loaders.append(cached)
    return cached


def let_go() -> None:
    """Frees what `kept` loaders have loaded: a worker process serves one operator after another, and the tables of
    one would count with what the next one needs."""
    full = [x for x in _loaders if x.cache_info().currsize]
    if full:
        for x in full:
            x.cache_clear()
        gc.collect()
        trim()


def trim() -> None:
    """Gives the system back what is free: else a worker process keeps the most that any of its tasks needed."""
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give:  # glibc
        give(0)


# --- Arrow -------------------------------------------------------------------------------------


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and 64-bit offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def steps(batches: Iterator[pa.RecordBatch], text: str, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each has about `most` bytes of text, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = utf8(batch.column(batch.schema.get_field_index(text)))[1]
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield batch.slice(at, upto - at)
            at = upto


def texts_of(batch: pa.RecordBatch, text: str) -> list[str]:
    return [x or "" for x in batch.column(batch.schema.get_field_index(text)).to_pylist()]


def binary_slices(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column whose row i holds values[ends[i]:ends[i+1]]."""
    raw = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer((ends * raw.itemsize).astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())]).cast(pa.binary())


# --- words and shingles ------------------------------------------------------------------------


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose outputs look random."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n + 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        up, down = np.full(size, _P, np.uint64), np.full(size, _P_INV, np.uint64)
        up[0] = down[0] = 1
        _POWERS[size] = np.cumprod(up), np.cumprod(down)
    return _POWERS[size]


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, down: np.ndarray) -> np.ndarray:
    """Hash of each byte span, from the running polynomial sums; equal bytes give equal values."""
    return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def running(data: np.ndarray, table: np.ndarray = _BYTE) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(len(data))
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=prefix[1:])
    return prefix, down


def word_spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs of bytes outside 20, 09-0D) and the words before each text."""
    n = len(data)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(ends), np.int64)
    word = ~_SPACE[data]
    fresh = np.zeros(n + 1, bool)
    fresh[ends] = True  # a text's first byte goes with nothing before it
    before = np.concatenate(([False], word[:-1])) & ~fresh[:n]
    starts = np.flatnonzero(word & ~before)
    after = np.concatenate((word[1:], [False])) & ~fresh[1:]
    stops = np.flatnonzero(word & ~after) + 1
    return starts, stops, np.searchsorted(starts, ends, "left")


def shingle_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of every five-word shingle, repeated ones too, and where each text's begin.

    A text with one to four words has its whole sequence as one shingle; one without words has none.
    """
    starts, stops, first = word_spans(data, ends)
    counts = np.diff(first)
    sizes = np.where(counts >= SHINGLE_WORDS, counts - SHINGLE_WORDS + 1, np.minimum(counts, 1))
    out_ends = np.concatenate(([0], np.cumsum(sizes)))
    if len(starts) == 0:
        return np.empty(0, np.uint64), out_ends
    prefix, down = running(data)
    words = span_hashes(prefix, starts, stops, down)
    padded = np.concatenate((words, np.zeros(SHINGLE_WORDS, np.uint64)))
    rolled = np.zeros(len(words), np.uint64)
    for k, q in enumerate(_Q):
        rolled += padded[k : k + len(words)] * np.uint64(q)
    # the words at which a shingle of its own text begins
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(words)) - first[owner]
    full = place <= counts[owner] - SHINGLE_WORDS
    out = np.empty(out_ends[-1], np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS))
    for i in short:
        value = sum(int(words[first[i] + k]) * _Q[k] for k in range(counts[i]))
        out[out_ends[i]] = (value + 0x51ED270B0A1F39C1 * int(counts[i])) & M64
    keep = np.ones(len(out), bool)
    keep[out_ends[short]] = False
    out[keep] = rolled[full]
    return mix64(out), out_ends


def distinct_per_row(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's values, sorted and without repeats."""
    rows = [np.unique(values[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return (np.concatenate(rows) if rows else np.empty(0, np.uint64)), np.concatenate(([0], np.cumsum(sizes)))


# --- connected components ----------------------------------------------------------------------


#: Up to so many edges, about 300 bytes each in Python, components are found in one task.
ONE_TASK_EDGES = 1_000_000


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (nodes, [root(n) for n in nodes])], ["node", "root"])


def components(edges: DataFrame, most_rounds: int = 60, one_task: int = ONE_TASK_EDGES) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node reachable.

    Up to `one_task` edges are joined in one task; beyond, by large-star and small-star steps in turn:
    every round is written to the shared folder, and only a row count and a checksum reach the driver.
    A node of very high degree is no problem: the smallest neighbour comes from a partially aggregated
    groupBy. Both ways give the same.
    """
    spark = edges.sparkSession

    def smallest(df: DataFrame) -> DataFrame:
        return df.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))

    def state(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    last = state(now)
    if last[0] == 0:
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    if last[0] <= one_task:
        return written(now.coalesce(1).mapInArrow(_union_find, "node long, root long"), "roots")
    for _ in range(most_rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b"), F.col("a")))
        large = both.join(smallest(both), "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        low = smallest(down)
        small = down.join(low, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(low.select("u", "m")).where("a <> b")
        now = written(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        found = state(now)
        if found == last:
            break
        last = found
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    roots = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
