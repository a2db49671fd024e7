"""Benchmark decontamination: short test items inside long documents.

An item lies in a document if at least 75 of 100 of its distinct five-word shingles occur there.
Items are partitioned by the size of their sets (powers of two). In each partition an item is
represented by a MinHash sketch for containment: its k smallest shingles under a random order, with
k = size - needed + 1. An item that reaches the threshold misses at most size - needed shingles, so
one of any k is in the document: the search loses nothing. Documents have no sketch: all their shingles are
looked up in the sketches of those partitions whose items they are large enough to hold; the partition's
size is used as that lower bound alone. What is hit is verified on the item's whole set.

The order in which an item's shingles are the smallest puts those that many items of the block hold last, so
that a sketch holds common phrases only where the item has nothing rarer; an item that a document holds is
looked at once, however many of its shingles hit.

The items' index is broadcast in blocks of at most BLOCK_SHINGLES shingles, by item; a benchmark of
any size is searched block after block, each over all documents, without a join.

Defined results: items without words (null or empty text) match nothing; an item of one to four
words matches only a document of exactly these words; rows that share an item_id are separate items
of that id; null ids stay null; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docpool.llm import common

PERCENT = 75
#: Shingles of items in one broadcast: 16 bytes each at most, 32 MB.
BLOCK_SHINGLES = 2_000_000
_FILTER_BITS = 20
#: Shingles in fewer items than this are alike rare; those in MANY or more alike common.
COMMON, MANY = 8, 1 << 20


class ItemIndex:
    """The sets of a block of items and, by size partition, their sketches."""

    def __init__(self, ids: list[int | None], sets: list[np.ndarray]):
        self.ids, self.sets = ids, sets
        sizes = np.array([len(s) for s in sets], np.int64)
        self.needed = -(-PERCENT * sizes // 100)
        self.partitions = []
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        classes = np.array([int(s).bit_length() for s in sizes])
        names, times = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.empty(0, np.uint64), np.empty(0, np.int64))

        def rarest(s: np.ndarray, k: int) -> np.ndarray:
            """The k shingles of a set that the fewest items hold, by hash among equals."""
            held = np.minimum(times[np.searchsorted(names, s)], MANY) // COMMON * COMMON
            return s[np.lexsort((common.mix64(s ^ np.uint64(0x2545F491)), held))[:k]]

        for c in sorted(set(classes.tolist())):
            members = np.flatnonzero((classes == c) & (sizes > 0))
            sketches = [rarest(sets[i], int(sizes[i] - self.needed[i] + 1)) for i in members]
            if not sketches:
                continue
            values, owner = np.concatenate(sketches), np.repeat(members, [len(s) for s in sketches])
            order = np.argsort(values, kind="stable")
            self.partitions.append((int(self.needed[members].min()), values[order], owner[order]))
            self.filter[values >> np.uint64(64 - _FILTER_BITS)] = True

    def search(self, shingles: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item position, shared shingles) of every item contained in a row's shingles."""
        near = np.flatnonzero(self.filter[shingles >> np.uint64(64 - _FILTER_BITS)])
        if not len(near):
            return []
        values = shingles[near]
        rows = np.searchsorted(ends, near, "right") - 1
        sizes = np.diff(ends)
        found = []
        starts = np.searchsorted(rows, np.arange(len(sizes) + 1))  # a row at a time: its candidates are at most the block's items
        for row in np.unique(rows).tolist():
            own = np.unique(values[starts[row] : starts[row + 1]])
            hit = np.zeros(len(self.sets), bool)
            for least, keys, owner in self.partitions:
                if sizes[row] >= least:
                    for a, b in zip(np.searchsorted(keys, own, "left").tolist(), np.searchsorted(keys, own, "right").tolist()):
                        hit[owner[a:b]] = True
            held = None
            for item in np.flatnonzero(hit).tolist():
                held = np.unique(shingles[ends[row] : ends[row + 1]]) if held is None else held
                at = np.searchsorted(held, self.sets[item])
                at[at == len(held)] = 0
                shared = int(np.count_nonzero(held[at] == self.sets[item]))
                if 100 * shared >= PERCENT * len(self.sets[item]):
                    found.append((row, item, shared))
        return found


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[ItemIndex]:
    """Indexes over all items, each of a bounded number of shingles.

    An item larger than a block has a block of its own. Only one block is on the driver at a time.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.steps(batches, "text"):
            sh, ends = common.distinct_per_row(*common.shingle_hashes(*common.utf8(batch.column(1))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends)), common.binary_slices(sh, ends)], ["item_id", "n", "shingles"])

    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(make, "item_id long, n long, shingles binary").where("n > 0")
    total = items.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-2 * total // BLOCK_SHINGLES)) if total > BLOCK_SHINGLES else 1
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)) == k)
        rows = part.select("item_id", "shingles").toArrow()
        if rows.num_rows:
            yield ItemIndex(rows.column(0).to_pylist(), [np.frombuffer(x, np.uint64) for x in rows.column(1).to_pylist()])


def contained_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_shared, containment: a row for each item in a document."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, n_item_shingles long, n_shared long, containment double"

    def searcher(index) -> Callable:
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = index.value
            for batch in common.steps(batches, "text"):
                hits = own.search(*common.shingle_hashes(*common.utf8(batch.column(1))))
                ids = batch.column(0).to_pylist()
                rows = [(ids[r], own.ids[i], len(own.sets[i]), s, s / len(own.sets[i])) for r, i, s in hits]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate(kinds)], ["doc_id", "item_id", "n_item_shingles", "n_shared", "containment"])

        return search

    out = spark.createDataFrame([], schema)
    for k, block in enumerate(item_blocks(benchmark)):
        hits = texts.mapInArrow(searcher(spark.sparkContext.broadcast(block)), schema)
        out = out.union(hits) if k else hits
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs that hold no item; all columns stay and nothing is shuffled."""
    spark = docs.sparkSession

    def cleaner(index) -> Callable:
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = index.value
            for batch in common.steps(batches, text_col):
                column = batch.column(batch.schema.get_field_index(text_col))
                keep = np.ones(batch.num_rows, bool)
                for row, _, _ in own.search(*common.shingle_hashes(*common.utf8(column))):
                    keep[row] = False
                yield batch.filter(pa.array(keep))

        return clean

    for block in item_blocks(benchmark):
        docs = docs.mapInArrow(cleaner(spark.sparkContext.broadcast(block)), docs.schema)
    return docs
