"""Token-id files: ORC with run-length coded ids, row indexes and Bloom filters on document ids.

Documents are dealt out by ranges of doc_id and sorted, so that the files, in the order of their part
numbers, hold ascending ids. Spark's ORC writer codes each stripe's ids with integer run-length
encoding, keeps minimum and maximum of doc_id for each row group, and a Bloom filter; readers take
stripes in parallel and skip row groups that can't hold a wanted id. Texts, not ids, are shuffled.

Defined results: a null text is empty and holds the end id alone; special strings are what the
library takes them for by default; rows with equal doc_id stand in the order of their texts; null
ids come first; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docpool.llm import common
from docpool.llm.byte_bpe import Codec

#: Bytes of text in a file, at most on average.
FILE_BYTES = 1 << 30
SCHEMA = "doc_id long, part int, seq long, ids array<int>"
WRITER = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true", "orc.row.index.stride": "2000", "orc.stripe.size": str(32 << 20), "compression": "zstd"}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = 0, files: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of every document, in the order of doc_id, to ORC files at path."""
    if files is None:  # by the bytes of all texts, but enough to keep the tasks of a shuffle busy
        size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
        files = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // FILE_BYTES))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seq = Codec.from_file(tokenizer), TaskContext.get().partitionId(), 0
        last = np.array([end], "<u4").tobytes()
        for batch in common.steps(batches, "text"):
            ids = [x + last for x in own.encode(common.texts_of(batch, "text"))]
            ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seq, seq + n)), lists], ["doc_id", "part", "seq", "ids"])
            seq += n

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dealt = rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(encode, SCHEMA).write.options(**WRITER).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, part, seq and ids; filters on doc_id reach the files' indexes."""
    return spark.read.schema(SCHEMA).orc(path)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files.

    start counts the ids of all documents before: a running sum inside each part, after the sum of
    the parts before it. Only one row a part is summed in one place.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(3)
            ends = column.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(column.values.to_numpy(zero_copy_only=False).astype("<i4")).view(np.uint8))
            sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())], ["doc_id", "part", "seq", "n_tokens", "ids_crc32"])

    rows = common.written(read_tokens(spark, path).mapInArrow(digest, "doc_id long, part int, seq long, n_tokens long, ids_crc32 long"), "token-index")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(parts, "part").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
