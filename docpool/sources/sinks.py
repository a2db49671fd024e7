"""Writers: shards of the same names as the input, and small JSON documents."""

from __future__ import annotations

import io
import json
import uuid
import os
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """One small file, by Hadoop's file system: written beside its place, then renamed."""
    jvm = spark.sparkContext._jvm
    place, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".part")
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(place, False)
    fs.rename(part, place)


def shared_folder(spark: SparkSession) -> str:
    """A new folder where the driver and all executors write: below spark.checkpoint.dir, on one machine else the warehouse."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = spark.conf.get("spark.sql.warehouse.dir")
    return f"{top.rstrip('/')}/pools/{uuid.uuid4().hex}"


def write_json(spark: SparkSession, path: str, data: dict) -> None:
    write_text_file(spark, path, json.dumps(data, ensure_ascii=False, indent=2))


def write_shards(rows: DataFrame, out: str, folder: str, version: str | None = None, empty: DataFrame | None = None) -> None:
    """value of (dataset, shard, place, value) to out[/version]/dataset/folder/shard, in place order.

    Spark's text writer can't name files: it writes one folder for each shard, which is then renamed to
    the shard's file. A shard is one file by its definition, so its lines meet in one task, sorted on
    disk. empty: (dataset, shard) that get an empty file if they have no row.
    """
    spark = rows.sparkSession
    top = "/".join([out.rstrip("/"), *([version] if version else [])])
    staging = f"{top}/_staging"
    # one task for each shard: the key is the shard, its lines sorted
    dealt = rows.repartition("dataset", "shard").sortWithinPartitions("dataset", "shard", "place")
    dealt.select("dataset", "shard", "value").write.mode("overwrite").partitionBy("dataset", "shard").text(staging)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(top).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for d in fs.globStatus(path(f"{staging}/dataset=*/shard=*")):
        # the writer escapes what file systems may not take in names
        dataset, shard = (jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(x.split("=", 1)[1]) for x in d.getPath().toString().split("/")[-2:])
        parts = sorted(f.getPath().toString() for f in fs.listStatus(d.getPath()) if f.getPath().getName().startswith("part-"))
        # a name with a colon is no URI: it is taken as a child
        target = path(path(path(path(top), path(None, None, dataset)), folder), path(None, None, shard))
        fs.mkdirs(target.getParent())
        fs.delete(target, False)
        if len(parts) != 1:
            raise RuntimeError(f"{len(parts)} files for {dataset}/{shard}")
        fs.rename(path(parts[0]), target)
    fs.delete(path(staging), True)
    if empty is not None:
        for r in empty.select("dataset", "shard").distinct().toLocalIterator():
            target = path(f"{top}/{r['dataset']}/{folder}/{r['shard']}")
            if not fs.exists(target):
                fs.mkdirs(target.getParent())
                fs.create(target, False).close()


def write_tars(records: DataFrame, images: DataFrame, out: str) -> DataFrame:
    """Images (path, content) of records to a tar for each partition; path and tar of every image.

    A path stands in one tar, once. Each task writes to its own name and renames, so that a task run
    again leaves one whole file. `out` must be a folder that all executors share.
    """
    wanted = records.select(F.explode(F.filter("images", lambda x: x.isNotNull())).alias("i")).select(F.col("i.relative_img_path").alias("path")).distinct()
    dealt = images.join(wanted, "path").dropDuplicates(["path"])

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        context = TaskContext.get()
        name = f"{out.rstrip('/')}/images_{context.partitionId():05d}.tar"
        temporary, written = f"{name}.{context.taskAttemptId()}", []
        os.makedirs(out, exist_ok=True)
        with tarfile.open(temporary, "w") as tar:
            for batch in batches:
                for path, content in zip(batch["path"], batch["content"]):
                    info = tarfile.TarInfo(path)
                    info.size = len(content)
                    tar.addfile(info, io.BytesIO(content))
                    written.append(path)
        os.replace(temporary, name)
        yield pd.DataFrame({"path": written, "tar": name})

    return dealt.select("path", "content").mapInPandas(write, "path string, tar string")
