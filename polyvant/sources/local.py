"""Deliveries in a directory tree of any file system that Spark reads."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..profiles import PROFILES, Profile
from . import pairing


def listing(spark: SparkSession, root: str) -> DataFrame:
    """path and length of every file below ``root``, hidden and empty ones too, which Spark's file sources skip.
    The driver holds names only, and parallelises them. A missing root or a file raises."""
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(top):
        raise FileNotFoundError(root)
    if not fs.getFileStatus(top).isDirectory():
        raise NotADirectoryError(root)
    found, files = [], fs.listFiles(top, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen()))
    return spark.createDataFrame(sorted(found), "path string, length bigint")


def read_sidecars(episodes: DataFrame) -> DataFrame:
    """``episodes`` with ``meta_json``, the bytes of each sidecar, null for none. A file that cannot be read gives
    bytes that do not parse, so that its episode carries an error and stays."""
    spark = episodes.sparkSession
    local = "coalesce(meta_path, '') like 'file:%' or coalesce(meta_path, '') like '/%' or meta_path is null"
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in episodes.schema) + ", meta_json binary"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs = []
            for p in b.column("meta_path").to_pylist():
                try:
                    docs.append(None if p is None else open(p.removeprefix("file:").replace("//", "/", 1) if p.startswith("file:") else p, "rb").read())
                except OSError as e:
                    docs.append(f"\0{e}".encode())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(docs, pa.binary())], [*b.schema.names, "meta_json"])

    here = episodes.where(local).mapInArrow(read, spec)
    there = episodes.where(f"not ({local})")
    if there.isEmpty():
        return here
    paths = [r[0] for r in there.select("meta_path").toLocalIterator()]  # names only
    content = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("meta_path"), F.col("content").alias("meta_json"))
    return here.union(there.join(content, "meta_path", "left").withColumn("meta_json", F.coalesce("meta_json", F.lit(b""))).select(*episodes.columns, "meta_json"))


def episodes(spark: SparkSession, root: str, profile: Profile = PROFILES["generic"], limit: int | None = None) -> DataFrame:
    """ord, stem, directory, source, video_path, meta_path, ingest_warnings, meta_json, video_us (null so far)."""
    return read_sidecars(pairing.local(listing(spark, root), profile, limit)).withColumn("video_us", F.lit(None).cast("bigint"))
