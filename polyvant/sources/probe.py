"""Measures video durations on the executors."""

from __future__ import annotations

import shutil
import subprocess
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Prober = Callable[[str], float | None]
MISSING = "ffprobe not found on PATH; falling back to metadata timestamps for all durations"


def ffprobe(ref: str, seconds: int = 60) -> float | None:
    """The duration that ffprobe reads from a path or URL; None for any failure and for what is not positive."""
    cmd = ["ffprobe", "-v", "error", "-show_entries", "format=duration", "-of", "default=noprint_wrappers=1:nokey=1", ref]
    try:
        done = subprocess.run(cmd, capture_output=True, text=True, timeout=seconds, check=True)
        value = float(done.stdout.strip())
    except (OSError, subprocess.SubprocessError, ValueError):
        return None
    return value if 0 < value < float("inf") else None


def measure(episodes: DataFrame, prober: Prober | None = None, partitions: int = 24, sign: Callable[[str], str] | None = None) -> DataFrame:
    """``episodes`` with video_us and a warning where a video cannot be read. ``sign`` makes a URL from a path, in
    the task that probes it, so it cannot expire while others wait. Without a prober and without ffprobe nothing is
    measured, and the first episode says so."""
    if prober is None and not shutil.which("ffprobe"):
        first = F.col("ord") == F.lit(episodes.agg(F.min("ord")).first()[0])
        return episodes.withColumn("ingest_warnings", F.when(first, F.array_append("ingest_warnings", F.lit(MISSING))).otherwise(F.col("ingest_warnings")))
    probe = prober or ffprobe
    names = episodes.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            us, notes = [], []
            for path, old in zip(b.column("video_path").to_pylist(), b.column("ingest_warnings").to_pylist()):
                s = probe(sign(path) if sign else path) if path is not None else None
                us.append(None if s is None else round(s * 1e6))
                notes.append((old or []) + (["ffprobe could not read video duration"] if path is not None and s is None else []))
            made = {"video_us": pa.array(us, pa.int64()), "ingest_warnings": pa.array(notes, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([made.get(n, b.column(i)) for i, n in enumerate(names)], names)

    return episodes.repartition(partitions).mapInArrow(run, episodes.schema)
