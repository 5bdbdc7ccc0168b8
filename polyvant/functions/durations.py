"""Reconciles measured and declared durations, in whole microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Limits
from .canon import text


def span_us(start: Column, end: Column) -> Column:
    """Declared span of two unix times in seconds; null unless the end is after the start."""
    return F.when(end > start, F.rint((end - start) * 1e6).cast("bigint"))


def resolve(video_us: Column, meta_us: Column, limits: Limits = Limits()) -> dict[str, Column]:
    """duration_us, duration_source, duration_mismatch and the warning, null for none. What is measured wins; the
    two disagree if they differ by more than the absolute and the relative tolerance."""
    has_v, has_m = video_us.isNotNull(), meta_us.isNotNull()
    diff = F.abs(video_us - meta_us)
    off = has_v & has_m & (diff > F.lit(round(limits.duration_abs_s * 1e6))) & (diff / meta_us > F.lit(limits.duration_rel))
    seconds = lambda c: text(c / F.lit(1e6), 1)
    warning = (
        F.when(off, F.concat(F.lit("duration mismatch: video="), seconds(video_us), F.lit("s vs metadata="), seconds(meta_us), F.lit("s (kept video)")))
        .when(~has_v & has_m, "no measured video duration; used metadata timestamps")
        .when(~has_v & ~has_m, "no duration available (no video, no valid timestamps); using 0h")
    )
    return {
        "duration_us": F.coalesce(video_us, meta_us, F.lit(0).cast("bigint")),
        "duration_source": F.when(has_v & has_m, "both").when(has_v, "video").when(has_m, "metadata").otherwise("none"),
        "duration_mismatch": F.coalesce(off, F.lit(False)),
        "duration_warning": warning,
    }
