"""Pairs videos and sidecars of a listing. Listings are DataFrames with a column key (or path), so pairing, natural
order and limits are plans over any number of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.canon import natural_key
from ..profiles import PROFILES, Profile

SUFFIXES = r"(?is)^(.*)\.(meta\.json|mp4|mov)$"


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _warnings(video: Column, meta: Column, collided: Column | None, no_meta: str, no_video: str) -> Column:
    parts = [F.when(meta.isNull(), no_meta), F.when(video.isNull(), no_video)]
    return F.array_compact(F.array(*([collided] if collided is not None else []), *parts))


def _numbered(d: DataFrame, limit: int | None, *ties: str) -> DataFrame:
    """``ord`` in natural order of the stem. A limit is applied to the listing, before anything is read."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be 1 or more")
    d = d.orderBy(natural_key(F.col("stem")), *ties)
    d = d.limit(limit) if limit is not None else d
    return d.withColumn("ord", F.monotonically_increasing_id())


def local(listing: DataFrame, profile: Profile = PROFILES["generic"], limit: int | None = None) -> DataFrame:
    """Files of a directory tree (column path), paired by directory and stem. Of several files of one kind the first
    by path is kept and the others are named in a warning."""
    d = listing.withColumn("name", base_name(F.col("path")))
    d = d.withColumn("directory", F.expr("substring(path, 1, length(path) - length(name) - 1)"))
    kind = F.lower(F.regexp_extract("name", SUFFIXES, 2))
    stem = F.regexp_extract("name", SUFFIXES, 1)
    if profile.sidecar:  # the pinned name is a sidecar of the only video beside it, by its directory
        pinned = F.lower("name") == profile.sidecar.lower()
        kind, stem = F.when(pinned, "meta.json").otherwise(F.when(kind != "meta.json", kind)), F.when(pinned, base_name(F.col("directory"))).otherwise(stem)
    d = d.withColumns({"kind": F.when(kind == "meta.json", "meta").when(kind.isin("mp4", "mov"), "video"), "stem": stem}).where(F.col("kind").isNotNull())
    of = lambda k: F.min(F.when(F.col("kind") == k, F.col("path")))
    g = d.groupBy("directory", "stem").agg(of("video").alias("video_path"), of("meta").alias("meta_path"), F.sort_array(F.collect_list("path")).alias("_all"))
    extra = F.filter("_all", lambda x: ~x.eqNullSafe(F.col("video_path")) & ~x.eqNullSafe(F.col("meta_path")))
    g = g.withColumn("_extra", F.transform(extra, base_name))
    collided = F.when(F.size("_extra") > 0, F.concat(F.lit("multiple files share stem '"), "stem", F.lit("'; extra file(s) ignored: "), F.array_join("_extra", ", ")))
    g = g.withColumn("ingest_warnings", _warnings(F.col("video_path"), F.col("meta_path"), collided, "orphan video: no .meta.json sidecar found", "orphan metadata: no video file found"))
    g = g.withColumn("source", F.coalesce("meta_path", "video_path"))
    return _numbered(g, limit, F.lower("directory"), "stem").select("ord", "stem", "directory", "source", "video_path", "meta_path", "ingest_warnings")


def folders(listing: DataFrame, prefix: str = "", profile: Profile = PROFILES["generic"], limit: int | None = None) -> DataFrame:
    """Objects (column key, in listing order of the key) grouped by the first segment after ``prefix``; objects
    directly below the prefix are no episodes."""
    prefix = prefix if not prefix or prefix.endswith("/") else prefix + "/"
    d = listing.where(F.col("key").startswith(prefix)).withColumn("rest", F.expr(f"substring(key, {len(prefix) + 1})")).where(F.col("rest").contains("/"))
    name = F.lower(base_name(F.col("key")))
    meta = name == profile.sidecar.lower() if profile.sidecar else (name == "metadata.json") | name.endswith(".meta.json")
    d = d.withColumns({"stem": F.split("rest", "/")[0], "meta": meta, "video": F.lower("key").rlike(r"\.(mov|mp4)$") & ~meta})
    g = d.groupBy("stem").agg(F.min(F.when(F.col("meta"), F.col("key"))).alias("meta_path"), F.min(F.when(F.col("video"), F.col("key"))).alias("video_path"))
    g = g.withColumn("ingest_warnings", _warnings(F.col("video_path"), F.col("meta_path"), None, "orphan video: no metadata object in folder", "orphan metadata: no video object in folder"))
    g = g.withColumns({"directory": F.concat(F.lit(prefix), "stem", F.lit("/")), "source": F.coalesce("meta_path", "video_path", F.concat(F.lit(prefix), "stem"))})
    return _numbered(g, limit, "stem").select("ord", "stem", "directory", "source", "video_path", "meta_path", "ingest_warnings")


def paired(listing: DataFrame, prefix: str = "", limit: int | None = None, media: str = "videos", sidecars: str = "metadata") -> DataFrame:
    """Objects below ``videos/`` and ``metadata/`` paired by stem: a full outer join as one aggregate. Dot files
    are skipped; below ``videos/`` anything but JSON is a video."""
    prefix = prefix if not prefix or prefix.endswith("/") else prefix + "/"
    d = listing.withColumn("name", base_name(F.col("key"))).where(~F.col("name").startswith("."))
    is_json = F.lower("name").endswith(".json")
    d = d.withColumns({"meta": F.col("key").startswith(f"{prefix}{sidecars}/") & is_json, "video": F.col("key").startswith(f"{prefix}{media}/") & ~is_json}).where("meta or video")
    d = d.withColumn("stem", F.regexp_extract("name", r"(?s)^(.*?)(\.[^.]*)?$", 1))
    g = d.groupBy("stem").agg(F.min(F.when(F.col("meta"), F.col("key"))).alias("meta_path"), F.min(F.when(F.col("video"), F.col("key"))).alias("video_path"))
    g = g.withColumn("ingest_warnings", _warnings(F.col("video_path"), F.col("meta_path"), None, "orphan video: no metadata sidecar", "orphan metadata: no video file"))
    g = g.withColumns({"directory": F.lit(prefix), "source": F.coalesce("meta_path", "video_path")})
    return _numbered(g, limit, "stem").select("ord", "stem", "directory", "source", "video_path", "meta_path", "ingest_warnings")
