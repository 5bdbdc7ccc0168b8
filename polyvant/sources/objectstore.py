"""Deliveries in an object store: URL rules, presigned reads and listings."""

from __future__ import annotations

import hashlib
import hmac
import os
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from itertools import islice
from urllib.parse import quote, urlsplit
from urllib.request import urlopen
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..profiles import PROFILES, Profile
from . import pairing


def split_url(url: str, default_bucket: str | None = None) -> tuple[str, str]:
    """(bucket, prefix) of s3://bucket/prefix. With a default bucket, a URL that does not start with it is all
    prefix."""
    rest = url.removeprefix("s3://")
    head, _, tail = rest.partition("/")
    return (default_bucket, rest) if default_bucket and head != default_bucket else (head, tail)


@dataclass(frozen=True)
class Store:
    """Where objects are and who reads them."""

    endpoint: str
    region: str
    key: str
    secret: str
    bucket: str | None = None

    @classmethod
    def from_env(cls, env: dict[str, str] | os._Environ = os.environ) -> Store:
        need = ("S3_ENDPOINT", "AWS_ACCESS_KEY_ID", "AWS_SECRET_ACCESS_KEY")
        if missing := [n for n in need if not env.get(n)]:
            raise ValueError(f"missing environment variable(s): {', '.join(missing)}")
        return cls(env["S3_ENDPOINT"], env.get("AWS_REGION") or "us-east-1", env["AWS_ACCESS_KEY_ID"], env["AWS_SECRET_ACCESS_KEY"], env.get("AWS_S3_BUCKET_NAME") or None)

    def presign(self, bucket: str, key: str, seconds: int = 3600, now: datetime | None = None, host_style: bool = False, extra: dict[str, str] | None = None) -> str:
        """A URL that reads one object, or with ``extra`` asks for a listing, for a while: Signature Version 4 in the
        query string."""
        at = now or datetime.now(timezone.utc)
        stamp, day = at.strftime("%Y%m%dT%H%M%SZ"), at.strftime("%Y%m%d")
        base = urlsplit(self.endpoint if "//" in self.endpoint else f"https://{self.endpoint}")
        host = f"{bucket}.{base.netloc}" if host_style else base.netloc
        path = ("" if host_style else f"/{quote(bucket)}") + (f"/{quote(key, safe='/-_.~')}" if key or host_style else "")
        scope = f"{day}/{self.region}/s3/aws4_request"
        query = {"X-Amz-Algorithm": "AWS4-HMAC-SHA256", "X-Amz-Credential": f"{self.key}/{scope}", "X-Amz-Date": stamp, "X-Amz-Expires": str(seconds), "X-Amz-SignedHeaders": "host", **(extra or {})}
        text = "&".join(f"{quote(k, safe='-_.~')}={quote(v, safe='-_.~')}" for k, v in sorted(query.items()))
        canonical = "\n".join(("GET", path, text, f"host:{host}\n", "host", "UNSIGNED-PAYLOAD"))
        to_sign = "\n".join(("AWS4-HMAC-SHA256", stamp, scope, hashlib.sha256(canonical.encode()).hexdigest()))
        k = f"AWS4{self.secret}".encode()
        for part in (day, self.region, "s3", "aws4_request"):
            k = hmac.new(k, part.encode(), hashlib.sha256).digest()
        return f"{base.scheme}://{host}{path}?{text}&X-Amz-Signature={hmac.new(k, to_sign.encode(), hashlib.sha256).hexdigest()}"


    def get(self, bucket: str, key: str, seconds: int = 120) -> bytes:
        """The bytes of one object."""
        with urlopen(self.presign(bucket, key), timeout=seconds) as r:
            return r.read()

    def page(self, bucket: str, prefix: str, token: str | None = None, delimiter: str | None = None, seconds: int = 120) -> tuple[list[str], list[str], str | None]:
        """(keys, prefixes, next token) of one page of a listing, version 2."""
        query = {"list-type": "2", "prefix": prefix, "max-keys": "1000"} | ({"continuation-token": token} if token else {}) | ({"delimiter": delimiter} if delimiter else {})
        with urlopen(self.presign(bucket, "", extra=query), timeout=seconds) as r:
            top = ElementTree.fromstring(r.read())
        text = lambda way: [e.text or "" for e in top.findall("/".join(f"{{*}}{x}" for x in way.split("/")))]
        more = text("IsTruncated") == ["true"]
        return text("Contents/Key"), text("CommonPrefixes/Prefix"), (text("NextContinuationToken") or [None])[0] if more else None

    def keys(self, bucket: str, prefix: str) -> Iterator[str]:
        return pages(lambda token: self.page(bucket, prefix, token)[::2])

    def top(self, bucket: str, prefix: str) -> tuple[list[str], list[str]]:
        """(keys, prefixes) directly below ``prefix``, which ends in a slash or is empty."""
        marked = pages(lambda token: (lambda p: ([("k", k) for k in p[0]] + [("p", x) for x in p[1]], p[2]))(self.page(bucket, prefix, token, "/")))
        found = list(marked)
        return [x for kind, x in found if kind == "k"], [x for kind, x in found if kind == "p"]


def pages(fetch: Callable[[str | None], tuple[Iterable, str | None]], tries: int = 4) -> Iterator:
    """What all pages of a listing hold; ``fetch`` takes a continuation token and returns that and the next one."""
    token = None
    while True:
        for n in range(tries):
            try:
                found, token = fetch(token)
                break
            except OSError:
                if n == tries - 1:
                    raise
        yield from found
        if token is None:
            return


def listing(spark: SparkSession, keys: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(k,) for k in keys], "key string")


def list_store(spark: SparkSession, store: Store, bucket: str, prefix: str = "", partitions: int = 24) -> DataFrame:
    """The keys below ``prefix``: folders directly below it are listed in tasks; the driver holds their names only."""
    prefix = prefix if not prefix or prefix.endswith("/") else prefix + "/"
    keys, below = store.top(bucket, prefix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.column("prefix").to_pylist():
                rest = store.keys(bucket, p)
                while part := list(islice(rest, 10_000)):
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.string())], ["key"])

    found = spark.createDataFrame([(p,) for p in below], "prefix string").repartition(max(1, min(partitions, len(below)))).mapInArrow(run, "key string")
    return listing(spark, keys).union(found)


def read_sidecars(episodes: DataFrame, get: Callable[[str], bytes]) -> DataFrame:
    """``episodes`` with meta_json, fetched in the tasks; a failure becomes an error of its episode."""
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in episodes.schema) + ", meta_json binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs = []
            for p in b.column("meta_path").to_pylist():
                try:
                    docs.append(None if p is None else get(p))
                except Exception as e:  # noqa: BLE001  any failure of one object is its episode's
                    docs.append(f"\0{e}".encode())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(docs, pa.binary())], [*b.schema.names, "meta_json"])

    return episodes.mapInArrow(run, spec)


def episodes(keys: DataFrame, get: Callable[[str], bytes], prefix: str = "", layout: str = "folder", profile: Profile = PROFILES["generic"], limit: int | None = None, partitions: int = 24) -> DataFrame:
    """Episodes of a listing (column key) in the ``folder`` or ``paired`` layout."""
    if layout not in ("folder", "paired"):
        raise ValueError(f"unknown layout '{layout}'")
    found = pairing.folders(keys, prefix, profile, limit) if layout == "folder" else pairing.paired(keys, prefix, limit)
    return read_sidecars(found.repartition(partitions), get).withColumn("video_us", F.lit(None).cast("bigint"))


def delivery(spark: SparkSession, store: Store, url: str, layout: str = "folder", profile: Profile = PROFILES["generic"], limit: int | None = None) -> tuple[DataFrame, Callable[[str], str]]:
    """Episodes of s3://bucket/prefix, and what makes a URL of a video's key."""
    bucket, prefix = split_url(url, store.bucket)
    found = episodes(list_store(spark, store, bucket, prefix), lambda key: store.get(bucket, key), prefix, layout, profile, limit)
    return found, lambda key: store.presign(bucket, key)
