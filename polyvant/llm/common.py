"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters that separate words.
SPACE_CLASS = r"[\x20\x09-\x0D]"


class Scope:
    """The tables that ``cut`` writes while it is the innermost open scope."""

    def __init__(self) -> None:
        self.tables: dict[str, SparkSession] = {}

    def __enter__(self) -> Scope:
        self._token = _current.set(self)
        self.outer = self._token.old_value if isinstance(self._token.old_value, Scope) else _session
        return self

    def __exit__(self, *_) -> None:
        """What is left goes to the scope around."""
        _current.reset(self._token)
        self.outer.tables |= self.tables
        self.tables = {}

    def free(self, keep: DataFrame | None = None) -> None:
        """Deletes the tables of this scope, but for those that ``keep`` reads."""
        used = reads(keep) if keep is not None else []
        for path in [p for p in self.tables if not any(p.rsplit("/", 1)[1] in u for u in used)]:
            spark = self.tables.pop(path)
            try:
                p = spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
            except Exception:  # noqa: BLE001  the session may have ended
                pass


_session = Scope()  # what results still read when their query has returned: freed at exit
_current: ContextVar[Scope] = ContextVar("scope", default=_session)
atexit.register(_session.free)


def scoped(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``f`` with a scope of its own: of the tables that it stores on its way, only those stay which its result
    reads; they go to the caller's scope."""

    @wraps(f)
    def run(*args, **kw) -> DataFrame:
        with Scope() as s:
            out = f(*args, **kw)
            s.free(keep=out)
            return out

    return run


def reads(df: DataFrame) -> list[str]:
    """The folders that the plan of ``df`` scans."""
    leaves, found = df._jdf.queryExecution().analyzed().collectLeaves(), []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation":
            found.append(leaf.relation().location().rootPaths().mkString(" "))
    return found


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share. Where the session names none, a local master gets one of its own; on a
    cluster, where executors would each write to their own disk, that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="polyvant-")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet to the shared folder and reads it again: the lineage ends there, and a
    lost executor costs no more than its running tasks."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/polyvant/{name}-{uuid.uuid4().hex}"
    _current.get().tables[path] = spark
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def lower_words(text: str | None) -> list[bytes]:
    """UTF-8 words with A-Z lower-cased. ``bytes.split`` and ``bytes.lower`` are ASCII-only, as wanted."""
    return text.encode().lower().split() if text else []


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n. A null id has the text ''."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows at most, chosen by a hash of ``key``: the same rows on every run."""
    n = df.count()
    if n <= rows:
        return df
    share = int(rows / n * (1 << 30))
    return df.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)) < share)
