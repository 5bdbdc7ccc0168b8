"""Secrets and multipart credentials, with built-in SQL functions only.

A span's place is found without leaving the row: the pieces between matches and the matches alternate, so
their lengths add up to positions in code points. Spans that are secrets by form alone are always reported.
Weak candidates (an identifier, a random-looking value, an endpoint) are reported only where complementary
parts co-occur: an interval join of parts within the same text and scope decides that. The join deals parts
by (text, bucket of the position), so a text with very many parts is spread, and it is a semi join, so no
pairs are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, scoped

#: The base kinds, in the order in which equal starts are listed.
BASE = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}",  # a run of 16 or more: a shorter run holds no longer one
    "hex": r"[0-9a-f]{32,}",
}
#: What a text must hold for a kind to be looked for; lower-cased where the kind takes either case.
HINTS = {
    "assign": "(contains(_lo, 'passw') or contains(_lo, 'secret') or contains(_lo, 'token') or contains(_lo, 'apikey') or contains(_lo, 'api_key'))",
    "access": "contains(_t, 'AKIA')",
    "hex": "_t rlike '[0-9a-f]{32}'",
    "user": "(contains(_lo, 'user') or contains(_lo, 'login') or contains(_lo, 'account') or contains(_lo, 'client') or contains(_lo, 'access'))",
    "value": "size(_user) + size(_access) > 0",
    "endpoint": "size(_user) + size(_access) > 0 and size(_assign) + size(_hex) + size(_value) > 0",
}
#: Parts that say nothing alone. user: a named account; value: a random-looking run; endpoint: a URL or host.
PARTS = {
    "user": r"""(?i:(user_?name|user_?id|user|login|account|client_?id|access_?key_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})""",
    "value": r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{24,}={0,2}(?![A-Za-z0-9+/=_-])",
    "endpoint": r"""(?:[a-zA-Z][a-zA-Z0-9+.-]{1,14}://[^\s"'<>]+|(?i:(?:host|endpoint|server))["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+\.[A-Za-z0-9:.-]+)""",
}
ORDER = [*BASE, *PARTS]
_SPAN = "array<struct<s:bigint,e:bigint,k:int>>"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _places(text: str, pattern: str, accept: str, hint: str) -> str:
    """SQL for the spans of ``pattern`` in the column ``text``: an array of (s, e, k). Lengths are added up in
    blocks of 256, so that a text with n matches takes about 128 n steps, not n squared."""
    p = _quoted(pattern)
    return f"""
      if({hint} and {text} rlike {p},
      transform(array(named_struct('m', regexp_extract_all({text}, {p}, 0), 'g', split({text}, {p}))), z ->
        transform(array(transform(z.m, (x, i) -> cast(length(x) as bigint) + length(z.g[i]))), step ->
          transform(array(transform(sequence(0, size(step) div 256), b -> aggregate(slice(step, b * 256 + 1, 256), 0L, (a, x) -> a + x))), sums ->
            transform(array(transform(sequence(0, size(step) div 256), b -> aggregate(slice(sums, 1, b), 0L, (a, x) -> a + x))), base ->
              filter(transform(z.m, (x, i) -> named_struct(
                'e', base[i div 256] + aggregate(slice(step, (i div 256) * 256 + 1, i % 256 + 1), 0L, (a, y) -> a + y), 'n', length(x), 'ok', {accept})),
              x -> x.ok))[0])[0])[0])[0],
      array())"""


def _spans(text: str, name: str) -> Column:
    pattern = (BASE | PARTS)[name]
    accept = {
        "assign": f"length(regexp_extract(x, {_quoted(pattern)}, 2)) >= 8",
        "value": "x rlike '[A-Z]' and x rlike '[a-z]' and x rlike '[0-9]'",
    }.get(name, "true")
    sql = _places(text, pattern, accept, HINTS[name])
    return F.expr(f"transform({sql}, x -> named_struct('s', x.e - x.n, 'e', x.e, 'k', {ORDER.index(name)}))").cast(_SPAN)


def _listed(spans: str) -> Column:
    names = "array(" + ", ".join(f"'{k}'" for k in ORDER) + ")"
    ordered = f"sort_array(transform({spans}, x -> named_struct('s', x.s, 'k', x.k, 'e', x.e)))"
    return F.expr(f"array_join(transform({ordered}, x -> concat({names}[x.k], ':', x.s, ':', x.e)), ',')")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, _h (hash of the text), base and weak spans of each row: one pass, no shuffle."""
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_t"))
    d = d.withColumn("_lo", F.lower("_t"))
    for k in (*BASE, *PARTS):  # a part whose complement is absent is not looked for
        d = d.withColumn(f"_{k}", _spans("_t", k))
    d = d.withColumn("_h", F.xxhash64("_t")).drop("_t", "_lo")
    base = F.concat(*(F.col(f"_{k}") for k in BASE))
    return d.select("doc_id", "_h", *(F.size(f"_{k}").cast("bigint").alias(f"n_{k}") for k in BASE), base.alias("base"), F.concat(*(F.col(f"_{k}") for k in PARTS)).alias("weak"))


def linked(found: DataFrame, scope: int = 256) -> DataFrame:
    """(_n, _h, more): the weak spans that complementary parts support, for each text that has any.

    Two parts are near if the gap between them is at most ``scope`` code points. An identifier (user, access)
    needs a secret (assign, hex, value) near it, a random value needs an identifier, and an endpoint needs
    both an identifier and a secret. A weak span inside a base span is that span and is not added."""
    parts = found.where("size(weak) > 0 and size(weak) + size(base) > 1").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_n"), "_h", F.explode(F.concat("base", "weak")).alias("x")
    ).select("_n", "_h", "x.s", "x.e", "x.k").distinct()
    k = {n: i for i, n in enumerate(ORDER)}
    parts = cut(parts, "parts")
    base = parts.where(F.col("k") < len(BASE))
    weak = parts.where(F.col("k") >= len(BASE))
    buckets = lambda lo, hi: F.explode(F.sequence(F.floor(lo / scope), F.floor(hi / scope)))

    def near(left: DataFrame, right: DataFrame, how: str, gap: int) -> DataFrame:
        """The rows of ``left`` with a span of ``right`` within ``gap`` (semi), or without one that contains them
        (anti). A span is dealt to each bucket that it, widened by the gap, touches on the left; to its own buckets
        on the right."""
        r = right.select("_n", "_h", F.col("s").alias("rs"), F.col("e").alias("re"), buckets(F.col("s"), F.col("e")).alias("_b")).distinct()
        wide = left.withColumn("_b", buckets(F.greatest(F.col("s") - gap, F.lit(0)), F.col("e") + gap))
        if how == "anti":
            place = (r["rs"] <= wide["s"]) & (r["re"] >= wide["e"])
        else:
            place = (r["rs"] <= wide["e"] + gap) & (r["re"] >= wide["s"] - gap) & ~((r["rs"] == wide["s"]) & (r["re"] == wide["e"]))
        hit = wide.join(r, (wide["_n"] == r["_n"]) & (wide["_h"] == r["_h"]) & (wide["_b"] == r["_b"]) & place, "left_semi").drop("_b").distinct()
        return hit if how == "semi" else left.join(hit, ["_n", "_h", "s", "e", "k"], "left_anti")

    free = cut(near(weak, base, "anti", 0), "weak")
    names = parts.where(F.col("k") == k["access"]).union(free.where(F.col("k") == k["user"]))
    secrets = parts.where(F.col("k").isin(k["assign"], k["hex"])).union(free.where(F.col("k") == k["value"]))
    out = near(free.where(F.col("k") == k["user"]), secrets, "semi", scope)
    out = out.union(near(free.where(F.col("k") == k["value"]), names, "semi", scope))
    out = out.union(near(near(free.where(F.col("k") == k["endpoint"]), names, "semi", scope), secrets, "semi", scope))
    return out.groupBy("_n", "_h").agg(F.collect_set(F.struct("s", "e", "k")).alias("more"))


@scoped
def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 256) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_assign, n_access, n_hex, base, more (arrays of spans).

    Null texts are empty and have no spans; null ids keep their row; repeated rows each get the same spans; an
    empty table gives an empty result; other columns are not read."""
    found = cut(candidates(docs, id_col, text_col), "spans")
    extra = linked(found, scope)
    joined = found.withColumn("_n", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).join(extra, ["_n", "_h"], "left")
    return joined.select("doc_id", "_h", *(f"n_{k}" for k in BASE), "base", F.coalesce(F.col("more"), F.array().cast(_SPAN)).alias("more"))


def report(found: DataFrame) -> DataFrame:
    """The digest of ``scan``: counts, base_sha256 and the listed spans."""
    d = found.withColumn("_all", F.concat("base", "more"))
    return d.select("doc_id", *(f"n_{k}" for k in BASE), F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("_all").alias("spans"), F.size("more").cast("bigint").alias("n_linked"))


@scoped
def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 256, mask: str = "[redacted]") -> DataFrame:
    """``docs`` with every reported span replaced by ``mask``; overlapping spans become one. Every row stays, with
    its columns, whatever their names: null texts and ids stay null, repeated rows are masked alike."""
    names = docs.columns
    found = scan(docs, id_col, text_col, scope)
    spans = found.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_n"), "_h", F.concat("base", "more").alias("_all")).where("size(_all) > 0").distinct()
    t = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    d = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"), F.col(f"`{text_col}`").alias("_t"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("_n"), F.xxhash64(t).alias("_h"))
    d = d.join(spans, ["_n", "_h"], "left")
    d = d.withColumn("_s", F.expr("sort_array(transform(coalesce(_all, array()), x -> named_struct('s', x.s, 'e', x.e)))"))
    # a span starts a new run if it starts after the furthest end so far; sorted ends give that by maximum
    d = d.withColumn("_m", F.expr("""aggregate(_s, cast(array() as array<struct<s:bigint,e:bigint>>), (a, x) ->
        if(size(a) > 0 and x.s < element_at(a, -1).e,
           concat(slice(a, 1, size(a) - 1), array(named_struct('s', element_at(a, -1).s, 'e', greatest(element_at(a, -1).e, x.e)))),
           concat(a, array(x))))"""))
    piece = f"concat(substring(_t, cast(if(i = 0, 0L, _m[i - 1].e) + 1 as int), cast(x.s - if(i = 0, 0L, _m[i - 1].e) as int)), '{mask}')"
    masked = F.expr(f"concat(array_join(transform(_m, (x, i) -> {piece}), ''), substring(_t, cast(element_at(_m, -1).e + 1 as int)))")
    return d.withColumn("_t", F.when(F.size("_m") > 0, masked).otherwise(F.col("_t"))).select(*(F.col("_t").alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in names))
