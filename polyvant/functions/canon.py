"""Scalar expressions: keys, labels, numbers and natural order. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import BUSINESS_SIZE, DIFFICULTY, DIFFICULTY_BIT, FALSE_TOKENS, HOUR_US, TRUE_TOKENS, WORKER_TYPE


def canon_key(c: Column) -> Column:
    """Lower case, without dashes, underscores, dots and (Unicode) white space."""
    return F.regexp_replace(F.lower(c), r"(?U)[-_.\s]+", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | c.rlike(r"(?U)^\s*$")


def label(c: Column, table: dict[str, tuple[str, ...]]) -> Column:
    """The canonical value that the token stands for; null for others."""
    token, out = canon_key(c), None
    for value, names in table.items():
        hit = token.isin(*names)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out


def difficulty(c: Column) -> Column:
    return label(c, DIFFICULTY)


def business_size(c: Column) -> Column:
    return label(c, BUSINESS_SIZE)


def worker_type(c: Column) -> Column:
    return label(c, WORKER_TYPE)


def flag(c: Column) -> Column:
    token = canon_key(c)
    return F.when(token.isin(*TRUE_TOKENS), True).when(token.isin(*FALSE_TOKENS), False)


def number(c: Column) -> Column:
    """A finite double, or null. Spellings with a type suffix, which a cast alone would take, are refused."""
    plain = F.when(F.trim(c).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), F.trim(c))
    value = plain.try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def pct(part: Column, whole: Column) -> Column:
    """100 * part / whole in doubles; 0 if the whole is 0."""
    return F.coalesce(F.try_divide(F.lit(100.0) * part, whole), F.lit(0.0))


def rounded(c: Column, places: int) -> Column:
    """Decimal rounding of the exact binary value, ties to even (``round`` decides some cases otherwise)."""
    return text(c, places).cast("double")


def text(c: Column, places: int) -> Column:
    return F.call_function("format_number", c, F.lit("0." + "0" * places))


def hours(us: Column) -> Column:
    return us / F.lit(float(HOUR_US))


def difficulty_bit(c: Column) -> Column:
    out = None
    for name, bit in DIFFICULTY_BIT.items():
        out = F.when(c == name, bit) if out is None else out.when(c == name, bit)
    return out


def severest(bits: Column) -> Column:
    return F.when(bits >= 4, "hard").when(bits >= 2, "medium").when(bits >= 1, "easy")


def mixed(bits: Column) -> Column:
    return F.coalesce(F.bit_count(bits) > 1, F.lit(False))


def natural_key(c: Column) -> Column:
    """An array that sorts a stem by its runs of digits (as numbers) and other characters (case-folded)."""
    runs = F.regexp_extract_all(c, F.lit(r"[0-9]+|[^0-9]+"), F.lit(0))

    def key(x: Column) -> Column:
        digits = x.rlike("^[0-9]")
        bare = F.regexp_replace(x, "^0+", "")
        return F.struct(F.when(digits, 0).otherwise(1).alias("kind"), F.when(digits, F.length(bare)).otherwise(0).alias("size"), F.when(digits, bare).otherwise(F.lower(x)).alias("run"))

    return F.transform(runs, key)
