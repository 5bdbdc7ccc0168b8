"""Learned decision lists over text statistics, with built-in SQL functions only.

``statistics`` computes the numbers in one row-local pass (no shuffle). ``learn`` grows a list of threshold
conjunctions by sequential covering: each growth step is one aggregate over binned statistics of labelled
rows, each finished rule is pruned on rows it was not grown on, and rows it covers are set aside. ``Rules``
then is an ordered conditional expression that Spark compiles into the scan's stage.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, Scope, bounded_sample, cut, scoped, words

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What rules may test. All are ratios or counts that a reader can check by hand.
FEATURES = ("n_words", "mean_word", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "mark_ratio", "upper_ratio")


def _repeat_words(w: str) -> Column:
    """Words in 3-word windows that are found twice or more: windows are sorted by hash with their position,
    equal neighbours are repeats, and the positions that they cover are counted once."""
    return F.expr(
        f"""size(array_distinct(flatten(transform(
              filter(_windows, (x, i) -> x.h = get(_windows, i - 1).h or x.h = get(_windows, i + 1).h),
              x -> array(x.i, x.i + 1, x.i + 2)))))""".replace("_windows", w)
    ).cast("bigint")


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed
    and FEATURES. Null texts have no words; ratios of nothing are 0. A column of ``docs`` that has one of these
    names is replaced."""
    t = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    d = docs.withColumn("_t", t).withColumn("_w", words(F.col("_t")))
    d = d.withColumn("_s", F.expr("sort_array(transform(slice(_w, 1, greatest(size(_w) - 2, 0)), (x, i) -> struct(xxhash64(x, _w[i + 1], _w[i + 2]) as h, i as i)))"))
    d = d.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    count = lambda marks: F.length("_t") - F.length(F.translate("_t", marks, ""))
    d = d.select(
        *(F.col(f"`{c}`") for c in docs.columns if c != text_col),
        F.size("_w").cast("bigint").alias("_n_words"),
        F.length(F.array_join("_w", "")).cast("bigint").alias("_word_chars"),
        count(SYMBOLS).cast("bigint").alias("_n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("_n_dup_lines"),
        _repeat_words("_s").alias("_n_repeat_words"),
        F.size("_l").alias("_lines"),
        count("!?").alias("_marks"),
        count(UPPER).alias("_upper"),
    )
    n = F.greatest(F.col("_n_words"), F.lit(1))
    named = {c: F.col(f"_{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    named |= {
        "base_failed": (F.col("_n_words") < 50) | (100 * F.col("_n_repeat_words") > 50 * F.col("_n_words")),
        "mean_word": F.col("_word_chars") / n,
        "symbol_ratio": F.col("_n_symbols") / n,
        "dup_line_ratio": F.col("_n_dup_lines") / F.greatest("_lines", F.lit(1)),
        "repeat_ratio": F.col("_n_repeat_words") / n,
        "mark_ratio": F.col("_marks") / n,
        "upper_ratio": F.col("_upper") / F.greatest("_word_chars", F.lit(1)),
    }
    return d.select(*(F.col(f"`{c}`") for c in docs.columns if c != text_col and c not in named), *(v.alias(k) for k, v in named.items()))


@dataclass(frozen=True)
class Rule:
    """A row that meets all conditions (feature, '<=' or '>', threshold) is rejected."""

    conditions: tuple[tuple[str, str, float], ...]
    precision: float
    covered: int

    def column(self) -> Column:
        out = F.lit(True)
        for f, op, x in self.conditions:
            out = out & (F.col(f) <= x if op == "<=" else F.col(f) > x)
        return out

    def __str__(self) -> str:
        return " AND ".join(f"{f} {op} {x:g}" for f, op, x in self.conditions)


@dataclass(frozen=True)
class Rules:
    rules: tuple[Rule, ...] = ()

    def number(self) -> Column:
        """The first rule that a row meets, from 1; 0 for none."""
        out = F.when(F.lit(False), F.lit(0))
        for k, r in enumerate(self.rules, 1):
            out = out.when(r.column(), F.lit(k))
        return out.otherwise(F.lit(0))

    def kept(self) -> Column:
        return self.number() == 0


def _gain(p0: float, n0: float, p: float, n: float) -> float:
    """FOIL's information gain of a condition that leaves p of p0 bad and n of n0 good rows."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def learn(stats: DataFrame, label_col: str, id_col: str = "doc_id", features: tuple[str, ...] = FEATURES, bins: int = 48, max_rules: int = 8, max_conditions: int = 4, precision: float = 0.97, least: int = 8) -> Rules:
    """A decision list that rejects rows with label 0. ``stats``: labelled statistics (null labels are left
    out). Ties of gain go to the first feature and the lowest threshold. Rules below ``precision`` or with under ``least`` covered rows, on the pruning third, are not kept;
    without labelled rows of both kinds there are no rules and everything is kept."""
    rows = stats.where(F.col(label_col).isNotNull()).select(
        (F.col(label_col) == 0).alias("bad"), (F.pmod(F.xxhash64(F.lit("prune"), F.col(f"`{id_col}`")), F.lit(3)) == 0).alias("prune"), *(F.col(f).cast("double").alias(f) for f in features)
    )
    with Scope() as scope:
        found = _cover(cut(rows, "labelled"), features, bins, max_rules, max_conditions, precision, least)
        scope.free()
    return Rules(tuple(found))


def _cover(rows: DataFrame, features: tuple[str, ...], bins: int, max_rules: int, max_conditions: int, precision: float, least: int) -> list[Rule]:
    """Grows and prunes rules over the stored rows (bad, prune, features)."""
    cuts = rows.agg(*(F.percentile_approx(f, [(i + 1) / bins for i in range(bins - 1)], 4096).alias(f) for f in features)).first()
    steps = {f: sorted(set(cuts[f] or [])) for f in features}
    binned = rows
    for f in features:  # bin b: above steps[b - 1], not above steps[b]
        here = F.col(f)
        b = F.array_size(F.filter(F.array(*(F.lit(float(x)) for x in steps[f])), lambda x: x < here)) if steps[f] else F.lit(0)  # noqa: B023
        binned = binned.withColumn(f"_b_{f}", b)
    binned = cut(binned, "binned")
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col(f"_b_{f}").alias("b"), F.col(f).alias("v")) for f in features))).alias("x")
    found: list[Rule] = []
    while len(found) < max_rules:
        left = binned.where(Rules(tuple(found)).kept())
        grow, conditions = left.where("not prune"), []
        while len(conditions) < max_conditions:
            inside = grow.where(Rule(tuple(conditions), 0, 0).column()).select("bad", pairs)
            seen = inside.groupBy("x.f", "x.b").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n"), F.min("x.v").alias("lo"), F.max("x.v").alias("hi")).collect()  # features x bins
            table = {(r["f"], r["b"]): (r["p"], r["n"]) for r in seen}
            ends = {(r["f"], r["b"]): (r["lo"], r["hi"]) for r in seen}
            p0, n0 = (sum(table.get((features[0], b), (0, 0))[k] for b in range(bins + 1)) for k in (0, 1))
            best = (1e-9, None)
            if p0 and n0:
                for f in features:
                    p = n = 0
                    for b in range(len(steps[f])):
                        dp, dn = table.get((f, b), (0, 0))
                        p, n = p + dp, n + dn
                        above = [ends[f, c][0] for c in range(b + 1, len(steps[f]) + 1) if (f, c) in ends]
                        if (f, b) in ends and above:  # the middle of the gap between the bins: the widest margin
                            x = (ends[f, b][1] + above[0]) / 2
                            best = max(best, (_gain(p0, n0, p, n), (f, "<=", x)), (_gain(p0, n0, p0 - p, n0 - n), (f, ">", x)), key=lambda g: g[0])
            if best[1] is None:
                break
            conditions.append(best[1])
        if not conditions:
            break
        ends = range(1, len(conditions) + 1)
        heads = [Rule(tuple(conditions[:k]), 0, 0).column() for k in ends]
        held = left.where("prune").agg(*(F.count_if(h & F.col("bad")).alias(f"p{k}") for k, h in zip(ends, heads)), *(F.count_if(h & ~F.col("bad")).alias(f"n{k}") for k, h in zip(ends, heads))).first()
        worth = [((held[f"p{k}"] - held[f"n{k}"]) / max(1, held[f"p{k}"] + held[f"n{k}"]), held[f"p{k}"], -k) for k in ends]
        good = [w for w in worth if w[1] >= least and (w[0] + 1) / 2 >= precision]
        if not good:
            break
        widest = max(good, key=lambda w: (w[1], w[2]))
        found.append(Rule(tuple(conditions[: -widest[2]]), (widest[0] + 1) / 2, widest[1]))
    return found


def learn_from(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_rows: int = 8000) -> Rules:
    """Learns from at most about ``max_rows`` labelled ids, chosen by a hash (a bounded fit: the rules are a few
    thresholds). The sample is bounded, so it is broadcast to the scan of ``docs``. Null ids and labels teach nothing;
    an id with two labels has the lesser; of rows that share an id, the least text counts; null texts are empty; from
    empty tables comes an empty list."""
    lab = labels.where(F.col(f"`{label_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").alias("_y"))
    lab = bounded_sample(lab.groupBy("_id").agg(F.min("_y").alias("_y")), "_id", max_rows)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text")).join(F.broadcast(lab), "_id")
    rows = rows.groupBy("_id").agg(F.min("_y").alias("_y"), F.min("_text").alias("_text"))
    return learn(statistics(rows, "_text"), "_y", "_id")


def _judged(docs: DataFrame, rules: Rules, text_col: str) -> DataFrame:
    """The statistics are stored first: else Spark would put them into each condition that reads them."""
    s = cut(statistics(docs, text_col), "statistics")
    return s.withColumn("rule", rules.number()).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


@scoped
def judge(docs: DataFrame, rules: Rules, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, plus statistics, ``rule`` (the first that a row meets; 0: none) and ``kept``: false
    for a row that fails the base rules, else the decision list's verdict.

    Null and empty texts have no words, so they fail; null ids and repeated rows each keep their row; an empty table
    stays empty; very long texts are read whole; a column with the name of a statistic is replaced."""
    return _judged(docs, rules, text_col)


@scoped
def keep_good(docs: DataFrame, rules: Rules, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns only, whatever their names; repeated rows
    go or stay together."""
    names = docs.columns
    kept = _judged(docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"), F.col(f"`{text_col}`").alias("_text")), rules, "_text").where("kept")
    return kept.select("_row.*")
