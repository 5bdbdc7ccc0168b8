"""A toxicity classifier whose scores do not hang on which group a sentence names.

Words and prefixes are hashed into a fixed table; the buckets that tell the classes apart are counted over
the training sample, those of the identity terms join them, and a logistic scorer is fitted. Every labelled text has
counterfactuals: where it names a group, its terms are swapped for another group's; where it names none, a term is
put in, and swapped in turn. The squared change of the logit is part of the loss, so neither a term nor the
prefixes that it shares with other words can carry weight, and neutral mentions are not flagged.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linear
from .common import bounded_sample, crc_mod

#: Terms of two groups each, in English, German, French and Spanish; swapped in both directions.
IDENTITY_PAIRS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("muslims", "christians"), ("muslim", "christian"), ("jews", "hindus"), ("jewish", "hindu"), ("black", "white"), ("gay", "straight"),
    ("immigrants", "citizens"), ("immigrant", "citizen"), ("african", "european"), ("asian", "american"), ("mexican", "canadian"), ("disabled", "abled"), ("transgender", "cisgender"), ("old", "young"),
    ("frauen", "männer"), ("frau", "mann"), ("mädchen", "jungen"), ("muslime", "christen"), ("juden", "hindus"), ("schwule", "heteros"), ("ausländer", "inländer"), ("schwarze", "weiße"), ("türken", "schweizer"), ("behinderte", "gesunde"),
    ("femmes", "hommes"), ("femme", "homme"), ("filles", "garçons"), ("musulmans", "chrétiens"), ("juifs", "hindous"), ("noirs", "blancs"), ("immigrés", "citoyens"), ("africains", "européens"), ("handicapés", "valides"), ("homosexuels", "hétérosexuels"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("niñas", "niños"), ("musulmanes", "cristianos"), ("judíos", "hindúes"), ("negros", "blancos"), ("inmigrantes", "ciudadanos"), ("gitanos", "vecinos"), ("discapacitados", "capacitados"), ("homosexuales", "heterosexuales"),
)
Terms = tuple[tuple[str, str], ...]


def swaps(terms: Terms = IDENTITY_PAIRS) -> dict[bytes, bytes]:
    """What each chunk that names a group becomes. A term of two pairs goes to its first partner."""
    out: dict[bytes, bytes] = {}
    for a, b in terms:
        for x, y in ((a, b), (b, a)):
            for mark in ("", ".", ",", "!", "?", ";", ":"):
                out.setdefault((x + mark).encode(), (y + mark).encode())
    return out


def counterfactuals(terms: Terms, each: int = 1) -> linear.Counterfactuals | None:
    """For a text's chunks, pairs of texts that should score alike: the text and its swapped self, or, where it names
    no group, the text with a term against both the text with the other term and the text as it is. The terms put in
    are ``each`` of ``terms``, from a place that its content gives."""
    swap = swaps(terms)
    if not terms:
        return None

    def change(chunks: list[bytes]) -> list[tuple[list[bytes], list[bytes]]]:
        if not swap.keys().isdisjoint(chunks):
            return [(chunks, [swap.get(c, c) for c in chunks])]
        first, out = zlib.crc32(b" ".join(chunks)), []
        for k in range(min(each, len(terms))):
            a, b = (x.encode() for x in terms[(first + k) % len(terms)])
            out += [([*chunks, a], [*chunks, b]), ([*chunks, a], chunks)]
        return out

    return change


def train_rows(docs: DataFrame, labels: DataFrame, allowed: Column, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", max_rows: int = 16000) -> DataFrame:
    """(y, text) of at most about ``max_rows`` labelled documents for which ``allowed`` (on _id) holds, chosen
    by a hash of the id; of rows that share an id, the least text. The sample is bounded, so it is broadcast to the
    scan of ``docs``."""
    lab = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").alias("y")).where(F.col("_id").isNotNull() & F.col("y").isNotNull()).where(allowed)
    lab = bounded_sample(lab.groupBy("_id").agg(F.max("y").cast("double").alias("y")), "_id", max_rows)
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(lab), "_id")
    return rows.groupBy("_id").agg(F.max("y").alias("y"), F.min("text").alias("text")).select("y", "text")


@dataclass
class Model:
    chosen: np.ndarray
    weights: np.ndarray
    bias: float
    rows: int
    pairs: int  # counterfactual pairs in the loss


def train(rows: DataFrame, terms: Terms = IDENTITY_PAIRS, fairness: float = 10.0, texts_a_term: int = 200) -> Model:
    """A model from (y, text), a bounded sample. Each pair of terms is put into about ``texts_a_term`` texts, or more.
    Without rows every score is 0.5."""
    rows = rows.cache()
    try:
        total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("p")).first()
        n_pos = total["p"] or 0.0
        chosen = linear.choose(linear.counts(rows), total["n"] - n_pos, n_pos)
        chosen = np.union1d(chosen, linear.expand(x.encode() for pair in terms for x in pair))
        y, f, pairs = linear.matrix(rows, chosen, counterfactuals(terms, -(-texts_a_term * len(terms) // max(1, total["n"]))))
    finally:
        rows.unpersist()
    return Model(chosen, *linear.fit(y, f, len(chosen), pairs, fairness), len(y), len(pairs))


def classify(docs: DataFrame, labels: DataFrame, held_out: int = 2, folds: int = 4, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 16000, fairness: float = 10.0, terms: Terms = IDENTITY_PAIRS) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``. Labels of rows whose crc32(id) mod ``folds``
    is ``held_out`` are never read. Null or empty texts get the score of a text without features; null ids
    keep their row; repeated rows each get the same score; without training rows every score is 0.5."""
    model = train(train_rows(docs, labels, crc_mod(F.col("_id"), folds) != held_out, id_col=id_col, text_col=text_col, max_rows=max_rows), terms, fairness)
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    out = linear.score(src, model.chosen, model.weights, model.bias, ["doc_id"])
    return out.select("doc_id", (crc_mod(F.col("doc_id"), folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
