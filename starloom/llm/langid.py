"""Language identification in two steps: the family first, then one-versus-one linear support
vector machines between the languages of the family.

Features are hashed character n-grams of the words of a whole text, in relative frequencies.
The machines are trained by averaged stochastic subgradients on at most ``ROWS_PER_LANGUAGE``
training rows per language (picked by a hash of their ids, the same in every run). Families of one
language need no second step. A language outside ``FAMILIES`` is a family of its own.

The ``MAX_LANGUAGES`` languages of most training rows are learned (of equals, the smallest names), from
``TRAINING_ROWS`` rows in all at most, so neither the driver nor the model grows with the values of ``lang``;
a row of another language gets the nearest learned one.

The score is the winner's share of the softmax-like votes, family times language. Texts that are
null or hold no letter are ``und`` with score 0, as is everything without a training row.
Repeated rows are predicted each for itself; an empty table gives none.
"""

from __future__ import annotations

import sys
import unicodedata
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import map_batches, written

# Which languages are close relatives.
FAMILIES = {
    **dict.fromkeys(("de", "en", "nl", "sv", "da", "no"), "germanic"),
    **dict.fromkeys(("es", "fr", "it", "pt", "ro", "ca"), "romance"),
    **dict.fromkeys(("ru", "uk", "pl", "cs", "bg", "sr"), "slavic"),
}
SIZE = 2048
GRAMS = (1, 2, 3)
ROWS_PER_LANGUAGE = 400
# Bounds of the driver: a row is 24 KB of features; machines grow with the square of the families.
MAX_LANGUAGES = 40
TRAINING_ROWS = 8_000
EPOCHS, RATE, DECAY, SEED = 20, 0.5, 1e-4, 5
CHUNK = 1 << 20
UNKNOWN = "und"


def _letter_table() -> np.ndarray:
    """Lower-case letter per code point, 0 for others."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] == "L":
            lowered = chr(c).lower()
            table[c] = ord(lowered) if len(lowered) == 1 else c
    return table


_LETTERS: list[np.ndarray] = []


def features(text: str | None, size: int = SIZE) -> np.ndarray | None:
    """Relative frequencies of the hashed n-grams (n = 1, 2, 3), each n with norm 1; None without a letter."""
    if not _LETTERS:
        _LETTERS.append(_letter_table())
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.zeros((len(GRAMS), size))
    for at in range(0, len(codes), CHUNK):
        # Chunks overlap by the longest n-gram less one, so each n-gram is counted once.
        own = _LETTERS[0][codes[max(0, at - 2) : at + CHUNK]].astype(np.uint64)
        skip = min(at, 2)
        for row, n in enumerate(GRAMS):
            if len(own) < n:
                continue
            hashed = np.zeros(len(own) - n + 1, np.uint64)
            for i in range(n):
                hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + own[i : len(own) - n + 1 + i] + np.uint64(1)
            hashed = ((hashed ^ (hashed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)
            letters = own[n - 1 :] if n == 1 else np.maximum(own[: len(own) - n + 1], own[n - 1 :])
            fresh = max(0, skip - n + 1)
            counts[row] += np.bincount(hashed[fresh:][letters[fresh:] > 0] % size, minlength=size)
    if not counts[0].any():
        return None
    norms = np.linalg.norm(counts, axis=1, keepdims=True)
    return (counts / np.maximum(norms, 1)).ravel()


def train(rows: np.ndarray, sides: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Weights (the last one the bias) of a linear machine with hinge loss; ``sides`` are 1 and -1."""
    rows = np.column_stack([rows.astype(float), np.ones(len(rows))])
    share = {s: len(sides) / 2 / max(1, int((sides == s).sum())) for s in (1, -1)}
    weights, mean, step = np.zeros(rows.shape[1]), np.zeros(rows.shape[1]), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            step += 1
            weights *= 1 - RATE * DECAY
            if sides[i] * (rows[i] @ weights) < 1:
                weights += RATE / np.sqrt(1 + step / 100) * share[int(sides[i])] * sides[i] * rows[i]
            mean += (weights - mean) / step
    return mean


class Duels:
    """One machine per pair of classes; every machine gives its winner a vote by its margin."""

    def __init__(self, rows: np.ndarray, names: list[str], rng):
        self.names = sorted(set(names))
        own = np.array(names)
        self.pairs = list(combinations(range(len(self.names)), 2))
        self.weights = [
            train(rows[pick], np.where(own[pick] == self.names[a], 1, -1), rng)
            for a, b in self.pairs
            for pick in [np.flatnonzero((own == self.names[a]) | (own == self.names[b]))]
        ]

    def best(self, row: np.ndarray) -> tuple[str, float]:
        votes = np.zeros(len(self.names))
        for (a, b), w in zip(self.pairs, self.weights):
            won = 1 / (1 + np.exp(-np.clip(4 * (row @ w[:-1] + w[-1]), -30, 30)))
            votes[a] += won
            votes[b] += 1 - won
        top = int(votes.argmax())
        return self.names[top], float(votes[top] / max(1, len(self.names) - 1)) if self.pairs else 1.0


class Model:
    def __init__(self, rows: np.ndarray, langs: list[str], families: dict[str, str] = FAMILIES):
        rng = np.random.default_rng(SEED)
        family = [families.get(lang, lang) for lang in langs]
        self.families = Duels(rows, family, rng)
        self.languages = {}
        for name in self.families.names:
            pick = [i for i, f in enumerate(family) if f == name]
            self.languages[name] = Duels(rows[pick], [langs[i] for i in pick], rng)

    def predict(self, text: str | None) -> tuple[str, float]:
        row = features(text)
        if row is None:
            return UNKNOWN, 0.0
        family, sure = self.families.best(row)
        lang, surer = self.languages[family].best(row)
        return lang, min(1.0, max(0.0, sure * surer))


def held_out() -> str:
    """SQL: rows that are never learned from."""
    return "coalesce(crc32(cast(doc_id as string)) % 3 = 1, false)"


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model | None:
    """A model of the rows of ``docs(doc_id, text, lang)`` that are not held out."""
    usable = docs.filter(f"not ({held_out()}) and lang is not null and text is not null and doc_id is not null")
    most = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES)
    counts = {r[0]: r[1] for r in most.collect()}
    if not counts:
        return None
    rows_per_language = max(1, min(rows_per_language, TRAINING_ROWS // len(counts)))
    # A share of each language's ids that holds about twice as many as wanted, so that no task ranks a
    # whole language. Only ids are dealt out; the texts of the chosen few are read afterwards.
    wide = F.create_map(*(F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, 2 * rows_per_language / n))))
    hashed = usable.select("doc_id", "lang", F.xxhash64("doc_id", F.lit(SEED)).alias("h"))
    near = hashed.filter(F.pmod("h", F.lit(1 << 30)) < F.coalesce(F.try_element_at(wide, F.col("lang")), F.lit(0.0)) * float(1 << 30))
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= rows_per_language)
    # At most TRAINING_ROWS ids, so this side may be broadcast.
    ids = written(docs.sparkSession, picked.select("doc_id").distinct(), "language-rows")

    def columns(batch):
        made = [features(t.as_py()) for t in batch["text"]]
        return [batch["lang"], [None if m is None else m.astype(np.float32).tobytes() for m in made]]

    # An id counts once, however often it is repeated.
    known = usable.join(F.broadcast(ids), "doc_id", "left_semi").filter(F.col("lang").isin(list(counts)))
    chosen = known.groupBy("doc_id").agg(F.min(F.struct("lang", "text")).alias("row")).select("row.*")
    rows = sorted(tuple(r) for r in map_batches(chosen, "lang string, f binary", columns).filter("f is not null").collect())
    if not rows:
        return None
    return Model(np.array([np.frombuffer(f, np.float32) for _, f in rows]), [lang for lang, _ in rows])


def predict(spark: SparkSession, docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row of ``docs(doc_id, text)``."""
    shared = spark.sparkContext.broadcast(model)

    def columns(batch):
        found = [shared.value.predict(t.as_py()) if shared.value else (UNKNOWN, 0.0) for t in batch["text"]]
        return [batch["doc_id"], batch["held_out"], [f[0] for f in found], [f[1] for f in found]]

    given = docs.select(F.col("doc_id").cast("long"), F.expr(held_out()).alias("held_out"), "text")
    return map_batches(given, "doc_id long, held_out boolean, lang_pred string, score double", columns)
