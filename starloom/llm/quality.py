"""Quality rules with an isolation forest on their statistics.

Every text gets its rule statistics in one pass. An isolation forest (random splits on random
statistics) is grown on a bounded sample of labelled rows that pass the base rule, ``SAMPLE`` rows at most; the path
lengths of all documents are its verdict. The threshold is calibrated on all such rows: of
the thresholds that reject at most ``MAX_FALSE`` of the good ones, the one that tells them best
from the bad ones. Without labelled rows of both kinds the base rule alone decides.

A null text has no words and fails the base rule. Repeated rows are judged each for itself;
other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import map_batches, written

WINDOW = 8
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT = 20, 30
BASE_FAILS = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT} * n_words"
TREES, ROWS_PER_TREE, SEED = 100, 256, 7
SAMPLE = TREES * ROWS_PER_TREE
MAX_FALSE = 0.002
STEPS = 10_000

FEATURES = ("f_symbol", "f_word", "f_upper", "f_digit", "f_mark", "f_line", "f_distinct")
BASE = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
STATS = BASE + "".join(f", {f} double" for f in FEATURES)
UPPER, DIGITS, MARKS = bytes(range(65, 91)), bytes(range(48, 58)), b"!?;:()[]{}=_/\\+@\"'"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more. Rolling hashes find candidates, which are compared."""
    count = len(words) - window + 1
    if count < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.uint64, len(words))
    mixed, hashes = ids * np.uint64(0x9E3779B97F4A7C15), np.zeros(count, np.uint64)
    mixed ^= mixed >> np.uint64(29)
    for i in range(window):
        hashes = hashes * np.uint64(0xD6E8FEB86659FD93) + mixed[i : i + count]
    _, where, times = np.unique(hashes, return_inverse=True, return_counts=True)
    suspects = np.flatnonzero(times[where] > 1).tolist()
    if not suspects:
        return 0
    windows = [tuple(words[i : i + window]) for i in suspects]
    found = Counter(windows)
    cover = np.zeros(len(words) + 1, np.int64)
    for i, w in zip(suspects, windows):
        if found[w] > 1:
            cover[i] += 1
            cover[i + window] -= 1
    return int((np.cumsum(cover) > 0).sum())


def statistics(text: str | None) -> list:
    """The counts of the contract, then the features of the forest."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    dup_lines = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    some, size = max(1, n), max(1, len(raw))
    share = lambda kind: (len(raw) - len(raw.translate(None, kind))) / size
    # In steps as coarse as the rules are: differences within good prose isolate nothing.
    features = [
        round(symbols / some, 1),
        math.floor(chars / some / 3.5),
        math.floor(5 * share(UPPER)) / 5,
        math.floor(5 * share(DIGITS)) / 5,
        math.floor(10 * share(MARKS)) / 10,
        math.floor(2 * dup_lines / max(1, len(lines))) / 2,
        round(min(1.0, len(set(words)) / some**0.8 / 1.5), 1),
    ]
    return [n, chars, symbols, dup_lines, repeated, *features]


def _ddl(carried: tuple) -> str:
    return "".join([STATS, *(f", {c} binary" for c in carried)])


def rule_statistics(docs: DataFrame, carried: tuple = ()) -> DataFrame:
    def columns(batch):
        made = [statistics(t.as_py()) for t in batch["text"]]
        return [batch["doc_id"], *(map(list, zip(*made)) if made else [[]] * (len(FEATURES) + 5)), *(batch[c] for c in carried)]

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text", *carried), _ddl(carried), columns)


# --- the forest ---------------------------------------------------------------------------


def _average_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """One tree as arrays: split feature (-1: leaf), split value, left child, path length of a leaf."""
    feature, value, left, path = [], [], [], []
    deepest = math.ceil(math.log2(max(2, len(rows))))

    def new() -> int:
        for column, v in zip((feature, value, left, path), (-1, 0.0, 0, 0.0)):
            column.append(v)
        return len(feature) - 1

    todo = [(new(), rows, 0)]
    while todo:
        node, own, depth = todo.pop()
        low, high = own.min(axis=0), own.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= deepest or len(own) < 2 or not len(usable):
            path[node] = depth + _average_path(len(own))
            continue
        f = int(rng.choice(usable))
        cut = rng.uniform(low[f], high[f])
        feature[node], value[node], left[node] = f, cut, new()
        new()
        below = own[:, f] <= cut
        todo += [(left[node], own[below], depth + 1), (left[node] + 1, own[~below], depth + 1)]
    return tuple(np.array(c) for c in (feature, value, left, path))


def fit(rows: np.ndarray, trees: int = TREES, seed: int = SEED) -> list[tuple[np.ndarray, ...]]:
    rng = np.random.default_rng(seed)
    size = min(ROWS_PER_TREE, len(rows))
    return [grow(rows[rng.choice(len(rows), size, replace=False)], rng) for _ in range(trees)]


def anomaly(rows: np.ndarray, forest, per_tree: int) -> np.ndarray:
    """2 ** (-mean path / expected path): towards 1 for rows that few splits isolate."""
    total = np.zeros(len(rows))
    every = np.arange(len(rows))
    for feature, value, left, path in forest:
        node = np.zeros(len(rows), np.int64)
        while (inner := feature[node] >= 0).any():
            at = node[inner]
            right = rows[every[inner], feature[at]] > value[at]
            node[inner] = left[at] + right
        total += path[node]
    return 2.0 ** (-total / len(forest) / max(1e-9, _average_path(per_tree)))


def calibrate(counts: dict[tuple[int, int], int], max_false: float = MAX_FALSE) -> float | None:
    """The threshold that best tells bad rows from good ones (difference of their rejected shares)
    while at most ``max_false`` of the good ones are rejected, in the middle of its gap.
    ``counts``: rows by (label, score step)."""
    total = {q: sum(n for (label, _), n in counts.items() if label == q) for q in (0, 1)}
    if not all(total.values()):
        return None
    steps = sorted({s for _, s in counts}, reverse=True)
    best, threshold, rejected = 0.0, None, {0: 0, 1: 0}
    for s, below in zip(steps, [*steps[1:], 0]):
        for q in rejected:
            rejected[q] += counts.get((q, s), 0)
        if rejected[1] > max_false * total[1]:
            break
        gain = rejected[0] / total[0] - rejected[1] / total[1]
        if gain > best:
            best, threshold = gain, (s + below + 1) / 2 / STEPS
    return threshold


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, carried: tuple = ()) -> DataFrame:
    """Statistics of every row of ``docs(doc_id, text)`` with ``base_failed``, ``anomaly`` and ``kept``,
    and the binary columns ``carried``.

    ``labels(doc_id, quality)``: 1 is good, 0 bad, other rows are left out.
    """
    stats = written(spark, rule_statistics(docs, carried), "quality")
    marked = labels.filter("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    # The forest decides where the base rule does not, so it learns and is calibrated there.
    labelled = stats.join(marked, "doc_id").filter(f"not ({BASE_FAILS})")
    # Rows of smallest hash: a bounded sample that is the same in every run.
    picked = labelled.orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(SAMPLE).select(*FEATURES).collect()
    rows = np.array([tuple(r) for r in picked], float).reshape(-1, len(FEATURES))
    if len(rows) < 2:
        scored, threshold = stats.withColumn("anomaly", F.lit(None).cast("double")), None
    else:
        forest, per_tree = fit(rows), min(ROWS_PER_TREE, len(rows))
        scored = _scored(stats, forest, per_tree, carried)
        step = F.floor(F.col("anomaly") * STEPS).cast("int")
        sums = _scored(labelled.drop("quality"), forest, per_tree).join(marked, "doc_id").groupBy("quality", step.alias("step")).count()
        threshold = calibrate({(r[0], r[1]): r[2] for r in sums.collect()})
    failed = F.expr(BASE_FAILS)
    fine = F.lit(True) if threshold is None else F.col("anomaly") < threshold
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & fine)


def _scored(stats: DataFrame, forest, per_tree: int, carried: tuple = ()) -> DataFrame:
    names = [c.split()[0] for c in _ddl(carried).split(", ")]

    def columns(batch):
        rows = np.column_stack([batch[f].to_numpy(zero_copy_only=False) for f in FEATURES]).astype(float)
        return [*(batch[c] for c in names), anomaly(rows, forest, per_tree)]

    return map_batches(stats.select(*names), f"{_ddl(carried)}, anomaly double", columns)
