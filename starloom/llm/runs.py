"""Periodic runs of words by longest common extensions on suffix trees.

A run is a stretch of words with smallest period q, at least ``max(min_length, 2 q)`` long, that
neither neighbour extends with period q. For both orders of the alphabet, each position has a longest
Lyndon word, which ends before the next smaller suffix; every run has a root among these. A candidate
root is extended to both sides by longest common extensions: in the suffix tree of the words to the
right, in that of the reversed words to the left. The trees are Ukkonen's; an Euler tour of each
gives its leaves in order and, between neighbours, the depth of their lowest common ancestor, and a
sparse table of these answers any extension in constant time.

Both copies of a run's periodic part are equal stretches of ``min_length / 2`` words or more. So words
that lie in no repeated stretch of that length are in no run; each document's trees hold the other
words only, and documents without repeats have none. A tree takes about 500 bytes a word.

Words are runs without ASCII white space, numbered from 0. A null text has none. Each row is judged
by itself: repeated rows come back as often as they came, ids may be null, other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import map_batches

MIN_LENGTH = 12
NONE = np.zeros(0, np.int64)


# --- suffix tree --------------------------------------------------------------------------


def suffix_tree(symbols: list[int]) -> tuple[dict[int, int], list[int], list[int], int]:
    """Ukkonen's tree of ``symbols``, the last of which is 0 and occurs once.

    Nodes are numbers, the root 0. Returns the child of ``node * base + symbol``, where the edge to
    each node begins and ends in ``symbols``, and ``base``.
    """
    base, size = max(symbols) + 1, len(symbols)
    child: dict[int, int] = {}
    begin, end, link = [0], [0], [0]
    node = edge = length = waiting = 0
    for i, symbol in enumerate(symbols):
        last = 0  # the inner node made before, whose suffix link is still open
        waiting += 1
        while waiting:
            if not length:
                edge = i
            key = node * base + symbols[edge]
            under = child.get(key)
            if under is None:
                child[key] = len(begin)
                begin.append(i)
                end.append(size)
                link.append(0)
                if last:
                    link[last] = node
                last = node
            else:
                span = end[under] - begin[under]
                if length >= span:
                    edge += span
                    length -= span
                    node = under
                    continue
                if symbols[begin[under] + length] == symbol:
                    length += 1
                    if last:
                        link[last] = node
                    break
                split = len(begin)
                child[key] = split
                begin += (begin[under], i)
                end += (begin[under] + length, size)
                link += (0, 0)
                begin[under] += length
                child[split * base + symbol] = split + 1
                child[split * base + symbols[begin[under]]] = under
                if last:
                    link[last] = split
                last = split
            waiting -= 1
            if not node and length:
                length -= 1
                edge = i - waiting + 1
            else:
                node = link[node]
    return child, begin, end, base


def euler_tour(tree, size: int, falling: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in the order of the tour, and the depth of the lowest common ancestor of each and the one before.

    Children come by symbol, rising or falling, but the end of the text first in both.
    """
    child, begin, end, base = tree
    keys = np.fromiter(child.keys(), np.int64, len(child))
    nodes = np.fromiter(child.values(), np.int64, len(child))
    parent, symbol = np.divmod(keys, base)
    # The stack turns the order of children around.
    rank = np.where(symbol == 0, base, symbol if falling else base - symbol)
    order = np.lexsort((rank, parent))
    below = nodes[order].tolist()
    first = np.searchsorted(parent[order], np.arange(len(begin) + 1)).tolist()
    suffixes, depths = [], []
    stack, depth, low = below[first[0] : first[1]], [0] * len(begin), size
    above = [0] * len(begin)
    while stack:
        node = stack.pop()
        at = depth[above[node]]
        if at < low:
            low = at
        a, b = first[node], first[node + 1]
        if a == b:
            suffixes.append(begin[node] - at)
            depths.append(low)
            low = size
        else:
            depth[node] = at + end[node] - begin[node]
            for under in below[a:b]:
                above[under] = node
            stack += below[a:b]
    return np.array(suffixes, np.int64), np.array(depths, np.int64)


class Extensions:
    """Longest common extensions of positions in constant time each."""

    def __init__(self, suffixes: np.ndarray, depths: np.ndarray):
        self.rank = np.empty(len(suffixes), np.int64)
        self.rank[suffixes] = np.arange(len(suffixes))
        self.table = [depths.astype(np.int32)]
        while 2 << (len(self.table) - 1) <= len(depths):
            half, step = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(half[:-step], half[step:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` and from ``b`` on agree; a and b differ."""
        a, b = self.rank[a], self.rank[b]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(a), np.int64)
        for k, row in enumerate(self.table):
            at = np.flatnonzero(level == k)
            found[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return found


def next_smaller(rank: list[int]) -> np.ndarray:
    """For each position the next one whose suffix is smaller; the last suffix is the smallest."""
    found, open_ = [0] * len(rank), []
    for i, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            found[open_.pop()] = i
        open_.append(i)
    return np.array(found, np.int64)


def maximal_runs(symbols: list[int], min_length: int) -> np.ndarray:
    """``start, length, period`` of every run among positive ``symbols``, by start and period."""
    n = len(symbols)
    text = [*symbols, 0]
    tree = suffix_tree(text)
    suffixes, depths = euler_tour(tree, n + 1)
    right = Extensions(suffixes, depths)
    rank = np.empty(n + 1, np.int64)
    rank[euler_tour(tree, n + 1, falling=True)[0]] = np.arange(n + 1)
    del tree
    mirrored = [*reversed(symbols), 0]
    left = Extensions(*euler_tour(suffix_tree(mirrored), n + 1))
    begin = np.tile(np.arange(n), 2)
    stop = np.concatenate([next_smaller(right.rank.tolist())[:n], next_smaller(rank.tolist())[:n]])
    period = stop - begin
    start = begin - left(n - begin, n - stop)
    length = stop + right(begin, stop) - start
    keep = length >= np.maximum(2 * period, min_length)
    return np.unique(np.stack([start, period, length], axis=1)[keep], axis=0)[:, [0, 2, 1]]


# --- documents ----------------------------------------------------------------------------


def repeated_stretches(hashes: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Maximal stretches covered by windows of ``size`` that occur twice. (A clash of hashes only adds words.)"""
    count = len(hashes) - size + 1
    if count < 2:
        return []
    windows = np.zeros(count, np.uint64)
    for k in range(size):
        windows = windows * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + count]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return []
    at = np.flatnonzero(np.isin(windows, twice))
    breaks = np.flatnonzero(np.diff(at) > size) + 1
    starts, ends = at[np.concatenate([[0], breaks])], at[np.concatenate([breaks - 1, [len(at) - 1]])] + size
    return list(zip(starts.tolist(), ends.tolist()))


def find_runs(words: list[bytes], min_length: int = MIN_LENGTH) -> np.ndarray:
    """``start, length, period`` of every run, by start and period."""
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    stretches = repeated_stretches(hashes, (min_length + 1) // 2)
    if not stretches:
        return np.zeros((0, 3), np.int64)
    ids: dict[bytes, int] = {}
    symbols, origin = [], []
    for number, (start, end) in enumerate(stretches):
        symbols += [ids.setdefault(word, len(ids) + 1) for word in words[start:end]]
        # A symbol of its own ends each stretch, so no run goes on into the next.
        symbols.append(-1 - number)
        origin.append(np.arange(start, end + 1))
    symbols = [s if s > 0 else len(ids) - s for s in symbols]
    found = maximal_runs(symbols, min_length)
    found[:, 0] = np.concatenate(origin)[found[:, 0]]
    return found


def collapsed(words: list[bytes], found: np.ndarray) -> bytes:
    """The words that no run contains after its first period, joined by spaces."""
    if not len(found):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def scan(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``doc_id``, ``runs`` (by start, then period) and the ``collapsed`` text for every row of ``docs(doc_id, text)``."""

    def columns(batch):
        all_runs, texts = [], []
        for value in batch["text"]:
            words = (value.as_py() or "").encode().split()
            found = find_runs(words, min_length)
            all_runs.append([dict(zip(("start", "length", "period"), row)) for row in found.tolist()])
            texts.append(collapsed(words, found).decode())
        return [batch["doc_id"], all_runs, texts]

    run = "struct<start: bigint, length: bigint, period: bigint>"
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), f"doc_id long, runs array<{run}>, collapsed string", columns)


def report(scanned: DataFrame) -> DataFrame:
    """Counts, the greatest run and digests."""
    longest = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return scanned.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
