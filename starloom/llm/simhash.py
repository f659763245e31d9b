"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints within ``max_bits`` bits, cut into ``max_bits // 2 + 1`` segments, have a segment
that differs by at most one bit. Each distinct fingerprint is therefore indexed under every
variant of every segment with one bit deleted; equal variants meet in an equality join, and
the full distance is verified in its condition. Copies share a fingerprint and travel as one.

A null text counts as empty; a text without words has fingerprint zero, linked like any other.
A null ``doc_id`` takes part but never names a component unless no other id is in it. Repeated
rows come back as often as they came; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import map_batches, written

SHINGLE = 3
MAX_BITS = 3
SEED = 42
CHUNK = 1 << 16


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint: the majority of the bits of the shingles' hashes."""
    # bytes: lower() and split() know ASCII only, as asked.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hashes = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        part = hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carried: tuple = ()) -> DataFrame:
    """``doc_id, print`` and the binary columns ``carried``."""

    def columns(batch):
        return [batch["doc_id"], [simhash(t.as_py(), shingle) for t in batch["text"]], *(batch[c] for c in carried)]

    ddl = "".join(["doc_id long, print long", *(f", {c} binary" for c in carried)])
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text", *carried), ddl, columns)


def _variants(max_bits: int) -> list[tuple[int, int, int]]:
    """(segment's mask, deleted bit, whether it is the segment's first) as signed numbers."""
    segments = max_bits // 2 + 1
    cuts = [64 * i // segments for i in range(segments + 1)]
    signed = lambda n: n - (1 << 64) if n >> 63 else n
    return [
        (signed(sum(1 << b for b in range(low, high))), signed(1 << bit), bit == low)
        for low, high in zip(cuts, cuts[1:])
        for bit in range(low, high)
    ]


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``a < b`` of all distinct fingerprints within ``max_bits`` bits; a pair may come once per segment."""
    listed = ", ".join(
        f"struct({n} as variant, {mask}L as mask, {bit}L as bit, {str(first).lower()} as first)".replace("-9223372036854775808L", "bigint('-9223372036854775808')")
        for n, (mask, bit, first) in enumerate(_variants(max_bits))
    )
    indexed = prints.select("print", F.explode(F.expr(f"array({listed})")).alias("v")).selectExpr(
        "v.variant", "print & v.mask & ~v.bit as kept", "print", "v.mask", "v.bit", "v.first"
    )
    left, right = indexed.alias("l"), indexed.select("variant", "kept", "print").alias("r")
    # A pair that agrees in a whole segment meets in all its variants and counts in the first.
    differs = "((l.print ^ r.print) & l.mask) != 0 or l.first"
    met = f"l.variant = r.variant and l.kept = r.kept and l.print < r.print and ({differs})"
    near = f"bit_count(l.print ^ r.print) <= {max_bits}"
    # The planner doesn't see how many variants a fingerprint has, so it must not judge the size.
    return left.join(right.hint("merge"), F.expr(f"{met} and {near}")).selectExpr("l.print as a", "r.print as b")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges(a, b)``, root being the smallest node reachable.

    Large-star and small-star contractions alternate until nothing changes; each round is
    written down, so its lineage stays short and survives a lost executor.
    """
    edges = written(spark, edges.selectExpr("greatest(a, b) as hi", "least(a, b) as lo").distinct(), "stars")
    seen = _mark(edges)
    while True:
        both = edges.unionByName(edges.selectExpr("lo as hi", "hi as lo"))
        least = both.groupBy("hi").agg(F.least("hi", F.min("lo")).alias("least"))
        large = both.join(least, "hi").filter("lo > hi").selectExpr("lo as hi", "least as lo").distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("least"))
        small = large.join(least, "hi").filter("lo != least").selectExpr("lo as hi", "least as lo")
        edges = written(spark, small.unionByName(least.selectExpr("hi", "least as lo")).distinct(), "stars")
        now = _mark(edges)
        if now == seen:
            return edges.selectExpr("hi as node", "lo as root")
        seen = now


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def groups(
    spark: SparkSession, docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS, carried: tuple = ()
) -> DataFrame:
    """``doc_id, print, root, component_id`` and ``carried`` for every row of ``docs(doc_id, text)``.
    A root is one component; an id that is null or used again may name several."""
    prints = written(spark, fingerprints(docs, shingle, carried), "simhash")
    distinct = written(spark, prints.groupBy("print").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = components(spark, links(distinct, max_bits))
    rooted = distinct.join(roots, distinct["print"] == roots["node"], "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(ids, "root").select("print", "root", "component_id")
    return prints.join(named, "print")


def near_duplicates(
    spark: SparkSession, docs: DataFrame, *, shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs(doc_id, text)``."""
    return groups(spark, docs, shingle=shingle, max_bits=max_bits).select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )
