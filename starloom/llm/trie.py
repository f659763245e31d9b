"""Conversation prefix trie, kept as a z-fast trie over the turns of conversations.

A conversation is a string whose symbols are its turns. Each prefix is known by a 128-bit chained hash.
The compacted trie is held as paths: every distinct conversation owns the points (prefixes) that it
was the first to reach, and cuts them at the depths of compacted nodes (where the trie branches or a
conversation ends). A compacted node between the depths a and b is filed under the hash of its handle,
the point at the two-fattest number of (a, b]: the one divisible by the greatest power of two.

Conversations are inserted in batches that grow. Fat binary search locates where each leaves the trie:
a probe at the two-fattest depth that is still possible, an equality join with the handles per round,
as many rounds as the longest conversation has binary digits. Only the points below go on: they
shrink to one row per point, with the first and last next point in it, and meet the trie's points. New points are
given to the smallest conversation that reaches them; old ones at which a conversation leaves or ends
become cuts of their owner. At the end the edges are expanded to one row per point.

A null role or text counts as empty, a null turn comes first; turns of equal number come by their hash.
Turns without ``conv_id`` belong to no conversation and are left out. Repeated rows are turns of their
own. An empty table gives no nodes; other columns are ignored. Turns travel as hashes, never as texts;
one conversation's hashes (16 bytes a turn) have to fit a row, and so nothing else does: members of a
node are digested as a sorted stream.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import WORD, arrow_schema, map_batches, written

ROOT = bytes(16)
ROOT_POINT = f"unhex('{ROOT.hex()}')"
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()
BATCHES = 4
# Ids whose texts travel as one row to where a node's members are digested.
IDS_A_ROW = 4096
# The stretches between a path's cuts.
EDGES = "zip_with(concat(array(base), slice(cuts, 1, size(cuts) - 1)), cuts, (a, b) -> struct(a as low, b as high))"
# The two-fattest number of (low, high].
FATTEST = "(high & shiftleft(-1, length(bin(low ^ high)) - 1))"


def turn_hash(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.md5(F.coalesce(role, F.lit(""))), F.md5(F.coalesce(text, F.lit(""))))))


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns`` (in order, as ``struct(hash, words)``) of ``conversations(conv_id, turn, role, text)``."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    turn = F.struct("turn", turn_hash(F.col("role"), F.col("text")).alias("hash"), words.alias("words"))
    rows = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return ordered.select("conv_id", F.expr("transform(turns, t -> struct(t.hash as hash, t.words as words))").alias("turns"))


def hashed(strings: DataFrame) -> DataFrame:
    """``key, path`` (the points from the root on) and ``words`` of the turns of ``strings(conv_id, turns)``."""

    def columns(batch):
        paths, words = [], []
        for turns in batch["turns"].to_pylist():
            point, path = ROOT, [ROOT]
            for turn in turns:
                point = hashlib.blake2b(point + turn["hash"], digest_size=16).digest()
                path.append(point)
            paths.append(path)
            words.append([turn["words"] for turn in turns])
        return [batch["conv_id"], paths, words]

    return map_batches(strings.select("conv_id", "turns"), "key long, path array<binary>, words array<long>", columns)


# --- the trie: rows of key, path, words, base, cuts ----------------------------------------


def nodes(trie: DataFrame) -> DataFrame:
    """``key, low, high, handle, point, parent`` of the compacted nodes but the root: those between two cuts of a path."""
    edges = trie.selectExpr("key", "path", f"{EDGES} as edges")
    made = f"struct(e.low as low, e.high as high, get(path, {FATTEST.replace('low', 'e.low').replace('high', 'e.high')}) as handle, get(path, e.high) as point, get(path, e.low) as parent)"
    return edges.selectExpr("key", f"inline(transform(edges, e -> {made}))")


def points(trie: DataFrame) -> DataFrame:
    """``point, owner, depth, next, is_node`` of every point but the root; ``next`` is the owner's."""
    made = "struct(get(path, d) as point, d as depth, get(path, d + 1) as next, get(cut, d - base - 1) as is_node)"
    # Cuts as one flag per point of the path.
    flags = trie.selectExpr("key", "path", "base", f"flatten(transform({EDGES}, e -> concat(array_repeat(false, e.high - e.low - 1), array(true)))) as cut")
    return flags.selectExpr("key as owner", f"inline(transform(sequence(base + 1, base + size(cut)), d -> {made}))")


def locate(trie: DataFrame, strings: DataFrame, rounds: int) -> DataFrame:
    """``strings(key, path)`` with ``known``, the depth up to which fat binary search finds them in the trie."""
    handles = nodes(trie).selectExpr("handle", "high as n_high", "point as n_point")
    rows = strings.selectExpr("key", "path", "0 as low", "size(path) - 1 as high", "0 as known")
    for _ in range(rounds):
        # A search that has ended asks for a handle that no node has, each for its own.
        probing = rows.withColumn("fat", F.expr(f"if(low < high, {FATTEST}, 0)"))
        probing = probing.withColumn("probe", F.expr("if(low < high, get(path, fat), unhex(md5(string(key))))"))
        found = probing.join(handles.hint("merge"), F.expr("probe = handle"), "left")
        # The whole edge matches and the search goes on below it; or it leaves within the edge and ends; or nothing is there.
        whole, hit = "coalesce(get(path, n_high) = n_point, false)", "handle is not null"
        rows = found.selectExpr(
            "key", "path",
            f"case when {whole} then n_high when {hit} then high else low end as low",
            f"if(low < high and not ({hit}), fat - 1, high) as high",
            f"case when {whole} then n_high when {hit} then fat else known end as known",
        )
    return rows.select("key", "path", "known")


def insert(spark: SparkSession, trie: DataFrame, strings: DataFrame, rounds: int) -> DataFrame:
    """The trie with ``strings(key, path, words)``, distinct and not yet in it."""
    located = locate(trie, strings, rounds)
    below = located.selectExpr("key", "inline(transform(sequence(known, size(path) - 1), d -> struct(d as depth, get(path, d) as point, get(path, d + 1) as next)))")
    reached = below.groupBy("point").agg(
        F.min("key").alias("key"), F.first("depth").alias("depth"), F.min("next").alias("first"), F.max("next").alias("last"), F.max(F.isnull("next")).alias("ends")
    )
    held = points(trie).selectExpr("point", "owner", "depth as held_depth", "next", "is_node")
    met = reached.filter(f"point != {ROOT_POINT}").join(held, "point", "left")
    met = written(spark, met, "trie-met")
    leaves = "ends or first != last"
    cuts = met.filter(f"owner is not null and not is_node and (coalesce({leaves}, false) or first != next)").groupBy("owner").agg(F.collect_set("held_depth").alias("more"))
    grown = trie.join(cuts, trie["key"] == cuts["owner"], "left").select("key", "path", "words", "base", F.expr("if(more is null, cuts, array_sort(concat(cuts, more)))").alias("cuts"))
    new = met.filter("owner is null").groupBy("key").agg((F.min("depth") - 1).alias("base"), F.array_sort(F.collect_set(F.expr(f"if({leaves}, depth, null)"))).alias("cuts"))
    paths = strings.join(new, "key").select("key", "path", "words", "base", "cuts")
    return written(spark, grown.unionByName(paths), "trie")


def build(spark: SparkSession, strings: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The trie of distinct ``strings(key, path, words)``, inserted in batches of which each is as large as all before."""
    longest = strings.agg(F.max(F.size("path") - 1)).first()[0] or 0
    trie = strings.filter("false").selectExpr("key", "path", "words", "0 as base", "array(0) as cuts")
    slot = F.pmod(F.xxhash64("key"), F.lit(1 << (batches - 1)))
    for number in range(batches):
        low, high = (1 << number) >> 1, 1 << number
        trie = insert(spark, trie, strings.filter((slot >= low) & (slot < high)), longest.bit_length() if number else 0)
    return trie


# --- statistics ---------------------------------------------------------------------------


def member_digests(members: DataFrame) -> DataFrame:
    """``point, ends_sha256`` of ``members(point, key)``: SHA-256 of the ascending ids, joined by commas.

    A digest of a list has to see it in order. Ids travel packed, and a task streams them, so the members of one
    node need no memory.
    """
    packed = members.groupBy("point", F.floor(F.col("key") / IDS_A_ROW).alias("part")).agg(F.array_sort(F.collect_list("key")).alias("ids"))
    lists = packed.select("point", "part", F.expr("array_join(ids, ',')").alias("ids"))
    schema = arrow_schema("point binary, ends_sha256 string")

    def digests(batches):
        point, state = None, None
        for batch in batches:
            done = []
            for p, ids in zip(batch["point"].to_pylist(), batch["ids"].to_pylist()):
                if p != point:
                    if point is not None:
                        done.append((point, state.hexdigest()))
                    point, state = p, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*done) if done else ([], []), schema)], schema=schema)
        if point is not None:
            yield pa.RecordBatch.from_arrays([pa.array([point], pa.binary()), pa.array([state.hexdigest()], pa.string())], schema=schema)

    ordered = lists.repartition("point").sortWithinPartitions("point", "part").select("point", "ids")
    return ordered.mapInArrow(digests, "point binary, ends_sha256 string")


EDGE = "array_sort(collect_list(struct(high, low, n_convs, conv_id, n_children, ends_sha256, parent_id{more}))) as edges"


def _below(batch) -> list[list]:
    """Saved tokens and leaves that a path gives to each point at or above its edges."""
    found, saved, leaves = [], [], []
    for path, words, base, edges in zip(*(batch[c].to_pylist() for c in ("path", "words", "base", "edges"))):
        total, n_leaves = 0, 0
        for edge in reversed(edges):
            total += (edge["n_convs"] - 1) * sum(words[edge["low"] : edge["high"]])
            n_leaves += edge["n_children"] == 0
            if edge["low"] > base:
                found.append(path[edge["low"]])
                saved.append(total)
                leaves.append(n_leaves)
        found += path[: base + 1]
        saved += [total] * (base + 1)
        leaves += [n_leaves] * (base + 1)
    return [found, saved, leaves]


def _expanded(batch) -> list[list]:
    """One row per point of every edge, from its node upwards."""
    rows = []
    for words, edges in zip(batch["words"].to_pylist(), batch["edges"].to_pylist()):
        for e in edges:
            saved, children, digest = e["saved"] or 0, e["n_children"], e["ends_sha256"] or EMPTY_DIGEST
            for depth in range(e["high"], e["low"], -1):
                saved += (e["n_convs"] - 1) * words[depth - 1]
                parent = e["parent_id"] if depth == e["low"] + 1 else e["conv_id"]
                rows.append((e["conv_id"], depth, parent, e["n_convs"], children, e["leaves"] or 1, saved, digest))
                children, digest = 1, EMPTY_DIGEST
    return [list(column) for column in zip(*rows)] if rows else [[] for _ in range(8)]


def prefix_trie(spark: SparkSession, turns: DataFrame, batches: int = BATCHES) -> DataFrame:
    """One row per distinct prefix of the sequences ``turns(conv_id, turns)``, the empty one included: ``conv_id``
    (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    strings = written(spark, hashed(turns), "trie-strings")
    ends = strings.select("key", F.element_at("path", -1).alias("point"))
    # Copies end at one point: the smallest stands for all.
    copies = written(spark, ends.groupBy("point").agg(F.min("key").alias("key"), F.count("*").alias("n")), "trie-copies")
    several = member_digests(ends.join(copies.filter("n > 1").select("point"), "point"))
    one = copies.filter("n = 1").select("point", F.sha2(F.col("key").cast("string"), 256).alias("ends_sha256"))
    digests = one.unionByName(several)
    distinct = written(spark, strings.join(copies.select("key", "n"), "key"), "trie-distinct")
    trie = build(spark, distinct.drop("n"), batches)

    reached = distinct.select("key", "n", F.explode("path").alias("point")).groupBy("point").agg(F.sum("n").alias("n_convs"), F.min("key").alias("conv_id"))
    reached = written(spark, reached, "trie-reached")
    edges = nodes(trie).select("key", "low", "high", "point", "parent")
    children = edges.groupBy(F.col("parent").alias("point")).agg(F.count("*").alias("n_children"))
    known = edges.join(reached, "point").join(children, "point", "left").join(digests, "point", "left")
    known = known.join(reached.select(F.col("point").alias("parent"), F.col("conv_id").alias("parent_id")), "parent")
    known = written(spark, known.fillna(0, ["n_children"]), "trie-nodes")

    owned = lambda rows, more="": trie.join(rows.groupBy("key").agg(F.expr(EDGE.format(more=more))), "key")
    given = map_batches(owned(known).select("path", "words", "base", "edges"), "point binary, saved long, leaves long", _below)
    below = written(spark, given.groupBy("point").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")), "trie-below")
    ddl = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    full = owned(known.join(below, "point", "left"), ", saved, leaves").select("words", "edges")
    at_root = F.expr(f"point = {ROOT_POINT}")
    root = reached.filter(at_root).join(children, "point", "left").join(below, "point", "left").join(digests, "point", "left")
    root = root.selectExpr(
        "conv_id", "0L as depth", "cast(null as long) as parent_conv_id", "n_convs", "coalesce(n_children, 0L) as n_children",
        "coalesce(leaves, 1L) as n_leaves", "coalesce(saved, 0L) as saved_tokens", f"coalesce(ends_sha256, '{EMPTY_DIGEST}') as ends_sha256",
    )
    return map_batches(full, ddl, _expanded).unionByName(root)
