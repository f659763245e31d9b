"""Run detection, the prefix trie and line dedup against brute force, and on awkward inputs."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from starloom.llm import lines, queries, runs, trie

CLASHING = ("a",) * 6
EXTRA = "runs string, words string, h string, n string, lines string, hash string"


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- runs ---------------------------------------------------------------------------------


def plain_runs(words, least):
    """Every stretch of every period, by comparing words."""
    n, found = len(words), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            smaller = any(all(words[start + k] == words[start + k + d] for k in range(length - d)) for d in range(1, q))
            if i > start and length >= max(least, 2 * q) and not smaller:
                found.add((start, length, q))
            i += i == start
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for trial in range(400):
        n = rng.randrange(60)
        words = [bytes([97 + rng.randrange(1 + trial % 4)]) for _ in range(n)]
        if n and trial % 2:
            a, p = rng.randrange(n), rng.randrange(1, 9)
            words = [words[a + (i - a) % p] if i >= a and a + (i - a) % p < n else w for i, w in enumerate(words)]
        assert [tuple(r) for r in runs.find_runs(words, least).tolist()] == plain_runs(words, least)


def test_extensions_equal_comparisons():
    rng = random.Random(1)
    symbols = [rng.randrange(1, 3) for _ in range(80)] + [0]
    extend = runs.Extensions(*runs.euler_tour(runs.suffix_tree(symbols), len(symbols)))
    for a in range(len(symbols)):
        for b in range(a + 1, len(symbols)):
            same = 0
            while b + same < len(symbols) and symbols[a + same] == symbols[b + same]:
                same += 1
            assert extend(runs.np.array([a]), runs.np.array([b]))[0] == same


def planted(doc_id, text):
    """The words of the contract's text."""
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def runs_row(doc_id, text):
    words = planted(doc_id, text)
    found = plain_runs(words, 12)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped).decode()
    return doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(listed), sha(kept)


def test_run_query_equals_brute_force(spark, tmp_path):
    prose = " ".join(f"w{i * i % 31}" for i in range(70))
    texts = [(i, " ".join(f"v{(i * 7 + j * j) % 11}" for j in range(i % 50))) for i in range(120)]
    texts += [(200, None), (201, ""), (202, " \n\t"), (203, "x " * 3000), (204, prose + " é  " * 9), (204, prose), (204, prose), (None, "a b " * 20), (205, "y")]
    df = spark.createDataFrame([(*t, *CLASHING) for t in texts], f"doc_id long, text string, {EXTRA}")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_runs(spark, str(tmp_path))
    assert ordered(map(tuple, got.collect())) == ordered(runs_row(*t) for t in texts)
    assert runs.report(runs.scan(df.limit(0))).count() == 0


def test_long_texts_have_linear_cost():
    # Two million different words, and a hundred thousand equal ones.
    assert len(runs.find_runs([b"%d" % i for i in range(2_000_000)])) == 0
    assert runs.find_runs([b"a"] * 100_000).tolist() == [[0, 100_000, 1]]


# --- trie ---------------------------------------------------------------------------------


def plain_trie(strings):
    """Statistics of every prefix of ``{conv_id: [(symbol, words), ...]}``."""
    members, own = defaultdict(list), {}
    for c, turns in strings.items():
        for d in range(len(turns) + 1):
            prefix = tuple(s for s, _ in turns[:d])
            members[prefix].append(c)
            own[prefix] = turns[d - 1][1] if d else 0
    rows = []
    for prefix, ids in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) == len(p) + 1 for q in below)]
        ends = ",".join(str(c) for c in sorted(ids) if len(strings[c]) == len(prefix))
        saved = sum((len(members[p]) - 1) * own[p] for p in below)
        parent = min(members[prefix[:-1]]) if prefix else None
        rows.append((min(ids), len(prefix), parent, len(ids), len(children), len(leaves), saved, sha(ends)))
    return rows


def as_table(spark, strings):
    turns = [(c, [(hashlib.md5(str(s).encode()).digest(), w) for s, w in t]) for c, t in strings.items()]
    return spark.createDataFrame(turns, "conv_id long, turns array<struct<hash:binary,words:long>>")


@pytest.mark.parametrize("seed, batches", [(1, 1), (2, 3), (3, 4)])
def test_trie_equals_brute_force(spark, seed, batches):
    rng = random.Random(seed)
    strings = {c: [(rng.randrange(2), rng.randrange(5)) for _ in range(rng.randrange(9))] for c in rng.sample(range(500), 60)}
    # Equal turns have equal words.
    strings = {c: [(s, s + 2) for s, _ in t] for c, t in strings.items()}
    long = [(i % 3, 1) for i in range(130)]
    strings |= {600: [(s, s + 2) for s, _ in long], 601: [(s, s + 2) for s, _ in long[:70]], 602: [(s, s + 2) for s, _ in long[:90]] + [(7, 9)]}
    got = trie.prefix_trie(spark, as_table(spark, strings), batches)
    assert ordered(map(tuple, got.collect())) == ordered(plain_trie(strings))


def test_fat_binary_search_finds_the_deepest_known_node(spark):
    strings = {0: "aaaaaaab", 1: "aaaac", 2: "aab", 3: "b", 4: "aaaaaaabcd"}
    table = trie.hashed(as_table(spark, {c: [(x, 1) for x in s] for c, s in strings.items()}))
    built = trie.build(spark, table, 1)
    probe = {10: "aaaaaaabz", 11: "aaaacccc", 12: "aaq", 13: "q", 14: "aaaaaaabcd"}
    asked = trie.hashed(as_table(spark, {c: [(x, 1) for x in s] for c, s in probe.items()}))
    known = {r["key"]: r.known for r in trie.locate(built, asked, 4).collect()}
    # Never beyond the common prefix, and never above the deepest node on the way.
    assert known == {10: 8, 11: 5, 12: 2, 13: 0, 14: 10}


def test_members_are_digested_in_order(spark, monkeypatch):
    monkeypatch.setattr(trie, "IDS_A_ROW", 3)
    members = [(bytes([p]) * 16, i) for p in range(3) for i in random.Random(p).sample(range(-50, 1000), 40)]
    got = dict(trie.member_digests(spark.createDataFrame(members, "point binary, key long").repartition(5)).collect())
    want = {p: sha(",".join(str(i) for q, i in sorted(members, key=lambda m: m[1]) if q == p)) for p, _ in members}
    assert {bytes(k): v for k, v in got.items()} == want


def conversation_rows(spark):
    rows = [(c, t, "user" if t % 2 else "bot", f"turn {t} of {c % 2 if t < 3 else c}") for c in range(0, 60) for t in range(c % 7)]
    rows += [(61, None, None, None), (61, 1, "user", ""), (61, 1, "user", "tie"), (61, 1, "user", "tie"), (None, 1, "user", "nobody"), (100, 0, "user", "far " * 9000)]
    return [(*r, *CLASHING) for r in rows]


def test_trie_query_equals_its_sql_on_awkward_rows(spark, tmp_path):
    df = spark.createDataFrame(conversation_rows(spark), f"conv_id long, turn long, role string, text string, {EXTRA}")
    df.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op12_trie(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(queries.SQL["op12_trie"])
    assert got.columns == want.columns
    assert ordered(map(tuple, got.collect())) == ordered(want.fetchall())
    assert trie.prefix_trie(spark, trie.sequences(df.limit(0))).count() == 0


# --- lines --------------------------------------------------------------------------------


def line_rows():
    common, other = "This Line stands in Many documents and is Long enough", "another line that many documents hold, of forty"
    rows = [(i, f"{common}\nown line number {i} which is long but stands only here, once\nshort") for i in range(30)]
    rows += [(i, f"  {common.upper()}\t\n\n{other}\n{other}") for i in range(30, 38)]
    rows += [(40, None), (41, ""), (42, "\n\n"), (43, "x" * 100_000 + "\n" + other), (43, other), (43, other)]
    rows += [(None, f"{common}\n{other}"), (None, "four of these are one too few to be called common, surely")]
    rows += [(i, "four of these are one too few to be called common, surely\r") for i in (50, 51, 52, 52)]
    return [(*r, *CLASHING) for r in rows]


def plain_lines(rows):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(lines.BLANKS))
    holders = defaultdict(set)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(i)
    out = []
    for i, text, *_ in rows:
        every = (text or "").split("\n")
        top = lambda k: max((h for h in holders[k] if h is not None), default=None)
        kept = [x for x in every if len(key(x)) < 40 or len(holders[key(x)]) < 5 or top(key(x)) == i]
        out.append((i, len(every), len(every) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("batches, fanout", [(8, 4), (1, 4), (5, 2)])
def test_lines_equal_brute_force(spark, batches, fanout):
    rows = line_rows()
    df = spark.createDataFrame(rows, f"doc_id long, text string, {EXTRA}")
    got = lines.dedup(spark, df, batches=batches, fanout=fanout)
    assert ordered(map(tuple, got.collect())) == ordered(plain_lines(rows))
    assert any(r[2] for r in plain_lines(rows))
    assert lines.dedup(spark, df.limit(0), batches=batches).count() == 0


def test_runs_are_compacted_and_skip_what_is_settled(spark):
    held = lines.Runs(spark, min_docs=3, fanout=2)
    hash_of = lambda n: bytes([n]) * 16
    for low in (90, 60, 30, 0):
        batch = [(low + i, hash_of(1)) for i in range(9)] + [(low, hash_of(2)), (low + 1, hash_of(10 + low))]
        held.add(spark.createDataFrame(batch, "doc_id long, hash binary"))
    assert [len(level) for level in held.levels] == [0, 0, 1]
    rows = {r.hash[0]: (r.n_docs, r.holder) for r in held.runs[0][0].collect()}
    # The first batch settles hash 1: later ones don't count it again. Hash 2 is settled when runs are compacted.
    assert rows[1] == (9, 98) and rows[2][1] == 90 and rows[2][0] >= 3
    assert {r.hash[0]: r.holder for r in held.common().collect()} == {1: 98, 2: 90}


def test_batches_go_from_the_largest_ids_down(spark):
    docs = spark.range(0, 100).withColumnRenamed("id", "doc_id").unionByName(spark.createDataFrame([(None,)], "doc_id long"))
    spans = docs.withColumn("b", lines._batch_number(docs, 4)).groupBy("b").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).orderBy("b").collect()
    assert [r.b for r in spans] == [0, 1, 2, 3] and all(a.low > b.high for a, b in zip(spans, spans[1:]))
