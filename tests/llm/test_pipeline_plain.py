"""The pipeline's rows, the forest and the fingerprints against plain versions in Python."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

import corpus_pipeline
from starloom.llm import bpe, quality, secret_rules, simhash

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def words_of(text):
    return re.findall(r"[^ \t-\r]+", text or "")


# --- quality --------------------------------------------------------------------------------


def plain_base_failed(text):
    words = words_of(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    found = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if found[w] > 1 for k in range(8)}
    return len(words) < 20 or 100 * len(repeated) > 30 * len(words)


def plain_path(tree, row):
    feature, value, left, path = tree
    node = 0
    while feature[node] >= 0:
        node = left[node] + (row[feature[node]] > value[node])
    return path[node]


def plain_quality(docs, labels):
    """Kept documents; no labelled id may be used twice."""
    features = {d: quality.statistics(d[1])[5:] for d in docs}
    passed = [d for d in docs if not plain_base_failed(d[1])]
    number = lambda i: int(np.uint64(xxhash.xxh64_intdigest(int(quality.SEED).to_bytes(4, "little"), xxhash.xxh64_intdigest(i.to_bytes(8, "little", signed=True), 42))).view(np.int64))
    marked = sorted((d for d in passed if labels.get(d[0]) in (0, 1)), key=lambda d: (number(d[0]), d[0]))
    rows = np.array([features[d] for d in marked], float)
    forest = quality.fit(rows)
    n = min(quality.ROWS_PER_TREE, len(rows))
    expected = 2 * sum(1 / k for k in range(1, n)) - 2 * (n - 1) / n
    assert quality._average_path(n) == pytest.approx(expected, rel=0.02)
    score = {d: 2 ** (-(sum(plain_path(t, features[d]) for t in forest) / len(forest)) / quality._average_path(n)) for d in passed}
    step = {d: math.floor(score[d] * quality.STEPS) for d in marked}
    size = Counter(labels[d[0]] for d in marked)
    best, threshold = 0, None
    for s in sorted(set(step.values()), reverse=True):
        out = Counter(labels[d[0]] for d in marked if step[d] >= s)
        if out[1] / size[1] > quality.MAX_FALSE:
            break
        if out[0] / size[0] - out[1] / size[1] > best:
            best = out[0] / size[0] - out[1] / size[1]
            threshold = (s + max((t for t in step.values() if t < s), default=0) + 1) / 2 / quality.STEPS
    return [d for d in passed if threshold is None or score[d] < threshold], threshold


def test_trees_split_as_an_isolation_forest_does():
    rng = np.random.default_rng(8)
    rows = np.column_stack([rng.integers(0, 5, 60), rng.normal(size=60), np.ones(60)]).astype(float)
    for seed in range(20):
        tree = quality.grow(rows, np.random.default_rng(seed))
        feature, value, left, path = tree
        todo, leaves = [(0, rows, 0)], 0
        while todo:
            node, own, depth = todo.pop()
            varied = [f for f in range(3) if len(set(own[:, f])) > 1]
            if feature[node] < 0:
                leaves += 1
                assert not varied or depth == math.ceil(math.log2(60))
                assert path[node] == pytest.approx(depth + quality._average_path(len(own)))
                continue
            f = feature[node]
            assert f in varied and own[:, f].min() <= value[node] <= own[:, f].max()
            below = own[:, f] <= value[node]
            todo += [(left[node], own[below], depth + 1), (left[node] + 1, own[~below], depth + 1)]
        assert leaves == (feature < 0).sum()
        got = quality.anomaly(rows, [tree], 60)
        assert got == pytest.approx([2 ** (-plain_path(tree, r) / quality._average_path(60)) for r in rows])


# --- near duplicates ------------------------------------------------------------------------


def plain_print(text):
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words_of(text)]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_fingerprint_bits_equal_a_count_of_each_bit():
    rng = np.random.default_rng(6)
    texts = [None, "", " \n", "A", "Ä B", "\x0bB\xa0c\td\r", "x " * 70_000]
    texts += [" ".join(rng.choice(["a", "B", "é", "東", "-"], rng.integers(1, 40))) for _ in range(60)]
    for text in texts:
        assert simhash.simhash(text) % (1 << 64) == plain_print(text), text


def plain_row_key(row):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    return hashlib.md5("".join(md5("" if v is None else f"={v}") for v in row).encode()).digest()


def plain_survivors(docs):
    docs = list(dict.fromkeys(docs))
    prints = [plain_print(d[1]) for d in docs]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = lambda d: (d[0] is None, d[0] or 0, plain_row_key(d))
    return [min((d for d, h in zip(docs, group) if h == g), key=first) for g in set(group)]


# --- secrets, mix, tokens ---------------------------------------------------------------------


def plain_masked(doc):
    text = doc[1] or ""
    merged = []
    for a, b in sorted(s for r in secret_rules.RULES for s in secret_rules.spans_of(r, text)):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    if not merged:
        return doc
    for a, b in reversed(merged):
        text = text[:a] + "[SECRET]" + text[b:]
    return (doc[0], text, doc[2], doc[3], len(text))


def plain_mix(docs):
    sources = sorted({d[3] for d in docs}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    size = {s: sum(len(words_of(d[1])) for d in docs if d[3] == s) for s in sources}
    # Shares by weight; sources above their cap are fixed at it, until none is above.
    capped = set()
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in capped)
        target = {s: 3 * size[s] if s in capped else left * weight[s] / sum(weight[t] for t in sources if t not in capped) for s in sources}
        above = {s for s in sources if s not in capped and target[s] > 3 * size[s]}
        if not above:
            break
        capped |= above
    taken = []
    for s in sources:
        own = []
        for d in docs:
            if d[3] == s:
                n, key = len(words_of(d[1])), plain_row_key(d)
                u = (int(hashlib.md5(key).hexdigest()[:13], 16) + 0.5) / 2**52
                symbols = sum(c in "#*$%&|<>" for c in d[1] or "")
                own.append((-math.log(u) * (1 + 4 * symbols / max(n, 1)), key, n, d))
        epochs = math.floor(target[s] / size[s]) if size[s] else 0
        budget, before = target[s] - epochs * size[s], 0
        for _, _, n, d in sorted(own):
            more = 0 <= budget < size[s] and before + n / 2 <= budget and epochs < 3
            taken += [d] * (epochs + more)
            before += n
    return taken


def plain_tokens(docs):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    rows = []
    for d in docs:
        ids = own.encode_ordinary(d[1] or "")
        rows.append((d[0], len(ids), sha(",".join(map(str, ids)).encode()), sha((d[1] or "").encode())))
    return rows


def some_documents():
    rng = np.random.default_rng(11)
    vocabulary = [f"w{i}é" if i % 9 == 0 else f"w{i}" for i in range(900)]
    prose = lambda n: " ".join(rng.choice(vocabulary, n))
    docs, labels = [], {}
    for i in range(90):
        text = prose(30 + 3 * i)
        if i % 6 == 1:
            text += f' token = "{hashlib.sha1(text.encode()).hexdigest()}" AKIA{"Q7" * 8} end'
        if i % 10 == 3:
            text += " #a |b"
        docs.append((i, text, "en", ("b", "a", None, "ü", "a", "c")[i % 6]))
        labels[i] = 1
    for i in range(90, 105):
        docs.append((i, prose(40 + i).replace(" ", "#$ ").upper(), None, "a"))
        labels[i] = 0
    # Rejected by the base rule: nothing, too short, repeating.
    docs += [(200, None, "en", "a"), (201, "", "en", "b"), (202, "too short", "en", "b"), (203, "one two three four " * 20, "en", "a")]
    # Copies under other ids, under none, under a used id; the same row again; near copies.
    docs += [(300 + i, docs[i][1], "de", docs[i][3]) for i in range(0, 30, 4)] + [(None, docs[i][1], "en", "c") for i in (2, 40)]
    docs += [(None, prose(50), "en", "c"), (None, prose(60), "en", "b"), (300, prose(45), "en", "ü"), (301, prose(70), None, None)]
    docs += [docs[5], docs[5], docs[-3]] + [(400 + i, docs[i][1] + " more", "en", "a") for i in range(60, 90, 5)]
    return [(*d, None if d[1] is None else len(d[1])) for d in docs], labels


def test_the_pipeline_equals_its_plain_version(spark, tmp_path):
    docs, labels = some_documents()
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in labels.items()], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept, threshold = plain_quality(docs, labels)
    survivors = plain_survivors(kept)
    clean = [plain_masked(d) for d in survivors]
    mixed = plain_mix(clean)
    # Every stage has work to do, and near copies are among it.
    assert threshold and {d[0] for d in docs[90:105]} - {d[0] for d in kept} and len(survivors) < len(set(kept)) - 5
    assert clean != survivors and len(mixed) > len(set(mixed)) and set(clean) - set(mixed)
    got = [tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert Counter(got) == Counter(plain_tokens(mixed))
