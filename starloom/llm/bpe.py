"""Byte-level BPE: each distinct word of the corpus is encoded once and joined back by position.

1. Blocks of documents are cut into words. A block keeps its distinct words once and, for every
   position, the number of the word there. The blocks are written down.
2. The distinct words of all blocks are shuffled by their hash. Where equal words of all blocks
   meet, the word is merged into tokens once; each block gets the ids of its words back.
3. Ids and positions meet again by block, and each document's ids are laid out by position.

A word travels once per block, however often it occurs there, so a frequent word weighs no more
than a rare one. Memory is bounded by ``BLOCK_CHARS`` of text per block (or one document) and
``BUCKET_WORDS`` words per word bucket; the number of buckets follows the data.

Decoding joins ids with the token-byte table, which has one row per id. It is broadcast: its size is that of
the tokenizer's file, ``MAX_FILE_BYTES`` at most, whatever the corpus. As ids are row numbers of the table, the
join takes rows by number, for ``DECODED_IDS`` ids (or one longer document) at a time; an id without a
row is an error.

A null text counts as empty: no ids, no bytes. Repeated rows are encoded each for itself;
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import heapq
import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import arrow_schema, map_batches, pack, pack_texts, ragged, unpack, unpack_texts, written

BLOCK_CHARS = 32_000_000
BUCKET_WORDS = 100_000
DECODED_IDS = 1_000_000
MAX_FILE_BYTES = 64_000_000

BLOCKS = "block long, ids array<long>, lengths array<int>, n_words long, words binary, slots binary"
SENT = "bucket int, block long, slots binary, words binary"
ENCODED = "block long, slots binary, lengths binary, tokens binary"
RESULT = "doc_id long, ids array<int>"
RESULT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file of base64 tokens and ids."""
    if os.path.getsize(path) > MAX_FILE_BYTES:
        raise ValueError(f"{path} is too large for a table that every task holds")
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the pair of lowest rank, leftmost first, until no pair has a rank.

    ``end[i]`` is where the part that starts at ``i`` ends (0: merged away). Pairs wait in a
    heap, so a word of n bytes takes n log n steps; outdated pairs are skipped.
    """
    if word in ranks:
        return [ranks[word]]
    size = len(word)
    end, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = [(r, i, i + 2) for i in range(size - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, first, stop = heapq.heappop(heap)
        second = end[first]
        if not second or second >= size or end[second] != stop:
            continue
        end[first], end[second] = stop, 0
        if stop < size:
            before[stop] = first
            if (r := ranks.get(word[first : end[stop]])) is not None:
                heapq.heappush(heap, (r, first, end[stop]))
        left = before[first]
        if left >= 0 and (r := ranks.get(word[left:stop])) is not None:
            heapq.heappush(heap, (r, left, stop))
    tokens, at = [], 0
    while at < size:
        tokens.append(ranks[word[at : end[at]]])
        at = end[at]
    return tokens


class _Numbers(dict):
    """Numbers new keys in the order of their first use."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class _Block:
    def __init__(self):
        self.numbers, self.ids, self.slots, self.chars = _Numbers(), [], [], 0

    def add(self, doc_id, words: list[str], chars: int) -> None:
        self.ids.append(doc_id)
        self.slots.append(np.fromiter(map(self.numbers.__getitem__, words), np.uint32, len(words)))
        self.chars += chars

    def row(self, block: int) -> list:
        """Words are renumbered by falling frequency, so that most positions hold small numbers."""
        words, lengths, slots = list(self.numbers), [len(s) for s in self.slots], np.concatenate(self.slots)
        self.numbers, self.slots = None, None
        order = np.argsort(-np.bincount(slots, minlength=len(words)), kind="stable")
        number = np.empty(len(words), np.uint32)
        number[order] = np.arange(len(words), dtype=np.uint32)
        packed = pack_texts([words[i].encode() for i in order.tolist()])
        return [block, self.ids, lengths, len(words), packed, pack(number[slots])]


def cut_blocks(docs: DataFrame, pattern: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per block: its documents, its distinct words, and the word number at each position."""
    schema = arrow_schema(BLOCKS)

    def run(batches):
        cut, block, made = regex.compile(pattern).findall, _Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                text = text.as_py() or ""
                block.add(doc_id.as_py(), cut(text), len(text))
                if block.chars >= block_chars:
                    yield _one_row(block.row(made), schema)
                    block, made = _Block(), made + 1
        if block.ids:
            yield _one_row(block.row(made), schema)

    return docs.select("doc_id", "text").mapInArrow(run, BLOCKS)


def _one_row(values: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def encode_words(blocks: DataFrame, ranks, buckets: int) -> DataFrame:
    """The ids of every block's words, each distinct word of the corpus merged once.
    ``ranks`` is a broadcast variable."""

    def deal(batch):
        rows = [[], [], [], []]
        for block, blob in zip(batch["block"].to_pylist(), batch["words"]):
            words, parts = unpack_texts(blob.as_py()), defaultdict(list)
            for slot, word in enumerate(words):
                parts[zlib.crc32(word) % buckets].append(slot)
            for bucket, slots in parts.items():
                row = bucket, block, pack(np.diff(np.array(slots, np.uint32), prepend=0)), pack_texts([words[s] for s in slots])
                for column, v in zip(rows, row):
                    column.append(v)
        return rows

    schema = arrow_schema(ENCODED)

    def merge(table: pa.Table) -> pa.Table:
        merges, done, lengths, tokens = ranks.value, {}, [], []
        for blob in table["words"]:
            ids = []
            for word in unpack_texts(blob.as_py()):
                if (known := done.get(word)) is None:
                    known = done[word] = encode_word(word, merges)
                ids.append(known)
            lengths.append(pack(np.fromiter(map(len, ids), np.uint32, len(ids))))
            tokens.append(pack(np.array([t for known in ids for t in known], np.uint32)))
        return pa.table([table["block"], table["slots"], pa.array(lengths, pa.binary()), pa.array(tokens, pa.binary())], schema)

    sent = map_batches(blocks.select("block", "words"), SENT, deal)
    return sent.groupBy("bucket").applyInArrow(merge, ENCODED)


def _lay_out(block: pa.Table, words: pa.Table) -> pa.Table:
    """The ids of a block's documents: the words' ids, taken by position."""
    n_words = block["n_words"][0].as_py()
    lengths, chunks, at = np.zeros(n_words, np.int64), [], 0
    starts = np.zeros(n_words, np.int64)
    for slots, sizes, tokens in zip(words["slots"], words["lengths"], words["tokens"]):
        own, sizes = np.cumsum(unpack(slots.as_py()), dtype=np.int64), unpack(sizes.as_py()).astype(np.int64)
        lengths[own], starts[own] = sizes, at + np.cumsum(sizes) - sizes
        chunks.append(unpack(tokens.as_py()))
        at += len(chunks[-1])
    tokens = np.concatenate([np.zeros(0, np.uint32), *chunks]).astype(np.int32)
    slots, start, ends = unpack(block["slots"][0].as_py()), 0, [0]
    for n in block["lengths"][0].as_py():
        ends.append(ends[-1] + int(lengths[slots[start : start + n]].sum()))
        start += n
    ids, start = np.empty(ends[-1], np.int32), 0
    for n, first, last in zip(block["lengths"][0].as_py(), ends, ends[1:]):
        own = slots[start : start + n]
        ids[first:last] = tokens[ragged(starts[own], lengths[own])]
        start += n
    rows = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)).cast(RESULT_SCHEMA[1].type)
    return pa.table([block["ids"][0].values, rows], RESULT_SCHEMA)


def encode(
    spark: SparkSession,
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    *,
    block_chars: int = BLOCK_CHARS,
    bucket_words: int = BUCKET_WORDS,
) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs(doc_id, text)``."""
    ranks = spark.sparkContext.broadcast(load_ranks(ranks_path))
    blocks = written(spark, cut_blocks(docs, pattern, block_chars), "bpe-blocks")
    total = blocks.agg(F.sum("n_words")).first()[0] or 0
    words = encode_words(blocks, ranks, max(1, -(-total // bucket_words)))
    held = blocks.select("block", "ids", "lengths", "n_words", "slots")
    return held.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(_lay_out, RESULT)


def token_bytes(path: str) -> pa.Array:
    """The token-byte table: row i is the token of id i, null where there is none."""
    tokens = {rank: token for token, rank in load_ranks(path).items()}
    return pa.array([tokens.get(i) for i in range(max(tokens, default=-1) + 1)], pa.large_binary())


def joined_bytes(ids: pa.ListArray, table: pa.Array) -> pa.Array:
    """The bytes of each list's ids."""
    found = table.take(ids.flatten())
    if found.null_count:
        raise ValueError("an id without a token")
    # The tokens lie one after the other, so a list's bytes are a slice of them.
    _, starts, data = found.buffers()
    starts = np.frombuffer(starts, np.int64, len(found) + 1) if len(found) else np.zeros(1, np.int64)
    ends = np.cumsum([0, *ids.value_lengths().to_pylist()])
    cuts = pa.py_buffer(starts[ends])
    return pa.Array.from_buffers(pa.large_binary(), len(ids), [None, cuts, data or pa.py_buffer(b"")]).cast(pa.binary())


def decode(spark: SparkSession, encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, ids, decoded``: the bytes of each row's ids."""
    table = spark.sparkContext.broadcast(token_bytes(ranks_path))

    schema = arrow_schema(f"{RESULT}, decoded binary")

    def run(batches):
        for batch in batches:
            ends, at = np.cumsum(batch["ids"].value_lengths().to_numpy(zero_copy_only=False)), 0
            while at < len(batch):
                before = ends[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(ends, before + DECODED_IDS, "right")))
                doc_id, ids = batch.slice(at, stop - at).columns
                yield pa.RecordBatch.from_arrays([doc_id, ids.cast(schema[1].type), joined_bytes(ids, table.value)], schema=schema)
                at = stop

    return encoded.select("doc_id", "ids").mapInArrow(run, f"{RESULT}, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """Token counts, and hashes of the ids and of the decoded bytes."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
