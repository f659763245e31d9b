"""The operators as queries over whole test tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import ann, bpe, langid, licences, lines, mixing, pii, quality, runs, secrets, simhash, trie, warc
from starloom.llm.common import WORD, read_table
from starloom.llm.sql import SQL as SQL  # noqa: PLC0414 -- offered beside QUERIES

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ids = bpe.encode(spark, read_table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(spark, ids, RANKS))


def op2_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(secrets.scan(read_table(spark, folder, "documents")))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    # The table has no capture times; a page's number stands for the second of its capture, modulo some 30 years.
    at = F.lit(warc.EPOCH) + F.pmod(F.coalesce(F.col("page_id"), F.lit(0)), F.lit(10**9))
    archives = warc.write_archives(spark, read_table(spark, folder, "pages"), at)
    return warc.capture_history(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key")


def op4_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(spark, read_table(spark, folder, "embeddings"))


def op5_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(read_table(spark, folder, "documents"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(spark, read_table(spark, folder, "documents"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(pii.scan(read_table(spark, folder, "documents")))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(spark, read_table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(spark, read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
    return judged.drop(*quality.FEATURES)


def op10_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return langid.predict(spark, docs, langid.fit(docs))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by a checksum of their ids, turn periodic somewhere; see the contract of op11."""
    planted = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    planted = planted.withColumn("words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"))))
    planted = planted.selectExpr("doc_id", "text", "words", "h div 10 as g", "size(words) as n")
    planted = planted.selectExpr("doc_id", "text", "words", "g", "n", "if(n > 0, cast(g % n as int), 0) as a")
    planted = planted.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    period = "flatten(array_repeat(slice(words, a + 1, p), cast(3 + g % 8 as int)))"
    text = f"array_join(concat(slice(words, 1, a), slice({period}, 1, n - a)), ' ')"
    return planted.select("doc_id", F.expr(f"if(n > 0, {text}, text)").alias("text"))


def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.report(runs.scan(with_planted_runs(read_table(spark, folder, "documents"))))


def with_shared_starts(turns: DataFrame) -> DataFrame:
    """Conversations in blocks of 20 begin with turns of the block's first; see the contract of op12."""
    heads = turns.select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, 3).alias("head"))
    own = turns.withColumn("h", F.expr("cast(crc32(string(conv_id)) % 4 as int)"))
    met = own.join(heads, F.expr("conv_id - conv_id % 20 = head_id"), "left")
    return met.selectExpr("conv_id", "concat(if(head is null, slice(turns, 1, 0), slice(head, 1, h)), slice(turns, h + 1, size(turns))) as turns")


def op12_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(spark, with_shared_starts(trie.sequences(read_table(spark, folder, "conversations"))))


def op13_lines(spark: SparkSession, folder: str) -> DataFrame:
    kept = lines.dedup(spark, read_table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_secrets": op2_secrets,
    "op3_warc": op3_warc,
    "op4_nearest": op4_nearest,
    "op5_licences": op5_licences,
    "op6_simhash": op6_simhash,
    "op7_pii": op7_pii,
    "op8_mixing": op8_mixing,
    "op9_quality": op9_quality,
    "op10_langid": op10_langid,
    "op11_runs": op11_runs,
    "op12_trie": op12_trie,
    "op13_lines": op13_lines,
}
