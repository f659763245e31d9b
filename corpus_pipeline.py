"""A corpus pipeline: filter, deduplicate, redact, mix and tokenise ``documents``.

Each stage reads what its predecessor kept. All but the last return the columns of documents:

* ``quality`` drops the documents that the quality rules reject;
* ``near_duplicates`` keeps the document of smallest id of each group, and one copy of it;
* ``secrets`` keeps every document and replaces its secrets by ``[SECRET]``;
* ``mix`` keeps the documents that the mix takes, each as often as it takes them;
* ``tokens`` returns counts and digests of the ids and of their decoded bytes.

Rows are told apart by a hash of all their columns, so ids may be null or used again. Only equal rows
share a hash; they are judged alike, are near-duplicates, and are dealt their copies together. The
columns of a document travel as one struct, so extra ones may have any name. Null texts count as empty; empty
tables give empty tables. A text is limited by what a row may hold (2 GB).

The forest and the compiled BPE merges have no SQL form, so there is no ``ORACLE_SQL``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, mixing, quality, secrets, simhash
from starloom.llm.common import read_table, row_key, written

ORACLE_SQL = None


def held(docs: DataFrame, *columns: str) -> DataFrame:
    """``docs`` as one column ``row`` beside its hash ``row_key`` and what a stage reads, so no other column can clash."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), row_key(docs).alias("row_key"), *columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = held(docs, "doc_id", "text")
    judged = quality.judge(spark, rows, read_table(spark, sf_dir, "labels"), carried=("row_key",))
    kept = judged.filter("kept").select("row_key").distinct()
    return rows.join(kept, "row_key", "left_semi").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = held(docs, "doc_id", "text")
    groups = simhash.groups(spark, rows, carried=("row_key",))
    # Not by component_id: groups may share it where ids are null or used again.
    first = groups.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "row_key")).alias("first"))
    survivors = rows.join(first.select("first.row_key"), "row_key", "left_semi")
    return survivors.dropDuplicates(["row_key"]).select("row.*")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", "text")
    found = secrets.scan(rows, keep=["row"])
    hit = F.size("spans") > 0
    clean = found.withColumn("text", F.when(hit, secrets.masked()).otherwise(F.col("row.text")))
    changed = {"text": F.col("text"), "n_chars": F.when(hit, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))}
    return clean.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = held(docs, "text", "source")
    mixed = mixing.mix(spark, rows.select(F.col("row_key").alias("doc_id"), "text", "source"))
    sums = mixed.groupBy(F.col("doc_id").alias("row_key")).agg(F.min("copies").alias("low"), F.max("copies").alias("high"), F.sum("copies").alias("total"))
    taken = written(spark, sums.filter("high > 0"), "mix-taken")
    rows = rows.select("row", "row_key")
    copied = lambda met, n: met.withColumn("row_copy", F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))).select("row.*")
    result = copied(rows.join(taken.filter("low = high"), "row_key"), "high")
    # Equal rows at the edge of a source, one key a source at most: the copies of all go to one of them.
    edge = taken.filter("low < high")
    if not edge.isEmpty():
        result = result.unionByName(copied(rows.join(edge, "row_key").dropDuplicates(["row_key"]), "total"))
    return result


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.decode(spark, bpe.encode(spark, docs, ranks, public_tokenizers.PATTERN), ranks))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secrets_stage),
    ("mix", mixing_stage),
    ("tokens", tokens_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
