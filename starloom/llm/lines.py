"""Line deduplication by levelled sorted runs of line hashes, in DataFrame operations alone.

A line's key is the line without ASCII white space at both ends and with A-Z lower-cased. Keys of at
least ``min_chars`` code points that stand in at least ``min_docs`` documents lose all their lines,
except in the largest ``doc_id`` that holds them.

Batches of documents come from the largest ids to the smallest. A batch shrinks to one row per hash
(how many documents, which is the largest), in the order of the hash. It is merge-anti-joined with the
runs so far: a hash that a run has settled (``min_docs`` documents counted, holder known) is not
recorded again, so common lines are met once. What remains is added as a run of level 0. ``fanout`` runs of a
level are compacted to one of the next level, which adds up their counts and settles more hashes.
Runs are bucketed and sorted by hash on shared storage, so a join with them moves the batch alone.

A document is its ``doc_id``: rows of one id count once, and null is one document, smaller than any
other. A null text is one empty line. Repeated rows come back as often as they came, other columns are
ignored, an empty table gives no rows. Hashes have 128 bits. A line in most documents is one row of a
batch after partial aggregation; where lines meet the common hashes, Spark splits that partition.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import written
from starloom.session import work_folder

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 8
FANOUT = 4
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def _body() -> Column:
    """Rows of equal id and text are treated alike, so this and the id name a row."""
    return F.unhex(F.md5(_text()))


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, body, line_no, hash`` of the lines whose key is long enough."""
    lines = docs.select("doc_id", _body().alias("body"), F.posexplode(F.split(_text(), "\n")).alias("line_no", "line"))
    long = lines.filter(F.char_length("line") >= min_chars).select("doc_id", "body", "line_no", line_key(F.col("line")).alias("key"))
    return long.filter(F.char_length("key") >= min_chars).select("doc_id", "body", "line_no", F.unhex(F.md5("key")).alias("hash"))


class Runs:
    """Levels of sorted runs ``hash, n_docs, holder``, one row per hash in each run."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # Per level, the run as a bucketed table and the folder of its files.
        self.levels: list[list[tuple[DataFrame, str]]] = []

    @property
    def runs(self) -> list[tuple[DataFrame, str]]:
        return [run for level in self.levels for run in level]

    def _stored(self, rows: DataFrame) -> tuple[DataFrame, str]:
        """``rows`` as a bucketed, sorted table; its name leaves the catalogue at once, its files stay."""
        name, folder = f"line_run_{uuid.uuid4().hex}", work_folder(self.spark, "line-run")
        writer = rows.repartition(self.buckets, "hash").write.bucketBy(self.buckets, "hash").sortBy("hash")
        writer.option("path", folder).saveAsTable(name)
        table = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return table, folder

    def add(self, batch: DataFrame) -> None:
        """Record the hashes of ``batch(doc_id, hash)``, whose ids are smaller than any before."""
        in_doc = batch.select("hash", "doc_id").distinct()
        fresh = in_doc.groupBy("hash").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("holder"))
        for run, _ in self.runs:
            settled = run.filter(F.col("n_docs") >= self.min_docs).select("hash")
            fresh = fresh.join(settled.hint("merge"), "hash", "left_anti")
        self._put(self._stored(fresh), 0)

    def _put(self, run: tuple[DataFrame, str], level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = self._stored(self._merged(self.levels[level]))
            self.levels[level] = []
            self._put(merged, level + 1)

    def _merged(self, runs: list[tuple[DataFrame, str]]) -> DataFrame:
        # As plain files: Spark 4.1 takes a union of bucketed tables for bucketed, but lays their scans one after the other.
        rows = self.spark.read.schema(runs[0][0].schema).parquet(*[folder for _, folder in runs])
        return rows.groupBy("hash").agg(F.sum("n_docs").alias("n_docs"), F.max("holder").alias("holder"))

    def common(self) -> DataFrame:
        """``hash, holder`` of the hashes in at least ``min_docs`` documents."""
        return self._merged(self.runs).filter(F.col("n_docs") >= self.min_docs).select("hash", "holder")


def _batch_number(docs: DataFrame, batches: int) -> Column:
    """0 for the largest ids; ranges of about as many documents each, and null in the last."""
    shares = [i / batches for i in range(1, batches)]
    borders = sorted(set(docs.agg(F.percentile_approx("doc_id", shares)).first()[0] or [])) if shares else []
    above = [F.when(F.col("doc_id") <= border, 1).otherwise(0) for border in borders]
    return F.when(F.col("doc_id").isNull(), len(borders)).otherwise(sum(above, F.lit(0)))


def common_lines(
    spark: SparkSession, lines: DataFrame, docs: DataFrame, *, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT
) -> DataFrame:
    """``hash, holder`` of the common ones among ``hashed_lines(docs)``."""
    numbered = written(spark, lines.select("doc_id", "hash", _batch_number(docs, batches).alias("batch")), "lines", "batch")
    runs = Runs(spark, min_docs, fanout)
    for number in range(batches):
        runs.add(numbered.filter(F.col("batch") == number))
    return written(spark, runs.common(), "common-lines")


def dedup(
    spark: SparkSession,
    docs: DataFrame,
    *,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` for every row of ``docs(doc_id, text)``."""
    lines = written(spark, hashed_lines(docs, min_chars), "hashed-lines")
    common = common_lines(spark, lines, docs, min_docs=min_docs, batches=batches, fanout=fanout)
    elsewhere = lines.join(common, "hash").filter(~F.col("doc_id").eqNullSafe(F.col("holder")))
    drops = elsewhere.groupBy(F.col("doc_id").alias("d_id"), F.col("body").alias("d_body")).agg(F.collect_set("line_no").alias("drops"))
    # The lines are an input of the join, not an expression after it: the lookups below don't split again.
    split = docs.select("doc_id", _body().alias("body"), F.split(_text(), "\n").alias("lines"))
    met = split.join(drops, F.expr("doc_id <=> d_id and body = d_body"), "left")
    kept = F.expr("transform(array_except(sequence(0, size(lines) - 1), drops), i -> get(lines, i))")
    return met.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(F.when(F.col("drops").isNull(), F.col("lines")).otherwise(kept), "\n").alias("text"),
    )
