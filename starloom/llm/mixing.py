"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations alone.

Every document draws an exponential key, ``-ln(u) / quality``; sorted by it, the documents of a
source come in a weighted random order without replacement. A source's target in words is first
filled by complete epochs; the rest by the documents of smallest keys up to the word budget.

The order of a whole source is never formed. Words are summed by ranges of the key's logarithm,
between the least and the greatest of the source; prefix sums of these find the range in which the
budget ends, which is cut again until it holds few documents or one key, and only these are sorted.
So a source may hold most rows and still no task holds many, unless they share one key.

``u`` is a hash of ``doc_id``, so reruns agree. Null texts have size 0; a null source is a source
and comes last. Repeated rows are documents of their own with equal keys; ties go by id and size.
Sources of no words get target 0. The number of sources (not of rows) has to fit one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import WORD, written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
RANGES = 512
# A range of more documents is cut again.
FEW_ROWS = 10_000
# More sources than this are joined by shuffles.
MAX_BROADCAST = 100_000


def quality(text: Column, size: Column) -> Column:
    """Weight in (0, 1]: documents full of symbols come late."""
    symbols = F.regexp_count(text, F.lit("[#*$%&|<>]"))
    return F.lit(1.0) / (1 + F.lit(4.0) * F.coalesce(symbols, F.lit(0)) / F.greatest(size, F.lit(1)))


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, key``; ``cut`` grows with the key, without an end at which it stops to grow."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    bits = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 13), 16, 10)
    u = (bits.cast("long") + 0.5) / F.lit(float(1 << 52))
    rows = docs.select("doc_id", "source", size.alias("size"), quality(F.col("text"), size).alias("quality"), u.alias("u"))
    return rows.select("doc_id", "source", "size", (-F.ln("u") / F.col("quality")).alias("key")).withColumn("cut", F.ln("key"))


def targets(rows: DataFrame, weights: tuple = WEIGHTS, share: float = 1.0, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target``. Capped sources stop at their cap; the rest share by weight.

    Sources in order of cap per weight: the first k are capped, where k is the first at which the
    level of the others stays below the next cap.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    sums = sums.withColumn("weight", weight.cast("double")).withColumn("cap", F.col("source_size") * float(max_epochs))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weighs = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = F.when(left / weighs <= F.col("cap") / F.col("weight"), left / weighs)
    first = F.first("level", ignorenulls=True).over(every)
    sums = sums.withColumn("level", level).withColumn("level", first)
    target = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return sums.select("source", "source_size", target.alias("target"))


def _budget_range(rows: DataFrame, found: DataFrame, few) -> DataFrame:
    """``found`` with each range (from ``low`` to ``high``, both inside) of many documents replaced by that part of it
    in which the budget ends. The borders are cuts of documents, so a part has its documents and no others."""
    wide = F.expr(f"n > {FEW_ROWS} and low < high")
    inside = rows.select("source", "size", "cut").join(few(found.filter(wide)), F.expr("source <=> b_source and cut between low and high"))
    part = F.least(F.floor((F.col("cut") - F.col("low")) / (F.col("high") - F.col("low")) * RANGES), F.lit(RANGES - 1))
    sums = inside.groupBy("b_source", part.alias("part")).agg(
        F.min("cut").alias("low"), F.max("cut").alias("high"), F.count("*").alias("n"),
        F.sum("size").alias("words"), F.first("start").alias("start"), F.first("budget").alias("budget"),
    )
    order = Window.partitionBy("b_source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.col("start") + F.coalesce(F.sum("words").over(order), F.lit(0)))
    ends = sums.filter("start <= budget and budget < start + words")
    return found.filter(~wide).unionByName(ends.select(found.columns))


def mix(
    spark: SparkSession,
    docs: DataFrame,
    *,
    weights: tuple = WEIGHTS,
    share: float = 1.0,
    max_epochs: float = MAX_EPOCHS,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken`` for every row of ``docs(doc_id, text, source)``."""
    rows = written(spark, sized(docs), "mix-sizes")
    goals = written(spark, targets(rows, weights, share, max_epochs), "mix-targets")
    few = F.broadcast if goals.count() <= MAX_BROADCAST else (lambda sources: sources)
    # One row per source: the words still wanted after the complete epochs.
    rest = goals.selectExpr(
        "source as r_source", "source_size as words", "case when source_size > 0 then target - floor(target / source_size) * source_size else 0D end as budget"
    )
    ends = rows.groupBy(F.col("source").alias("b_source")).agg(F.min("cut").alias("low"), F.max("cut").alias("high"), F.count("*").alias("n"))
    inner = rest.filter("0 <= budget and budget < words")
    found = ends.join(few(inner), F.expr("b_source <=> r_source")).selectExpr("b_source", "low", "high", "n", "0L as start", "budget")
    found = written(spark, found, "mix-ranges")
    while not found.filter(f"n > {FEW_ROWS} and low < high").isEmpty():
        found = written(spark, _budget_range(rows, found, few), "mix-ranges")
    last = found.select("b_source", "low", "high", "start", "budget")
    dealt = rows.join(few(goals.selectExpr("source as g_source", "source_size", "target")), F.expr("source <=> g_source")).join(
        few(last), F.expr("source <=> b_source"), "left"
    )
    inside = F.expr("coalesce(cut between low and high, false)")
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = dealt.filter(inside).withColumn("prefix", F.col("start") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    # The document at the edge is taken if that comes nearer to the budget.
    edge = edge.withColumn("more", F.expr("prefix + size / 2D <= budget")).drop("prefix")
    # Sources whose budget ends nowhere (below 0 or at all words, by rounding, or without words) take nothing more.
    other = dealt.filter(~inside).withColumn("more", F.expr("coalesce(cut < low, false)"))
    epochs = F.expr("case when source_size > 0 then cast(floor(target / source_size) as long) else 0L end")
    copies = epochs + F.when(F.col("more") & (epochs < max_epochs), 1).otherwise(0)
    return edge.unionByName(other).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )
