"""Reading what is new, and merging it into rows that exist."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Rows of a month that one task merges, at most about twice as many.
ROWS_PER_PIECE = 1_000_000
FLOOR = date(1900, 1, 1)
LOOKBACK_DAYS = 2


def floored(stamp: Column) -> Column:
    """A missing stamp counts as 1900-01-01."""
    return F.coalesce(stamp, F.lit(FLOOR).cast("timestamp"))


def watermark(target: DataFrame | None, stamp: str, lookback_days: int = LOOKBACK_DAYS) -> date | None:
    """Midnight ``lookback_days`` before the target's newest stamp; None without a target.

    A one-row job over one column. Its result becomes a literal, which, unlike a subquery,
    reaches the file scan of the source.
    """
    if target is None:
        return None
    newest = F.max(stamp).cast("timestamp")
    return target.agg(F.date_sub(floored(newest), lookback_days)).first()[0]


def since(source: DataFrame, stamp: str, bound: date | None) -> DataFrame:
    """Rows stamped at or after ``bound``. Unstamped rows pass only while the bound is at the floor."""
    if bound is None:
        return source
    literal = F.lit(bound).cast(source.schema[stamp].dataType)
    fresh = F.col(stamp) >= literal
    return source.filter(fresh | F.col(stamp).isNull() if bound <= FLOOR else fresh)


def arrived(raw: DataFrame, mark: dict | None, loaded: str = "etl_ingested_at") -> DataFrame:
    """Raw rows that were loaded after ``mark`` (see :func:`load_mark`), by a literal that reaches the file scan.

    If more rows have come with the mark's own moment since, all of that moment are read again.
    Rows that don't say when they were loaded always are.
    """
    if not mark or mark["at"] is None:
        return raw
    moment = F.lit(mark["at"]).cast("timestamp")
    has_grown = raw.filter(F.col(loaded) == moment).count() != mark["rows"]
    news = F.col(loaded) >= moment if has_grown else F.col(loaded) > moment
    return raw.filter(news | F.col(loaded).isNull())


def load_mark(raw: DataFrame, before: dict | None, loaded: str = "etl_ingested_at") -> dict:
    """How far ``raw`` goes: its latest loading time, as text, and how many rows came with it. Without any, as ``before``."""
    # Counted by moment in one pass, for raw rows may be expensive to make.
    moments = raw.filter(F.col(loaded).isNotNull()).groupBy(F.col(loaded).alias("at")).agg(F.count("*").alias("rows"))
    latest = moments.agg(F.max(F.struct("at", "rows")).alias("m")).select(F.col("m.at").cast("string"), "m.rows").first()
    if latest[0] is None:
        return before or {"at": None, "rows": 0}
    return {"at": latest[0], "rows": latest[1]}


def in_shape(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``: new ones NULL, removed ones dropped."""
    have = set(df.columns)
    return df.select(
        [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def not_older(target: DataFrame, source: DataFrame, key: str, newer_by: str | tuple[str, ...]) -> DataFrame:
    """Source rows that are not older than the target's row of their key.

    ``newer_by`` is one stamp, or the columns that order versions, a missing value being the oldest.
    """
    version = floored(F.col(newer_by)) if isinstance(newer_by, str) else F.struct(*newer_by)
    held = target.select(F.col(key).alias("__held_key"), version.alias("__held"))
    met = source.join(held, F.col(key).eqNullSafe(F.col("__held_key")), "left")
    return met.filter(F.col("__held").isNull() | (version >= F.col("__held"))).select(*source.columns)


def merge_rows(
    target: DataFrame, source: DataFrame, key: str, *, newer_by: str | tuple[str, ...] | None = None
) -> DataFrame:
    """Target after the merge: source rows replace those of equal key, the others stay. A missing
    key is a key like any other.

    With ``newer_by`` a source row older than the target's row of that key is ignored, so
    batches may arrive out of order. Both sides are unique by key; see :func:`duplicated`.
    """
    target = in_shape(target, source.schema)
    if newer_by:
        source = not_older(target, source, key, newer_by)
    replaced = F.col(key).eqNullSafe(F.col("__new_key"))
    return target.join(source.select(F.col(key).alias("__new_key")), replaced, "left_anti").unionByName(source)


def merge_months(
    target: DataFrame, source: DataFrame, key: str, month: str, left: DataFrame | None = None, pieces: int = 1
) -> DataFrame:
    """:func:`merge_rows` for a target that is written by month: all rows are shuffled once, by month and share of the keys,
    and are written where they are.

    A source row replaces the target's row of equal key in its own month; ``left`` lists the (key, month) pairs of target rows
    whose keys are in the source with any month. ``pieces`` is the number of shares a month is merged in.
    """
    target = in_shape(target, source.schema)
    rows = target.withColumn("__by", F.lit(0)).unionByName(source.withColumn("__by", F.lit(1)))
    if left is not None:
        rows = rows.unionByName(in_shape(left, source.schema).withColumn("__by", F.lit(2)))
    dealt = rows.withColumn("__piece", F.pmod(F.xxhash64(F.col(key)), F.lit(pieces))).repartition(month, "__piece")
    last = F.max("__by").over(Window.partitionBy(month, "__piece", key))
    kept = dealt.withColumn("__last", last).filter((F.col("__by") == 1) | (F.col("__last") == 0))
    return kept.select(*source.columns)


def duplicated(source: DataFrame, key: str, show: int = 5) -> list:
    """A few key values that occur more than once: a merge with them would be ambiguous."""
    repeated = source.groupBy(key).count().filter("count > 1")
    return [row[0] for row in repeated.select(key).take(show)]
