"""Special dimension members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Column
from pyspark.sql import functions as F


def with_member(rows: DataFrame, values: dict[str, Column | str | bool]) -> DataFrame:
    """Append one row holding ``values``; every other column is a NULL of its own type.

    The row is made by the JVM from a one-row range and typed from ``rows``, so the two sides
    cannot drift apart.
    """
    unknown = set(values) - set(rows.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    member = rows.sparkSession.range(0, 1, 1, 1).select(
        *[_cell(values.get(f.name)).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    )
    return rows.unionByName(member)


def _cell(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def duplicate_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row: each would multiply the facts that point to it."""
    return dimension.groupBy(key).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)
