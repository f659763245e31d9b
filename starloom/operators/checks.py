"""Data-quality checks: rules that return the violating rows, and a runner that batches them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"
REPORT_SCHEMA = "check_name string, table_name string, column_name string, severity string, violations bigint"


# --- rules over one table, as "this row violates" conditions ------------------------------


def missing(column: str) -> Column:
    return F.col(column).isNull()


def outside_values(column: str, allowed: list) -> Column:
    """NULL passes: it is the business of :func:`missing`."""
    return F.coalesce(~F.col(column).isin(*allowed), F.lit(False))


def outside_range(column: str, low=None, high=None) -> Column:
    """Both bounds inclusive and optional. NULL passes."""
    tests = []
    if low is not None:
        tests.append(F.col(column) < low)
    if high is not None:
        tests.append(F.col(column) > high)
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


# --- rules that need a shuffle ------------------------------------------------------------


def repeated(df: DataFrame, *columns: str) -> DataFrame:
    """Value combinations held by more than one row (counted map-side before the shuffle)."""
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Like :func:`repeated` for one column, leaving missing values out."""
    return repeated(df.filter(F.col(column).isNotNull()), column)


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child values absent from the parent, with their row counts.

    The child shrinks to one row per distinct value before it is shuffled for the join.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_rows"))
    return used.join(parent.select(F.col(field).alias(column)), column, "left_anti")


def unequal_counts(left: DataFrame, left_name: str, right: DataFrame, right_name: str) -> DataFrame:
    """One row holding both row counts if they differ, else none.

    Both counts are folded into one aggregate over two partial counts; nothing is joined.
    """
    sides = left.agg(F.count("*").alias("l"), F.lit(0).cast("bigint").alias("r")).unionByName(
        right.agg(F.lit(0).cast("bigint").alias("l"), F.count("*").alias("r"))
    )
    totals = sides.agg(F.sum("l").alias(left_name), F.sum("r").alias(right_name))
    return totals.filter(F.col(left_name) != F.col(right_name))


def several_per_key(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """Keys with more than one row or more than one value of a column, with the distinct counts,
    named as ``columns`` says.

    Distinct tuples come first, so repeated rows collapse before the shuffle. Smallest and largest
    value tell which keys are wrong; values are counted for these alone.
    """
    tuples = df.groupBy(key, *columns).agg(F.count("*").alias("__n"))
    ends = [a for c in columns for a in (F.min(c).alias(f"__lo_{c}"), F.max(c).alias(f"__hi_{c}"))]
    differs = [F.coalesce(F.col(f"__lo_{c}") != F.col(f"__hi_{c}"), F.lit(False)) for c in columns]
    keyed = tuples.groupBy(F.col(key).alias("__key")).agg(F.sum("__n").alias("n_rows"), *ends)
    broken = keyed.filter(reduce(lambda a, b: a | b, differs, F.col("n_rows") > 1)).select("__key", "n_rows")
    # -0.0 and 0.0 are one value.
    value = {f.name: F.col(f.name) + F.lit(0.0) if f.dataType.typeName() in ("float", "double") else F.col(f.name) for f in df.schema}
    pairs = F.array(*[F.struct(F.lit(c).alias("__column"), value[c].cast("string").alias("__value")) for c in columns])
    of_broken = tuples.join(broken.select("__key"), F.col(key).eqNullSafe(F.col("__key")), "left_semi")
    values = of_broken.select(F.col(key).alias("__held"), F.inline(pairs)).filter("__value is not null").distinct()
    counts = values.groupBy("__held").agg(*[F.count_if(F.col("__column") == c).alias(name) for c, name in columns.items()])
    met = broken.join(counts, F.col("__key").eqNullSafe(F.col("__held")), "left")
    named = [F.coalesce(F.col(name), F.lit(0)).alias(name) for name in columns.values()]
    return met.select(F.col("__key").alias(key), "n_rows", *named)


def conflicting_tuples(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys that map to more than one value of a column, whatever their number of rows.

    min/max instead of several distinct counts: no row expansion.
    """
    tuples = df.select(key, *columns).distinct()
    ends = [a for c in columns for a in (F.min(c).alias(f"__lo_{c}"), F.max(c).alias(f"__hi_{c}"))]
    differs = [F.col(f"__lo_{c}") != F.col(f"__hi_{c}") for c in columns]
    spread = tuples.groupBy(key).agg(F.count("*").alias("n_tuples"), *ends)
    return spread.filter(F.coalesce(reduce(lambda a, b: a | b, differs), F.lit(False))).select(key, "n_tuples")


# --- declared checks ----------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A declared check. ``rule`` is one of not_null, unique, accepted_values, relationship,
    range, or the name of a business rule with its own query."""

    table: str
    rule: str
    column: str = ""
    severity: str = ERROR
    allowed: tuple = ()
    parent: tuple[str, str] = ("", "")
    low: int | None = None
    high: int | None = None
    where: str = ""
    query: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None

    @property
    def name(self) -> str:
        return ":".join(filter(None, [self.rule, self.table, self.column]))

    @property
    def batch(self) -> str:
        """What the check can be computed together with: other row tests, or its own rule."""
        if self.query or (self.where and self.rule in ("unique", "relationship")):
            return ""
        return self.rule if self.rule in ("unique", "relationship") else "rows"

    def row_test(self) -> Column | None:
        """The condition of a rule that one row can break by itself; None for the others."""
        if self.rule == "not_null":
            test = missing(self.column)
        elif self.rule == "accepted_values":
            test = outside_values(self.column, list(self.allowed))
        elif self.rule == "range":
            test = outside_range(self.column, self.low, self.high)
        else:
            return None
        return F.expr(self.where) & test if self.where else test

    def violating(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        """The violating rows (or values, with their counts)."""
        df = tables[self.table]
        if self.query:
            return self.query(tables)
        test = self.row_test()
        if test is not None:
            return df.filter(test)
        if self.where:
            df = df.filter(self.where)
        if self.rule == "unique":
            return repeated_values(df, self.column)
        if self.rule == "relationship":
            parent, field = self.parent
            return orphans(df, self.column, tables[parent], field)
        raise ValueError(f"unknown rule {self.rule}")

    def _row(self, violations: Column) -> list[Column]:
        labels = [self.name, self.table, self.column, self.severity]
        names = ["check_name", "table_name", "column_name", "severity"]
        return [F.lit(v).alias(n) for v, n in zip(labels, names)] + [violations.alias("violations")]


def row_test_counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-wise checks of one table in a single scan: one counter per check, then unpivoted."""
    counters = [F.count_if(c.row_test()).alias(f"c{i}") for i, c in enumerate(checks)]
    results = [F.struct(*c._row(F.col(f"c{i}"))) for i, c in enumerate(checks)]
    return df.agg(*counters).select(F.inline(F.array(*results)))


def keyed_counts(tables: Mapping[str, DataFrame], table: str, checks: list[Check]) -> DataFrame:
    """All uniqueness or all relationship checks of one table in a single scan.

    The checked columns are turned into (column, value) pairs and counted, map-side first, so
    the table is computed once and only distinct values travel.
    """
    columns = list(dict.fromkeys(c.column for c in checks))
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    values = (
        tables[table]
        .select(F.inline(pairs))
        .filter("value is not null")
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n_rows"))
    )
    if checks[0].rule == "unique":
        broken, weight = values.filter("n_rows > 1"), F.lit(1)
    else:
        known = [
            tables[parent].select(F.lit(c.column).alias("column_name"), F.col(field).cast("string").alias("value"))
            for c in checks
            for parent, field in [c.parent]
        ]
        known = reduce(DataFrame.unionByName, known)
        # An orphan value counts once per row that uses it; a repeated value counts once.
        broken, weight = values.join(known, ["column_name", "value"], "left_anti"), F.col("n_rows")
    counters = [
        F.coalesce(F.sum(F.when(F.col("column_name") == c.column, weight)), F.lit(0)).cast("bigint").alias(f"c{i}")
        for i, c in enumerate(checks)
    ]
    results = [F.struct(*c._row(F.col(f"c{i}"))) for i, c in enumerate(checks)]
    return broken.agg(*counters).select(F.inline(F.array(*results)))


def counted(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Number of violations of one check that needs its own query."""
    rows = check.violating(tables)
    n = F.coalesce(F.sum("n_rows"), F.lit(0)) if check.rule == "relationship" else F.count("*")
    return rows.agg(n.alias("n")).select(*check._row(F.col("n")))


def report(tables: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One row per check with its number of violations.

    The row-wise checks of a table share one scan, and so do its uniqueness checks and its
    relationship checks. The result has as many rows as there are checks.
    """
    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        groups: dict[str, list[Check]] = {}
        for check in [c for c in checks if c.table == table]:
            groups.setdefault(check.batch, []).append(check)
        for batch, group in groups.items():
            if batch == "rows":
                parts.append(row_test_counts(tables[table], group))
            elif batch:
                parts.append(keyed_counts(tables, table, group))
            else:
                parts += [counted(c, tables) for c in group]
    return reduce(DataFrame.unionByName, parts)


class Watched:
    """The row-wise checks of a table as metrics of the job that writes it, so they cost no scan of their own."""

    def __init__(self, table: str, checks: Iterable[Check]):
        self.checks = [c for c in checks if c.table == table and c.batch == "rows"]
        self._metrics = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        counters = [F.count_if(c.row_test()).alias(f"c{i}") for i, c in enumerate(self.checks)]
        return df.observe(self._metrics, *counters) if counters else df

    def broken(self, written: DataFrame) -> list[tuple[str, int]]:
        """Blocking checks that failed, with their numbers of violations, once the table is ``written``."""
        # Spark may leave a plan without rows out, and its metrics with it.
        if not self.checks or written.isEmpty():
            return []
        found = self._metrics.get
        counted = [(c, found[f"c{i}"]) for i, c in enumerate(self.checks)]
        return [(c.name, n) for c, n in counted if n and c.severity == ERROR]


class QualityError(Exception):
    """Raised by :func:`gate` with the checks that block."""


def gate(results: DataFrame) -> DataFrame:
    """Raise if an error-level check failed; a warning only stays in the report."""
    blocking = results.filter((F.col("severity") == ERROR) & (F.col("violations") > 0))
    refuse([(r.check_name, r.violations) for r in blocking.collect()])
    return results


def refuse(failed: list[tuple[str, int]]) -> None:
    if failed:
        raise QualityError(", ".join(f"{name}: {n}" for name, n in failed))
