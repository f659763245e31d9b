"""Three-valued flags, flag arithmetic and ordered rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def within(column: Column, low=None, high=None, *, above=None, missing: bool | None = None) -> Column:
    """Range flag: ``low <= x <= high`` and ``x > above``, each bound optional.

    ``missing`` is the answer for a NULL input: NULL by default, or a fixed true/false.
    """
    tests = []
    if low is not None:
        tests.append(column >= low)
    if high is not None:
        tests.append(column <= high)
    if above is not None:
        tests.append(column > above)
    flag = reduce(lambda a, b: a & b, tests)
    return flag if missing is None else F.coalesce(flag, F.lit(missing))


def is_label(column: Column, *labels: str) -> Column:
    """Exact, case-sensitive match with one of the labels; NULL stays NULL."""
    return column.isin(*labels) if len(labels) > 1 else column == labels[0]


def sure(flag: Column) -> Column:
    """Unknown read as false."""
    return F.coalesce(flag, F.lit(False))


def as_count(flag: Column) -> Column:
    """1 for true, 0 for false and unknown, so that flags can be summed."""
    return sure(flag).cast("int")


def true_count(*flags: Column) -> Column:
    return reduce(lambda a, b: a + b, map(as_count, flags))


def any_true(*flags: Column) -> Column:
    return reduce(lambda a, b: a | b, map(sure, flags))


def all_true(*flags: Column) -> Column:
    return reduce(lambda a, b: a & b, map(sure, flags))


def at_least_true(n: int, *flags: Column) -> Column:
    return true_count(*flags) >= n


def first_rule(rules: list[tuple[str, Column]], otherwise: str) -> Column:
    """Label of the first rule that holds."""
    chain = F
    for label, holds in rules:
        chain = chain.when(holds, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def band(column: Column, cuts: list[tuple[int, str]], top: str, *, closed: bool, missing: str = "Unknown") -> Column:
    """Label of the first cut above the value (at or above it when ``closed``), else ``top``."""
    rules = [(missing, column.isNull())]
    rules += [(label, column <= cut if closed else column < cut) for cut, label in cuts]
    return first_rule(rules, top)
