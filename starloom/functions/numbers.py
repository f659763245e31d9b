"""Safe typing and money arithmetic."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
CENT = "0.01"


def money(column: Column) -> Column:
    """Amount with two decimals; NULL where the input does not parse or does not fit."""
    return column.try_cast(MONEY)


def whole(column: Column) -> Column:
    return column.try_cast("int")


def big_whole(column: Column) -> Column:
    return column.try_cast("bigint")


def moment(column: Column) -> Column:
    return column.try_cast("timestamp")


def no_money() -> Column:
    return F.lit(0).cast(MONEY)


def signed_total(plus: Iterable[Column], minus: Iterable[Column] = ()) -> Column:
    """Sum of ``plus`` less ``minus``, a missing part counting as nothing."""
    parts = [F.coalesce(c, no_money()) for c in plus]
    parts += [-F.coalesce(c, no_money()) for c in minus]
    return reduce(lambda a, b: a + b, parts)


def agrees(stated: Column, computed: Column, tolerance: str = CENT) -> Column:
    """Whether two amounts differ by at most ``tolerance``; NULL if nothing is stated."""
    return F.abs(stated - computed) <= F.lit(tolerance).cast(MONEY)


def safe_ratio(amount: Column, count: Column) -> Column:
    """``amount`` per ``count`` as money; NULL for a count of zero (ANSI division would fail)."""
    return (amount / F.nullif(count, F.lit(0))).cast(MONEY)


def amount_if(condition: Column, amount: Column) -> Column:
    """``amount`` where the condition holds and the amount is not negative, else zero money."""
    return F.when(condition & (amount >= 0), amount).otherwise(no_money())
