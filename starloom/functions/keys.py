"""Deterministic hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text a missing part hashes as, the separator, and the special members.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"
UNKNOWN_ID = "UNKNOWN"
UNKNOWN = "Unknown"
NOT_APPLICABLE = "Not Applicable"


def surrogate_key(*columns: Column, null_token: str = NULL_TOKEN, length_prefixed: bool = False) -> Column:
    """MD5 over the parts as text, equal across runs and NULL-safe.

    Joined parts are ambiguous (``('a-b','c')`` and ``('a','b-c')`` share a key).
    ``length_prefixed`` removes that, at the price of keys that differ from the default.
    """
    parts = [F.coalesce(c.cast("string"), F.lit(null_token)) for c in columns]
    if length_prefixed:
        parts = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def literal_key(*texts: str) -> Column:
    """Key of a special member. Catalyst folds it to a constant, so no join is needed for it."""
    return surrogate_key(*[F.lit(t) for t in texts])


def unknown_key() -> Column:
    return literal_key(UNKNOWN_ID)


def reason_key(category: Column, reason: Column) -> Column:
    return surrogate_key(category, reason)


def routed_reason_key(is_churned: Column, category: Column, reason: Column) -> Column:
    """Reason key of a month: the pair's key, unless the month is known not to be churned
    (Not Applicable) or is churned without any reason (Unknown).

    An unknown status keeps the pair's key; that key may be absent from the dimension.
    """
    unexplained = is_churned & category.isNull() & reason.isNull()
    return (
        F.when(~is_churned, literal_key(NOT_APPLICABLE, NOT_APPLICABLE))
        .when(unexplained, literal_key(UNKNOWN, UNKNOWN))
        .otherwise(reason_key(category, reason))
    )
