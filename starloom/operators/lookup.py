"""Left joins that keep every left row and stay even under skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FANOUT = 64
HEAVY_SHARE = 0.005
# Fixed value: what rows without a key meet by, followed by the number of their share.
MISSING = "__missing_"


def _name(column: str) -> str:
    return f"`{column}`"


def _label(columns: list[str]) -> str:
    """One text per key. Equal keys have equal labels; a rare collision only costs a few copies."""
    return f"concat_ws('|', {', '.join(f'string({_name(c)})' for c in columns)})"


def _all_present(columns: list[str]) -> str:
    return " and ".join(f"{_name(c)} is not null" for c in columns)


def _meeting_key(column: str, spread_by: str, fanout: int = FANOUT) -> str:
    """The key, or for rows without one a share by ``spread_by``. The same text in every lookup: Spark then leaves rows
    where an earlier lookup by the same key has brought them."""
    share = f"concat('{MISSING}', string(pmod(xxhash64({_name(spread_by)}), {fanout})))"
    return f"if({_name(column)} is not null, {_name(column)}, {share})"


def heavy_keys(df: DataFrame, on: list[str], share: float = HEAVY_SHARE) -> list[str]:
    """Labels of the keys that hold more than ``share`` of the rows.

    Two passes over the key columns alone: bounded counters name at most ``1/share`` candidates
    and miss none above the share, then the candidates are counted exactly.
    """
    labelled = df.filter(_all_present(on)).selectExpr(f"{_label(on)} as label")
    candidates = labelled.freqItems(["label"], share).first()[0]
    if not candidates:
        return []
    named = F.when(F.col("label").isin(candidates), F.col("label"))
    counts = {r[0]: r[1] for r in labelled.groupBy(named.alias("label")).count().collect()}
    least = share * sum(counts.values())
    return sorted(label for label, n in counts.items() if label is not None and n > least)


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    *,
    matched: str | None = None,
    spread_by: str | None = None,
    heavy: list[str] | None = None,
    fanout: int = FANOUT,
    meet_by_first: bool = False,
) -> DataFrame:
    """``left`` with the non-key columns of ``right``; unmatched rows get NULLs.

    * ``spread_by`` names a column that tells left rows apart. Rows with a missing key cannot
      match: instead of meeting in one shuffle partition they are spread by a hash of that
      column, and the join condition keeps them unmatched. (The first key must be text.)
    * ``heavy`` lists keys that hold many left rows, as found by :func:`heavy_keys`. Those rows
      are dealt by ``spread_by`` over ``fanout`` partitions and the right rows of these keys,
      one each, are repeated for each. Without it, adaptive execution splits the partitions it
      finds skewed.
    * ``meet_by_first``: rows meet by the first key alone, and the other keys are compared then. A later
      :func:`resolve_member` by that key finds the left rows in place and doesn't shuffle them again. For keys of which
      the right side holds a bounded number of rows (a customer's months); needs ``spread_by``, not for ``heavy`` keys.
    * Spark broadcasts ``right`` only if its measured size is below the session's threshold.
    """
    renamed = {c: f"__right_{c}" for c in on}
    right = right.withColumnsRenamed(renamed)
    first, *rest = on
    pairs, helpers = [f"{_name(c)} = {_name(renamed[c])}" for c in rest], []
    if meet_by_first and not heavy:
        # Not written as an equality, which Spark would make part of what rows are shuffled by.
        pairs = [f"{_name(c)} {sign} {_name(renamed[c])}" for c in rest for sign in ("<=", ">=")]
        pairs += [f"{_meeting_key(first, spread_by)} = {_name(renamed[first])}", _all_present(on)]
    elif spread_by:
        spread = f"if({_all_present(on)}, {_name(first)}, string(xxhash64({_name(spread_by)})))"
        pairs += [f"{spread} = {_name(renamed[first])}", _all_present(on)]
    else:
        pairs.append(f"{_name(first)} = {_name(renamed[first])}")
    if heavy:
        dealt = F.when(_is_in(on, heavy), F.pmod(F.xxhash64(F.col(spread_by)), F.lit(fanout)))
        left = left.withColumn("__deal", F.coalesce(dealt.cast("int"), F.lit(0)))
        every = F.sequence(F.lit(0), F.lit(fanout - 1))
        copies = F.when(_is_in(list(renamed.values()), heavy), every).otherwise(F.array(F.lit(0)))
        right = right.withColumn("__copy", F.explode(copies))
        pairs.append("__deal = __copy")
        helpers = ["__deal", "__copy"]

    joined = left.join(right, F.expr(" and ".join(pairs)), "left")
    if matched:
        joined = joined.withColumn(matched, F.expr(f"{_name(renamed[first])} is not null"))
    return joined.drop(*helpers, *renamed.values())


def _is_in(columns: list[str], labels: list[str]) -> Column:
    return F.expr(_label(columns)).isin(labels)


def resolve_key(
    facts: DataFrame,
    dimension: DataFrame,
    *,
    key: str,
    unknown: Column,
    matched: str,
    spread_by: str | None = None,
    heavy: list[str] | None = None,
) -> DataFrame:
    """Keep ``key`` where the dimension has it, else put the Unknown key in its place.

    Only the key column of the dimension is read. ``matched`` records which of the two it was.
    ``spread_by`` and ``heavy`` are those of :func:`left_lookup`.
    """
    found = left_lookup(facts, dimension.select(key), [key], matched=matched, spread_by=spread_by, heavy=heavy)
    return found.withColumn(key, F.when(F.col(matched), F.col(key)).otherwise(unknown))


def resolve_member(
    facts: DataFrame,
    dimension: DataFrame,
    *,
    member: str,
    key: str,
    key_of: Column,
    missing: str,
    unknown: Column,
    matched: str,
    spread_by: str,
) -> DataFrame:
    """:func:`resolve_key` for a dimension whose ``key`` is a hash of its column ``member``: rows meet by the member itself,
    which facts hold too and which is shorter than its hash, and ``key_of`` makes the key afterwards.

    ``missing`` is the text that a missing member is hashed as. The dimension's row of it is repeated for each share of
    the facts without a member (:func:`_meeting_key`). Facts that met another table by the same column and
    ``spread_by`` before (``meet_by_first`` of :func:`left_lookup`) are not shuffled again.
    """
    name, shares = F.coalesce(F.col(member), F.lit(missing)), [f"{MISSING}{i}" for i in range(FANOUT)]
    asked = [F.struct(F.lit(text).alias("__member"), F.lit(text != missing).alias("__is_share")) for text in (missing, *shares)]
    alone = F.array(F.struct(name.alias("__member"), F.lit(False).alias("__is_share")))
    members = dimension.select(F.inline(F.when(name == missing, F.array(*asked)).otherwise(alone)))
    absent = f"({_name(member)} is null)"
    met = f"{_meeting_key(member, spread_by)} = __member and {absent} <= __is_share and {absent} >= __is_share"
    found = facts.join(members, F.expr(met), "left").withColumn(matched, F.col("__member").isNotNull())
    return found.withColumn(key, F.when(F.col(matched), key_of).otherwise(unknown)).drop("__member", "__is_share")


def heavy_values(weighted: DataFrame, columns: list[str], weight: str, share: float = HEAVY_SHARE) -> dict[str, list[str]]:
    """For each of several text columns, the values that hold more than ``share`` of the whole weight.

    One pass for all columns; at most ``1/share`` values of each come back.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns])
    sums = weighted.select(F.inline(pairs), weight).groupBy("name", "value").agg(F.sum(weight).alias("held"))
    least = weighted.agg((F.sum(weight) * F.lit(share)).alias("least")).first()["least"] or 0
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in sums.filter((F.col("held") > F.lit(float(least))) & F.col("value").isNotNull()).collect():
        found[row["name"]].append(row["value"])
    return {name: sorted(values) for name, values in found.items()}
