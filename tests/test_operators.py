import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.operators import checks
from starloom.operators.calendar import calendar_attributes, days, fixed_bounds, whole_years
from starloom.operators.dedup import latest_rows
from starloom.operators.increment import duplicated, in_shape, merge_rows, since, watermark
from starloom.operators.lookup import heavy_keys, left_lookup, resolve_key
from starloom.operators.members import duplicate_keys, with_member


def collected(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- newest rows --------------------------------------------------------------------------


def test_latest_rows_puts_missing_stamps_last_and_breaks_ties(rows):
    df = rows(
        "k string, ts int, line int",
        *[("a", 1, 1), ("a", 2, 2), ("a", None, 9), ("b", 5, 1), ("b", 5, 2), ("c", None, 1), (None, 1, 1), (None, 2, 2), ("", 3, 3)],
    )
    got = {r.k: (r.ts, r.line) for r in latest_rows(df, "k", ["ts", "line"]).collect()}
    assert got == {"a": (2, 2), "b": (5, 2), "c": (None, 1), None: (2, 2), "": (3, 3)}


def test_latest_rows_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 'hot', string(id)) as k", "id as ts")
    plan = latest_rows(df, "k", ["ts"])._jdf.queryExecution().executedPlan().toString()
    below_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below_shuffle
    assert latest_rows(df, "k", ["ts"]).filter("k = 'hot'").first().ts == 999


# --- left joins under skew ----------------------------------------------------------------


@pytest.fixture
def skewed(spark):
    """A third of the rows on one key, a sixth without a key, some keys unknown to the right side."""
    left = spark.range(6000).selectExpr(
        "string(id) as row_id", "case when id % 3 = 0 then 'hot' when id % 6 = 1 then null else concat('k', id % 500) end as k"
    )
    right = spark.range(400).selectExpr("concat('k', id) as k", "id as v").unionByName(
        spark.createDataFrame([("hot", -1), (None, -2)], "k string, v bigint")
    )
    return left, right


def brute_force(left, right):
    known = {r.k: r.v for r in right.collect() if r.k is not None}
    return Counter((r.row_id, r.k, known.get(r.k)) for r in left.collect())


@pytest.mark.parametrize("options", [{}, {"spread_by": "row_id"}, {"spread_by": "row_id", "heavy": ["hot", "k7"], "fanout": 8}])
@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_left_lookup_keeps_every_row_once(spark, skewed, options, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        left, right = skewed
        got = left_lookup(left, right, ["k"], matched="hit", **options)
        assert Counter((r.row_id, r.k, r.v) for r in got.collect()) == brute_force(left, right)
        assert got.filter("hit <> (v is not null)").count() == 0
        assert got.columns == ["row_id", "k", "v", "hit"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_missing_and_heavy_keys_are_spread_over_partitions(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left, right = skewed
        joined = left_lookup(left, right, ["k"], spread_by="row_id", heavy=["hot"], fanout=16)
        by_task = joined.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count_if(F.col("k") == "hot").alias("hot"), F.count_if(F.col("k").isNull()).alias("none")
        )
        counts = by_task.collect()
        assert sum(r.hot > 0 for r in counts) > 1 and sum(r.none > 0 for r in counts) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_two_column_lookup_spreads_and_deals(spark):
    left = spark.range(900).selectExpr(
        "string(id) as row_id", "if(id % 3 = 0, 'hot', concat('k', id % 50)) as k", "if(id % 5 = 0, null, date'2025-01-01') as m"
    )
    right = spark.createDataFrame([("hot", dt.date(2025, 1, 1), 1), ("k4", dt.date(2025, 1, 1), 2)], "k string, m date, v int")
    heavy = heavy_keys(left, ["k", "m"], share=0.2)
    assert heavy == ["hot|2025-01-01"]
    plain = left_lookup(left, right, ["k", "m"])
    dealt = left_lookup(left, right, ["k", "m"], spread_by="row_id", heavy=heavy, fanout=4)
    assert collected(plain, "row_id") == collected(dealt, "row_id")


def test_heavy_keys_are_exactly_those_above_the_share(skewed):
    left, _ = skewed
    assert heavy_keys(left, ["k"], share=0.1) == ["hot"]
    assert heavy_keys(left.filter("k is null"), ["k"], share=0.1) == []


def test_resolve_key_falls_back_to_unknown(rows):
    facts = rows("id int, k string", (1, "a"), (2, "zz"), (3, None))
    dim = rows("k string, label string", ("a", "A"), ("u", "Unknown"))
    got = resolve_key(facts, dim, key="k", unknown=F.lit("u"), matched="hit", spread_by="id")
    assert collected(got, "id") == [(1, "a", True), (2, "u", False), (3, "u", False)]


def test_a_duplicate_dimension_key_multiplies_facts_and_is_reported(rows):
    facts, dim = rows("id int, k string", (1, "a")), rows("k string", ("a",), ("a",))
    assert resolve_key(facts, dim, key="k", unknown=F.lit("u"), matched="hit").count() == 2
    assert collected(duplicate_keys(dim, "k")) == [("a", 2)]


# --- members and calendar -----------------------------------------------------------------


def test_with_member_types_the_row_from_the_table(rows):
    df = with_member(rows("k string, n bigint, ok boolean", ("a", 1, True)), {"k": "UNKNOWN"})
    assert collected(df) == [("a", 1, True), ("UNKNOWN", None, None)]
    with pytest.raises(ValueError):
        with_member(df, {"nope": "x"})


def test_calendar_of_three_years(spark):
    cal = days(fixed_bounds(spark, "2024-01-01", "2027-01-01")).select(*calendar_attributes())
    assert cal.count() == 1096 and len(cal.columns) == 19
    leap = cal.filter("date_key = 20240229").first()
    assert (leap.day_name, leap.day_of_week, leap.week_of_year, leap.is_month_end, leap.is_weekend) == ("Thursday", 5, 9, True, False)
    sunday = cal.filter("date_key = 20261101").first()
    assert (sunday.day_of_week, sunday.is_weekend, sunday.is_month_start, sunday.year_quarter) == (1, True, True, "2026-Q4")
    assert (sunday.year_month, sunday.month_name, sunday.quarter_name) == ("2026-11", "November", "Q4")
    assert days(fixed_bounds(spark, "2024-01-01", "2024-01-01")).count() == 0


def test_whole_years_cover_all_given_dates(rows):
    a, b = rows("d date", (dt.date(2001, 5, 6),), (None,)), rows("t timestamp", (dt.datetime(2003, 12, 31, 23),))
    assert collected(whole_years((a, "d"), (b, "t"))) == [(dt.date(2001, 1, 1), dt.date(2004, 1, 1))]


# --- watermark and merge ------------------------------------------------------------------


def stamp(text):
    return dt.datetime.fromisoformat(text)


def test_watermark_is_midnight_two_days_back(rows):
    target = rows("ts timestamp", (stamp("2025-01-10 17:00:00"),), (None,))
    assert watermark(target, "ts") == dt.date(2025, 1, 8)
    source = rows("id int, ts timestamp", (1, stamp("2025-01-08 00:00:00")), (2, stamp("2025-01-07 23:59:59")), (3, None))
    assert collected(since(source, "ts", dt.date(2025, 1, 8)).select("id")) == [(1,)]


def test_everything_passes_without_a_target_or_with_an_empty_one(rows):
    source = rows("id int, ts timestamp", (1, stamp("2025-01-08 00:00:00")), (3, None))
    assert watermark(None, "ts") is None and since(source, "ts", None).count() == 2
    bound = watermark(source.filter("false"), "ts")
    assert bound == dt.date(1899, 12, 30) and since(source, "ts", bound).count() == 2


def test_the_bound_reaches_the_file_scan(spark, tmp_path):
    spark.range(10).selectExpr("id", "timestamp_seconds(id) as ts", "string(id) as wide").write.parquet(f"{tmp_path}/t")
    df = since(spark.read.parquet(f"{tmp_path}/t"), "ts", dt.date(2025, 1, 1)).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "wide" not in plan[plan.index("ReadSchema") :]


def test_merge_replaces_inserts_and_never_deletes(rows):
    target = rows("k string, v int", ("a", 1), ("b", 2))
    source = rows("k string, v int", ("b", 20), ("c", 30))
    assert collected(merge_rows(target, source, "k"), "k") == [("a", 1), ("b", 20), ("c", 30)]


def test_merge_follows_the_schema_of_the_source(rows):
    target = rows("k string, gone int, n int", ("a", 1, 7))
    source = rows("k string, n bigint, new string", ("b", 8, "x"))
    merged = merge_rows(target, source, "k")
    assert merged.columns == ["k", "n", "new"] and merged.schema["n"].dataType.simpleString() == "bigint"
    assert collected(merged, "k") == [("a", 7, None), ("b", 8, "x")]
    assert in_shape(target, source.schema).columns == ["k", "n", "new"]


def test_merge_may_ignore_older_rows(rows):
    schema = "k string, ts timestamp, v int"
    target = rows(schema, ("a", stamp("2025-01-02 00:00:00"), 1), ("b", None, 2))
    source = rows(schema, ("a", stamp("2025-01-01 00:00:00"), 10), ("b", stamp("2024-01-01 00:00:00"), 20), ("c", None, 30))
    assert [r[::2] for r in collected(merge_rows(target, source, "k", newer_by="ts"), "k")] == [("a", 1), ("b", 20), ("c", 30)]


def test_ambiguous_sources_are_found(rows):
    assert duplicated(rows("k string", ("a",), ("a",), ("b",)), "k") == ["a"]
    assert duplicated(rows("k string", ("a",), ("b",)), "k") == []


# --- checks: one failing and one passing input each ---------------------------------------


def check(rule, column="x", **kw):
    return checks.Check("t", rule, column, **kw)


@pytest.mark.parametrize(
    "declared, kind, bad, good",
    [
        (check("not_null"), "int", [1, None], [1, 2]),
        (check("unique"), "int", [1, 1, None], [1, 2, None, None]),
        (check("accepted_values", allowed=("a", "b")), "string", ["a", "z"], ["a", "b", None]),
        (check("accepted_values", allowed=(True,)), "boolean", [True, False], [True, None]),
        (check("range", low=1, high=5), "int", [0, 3], [1, 5, None]),
        (check("range", low=0, where="x <> 7"), "int", [-1], [0, 7]),
        (check("relationship", parent=("p", "id")), "string", ["a", "q"], ["a", None]),
    ],
)
def test_every_rule_has_a_failing_and_a_passing_input(rows, declared, kind, bad, good):
    for values, expected in ((bad, 1), (good, 0)):
        tables = {"t": rows(f"x {kind}", *[(v,) for v in values]), "p": rows("id string", ("a",))}
        assert [r.violations for r in checks.report(tables, [declared]).collect()] == [expected]
        assert declared.violating(tables).count() == expected


def test_row_rules_of_a_table_share_one_scan(spark, tmp_path):
    spark.range(5).selectExpr("id as x", "string(id) as y").write.parquet(f"{tmp_path}/t")
    chosen = [check("not_null"), check("range", low=0, high=3), check("accepted_values", "y", allowed=("0", "1"))]
    result = checks.report({"t": spark.read.parquet(f"{tmp_path}/t")}, chosen)
    assert [r.violations for r in result.collect()] == [0, 1, 3]
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1


def test_orphans_count_their_rows(rows):
    child, parent = rows("x string", ("q",), ("q",), ("a",)), rows("id string", ("a",))
    assert collected(checks.orphans(child, "x", parent, "id")) == [("q", 2)]
    assert checks.report({"t": child, "p": parent}, [check("relationship", parent=("p", "id"))]).first().violations == 2


def test_row_counts_are_compared_without_a_join(rows):
    one, two = rows("a int", (1,)), rows("a int", (1,), (2,))
    assert collected(checks.unequal_counts(one, "l", two, "r")) == [(1, 2)]
    assert collected(checks.unequal_counts(two, "l", two, "r")) == []
    plan = checks.unequal_counts(one, "l", two, "r")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_mapping_rules(rows):
    df = rows("z string, city string, lat double", ("1", "A", 1.0), ("1", "A", 1.0), ("2", "A", 1.0), ("2", "B", 1.0), ("3", None, 2.0))
    assert collected(checks.conflicting_tuples(df, "z", ["city", "lat"])) == [("2", 2)]
    assert collected(checks.several_per_key(df, "z", {"city": "cities", "lat": "lats"}), "z") == [("1", 2, 1, 1), ("2", 2, 2, 1)]


def test_the_gate_blocks_errors_and_lets_warnings_pass(rows):
    results = lambda severity: rows(checks.REPORT_SCHEMA, ("c", "t", "x", severity, 3), ("d", "t", "y", "error", 0))
    checks.gate(results("warn"))
    with pytest.raises(checks.QualityError, match="c: 3"):
        checks.gate(results("error"))


def test_raw_rows_are_new_by_when_they_were_loaded(rows):
    from starloom.operators.increment import arrived, load_mark

    stamp = lambda n: dt.datetime(2025, 1, n)
    first = rows("id int, etl_ingested_at timestamp", (1, stamp(1)), (2, stamp(2)), (3, None))
    mark = load_mark(first, None)
    assert mark == {"at": "2025-01-02 00:00:00", "rows": 1}
    ids = lambda df: {r.id for r in df.collect()}
    # A row without a loading time always counts as new; a moment that has grown is read again.
    assert ids(arrived(first, None)) == {1, 2, 3} and ids(arrived(first, mark)) == {3}
    more = first.unionByName(rows("id int, etl_ingested_at timestamp", (4, stamp(3))))
    assert ids(arrived(more, mark)) == {3, 4}
    assert ids(arrived(more.unionByName(rows("id int, etl_ingested_at timestamp", (5, stamp(2)))), mark)) == {2, 3, 4, 5}
    assert load_mark(first.filter("id = 3"), mark) == mark
    assert ids(arrived(first, load_mark(first.limit(0), None))) == {1, 2, 3}


def test_a_calendar_ends_within_its_limits(rows):
    far = rows("start date, stop date", (dt.date(1, 1, 1), dt.date(9999, 12, 31)))
    assert days(far).count() == (dt.date(2199, 12, 31) - dt.date(1900, 1, 1)).days + 1
    one = rows("start date, stop date", (dt.date(2024, 12, 30), dt.date(2025, 1, 3)))
    assert sorted(r[0] for r in days(one).collect()) == [dt.date(2024, 12, 30), dt.date(2024, 12, 31), dt.date(2025, 1, 1), dt.date(2025, 1, 2)]
    assert days(rows("start date, stop date", (None, None), (dt.date(2025, 1, 2), dt.date(2025, 1, 2)))).count() == 0


def test_values_are_counted_for_wrong_keys_alone(rows):
    df = rows(
        "k string, city string, at double",
        *[("a", "x", 1.0), ("b", "x", 0.0), ("b", "x", -0.0), ("c", "x", 1.0), ("c", "y", 1.0), ("c", None, 2.0)],
        *[(None, "x", 1.0), (None, "z", None), ("d", None, None), ("e", None, 1.0), ("e", None, 1.0)],
    )
    found = checks.several_per_key(df, "k", {"city": "cities", "at": "places"})
    assert {tuple(r) for r in found.collect()} == {("b", 2, 1, 1), ("c", 3, 2, 2), (None, 2, 2, 1), ("e", 2, 0, 1)}
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()


def test_row_checks_are_counted_while_a_table_is_written(rows, tmp_path):
    df = rows("a int, b string", (1, "x"), (None, "y"), (7, "z"))
    declared = [
        checks.Check("t", "not_null", "a"),
        checks.Check("t", "range", "a", low=0, high=5, severity=checks.WARN),
        checks.Check("t", "accepted_values", "b", allowed=("x", "y", "z")),
        checks.Check("t", "unique", "a"),
        checks.Check("other", "not_null", "b"),
    ]
    for number, (given, found) in enumerate([(df, [("not_null:t:a", 1)]), (df.limit(0), []), (df.filter("false"), [])]):
        watch = checks.Watched("t", declared)
        watch.watch(given).write.parquet(f"{tmp_path}/{number}")
        assert watch.broken(df.sparkSession.read.parquet(f"{tmp_path}/{number}")) == found
    assert checks.Watched("none", declared).broken(df) == []
