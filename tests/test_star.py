"""The star built on storage: incremental replay, the effect of each defect, and the checks."""

import datetime as dt
import hashlib
import os
from collections import Counter

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from starloom.functions.audit import AUDIT_COLUMNS, Audit
from starloom.functions.keys import NULL_TOKEN
from starloom.operators import checks
from starloom.operators.increment import since
from starloom.plans import dimensions, entities, facts, quality, staging
from starloom.plans.star import LAYERS, MERGED_STAGING, MERGES, HeavyKeys, Star, recent_months, refresh, restage, shown, stored
from starloom.sources.adapters import bronze
from starloom.sources.bronze import Bronze
from starloom.sources.lake import DIMENSIONS, ENTITIES, FACTS, STAGING, Lake

SPLIT = "timestamp'2001-01-01'"


def early(raw):
    """The raw tables as they were before the split day."""
    before = f"updated_at < {SPLIT} or updated_at is null"
    return Bronze(
        lambda: raw.customers, lambda: raw.zips, lambda: raw.months.filter(before), lambda: raw.events.filter(before)
    )


def loaded_later(raw):
    """The raw tables as they are when the rows after the split day were loaded by a second delivery."""
    later = F.when(F.col("updated_at") >= F.expr(SPLIT), F.expr("etl_ingested_at + interval 1 day"))
    stamped = lambda rows: rows.withColumn("etl_ingested_at", F.coalesce(later, F.col("etl_ingested_at")))
    return Bronze(lambda: raw.customers, lambda: raw.zips, lambda: stamped(raw.months), lambda: stamped(raw.events))


def same(a, b):
    a, b = a.drop(*AUDIT_COLUMNS), b.drop(*AUDIT_COLUMNS)
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    a, b = a.select(columns), b.select(columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """A lake loaded in two steps, one loaded in a single full build, and the reports."""
    raw = bronze(spark, SMALL)
    stepwise, whole = (Lake(spark, str(tmp_path_factory.mktemp(n))) for n in ("stepwise", "whole"))
    first = refresh(spark, early(raw), stepwise)
    second = refresh(spark, loaded_later(raw), stepwise)
    full = refresh(spark, raw, whole, full_refresh=True)
    return raw, stepwise, whole, (first, second, full)


def test_two_loads_equal_one_full_build(built):
    _, stepwise, whole, _ = built
    for table in LAYERS[FACTS]:
        assert same(stepwise.read(FACTS, table), whole.read(FACTS, table)), table
    for table in LAYERS[DIMENSIONS]:
        assert same(stepwise.read(DIMENSIONS, table), whole.read(DIMENSIONS, table)), table


def test_the_second_load_is_incremental(built):
    _, stepwise, _, (first, second, full) = built
    for table in LAYERS[FACTS]:
        total = stepwise.read(FACTS, table).count()
        assert first.bounds[table] is None and full.bounds[table] is None
        assert dt.date(2000, 12, 1) < second.bounds[table] < dt.date(2001, 1, 1)
        assert 0 < second.merges[table].source_rows < total / 3
    # A month's key fixes its month; a corrected event also touches the month it leaves.
    months = second.merges[facts.MONTH_FACT]
    assert months.partitions_rewritten <= 10 and months.rows_written < months.source_rows * 2


def test_staging_follows_the_rows_that_were_loaded(built):
    raw, stepwise, whole, (first, second, full) = built
    for table in MERGED_STAGING:
        held = shown(stepwise.read(STAGING, table))
        assert same(held, shown(whole.read(STAGING, table))) and same(held, Star(raw)[table]), table
        assert first.staged[table].first_load and full.staged[table].first_load and not second.staged[table].first_load
        assert 0 < second.staged[table].source_rows < held.count() / 3
        if table == quality.MONTHS:
            # (Corrections of events come from all over the years.)
            assert second.staged[table].partitions_rewritten < held.select("snapshot_month").distinct().count() / 2
        again = restage(stepwise, table, loaded_later(raw), Audit.of_run())
        assert again.source_rows == again.partitions_rewritten == 0 and same(held, shown(stepwise.read(STAGING, table)))


def test_deleted_raw_rows_are_reported(built):
    raw, stepwise, _, _ = built
    parity = [c for c in quality.extra_rules() if c.rule == "arrivals_staged"]
    assert all(r.violations == 0 for r in checks.report(stored(stepwise, raw), parity).collect())
    thinned = Bronze(lambda: raw.customers, lambda: raw.zips, lambda: raw.months, lambda: raw.events.filter("channel != 'Chat'"))
    found = {r.table_name: r.violations for r in checks.report(stored(stepwise, thinned), parity).collect()}
    assert found == {quality.MONTHS: 0, quality.EVENTS: 1}
    with pytest.raises(checks.QualityError, match="arrivals_staged"):
        checks.gate(checks.report(stored(stepwise, thinned), parity))


def test_a_failed_check_of_a_fact_leaves_it_as_it_was(spark, built, tmp_path):
    raw, lake = built[0], Lake(spark, str(tmp_path))
    refresh(spark, early(raw), lake)
    before = {t: lake.read(FACTS, t).collect() for t in LAYERS[FACTS]}
    latest = {r[0] for r in lake.read(FACTS, facts.EVENT_FACT).select("support_event_id").collect()}
    # Only the merged rows break it: events that the first load did not have.
    strict = checks.Check(facts.EVENT_FACT, "known_events", query=lambda t: t[facts.EVENT_FACT].filter(~F.col("support_event_id").isin(sorted(latest)[:2000]) & (F.col("source_updated_at") >= F.expr(SPLIT))))
    with pytest.raises(checks.QualityError, match="known_events"):
        refresh(spark, loaded_later(raw), lake, checks=[strict])
    assert sorted(lake.read(FACTS, facts.EVENT_FACT).collect()) == sorted(before[facts.EVENT_FACT])
    assert sorted(p for p in os.listdir(f"{lake.root}/{FACTS}") if facts.EVENT_FACT in p) == [facts.EVENT_FACT, f"{facts.EVENT_FACT}__keys"]
    # The next run, without it, catches up.
    refresh(spark, loaded_later(raw), lake)
    assert same(lake.read(FACTS, facts.EVENT_FACT), built[1].read(FACTS, facts.EVENT_FACT))


def test_a_part_of_the_star_is_refreshed_alone(spark, built, tmp_path):
    raw, _, whole, _ = built
    lake = Lake(spark, str(tmp_path))
    refresh(spark, early(raw), lake, through=STAGING)
    assert all(lake.exists(STAGING, t) for t in LAYERS[STAGING])
    assert not any(lake.exists(layer, t) for layer in (ENTITIES, DIMENSIONS, FACTS) for t in LAYERS[layer])
    early_run = refresh(spark, early(raw), lake, only_facts=[facts.EVENT_FACT])
    assert set(early_run.merges) == {facts.EVENT_FACT} and not lake.exists(FACTS, facts.MONTH_FACT)
    refresh(spark, loaded_later(raw), lake, through=DIMENSIONS)
    for table in LAYERS[DIMENSIONS]:
        assert same(lake.read(DIMENSIONS, table), whole.read(DIMENSIONS, table))
    # The facts catch up, each from its own watermark.
    report = refresh(spark, loaded_later(raw), lake)
    assert report.bounds[facts.MONTH_FACT] is None and report.bounds[facts.EVENT_FACT] is not None
    for table in LAYERS[FACTS]:
        assert same(lake.read(FACTS, table), whole.read(FACTS, table))


def test_an_unknown_part_is_refused(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for part in ({"through": "silver"}, {"only_facts": ["fct_nothing"]}):
        with pytest.raises(ValueError, match="there are"):
            refresh(spark, None, lake, **part)


def test_stored_facts_equal_the_lazy_ones(spark, built):
    raw, _, whole, _ = built
    lazy = Star(raw)
    for table in LAYERS[FACTS]:
        assert same(lazy[table], whole.read(FACTS, table)), table


def test_the_report_covers_all_checks_and_finds_the_defects(built):
    raw, _, whole, _ = built
    results = {r.check_name: r for r in checks.report(stored(whole, raw), quality.all_checks()).collect()}
    assert len(results) == 151 + 15
    found = {name: r.violations for name, r in results.items() if r.violations}
    # Deliberate defects of the raw tables, and nothing else.
    assert {n.split(":")[0] for n in found} <= {
        *("not_null", "accepted_values", "relationship", "range"),
        *("resolution_consistency", "revenue_reconciles", "fact_keys_present", "negative_charges"),
    }
    assert results["negative_charges:stg_telecom_customer_churn"].severity == "warn"
    assert found["fact_keys_present:fct_customer_monthly_snapshot"] == found["not_null:fct_support_event:date_key"]
    with pytest.raises(checks.QualityError):
        checks.gate(checks.report(stored(whole, raw), [c for c in quality.column_checks() if c.name in found][:3]))


def test_a_failed_check_stops_the_run_before_the_next_layer(spark, built, tmp_path):
    raw, lake = built[0], Lake(spark, str(tmp_path))
    impossible = checks.Check(quality.MONTH_360, "accepted_values", "customer_count", allowed=(2,))
    warning = checks.Check(quality.MONTHS, "accepted_values", "customer_status", checks.WARN, allowed=("none",))
    with pytest.raises(checks.QualityError, match="int_customer_monthly_360"):
        refresh(spark, raw, lake, checks=[impossible, warning])
    assert all(lake.exists(ENTITIES, t) for t in LAYERS[ENTITIES])
    assert not any(lake.exists(layer, t) for layer in (DIMENSIONS, FACTS) for t in LAYERS[layer])


def test_a_checked_run_builds_the_same_facts(spark, built, tmp_path):
    raw, _, whole, _ = built
    lake, grain = Lake(spark, str(tmp_path)), [c for c in quality.business_rules() if c.rule.startswith("duplicate")]
    for source in (early(raw), raw):
        refresh(spark, source, lake, checks=grain)
    for table in LAYERS[FACTS]:
        assert same(lake.read(FACTS, table), whole.read(FACTS, table)), table


def test_the_catalogue_is_complete():
    declared = quality.column_checks()
    by_rule = Counter(c.rule for c in declared)
    assert by_rule == {"not_null": 72, "unique": 22, "accepted_values": 38, "relationship": 14, "range": 5}
    assert Counter(c.severity for c in declared)["warn"] == 6
    rules = quality.business_rules()
    assert len(rules) == 15 and Counter(c.severity for c in rules)["warn"] == 1
    assert len({c.name for c in quality.all_checks()}) == 166


def test_the_watermark_may_sink_below_the_deduplication(spark):
    raw, audit = bronze(spark, SMALL), Audit.of_run()
    bound = dt.date(1999, 6, 1)
    above = since(staging.stg_months(raw.months, audit), "source_updated_at", bound)
    assert above.count() > 0 and same(above, recent_months(raw.months, bound, audit))


def test_a_hot_customer_changes_nothing_but_the_plan(spark):
    """A third of all months and events on one customer: dealt out, the rows stay the same."""
    raw = bronze(spark, SMALL)
    hot = F.when(F.col("etl_file_row_number") % 3 == 0, F.lit("C0000007")).otherwise(F.col("customer_id"))
    skewed = Bronze(
        lambda: raw.customers,
        lambda: raw.zips,
        lambda: raw.months.withColumn("customer_id", hot),
        lambda: raw.events.withColumns({"customer_id": hot, "event_timestamp": F.lit("1998-05-05").cast("timestamp")}),
    )
    plain = Star(skewed)
    heavy = HeavyKeys.of(plain["stg_customer_monthly_snapshot"], plain["stg_customer_support_events"])
    assert "C0000007" in heavy.customers and "C0000007|1998-05-01" in heavy.customer_months
    assert not heavy.of_months
    heavy = HeavyKeys.of(plain["stg_customer_monthly_snapshot"], plain["stg_customer_support_events"], plain.customers)
    key_of = lambda text: hashlib.md5(text.encode()).hexdigest()
    for found in (heavy.of_months, heavy.of_events):
        assert key_of("C0000007") in found["customer_key"] and len(found["geography_key"]) > 1 and found["service_profile_key"]
        # Customers nobody knows have no ZIP, and a missing ZIP hashes to a key of its own.
        assert key_of(NULL_TOKEN) in found["geography_key"]
    dealt = Star(skewed, heavy=heavy)
    for table in ("int_customer_monthly_360", "int_support_event_enriched", facts.MONTH_FACT, facts.EVENT_FACT):
        assert same(plain[table], dealt[table]), table


def test_calendar_is_a_parameter(spark):
    from starloom.operators.calendar import fixed_bounds

    star = Star(bronze(spark, SMALL), calendar=fixed_bounds(spark, "2024-01-01", "2027-01-01"))
    assert star["dim_date"].count() == 1096


def test_two_sources_of_one_profile_make_a_duplicate_key(spark):
    audit = Audit.of_run()
    customers = staging.stg_customers(bronze(spark, SMALL).customers, audit).limit(1)
    twice = customers.unionByName(customers.withColumn("etl_source_system", F.lit("OTHER")))
    dim = dimensions.dim_service_profile(entities.service_profile(twice, audit), audit)
    check = checks.Check("d", "unique", "service_profile_key")
    assert checks.report({"d": dim}, [check]).first().violations == 1


def test_a_missing_zip_matches_only_a_missing_zip_member(spark, rows):
    audit = Audit.of_run()
    geography = rows("zip_code string, city string, state string, region string, latitude double, longitude double, "
                     "population bigint, is_population_valid boolean, etl_source_system string",
                     (None, "Nowhere", None, None, None, None, None, None, "S"))
    dim = dimensions.dim_geography(geography, audit)
    months = rows("id string, zip_code string", ("a", None), ("b", "00601"))
    from starloom.functions.keys import surrogate_key, unknown_key
    from starloom.operators.lookup import resolve_key

    keyed = months.select("id", surrogate_key(F.col("zip_code")).alias("geography_key"))
    got = resolve_key(keyed, dim, key="geography_key", unknown=unknown_key(), matched="hit")
    assert {r.id: r.hit for r in got.collect()} == {"a": True, "b": False}


def test_merge_settings_name_the_fact_keys():
    assert MERGES[facts.MONTH_FACT]["key"] == "customer_monthly_snapshot_key"
    assert not MERGES[facts.EVENT_FACT]["key_fixes_month"]


# --- each business rule with a failing and a passing input --------------------------------


@pytest.fixture(scope="module")
def sound_months(spark):
    """Months that contradict nothing."""
    columns = ("customer_monthly_snapshot_key", *quality.FACT_KEYS, "customer_count", "monthly_charge", "monthly_revenue_lost")
    churned = Star(bronze(spark, SMALL))[facts.MONTH_FACT].filter("is_churned")
    return churned.select(*columns, *quality.COUNTED_IN_FACT, *quality.COUNTED_IN_FACT.values()).persist()


@pytest.mark.parametrize(
    "column, wrong",
    [
        ("customer_count", "2"),
        ("churned_customer_count", "0"),
        ("stayed_customer_count", "1"),
        ("is_stayed", "true"),
        ("monthly_revenue_lost", "cast(-1 as decimal(18,2))"),
    ],
)
def test_inconsistent_months_are_found(sound_months, column, wrong):
    n = sound_months.count()
    assert n > 0 and quality.inconsistent_months(sound_months, quality.COUNTED_IN_FACT).count() == 0
    broken = sound_months.withColumn(column, F.expr(wrong))
    assert quality.inconsistent_months(broken, quality.COUNTED_IN_FACT).count() == n


def test_the_360_rule_leaves_two_counts_unchecked(sound_months):
    broken = sound_months.withColumn("stayed_customer_count", F.lit(1))
    assert quality.inconsistent_months(broken, quality.COUNTED).count() == 0


def test_resolution_rule(rows):
    schema = "support_event_id string, resolution_status string, resolution_hours int, satisfaction_score int"
    good = [("a", "Pending", None, None), ("b", "Resolved", 1, 5), ("c", None, None, 1), ("d", "Other", 1, None)]
    bad = [("e", "Pending", 1, None), ("f", "Escalated", None, 3), ("g", "Closed - Unresolved", 2, None)]
    found = quality.unresolved_mismatch(rows(schema, *good, *bad))
    assert {r.support_event_id for r in found.collect()} == {"e", "f", "g"}


def test_missing_fact_keys_are_listed(sound_months):
    one = sound_months.limit(1).withColumn("date_key", F.lit(None).cast("int"))
    found = quality.null_key_flags(one, "m", "customer_monthly_snapshot_key", quality.FACT_KEYS)
    assert [r.null_fk_flags for r in found.collect()] == ["false|false|false|false|true"]
    assert quality.null_key_flags(sound_months, "m", "customer_monthly_snapshot_key", quality.FACT_KEYS).isEmpty()


def test_events_of_a_customer_are_shuffled_once_for_their_month_and_their_key(spark, built):
    """Missing and unknown customers keep their rows, and the customer lookup of the event fact shuffles no events."""
    from starloom.functions.keys import surrogate_key, unknown_key
    from starloom.operators.lookup import left_lookup, resolve_member

    ids = "case when id % 7 = 0 then null when id % 5 = 0 then 'nobody' else concat('c', id % 11) end as customer_id"
    events = spark.range(500).selectExpr("string(id) as event", ids, "date_add(date'2025-01-01', int(id % 3)) as at")
    months = spark.range(11).selectExpr("concat('c', id) as customer_id", "date'2025-01-02' as at", "id as v")
    known = spark.range(9).selectExpr("concat('c', id) as customer_id").unionByName(spark.createDataFrame([(None,)], "customer_id string"))
    members = known.select(surrogate_key(F.col("customer_id")).alias("k"), "customer_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = left_lookup(events, months, ["customer_id", "at"], matched="has_month", spread_by="event", meet_by_first=True)
        how = {"member": "customer_id", "key": "k", "key_of": surrogate_key(F.col("customer_id")), "missing": NULL_TOKEN}
        found = resolve_member(met, members, **how, unknown=unknown_key(), matched="is_known", spread_by="event")
        got = {r.event: r for r in found.collect()}
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found.count() == len(got) == 500
    for r in events.collect():
        of = got[r.event]
        assert of.has_month == (r.customer_id not in (None, "nobody") and str(r["at"]) == "2025-01-02")
        assert of.is_known == (r.customer_id in {None, *[f"c{i}" for i in range(9)]})
        text = NULL_TOKEN if r.customer_id is None else r.customer_id
        assert of.k == hashlib.md5((text if of.is_known else "UNKNOWN").encode()).hexdigest()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("SortMergeJoin") == 2 and final.count("Exchange hashpartitioning") == 3
