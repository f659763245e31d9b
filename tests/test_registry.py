"""Registered queries against their SQL in DuckDB, on the smallest test tables."""

import re

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from starloom.plans.star import LAYERS, Star
from starloom.registry.sql_tables import PARTS
from starloom.sources.adapters import TEST_SCHEMAS, bronze
from starloom.sources.bronze import REQUIRED, SCHEMAS, freshness, read_files

COMPARED = [
    *("src_scan", "clean_text", "safe_cast", "yes_no_bool", "zip_normalize", "dedup_latest", "dedup_latest_by_load"),
    *("valid_flags", "reconcile", "with_audit", "safe_ratio", "flag_any", "surrogate_key", "period_enrich"),
    *("fk_lookup", "rep_min", "count_distinct_groups", "star_rollup", "date_dim", "hwm_read", "upsert", "schema_sync"),
    *("full_refresh", "dim_overwrite", "freshness", "stream_upsert", "chk_relationship_staging", "chk_fk_flags", "chk_date_keys_fixed_range", "chk_relationship_extra", "chk_zip_cut"),
    *("staging_increment", "entity_360_skewed", "period_enrich_skewed", "fk_lookup_skewed"),
    *("model_int_customer_monthly_360", "model_fct_customer_monthly_snapshot", "model_fct_support_event"),
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TEST_SCHEMAS:
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_its_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SMALL)
    found = duck.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    expected = sorted([[str(row[columns.index(c)]) for c in sorted(columns)] for row in found.fetchall()])
    assert sorted([[str(row[c]) for c in sorted(columns)] for row in df.collect()]) == expected


@pytest.mark.parametrize("name", [n for n in entry_points.QUERIES if n.startswith("chk_spoiled_")])
def test_spoiled_tables_break_their_rule(spark, duck, name):
    test_query_equals_its_sql(spark, duck, name)
    assert duck.execute(entry_points.oracle_sql()[name]).fetchall()


def test_every_query_has_sql():
    assert set(entry_points.QUERIES) == set(entry_points.SQL)
    tables = {t for names in LAYERS.values() for t in names}
    assert len(tables) == 18 and {f"model_{t}" for t in tables} < set(entry_points.queries())


def test_every_query_reads_the_test_tables():
    for name, sql in entry_points.SQL.items():
        assert re.search(rf"(FROM|JOIN) ({'|'.join(TEST_SCHEMAS)})\b", sql), name
    assert not set(PARTS) & set(TEST_SCHEMAS)


def test_the_flagship_query_runs(spark):
    assert entry_points.entry(spark).count() > 0


def test_raw_tables_read_with_their_stated_schema(spark, tmp_path):
    made = bronze(spark, SMALL)
    for name in SCHEMAS:
        made[name].write.parquet(f"{tmp_path}/{name}")
    read = read_files(spark, str(tmp_path))
    for name, required in REQUIRED.items():
        assert set(required) <= set(read[name].columns)
        given = {f.name: f.dataType for f in made[name].schema}
        assert {f.name: f.dataType for f in read[name].schema} == given
    assert Star(read)["dim_churn_reason"].count() == Star(made)["dim_churn_reason"].count()


def test_freshness_verdicts(rows):
    import datetime as dt

    df = rows("ts timestamp", (dt.datetime(2025, 1, 1),))
    verdicts = {"2025-01-02 00:30:00": "pass", "2025-01-02 01:00:00": "warn", "2025-01-04 01:00:00": "error"}
    for as_of, verdict in verdicts.items():
        assert freshness(df, "ts", as_of).first().freshness == verdict
    empty = freshness(df.filter("false"), "ts", "2025-01-01").collect()
    assert [(r.newest, r.freshness) for r in empty] == [(None, "error")]
