import datetime as dt

from starloom.functions.audit import AUDIT_COLUMNS, Audit
from starloom.functions.dates import month_floor
from starloom.operators.dedup import latest_rows
from starloom.plans.staging import stg_events
from starloom.sources.bronze import EVENT_SCHEMA
from starloom.sources.lake import FACTS, Lake
from starloom.streaming.merge import merge_stream, raw_stream
from pyspark.sql import functions as F

MERGE = {"key": "support_event_id", "month": "event_month", "key_fixes_month": False}


def build(raw):
    staged = stg_events(raw, Audit.of_run()).drop(*AUDIT_COLUMNS)
    return staged.withColumn("event_month", month_floor(F.col("event_timestamp")))


def raw_rows(spark, *versions):
    """(id, event day, update day, status, line) in January or February 2025."""
    columns = "id string, at timestamp, updated timestamp, status string, line bigint"
    df = spark.createDataFrame([(i, a, u, s, n) for i, a, u, s, n in versions], columns)
    given = {"support_event_id": "id", "event_timestamp": "at", "updated_at": "updated", "resolution_status": "status"}
    given |= {"etl_file_row_number": "line", "customer_id": "'C1'", "etl_source_system": "'CRM'"}
    empty = spark.createDataFrame([], EVENT_SCHEMA)
    return df.selectExpr(*[f"cast({given.get(f.name, 'null')} as {f.dataType.simpleString()}) as {f.name}" for f in empty.schema])


def test_batches_in_any_order_give_the_batch_result(spark, tmp_path):
    jan, feb = dt.datetime(2025, 1, 20), dt.datetime(2025, 2, 3)
    newer = raw_rows(spark, ("e1", feb, feb, "Resolved", 1), ("e2", jan, jan, "Pending", 2), ("e4", jan, None, "Pending", 1))
    older = raw_rows(spark, ("e1", jan, jan, "Pending", 3), ("e3", jan, jan, "Resolved", 4), ("e2", jan, feb, "Escalated", 5))
    landing, lake = f"{tmp_path}/landing", Lake(spark, f"{tmp_path}/lake")

    for files in (newer, older):
        files.coalesce(1).write.mode("append").parquet(landing)
        merge_stream(raw_stream(spark, landing, newer.schema, 1), lake, "events", build, newer_by="source_updated_at", **MERGE)

    streamed = lake.read(FACTS, "events")
    batch = build(newer.unionByName(older))
    columns = sorted(batch.columns)
    assert sorted(streamed.columns) == columns
    assert streamed.count() == 4
    assert streamed.select(columns).exceptAll(batch.select(columns)).isEmpty()
    assert {r.support_event_id: r.resolution_status for r in streamed.collect()}["e1"] == "Resolved"
    assert latest_rows(streamed, "support_event_id", ["source_updated_at"]).count() == 4
