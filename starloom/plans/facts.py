"""Entities and dimensions -> facts, and the star query they are made for."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.audit import Audit
from starloom.functions.dates import date_key
from starloom.functions.keys import NULL_TOKEN, routed_reason_key, surrogate_key, unknown_key
from starloom.operators.lookup import heavy_values, resolve_key, resolve_member
from starloom.plans.entities import service_columns

MONTH_FACT, EVENT_FACT = "fct_customer_monthly_snapshot", "fct_support_event"
MONTH_KEY, EVENT_KEY = "customer_monthly_snapshot_key", "support_event_key"

DIMENSION_KEYS = {
    "customer_key": "is_customer_matched",
    "geography_key": "is_geography_matched",
    "service_profile_key": "is_service_profile_matched",
}
DELIVERY = ("source_updated_at", "source_batch_id", "source_system", "etl_source_system")


Heavy = Mapping[str, list[str]]


def heavy_dimension_keys(rows: DataFrame, customers: DataFrame) -> dict[str, list[str]]:
    """Dimension keys that hold many of ``rows(customer_id)``, also the key that a missing id or ZIP hashes to.

    The rows shrink to one count per customer before they meet the staged customers.
    """
    counts = rows.groupBy("customer_id").agg(F.count("*").alias("n_rows"))
    service_key = service_columns()[0]
    known = customers.select(F.col("customer_id").alias("known_id"), "zip_code", service_key)
    met = counts.join(known, F.col("customer_id") == F.col("known_id"), "left")
    keyed = met.select(
        surrogate_key(F.col("customer_id")).alias("customer_key"),
        surrogate_key(F.col("zip_code")).alias("geography_key"),
        "service_profile_key",
        "n_rows",
    )
    return heavy_values(keyed, list(DIMENSION_KEYS), "n_rows")


def with_dimension_keys(
    rows: DataFrame,
    row_id: str,
    customers: DataFrame,
    geography: DataFrame,
    services: DataFrame,
    heavy: Heavy | None = None,
) -> DataFrame:
    """Keys of the three looked-up dimensions, Unknown where there is no such member.

    ``rows`` brings its service key along, missing where the customer is not known; the other
    two are hashed here and never missing. ``heavy`` lists the keys of each dimension that hold many rows;
    all three lookups deal these rows out by the same hash of ``row_id``. Without heavy customers, rows are looked up by
    customer id where the join to their customer's months or attributes has left them.
    """
    customer_key, heavy = surrogate_key(F.col("customer_id")), heavy or {}
    keyed, others = rows.withColumn("geography_key", surrogate_key(F.col("zip_code"))).drop("zip_code"), dict(DIMENSION_KEYS)
    found = {"key": "customer_key", "unknown": unknown_key(), "matched": others.pop("customer_key"), "spread_by": row_id}
    if heavy.get("customer_key"):
        keyed = resolve_key(keyed.withColumn("customer_key", customer_key), customers, heavy=heavy["customer_key"], **found)
    else:
        keyed = resolve_member(keyed, customers, member="customer_id", key_of=customer_key, missing=NULL_TOKEN, **found)
    for dimension, (key, matched) in zip((geography, services), others.items()):
        many = heavy.get(key)
        spread = row_id if many or key == "service_profile_key" else None
        skew = {"spread_by": spread, "heavy": many}
        keyed = resolve_key(keyed, dimension, key=key, unknown=unknown_key(), matched=matched, **skew)
    return keyed


def fact_months(
    months: DataFrame,
    customers: DataFrame,
    geography: DataFrame,
    services: DataFrame,
    audit: Audit,
    heavy: Heavy | None = None,
) -> DataFrame:
    """One row per customer and month. Reads only the fact's share of the wide month rows."""
    measures = (
        *("monthly_charge", "monthly_revenue", "total_revenue", "monthly_revenue_lost"),
        *("customer_count", "eligible_customer_count", "churned_customer_count"),
        *("stayed_customer_count", "new_customer_count"),
        *("is_churned", "is_stayed", "is_new_customer", "is_churn_eligible", "data_quality_status"),
    )
    identity = ("monthly_snapshot_id", "customer_id", "snapshot_month", "tenure_months")
    reason = routed_reason_key(*map(F.col, ("is_churned", "churn_category", "churn_reason")))
    rows = months.select(
        reason.alias("churn_reason_key"),
        date_key(F.col("snapshot_month")).alias("date_key"),
        *identity,
        *("zip_code", "service_profile_key"),
        *measures,
        *DELIVERY,
    )
    return with_dimension_keys(rows, "monthly_snapshot_id", customers, geography, services, heavy).select(
        surrogate_key(F.col("customer_id"), F.col("snapshot_month")).alias(MONTH_KEY),
        *DIMENSION_KEYS,
        *("churn_reason_key", "date_key"),
        *DIMENSION_KEYS.values(),
        *identity,
        *measures,
        *DELIVERY,
        *audit.columns(),
    )


def fact_events(
    events: DataFrame,
    customers: DataFrame,
    geography: DataFrame,
    services: DataFrame,
    audit: Audit,
    heavy: Heavy | None = None,
) -> DataFrame:
    """One row per support event; geography and services are those of the event's month."""
    details = (
        *("support_event_id", "customer_id", "event_timestamp", "event_date", "event_month"),
        *("issue_category", "channel", "priority", "resolution_status"),
        *("customer_status_at_event_month", "contract_type_at_event_month", "internet_type_at_event_month"),
    )
    measures = (
        *("resolution_hours", "satisfaction_score", "is_resolved", "is_escalated"),
        *("is_resolution_hours_valid", "is_satisfaction_score_valid"),
    )
    rows = events.select(
        date_key(F.col("event_date")).alias("date_key"),
        "is_customer_snapshot_matched",
        *details,
        *("zip_code", "service_profile_key"),
        *measures,
        *DELIVERY,
    )
    return with_dimension_keys(rows, "support_event_id", customers, geography, services, heavy).select(
        surrogate_key(F.col("support_event_id")).alias(EVENT_KEY),
        *DIMENSION_KEYS,
        "date_key",
        *DIMENSION_KEYS.values(),
        "is_customer_snapshot_matched",
        *details,
        F.lit(1).alias("event_count"),
        *measures,
        *DELIVERY,
        *audit.columns(),
    )


def _share(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")


def churn_by_month_and_city(facts: DataFrame, geography: DataFrame) -> DataFrame:
    """Churn rate, eligible customers and revenue lost by month and city.

    Facts shrink to one row per month and ZIP key before they meet the dimension.
    """
    measures = ("customer_count", "eligible_customer_count", "churned_customer_count", "monthly_revenue_lost")
    per_key = facts.groupBy("snapshot_month", "geography_key").agg(*[F.sum(m).alias(m) for m in measures])
    places = geography.select("geography_key", "city")
    totals = (
        per_key.join(places, "geography_key", "left")
        .groupBy("snapshot_month", "city")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    return totals.select(
        "snapshot_month",
        "city",
        F.col("customer_count").alias("customers"),
        F.col("eligible_customer_count").alias("eligible"),
        F.col("churned_customer_count").alias("churned"),
        _share(F.col("churned_customer_count"), F.col("eligible_customer_count")).alias("churn_rate"),
        F.col("monthly_revenue_lost").cast("decimal(18,2)").alias("revenue_lost"),
    )
