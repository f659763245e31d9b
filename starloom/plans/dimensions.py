"""Entities -> dimensions. Each holds an Unknown member, so every fact has something to point to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.audit import AUDIT_COLUMNS, Audit
from starloom.functions.keys import (
    NOT_APPLICABLE,
    UNKNOWN,
    UNKNOWN_ID,
    literal_key,
    reason_key,
    surrogate_key,
    unknown_key,
)
from starloom.operators.calendar import calendar_attributes, days
from starloom.operators.members import with_member
from starloom.plans.entities import BUNDLES, CONFIGURATION
from starloom.plans.staging import CHURNED

# Fixed value: the source-system label of churn reasons.
REASON_SOURCE = "MAVEN_SYNTHETIC"


def _with_unknown(rows: DataFrame, key: str, audit: Audit, **labels) -> DataFrame:
    real = rows.withColumn("is_unknown_member", F.lit(False))
    source = real.columns.index("etl_source_system")
    ordered = [c for c in real.columns if c != "etl_source_system"] + [real.columns[source]]
    member = {key: unknown_key(), "is_unknown_member": True, **labels}
    return audit.on(with_member(real.select(ordered), member))


def dim_customer(profile: DataFrame, audit: Audit) -> DataFrame:
    rows = profile.drop("zip_code", *AUDIT_COLUMNS)
    keyed = rows.select(surrogate_key(F.col("customer_id")).alias("customer_key"), "*")
    return _with_unknown(
        keyed,
        "customer_key",
        audit,
        customer_id=UNKNOWN_ID,
        gender=UNKNOWN,
        age_band=UNKNOWN,
        current_tenure_band=UNKNOWN,
    )


def dim_geography(geography: DataFrame, audit: Audit) -> DataFrame:
    keyed = geography.select(
        surrogate_key(F.col("zip_code")).alias("geography_key"),
        *("zip_code", "city", "state", "region", "latitude", "longitude"),
        *("population", "is_population_valid", "etl_source_system"),
    )
    return _with_unknown(keyed, "geography_key", audit, zip_code=UNKNOWN_ID, city=UNKNOWN)


def dim_service_profile(services: DataFrame, audit: Audit) -> DataFrame:
    """Distinct configurations. The source system is part of what is distinct but not of the
    key, so one configuration from two sources makes two rows of one key."""
    distinct = services.select("service_profile_key", *CONFIGURATION, *BUNDLES, "etl_source_system").distinct()
    return _with_unknown(
        distinct, "service_profile_key", audit, offer=UNKNOWN, contract_type=UNKNOWN, internet_type=UNKNOWN
    )


def dim_churn_reason(status: DataFrame, audit: Audit) -> DataFrame:
    """Reasons seen on churned customers, a member for months that are not churned and one for
    churned months without a reason."""
    pair = ("churn_category", "churn_reason")
    given = F.col("churn_category").isNotNull() | F.col("churn_reason").isNotNull()
    real = (
        status.filter((F.col("customer_status") == CHURNED) & given)
        .select(*pair)
        .distinct()
        .select(
            reason_key(*map(F.col, pair)).alias("churn_reason_key"),
            *pair,
            F.lit("Real").alias("member_type"),
            F.lit(False).alias("is_unknown_member"),
            F.lit(REASON_SOURCE).alias("etl_source_system"),
        )
    )
    for label in (NOT_APPLICABLE, UNKNOWN):
        special = dict.fromkeys((*pair, "member_type"), label)
        special |= {"churn_reason_key": literal_key(label, label), "is_unknown_member": label == UNKNOWN}
        real = with_member(real, special)
    return audit.on(real)


def dim_date(bounds: DataFrame, audit: Audit) -> DataFrame:
    return days(bounds).select(*calendar_attributes(), *audit.columns())
