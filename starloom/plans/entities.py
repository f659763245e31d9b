"""Staging -> business entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import flags
from starloom.functions.audit import AUDIT_COLUMNS, Audit
from starloom.functions.dates import month_floor, months_before
from starloom.functions.keys import surrogate_key
from starloom.functions.numbers import MONEY, amount_if, safe_ratio
from starloom.operators.lookup import left_lookup
from starloom.plans.staging import churn_flags, stated_revenue_parts

# The bands.
AGE_CUTS, AGE_TOP = [(30, "18-29"), (45, "30-44"), (60, "45-59")], "60+"
TENURE_CUTS = [(6, "0-6 months"), (12, "7-12 months"), (24, "13-24 months"), (48, "25-48 months")]
TENURE_TOP = "49+ months"

# The quality classes of a month, in order of precedence.
QUALITY = ("MISSING_CUSTOMER_ID", "INVALID_SNAPSHOT_MONTH", "INVALID_MONTHLY_CHARGE", "MISSING_ZIP_CODE", "VALID")

STREAMING = ("has_streaming_tv", "has_streaming_movies", "has_streaming_music")
SECURITY = ("has_online_security", "has_online_backup", "has_device_protection")
SERVICE_FLAGS = (
    "has_phone_service",
    "has_multiple_lines",
    "has_internet_service",
    *SECURITY,
    "has_premium_tech_support",
    *STREAMING,
    "has_unlimited_data",
)
# The attributes that make up a service configuration, in hashing order.
CONFIGURATION = ("offer", "contract_type", "internet_type", *SERVICE_FLAGS)
BUNDLES = ("service_count", "has_any_streaming_service", "has_streaming_bundle", "has_security_bundle")


def age_band(age: Column) -> Column:
    return flags.band(age, AGE_CUTS, AGE_TOP, closed=False)


def tenure_band(tenure: Column) -> Column:
    return flags.band(tenure, TENURE_CUTS, TENURE_TOP, closed=True)


def latest_month(months: DataFrame) -> DataFrame:
    return months.groupBy("customer_id").agg(F.max("snapshot_month").alias("latest_snapshot_month"))


def profile_columns() -> list[Column]:
    """Profile of a staged customer that carries its ``latest_snapshot_month``."""
    tenure = F.col("tenure_months")
    return [
        F.col("gender"),
        F.col("age"),
        age_band(F.col("age")).alias("age_band"),
        F.col("is_married"),
        F.col("number_of_dependents").alias("dependent_count"),
        F.col("number_of_referrals").alias("referral_count"),
        F.col("zip_code"),
        months_before(F.col("latest_snapshot_month"), tenure).alias("first_join_month"),
    ]


def customer_profile(customers: DataFrame, months: DataFrame, audit: Audit) -> DataFrame:
    """Demographics, ZIP, bands and the estimated month of joining; one row per customer."""
    tenure = F.col("tenure_months")
    return left_lookup(customers, latest_month(months), ["customer_id"]).select(
        "customer_id",
        *profile_columns(),
        tenure.alias("current_tenure_months"),
        tenure_band(tenure).alias("current_tenure_band"),
        "etl_source_system",
        *audit.columns(),
    )


def _staged(name: str) -> Column:
    """A service attribute by the name it has in staging."""
    return F.col({"contract_type": "contract", "has_device_protection": "has_device_protection_plan"}.get(name, name))


def service_columns() -> list[Column]:
    """Configuration of a staged customer: its key, its attributes and the bundles they make."""
    streaming, security = [_staged(c) for c in STREAMING], [_staged(c) for c in SECURITY]
    return [
        surrogate_key(*map(_staged, CONFIGURATION)).alias("service_profile_key"),
        *[_staged(c).alias(c) for c in CONFIGURATION],
        flags.true_count(*map(_staged, SERVICE_FLAGS)).alias("service_count"),
        flags.any_true(*streaming).alias("has_any_streaming_service"),
        flags.at_least_true(2, *streaming).alias("has_streaming_bundle"),
        flags.all_true(*security).alias("has_security_bundle"),
    ]


def service_profile(customers: DataFrame, audit: Audit) -> DataFrame:
    """Current service configuration; one row per customer."""
    return customers.select(
        "customer_id",
        *service_columns(),
        "avg_monthly_gb_download",
        F.col("avg_monthly_long_distance_charges").alias("avg_monthly_long_distance_charge"),
        "etl_source_system",
        *audit.columns(),
    )


def customer_financial(customers: DataFrame, audit: Audit) -> DataFrame:
    """Money columns with the reconciliation difference and the average month."""
    stated = F.col("total_revenue")
    return customers.select(
        "customer_id",
        "monthly_charge",
        "total_charges",
        "total_refunds",
        "total_extra_data_charges",
        "total_long_distance_charges",
        "total_revenue",
        "calculated_total_revenue",
        (stated - stated_revenue_parts()).cast(MONEY).alias("revenue_reconciliation_difference"),
        "is_total_revenue_reconciled",
        "is_monthly_charge_valid",
        safe_ratio(stated, F.col("tenure_months")).alias("average_monthly_revenue"),
        "tenure_months",
        F.col("contract").alias("contract_type"),
        "payment_method",
        "is_paperless_billing",
        "etl_source_system",
        *audit.columns(),
    )


def churn_status(customers: DataFrame, audit: Audit) -> DataFrame:
    """Terminal churn status of a customer and the monthly revenue its churn cost."""
    state = churn_flags()
    return customers.select(
        "customer_id",
        "customer_status",
        "churn_category",
        "churn_reason",
        *[c.alias(n) for n, c in state.items()],
        amount_if(state["is_churned"], F.col("monthly_charge")).alias("monthly_revenue_lost_current"),
        "etl_source_system",
        *audit.columns(),
    )


def zip_attributes(customers: DataFrame) -> DataFrame:
    """Smallest city, latitude and longitude per ZIP, each taken by itself.

    The first aggregation has numeric buffers only, so it runs as a hash aggregate and shrinks
    the customers to (ZIP, city) pairs before the text minimum, which Spark can only sort for.
    """
    pairs = (
        customers.filter(F.col("zip_code").isNotNull())
        .groupBy("zip_code", "city")
        .agg(F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude"))
    )
    return pairs.groupBy("zip_code").agg(*[F.min(c).alias(c) for c in ("city", "latitude", "longitude")])


def zip_geography(zips: DataFrame, customers: DataFrame, audit: Audit) -> DataFrame:
    """ZIP reference with the attributes customers give it; state and region have no source."""
    return left_lookup(zips.drop(*AUDIT_COLUMNS), zip_attributes(customers), ["zip_code"]).select(
        "zip_code",
        "city",
        "latitude",
        "longitude",
        "population",
        "is_population_valid",
        *[F.lit(None).cast("string").alias(c) for c in ("state", "region")],
        "etl_source_system",
        *audit.columns(),
    )


GEOGRAPHY = ("city", "latitude", "longitude", "population", "is_population_valid")


def customer_context(customers: DataFrame, months: DataFrame, geography: DataFrame) -> DataFrame:
    """Everything a month takes from its customer, as one row per customer.

    Profile, churn attribution and services are projections of the same customer rows, so they
    are computed side by side instead of being joined to the months one by one, and the ZIP
    attributes join here, at customer grain, rather than at the grain of the months.
    Contract and internet type stay behind: a month brings its own.
    """
    described = left_lookup(customers, latest_month(months), ["customer_id"]).select(
        "customer_id", "churn_category", "churn_reason", *profile_columns(), *service_columns()
    )
    placed = left_lookup(described, geography.select("zip_code", *GEOGRAPHY), ["zip_code"], spread_by="customer_id")
    return placed.drop("contract_type", "internet_type")


def quality_status() -> Column:
    """First thing wrong with a month. Rows are classified, never dropped."""
    wrong = [
        F.col("customer_id").isNull(),
        F.col("snapshot_month").isNull(),
        F.col("monthly_charge") < 0,
        F.col("zip_code").isNull(),
    ]
    return flags.first_rule(list(zip(QUALITY, wrong)), QUALITY[-1])


def additive_columns() -> dict[str, Column]:
    counted = {
        "eligible_customer_count": "is_churn_eligible",
        "churned_customer_count": "is_churned",
        "stayed_customer_count": "is_stayed",
        "new_customer_count": "is_new_customer",
    }
    return {"customer_count": F.lit(1), **{name: flags.as_count(F.col(flag)) for name, flag in counted.items()}}


# The columns of a month, in order.
MONTH_COLUMNS = (
    *("monthly_snapshot_id", "customer_id", "snapshot_month", "tenure_months", "tenure_band"),
    *("customer_status", "contract_type", "internet_type"),
    *("is_churned", "is_stayed", "is_new_customer", "is_churn_eligible"),
    *("churn_category", "churn_reason"),
    *("gender", "age", "age_band", "is_married", "dependent_count", "referral_count", "first_join_month"),
    *("service_profile_key", "offer", *SERVICE_FLAGS, *BUNDLES),
    *("zip_code", *GEOGRAPHY),
    *("monthly_charge", "monthly_revenue", "total_revenue", "is_monthly_charge_valid", "monthly_revenue_lost"),
    *("customer_count", "eligible_customer_count", "churned_customer_count"),
    *("stayed_customer_count", "new_customer_count", "data_quality_status"),
    *("source_updated_at", "source_batch_id", "source_system", "etl_source_system"),
)


def monthly_360(months: DataFrame, context: DataFrame, audit: Audit, heavy: list | None = None) -> DataFrame:
    """A customer's month with everything known about the customer; one row per month.

    Status, contract and internet type are those of the month, services and ZIP those of the
    current customer record. The churn reason is terminal: it rides on every month and only
    counts where a fact makes it effective.
    """
    spine = months.drop(*AUDIT_COLUMNS)
    derived = {
        "tenure_band": tenure_band(F.col("tenure_months")),
        "monthly_revenue_lost": amount_if(F.col("is_churned"), F.col("monthly_charge")),
        "data_quality_status": quality_status(),
        **additive_columns(),
    }
    skew = {"spread_by": "monthly_snapshot_id", "heavy": heavy, "meet_by_first": True}
    joined = left_lookup(spine, context, ["customer_id"], **skew)
    columns = [derived[c].alias(c) if c in derived else F.col(c) for c in MONTH_COLUMNS]
    return joined.select(*columns, *audit.columns())


# What an event takes from the customer's month, and the name it gets there.
MONTH_CONTEXT = {
    "customer_status": "customer_status_at_event_month",
    "contract_type": "contract_type_at_event_month",
    "internet_type": "internet_type_at_event_month",
    **{c: c for c in ("service_profile_key", "zip_code", *GEOGRAPHY)},
}


def event_dates() -> dict[str, Column]:
    stamp = F.col("event_timestamp")
    return {"event_date": stamp.cast("date"), "event_month": month_floor(stamp)}


def support_enriched(events: DataFrame, months: DataFrame, audit: Audit, heavy: list | None = None) -> DataFrame:
    """Support events with the customer's state in the month of the event.

    An equality join on customer and month, never on current data: an event without a month of
    its own keeps NULLs and says so in ``is_customer_snapshot_matched``. Events and months meet by
    customer, so that the fact finds the events of a customer in one place.
    """
    spine = events.drop(*AUDIT_COLUMNS).withColumns(event_dates())
    context = months.select(
        "customer_id", F.col("snapshot_month").alias("event_month"), *[F.col(c).alias(n) for c, n in MONTH_CONTEXT.items()]
    )
    skew = {"spread_by": "support_event_id", "heavy": heavy, "meet_by_first": True}
    joined = left_lookup(spine, context, ["customer_id", "event_month"], matched="is_customer_snapshot_matched", **skew)
    return joined.select(
        *("support_event_id", "customer_id", "event_timestamp", "event_date", "event_month"),
        *("issue_category", "channel", "priority", "resolution_status", "resolution_hours", "satisfaction_score"),
        *("is_resolved", "is_escalated", "is_resolution_hours_valid", "is_satisfaction_score_valid"),
        *MONTH_CONTEXT.values(),
        "is_customer_snapshot_matched",
        *("source_updated_at", "source_batch_id", "source_system", "etl_source_system"),
        *audit.columns(),
    )
