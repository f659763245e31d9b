"""The four raw tables: schemas, readers, freshness.

Raw tables are append-only copies of what the sources delivered. They hold duplicates, blanks
and loosely typed values; only their keys are required.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column names and types as the sources deliver them.
LOAD_COLUMNS = (
    "etl_ingested_at timestamp, etl_source_file string, etl_file_row_number bigint, etl_source_system string"
)

CUSTOMER_SCHEMA = f"""
    `Customer ID` string, `Gender` string, `Age` int, `Married` string, `Number of Dependents` int,
    `City` string, `Zip Code` int, `Latitude` double, `Longitude` double, `Number of Referrals` int,
    `Tenure in Months` int, `Offer` string, `Phone Service` string,
    `Avg Monthly Long Distance Charges` string, `Multiple Lines` string, `Internet Service` string,
    `Internet Type` string, `Avg Monthly GB Download` int, `Online Security` string,
    `Online Backup` string, `Device Protection Plan` string, `Premium Tech Support` string,
    `Streaming TV` string, `Streaming Movies` string, `Streaming Music` string,
    `Unlimited Data` string, `Contract` string, `Paperless Billing` string, `Payment Method` string,
    `Monthly Charge` string, `Total Charges` string, `Total Refunds` string,
    `Total Extra Data Charges` string, `Total Long Distance Charges` string, `Total Revenue` string,
    `Customer Status` string, `Churn Category` string, `Churn Reason` string, {LOAD_COLUMNS}
"""
ZIP_SCHEMA = f"`Zip Code` int, `Population` string, {LOAD_COLUMNS}"
MONTH_SCHEMA = f"""
    monthly_snapshot_id string, customer_id string, snapshot_month date, tenure_months string,
    contract_type string, internet_type string, monthly_charge string, monthly_revenue string,
    total_revenue string, customer_status string, updated_at timestamp, batch_id string,
    source_system string, {LOAD_COLUMNS}
"""
EVENT_SCHEMA = f"""
    support_event_id string, customer_id string, event_timestamp timestamp, issue_category string,
    channel string, priority string, resolution_status string, resolution_hours string,
    satisfaction_score string, updated_at timestamp, batch_id string, source_system string, {LOAD_COLUMNS}
"""

CUSTOMERS = "telecom_customer_churn"
ZIPS = "telecom_zipcode_population"
MONTHS = "customer_monthly_snapshot"
EVENTS = "customer_support_events"

SCHEMAS = {CUSTOMERS: CUSTOMER_SCHEMA, ZIPS: ZIP_SCHEMA, MONTHS: MONTH_SCHEMA, EVENTS: EVENT_SCHEMA}
REQUIRED = {
    CUSTOMERS: ("Customer ID", "Zip Code"),
    ZIPS: ("Zip Code",),
    MONTHS: ("monthly_snapshot_id", "customer_id", "snapshot_month"),
    EVENTS: ("support_event_id", "customer_id"),
}


class Bronze:
    """The raw tables, each opened when it is first used."""

    def __init__(
        self,
        customers: Callable[[], DataFrame],
        zips: Callable[[], DataFrame],
        months: Callable[[], DataFrame],
        events: Callable[[], DataFrame],
    ):
        self.open = {CUSTOMERS: customers, ZIPS: zips, MONTHS: months, EVENTS: events}
        self._opened: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._opened:
            self._opened[table] = self.open[table]()
        return self._opened[table]

    @property
    def customers(self) -> DataFrame:
        return self[CUSTOMERS]

    @property
    def zips(self) -> DataFrame:
        return self[ZIPS]

    @property
    def months(self) -> DataFrame:
        return self[MONTHS]

    @property
    def events(self) -> DataFrame:
        return self[EVENTS]


def read_files(spark: SparkSession, root: str) -> Bronze:
    """Parquet folders named after the raw tables, read with a stated schema (no inference)."""

    def opener(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")

    return Bronze(*map(opener, (CUSTOMERS, ZIPS, MONTHS, EVENTS)))


def read_catalog(spark: SparkSession, database: str = "bronze") -> Bronze:
    def opener(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.table(f"{database}.{name}")

    return Bronze(*map(opener, (CUSTOMERS, ZIPS, MONTHS, EVENTS)))


def freshness(df: DataFrame, stamp: str, as_of: datetime | str, warn_hours: int = 24, error_hours: int = 72) -> DataFrame:
    """Age of the newest row in hours at ``as_of`` and its verdict; one row, also for an empty table."""
    newest = F.max(stamp).cast("timestamp")
    age = F.timestamp_diff("HOUR", F.col("newest"), F.lit(as_of).cast("timestamp"))
    verdict = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    aged = df.agg(newest.alias("newest")).select("newest", age.alias("age_hours"))
    return aged.select("newest", "age_hours", verdict.alias("freshness"))
