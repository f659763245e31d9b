"""Registered queries: each reads whole test tables, and each has SQL that must agree with it.

A query is a function of (session, folder of the test tables). Its SQL sits next to it.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions import flags
from starloom.functions.audit import AUDIT_COLUMNS, Audit
from starloom.functions.dates import date_key, month_floor, months_before
from starloom.functions.keys import literal_key, routed_reason_key, surrogate_key, unknown_key
from starloom.functions.numbers import MONEY, agrees, amount_if, big_whole, moment, money, safe_ratio, signed_total, whole
from starloom.functions.text import clean_text, is_zip_cut, yes_no, zip5
from starloom.operators import checks
from starloom.operators.calendar import calendar_attributes, days, fixed_bounds, whole_years
from starloom.operators.dedup import latest_rows
from starloom.operators.increment import merge_rows, since, watermark
from starloom.operators.lookup import heavy_keys, left_lookup, resolve_key
from starloom.operators.members import with_member
from starloom.plans import entities, facts, quality, staging
from starloom.plans.staging import raw
from starloom.plans.star import LAYERS, Star, restage, shown
from starloom.registry.sql_tables import (
    AGE_BAND,
    AMOUNTS,
    CHURN,
    EXTRA,
    FLAG_FIELDS,
    HAS,
    PART_OF,
    REFUNDS,
    SERVICE,
    TEXTS,
    UNKNOWN_KEY,
    clean,
    columns,
    key,
    money as money_sql,
    number,
    query as with_parts,
    snake,
    tenure_band,
    yes_no as yes_no_sql,
)
from starloom.session import tune, work_folder
from starloom.sources import adapters
from starloom.sources.bronze import REQUIRED, Bronze, freshness
from starloom.sources.lake import DIMENSIONS, FACTS, STAGING, Lake
from starloom.streaming.merge import merge_stream, raw_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# The first load of the incremental queries sees what was stamped before this day.
FIRST_LOAD_BEFORE = "2001-01-01"
MONTHS, EVENTS = quality.MONTHS, quality.EVENTS
CUSTOMERS, ZIPS = quality.CUSTOMERS, quality.ZIPS


def plain(df: DataFrame) -> DataFrame:
    """Without the audit block (it differs per run) and with zone-free timestamps."""
    df = df.drop(*AUDIT_COLUMNS)
    zoned = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if f.dataType.typeName() == "timestamp"}
    return df.withColumns(zoned) if zoned else df


def register(name: str, sql: str | None = None):
    """Register a query under ``name``; without SQL only its rows are counted."""

    def wrap(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(fn(tune(spark), folder))

        QUERIES[name] = run
        if sql:
            SQL[name] = with_parts(sql)
        return run

    return wrap


def star(spark: SparkSession, folder: str) -> Star:
    return Star(adapters.bronze(spark, folder))


def _register_tables() -> None:
    def table(name: str) -> Query:
        return lambda spark, folder: star(spark, folder)[name]

    for name in REQUIRED:
        register(f"src_{name}", f"SELECT * FROM {PART_OF[name]}")(table(name))
    for names in LAYERS.values():
        for name in names:
            register(f"model_{name}", f"SELECT * FROM {PART_OF[name]}")(table(name))


def _bronze_counts_sql() -> str:
    one = 'SELECT \'{t}\' AS source, count(*) AS n_rows, count(*) - count("{k}") AS n_missing, count(DISTINCT "{k}") AS n_keys FROM {p}'
    return " UNION ALL ".join(one.format(t=t, k=cols[0], p=PART_OF[t]) for t, cols in REQUIRED.items())


@register("src_scan", _bronze_counts_sql())
def src_scan(spark, folder):
    """Rows, missing keys and distinct keys of the raw tables; duplicates are allowed there."""
    bronze = adapters.bronze(spark, folder)
    named = {name: bronze[name] for name in REQUIRED}
    profiles = [
        df.agg(
            F.lit(name).alias("source"),
            F.count("*").alias("n_rows"),
            F.count_if(raw(REQUIRED[name][0]).isNull()).alias("n_missing"),
            F.count_distinct(raw(REQUIRED[name][0])).alias("n_keys"),
        )
        for name, df in named.items()
    ]
    out = profiles[0]
    for p in profiles[1:]:
        out = out.unionByName(p)
    return out


# --- staging operators --------------------------------------------------------------------

_RENAMED = {f: snake(f) for f in ("Customer ID", "Tenure in Months", "Number of Referrals", "Avg Monthly GB Download")}


@register("rename_project", f"SELECT {', '.join(f'{chr(34)}{a}{chr(34)} AS {b}' for a, b in _RENAMED.items())} FROM raw_customer")
def rename_project(spark, folder):
    return adapters.bronze(spark, folder).customers.select(*[raw(a).alias(b) for a, b in _RENAMED.items()])


_ID = 'trim("Customer ID") AS customer_id, etl_file_row_number AS line'


def _lines(df: DataFrame, *cols) -> DataFrame:
    return df.select(F.trim(raw("Customer ID")).alias("customer_id"), F.col("etl_file_row_number").alias("line"), *cols)


def _raw_columns(mapping: dict[str, str]) -> str:
    return columns(mapping)


@register("clean_text", f"SELECT {_ID}, {columns({snake(c): clean(f'{chr(34)}{c}{chr(34)}') for c in TEXTS})} FROM raw_customer")
def clean_texts(spark, folder):
    return _lines(adapters.bronze(spark, folder).customers, *[clean_text(raw(c)).alias(snake(c)) for c in TEXTS])


@register(
    "safe_cast",
    "SELECT monthly_snapshot_id, etl_file_row_number AS line, TRY_CAST(tenure_months AS INT) AS tenure,"
    f" {money_sql('monthly_charge')} AS charge, TRY_CAST(batch_id AS BIGINT) AS batch,"
    " TRY_CAST(total_revenue AS TIMESTAMP) AS not_a_time FROM raw_month",
)
def safe_casts(spark, folder):
    return adapters.bronze(spark, folder).months.select(
        "monthly_snapshot_id",
        F.col("etl_file_row_number").alias("line"),
        whole(F.col("tenure_months")).alias("tenure"),
        money(F.col("monthly_charge")).alias("charge"),
        big_whole(F.col("batch_id")).alias("batch"),
        moment(F.col("total_revenue")).alias("not_a_time"),
    )


@register("yes_no_bool", f"SELECT {_ID}, {columns({snake(f): yes_no_sql(f'{chr(34)}{f}{chr(34)}') for f in FLAG_FIELDS})} FROM raw_customer")
def yes_no_bool(spark, folder):
    return _lines(adapters.bronze(spark, folder).customers, *[yes_no(raw(f)).alias(snake(f)) for f in FLAG_FIELDS])


@register(
    "zip_normalize",
    f"""SELECT {_ID}, left(lpad(CAST("Zip Code" AS VARCHAR), CAST(greatest(length(CAST("Zip Code" AS VARCHAR)), 5) AS INT), '0'), 5) AS zip_code,
        "Zip Code" > 99999 AS is_cut FROM raw_customer""",
)
def zip_normalize(spark, folder):
    code = raw("Zip Code")
    return _lines(adapters.bronze(spark, folder).customers, zip5(code).alias("zip_code"), is_zip_cut(code).alias("is_cut"))


@register(
    "month_floor",
    "SELECT etl_file_row_number AS line, make_date(year(snapshot_month), month(snapshot_month), 1) AS month FROM raw_month",
)
def month_floors(spark, folder):
    months = adapters.bronze(spark, folder).months
    return months.select(F.col("etl_file_row_number").alias("line"), month_floor(F.col("snapshot_month")).alias("month"))


@register(
    "dedup_latest",
    """SELECT monthly_snapshot_id, max(newest) AS line FROM (
           SELECT monthly_snapshot_id, first_value(etl_file_row_number) OVER (
               PARTITION BY monthly_snapshot_id ORDER BY updated_at DESC NULLS LAST, etl_file_row_number DESC) AS newest
           FROM raw_month) GROUP BY monthly_snapshot_id""",
)
def dedup_latest(spark, folder):
    months = adapters.bronze(spark, folder).months
    newest = latest_rows(months, "monthly_snapshot_id", ["updated_at", "etl_ingested_at", "etl_file_row_number"])
    return newest.select("monthly_snapshot_id", F.col("etl_file_row_number").alias("line"))


@register(
    "dedup_latest_by_load",
    """SELECT "Customer ID" AS id, arg_max(etl_file_row_number, struct_pack(a := etl_ingested_at, b := etl_file_row_number)) AS line
       FROM raw_customer GROUP BY "Customer ID"
       UNION ALL
       SELECT CAST("Zip Code" AS VARCHAR), arg_max(etl_file_row_number, struct_pack(a := etl_ingested_at, b := etl_file_row_number))
       FROM raw_zip GROUP BY "Zip Code" """,
)
def dedup_latest_by_load(spark, folder):
    bronze = adapters.bronze(spark, folder)
    parts = []
    for df, column in ((bronze.customers, "Customer ID"), (bronze.zips, "Zip Code")):
        keyed = df.select(raw(column).cast("string").alias("id"), "etl_ingested_at", F.col("etl_file_row_number").alias("line"))
        parts.append(latest_rows(keyed, "id", ["etl_ingested_at", "line"]).select("id", "line"))
    return parts[0].unionByName(parts[1])


@register(
    "valid_flags",
    f"""SELECT 'customer' AS kind, "Customer ID" AS id, etl_file_row_number AS line, {money_sql('"Monthly Charge"')} >= 0 AS valid FROM raw_customer
        UNION ALL SELECT 'zip', CAST("Zip Code" AS VARCHAR), etl_file_row_number, TRY_CAST("Population" AS BIGINT) >= 1 FROM raw_zip
        UNION ALL SELECT 'hours', support_event_id, etl_file_row_number, NOT coalesce({money_sql('resolution_hours')} < 0, false) FROM raw_event
        UNION ALL SELECT 'score', support_event_id, etl_file_row_number,
            satisfaction_score IS NULL OR satisfaction_score IN ('1', '2', '3', '4', '5') FROM raw_event""",
)
def valid_flags(spark, folder):
    bronze, line = adapters.bronze(spark, folder), F.col("etl_file_row_number").alias("line")

    def judged(df, kind, id_column, flag):
        return df.select(F.lit(kind).alias("kind"), id_column.cast("string").alias("id"), line, flag.alias("valid"))

    event_id = F.col("support_event_id")
    hours, score = money(F.col("resolution_hours")), whole(F.col("satisfaction_score"))
    return (
        judged(bronze.customers, "customer", raw("Customer ID"), flags.within(money(raw("Monthly Charge")), low=0))
        .unionByName(judged(bronze.zips, "zip", raw("Zip Code"), flags.within(big_whole(raw("Population")), above=0)))
        .unionByName(judged(bronze.events, "hours", event_id, flags.within(hours, low=0, missing=True)))
        .unionByName(judged(bronze.events, "score", event_id, flags.within(score, 1, 5, missing=True)))
    )


@register(
    "status_flags",
    f"""SELECT line, customer_status, {columns(CHURN)} FROM
        (SELECT etl_file_row_number AS line, {clean('customer_status')} AS customer_status FROM raw_month)""",
)
def status_flags(spark, folder):
    months = adapters.bronze(spark, folder).months
    labelled = months.select(F.col("etl_file_row_number").alias("line"), clean_text(F.col("customer_status")).alias("customer_status"))
    return labelled.select("*", *[c.alias(n) for n, c in staging.churn_flags().items()])


_TOTAL = (
    f"(10000 + (k * 7919) % 900000) - coalesce({REFUNDS}, 0) + {EXTRA} + ((k * 17) % 200000)"
)


@register(
    "reconcile",
    f"""SELECT customer_id, CAST(CAST(total AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,2)) AS calculated,
            CASE WHEN k % 303 <> 0 THEN CAST(CASE WHEN k % 500 = 7 THEN 0.02 ELSE 0 END AS DECIMAL(18,2)) END AS difference,
            CASE WHEN k % 303 <> 0 THEN k % 500 <> 7 END AS reconciled
        FROM (SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS customer_id, c_custkey AS k, {_TOTAL.replace('k *', 'c_custkey *').replace('k %', 'c_custkey %')} AS total
              FROM customer)""",
)
def reconcile(spark, folder):
    customers = staging.typed_customers(adapters.bronze(spark, folder).customers)
    newest = latest_rows(customers, "customer_id", staging.LOAD_ORDER)
    parts = signed_total(
        plus=[F.col("total_charges"), F.col("total_extra_data_charges"), F.col("total_long_distance_charges")],
        minus=[F.col("total_refunds")],
    )
    stated = F.col("total_revenue")
    return newest.select(
        "customer_id",
        parts.cast(MONEY).alias("calculated"),
        (stated - parts).cast(MONEY).alias("difference"),
        agrees(stated, parts).alias("reconciled"),
    )


@register("with_audit", "SELECT customer_id, 'job-7' AS job, 'local' AS run, 'manual' AS task, true AS one_stamp FROM customers")
def with_audit(spark, folder):
    """A run variable wins over the environment, which wins over the default; one stamp per run."""
    audit = Audit.of_run({"etl_job_id": "job-7", "etl_run_id": ""}, environ={"DBT_ETL_JOB_ID": "ignored"})
    stamped = audit.on(star(spark, folder).customers.select("customer_id"))
    return stamped.select(
        "customer_id",
        F.col("etl_job_id").alias("job"),
        F.col("etl_run_id").alias("run"),
        F.col("etl_task_name").alias("task"),
        (F.col("etl_updated_at") == F.lit(audit.etl_updated_at)).alias("one_stamp"),
    )


# --- derived columns ----------------------------------------------------------------------


@register("age_band", f"SELECT customer_id, age, {AGE_BAND} AS age_band FROM customers")
def age_band(spark, folder):
    return star(spark, folder).customers.select("customer_id", "age", entities.age_band(F.col("age")).alias("age_band"))


@register("tenure_band", f"SELECT monthly_snapshot_id, tenure_months, {tenure_band('tenure_months')} AS tenure_band FROM months")
def tenure_bands(spark, folder):
    tenure = F.col("tenure_months")
    return star(spark, folder).months.select("monthly_snapshot_id", tenure, entities.tenure_band(tenure).alias("tenure_band"))


@register(
    "first_month",
    """SELECT monthly_snapshot_id, CAST(snapshot_month - to_months(CAST(tenure_months AS INT)) + to_months(1) AS DATE) AS began
       FROM months""",
)
def first_month(spark, folder):
    began = months_before(F.col("snapshot_month"), F.col("tenure_months"))
    return star(spark, folder).months.select("monthly_snapshot_id", began.alias("began"))


@register("safe_ratio", "SELECT customer_id, average_monthly_revenue FROM financial")
def ratio(spark, folder):
    per_month = safe_ratio(F.col("total_revenue"), F.col("tenure_months"))
    return star(spark, folder).customers.select("customer_id", per_month.alias("average_monthly_revenue"))


@register(
    "conditional_amount",
    """SELECT monthly_snapshot_id,
        CAST(coalesce(CASE WHEN customer_status = 'Churned' AND monthly_charge > 0 THEN monthly_charge END, 0) AS DECIMAL(18,2)) AS lost
       FROM months""",
)
def conditional_amount(spark, folder):
    lost = amount_if(F.col("is_churned"), F.col("monthly_charge"))
    return star(spark, folder).months.select("monthly_snapshot_id", lost.alias("lost"))


@register("flag_count", f"SELECT customer_id, len(list_filter([{', '.join(HAS)}], lambda x: x)) AS service_count FROM customers")
def flag_count(spark, folder):
    return star(spark, folder).customers.select("customer_id", flags.true_count(*[F.col(h) for h in HAS]).alias("service_count"))


_TV = ("has_streaming_tv", "has_streaming_movies", "has_streaming_music")
_SAFE = ("has_online_security", "has_online_backup", "has_device_protection_plan")


@register(
    "flag_any",
    f"""SELECT customer_id, {' OR '.join(f'coalesce({c}, false)' for c in _TV)} AS any_streaming,
        {' + '.join(map(number, _TV))} >= 2 AS two_streaming, {' AND '.join(f'coalesce({c}, false)' for c in _SAFE)} AS all_security
        FROM customers""",
)
def flag_any(spark, folder):
    tv, safe = [F.col(c) for c in _TV], [F.col(c) for c in _SAFE]
    return star(spark, folder).customers.select(
        "customer_id",
        flags.any_true(*tv).alias("any_streaming"),
        flags.at_least_true(2, *tv).alias("two_streaming"),
        flags.all_true(*safe).alias("all_security"),
    )


@register("dq_status", "SELECT data_quality_status, count(*) AS n_rows FROM month_360 GROUP BY data_quality_status")
def dq_status(spark, folder):
    return star(spark, folder)["int_customer_monthly_360"].groupBy("data_quality_status").agg(F.count("*").alias("n_rows"))


@register(
    "additive_counts",
    """SELECT snapshot_month, count(*) AS customer_count,
        count(*) FILTER (customer_status IN ('Stayed', 'Churned')) AS eligible_customer_count,
        count(*) FILTER (customer_status = 'Churned') AS churned_customer_count,
        count(*) FILTER (customer_status = 'Stayed') AS stayed_customer_count,
        count(*) FILTER (customer_status = 'Joined') AS new_customer_count
       FROM months GROUP BY snapshot_month""",
)
def additive_counts(spark, folder):
    counted = star(spark, folder).months.select("snapshot_month", *[c.alias(n) for n, c in entities.additive_columns().items()])
    return counted.groupBy("snapshot_month").agg(*[F.sum(n).alias(n) for n in counted.columns[1:]])


@register("typed_nulls", "SELECT zip_code, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS region FROM zips")
def typed_nulls(spark, folder):
    return star(spark, folder)["int_zipcode_geography"].select("zip_code", "state", "region")


@register(
    "surrogate_key",
    f"""SELECT customer_id, {key('customer_id')} AS one, {key('offer', 'contract', 'internet_type', *HAS)} AS fourteen,
        {key('total_revenue', 'age', 'latitude')} AS typed, {UNKNOWN_KEY} AS special FROM customers""",
)
def surrogate_keys(spark, folder):
    configuration = [F.col(c) for c in ("offer", "contract", "internet_type", *HAS)]
    return star(spark, folder).customers.select(
        "customer_id",
        surrogate_key(F.col("customer_id")).alias("one"),
        surrogate_key(*configuration).alias("fourteen"),
        surrogate_key(F.col("total_revenue"), F.col("age"), F.col("latitude")).alias("typed"),
        unknown_key().alias("special"),
    )


@register("date_key", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_key FROM orders")
def date_keys(spark, folder):
    return adapters.raw(spark, folder, "orders").select("o_orderkey", date_key(F.col("o_orderdate")).alias("date_key"))


# --- joins --------------------------------------------------------------------------------


@register(
    "ref_left_agg",
    """SELECT zips.zip_code, population, any_city AS city FROM zips LEFT JOIN
       (SELECT zip_code, min(city) AS any_city FROM customers GROUP BY zip_code) AS c ON c.zip_code = zips.zip_code""",
)
def ref_left_agg(spark, folder):
    s = star(spark, folder)
    attributes = entities.zip_attributes(s.customers).select("zip_code", "city")
    return left_lookup(s[ZIPS].select("zip_code", "population"), attributes, ["zip_code"])


@register(
    "master_left_latest",
    """SELECT customers.customer_id, latest_snapshot_month FROM customers LEFT JOIN
       (SELECT customer_id, max(snapshot_month) AS latest_snapshot_month FROM months GROUP BY customer_id) AS l
       ON l.customer_id = customers.customer_id""",
)
def master_left_latest(spark, folder):
    s = star(spark, folder)
    return left_lookup(s.customers.select("customer_id"), entities.latest_month(s.months), ["customer_id"])


@register(
    "entity_360",
    """SELECT m.monthly_snapshot_id, c.zip_code, g.city, c.churn_reason, s.service_profile_key, c.customer_id IS NOT NULL AS known
       FROM months AS m LEFT JOIN customers AS c ON c.customer_id = m.customer_id
       LEFT JOIN services AS s ON s.customer_id = m.customer_id
       LEFT JOIN geography AS g ON g.zip_code = c.zip_code""",
)
def entity_360(spark, folder):
    """The spine meets one wide customer row instead of three customer tables and a ZIP table."""
    s = star(spark, folder)
    spine = s.months.select("monthly_snapshot_id", "customer_id")
    taken = s.context.select("customer_id", "zip_code", "city", "churn_reason", "service_profile_key")
    return left_lookup(spine, taken, ["customer_id"], matched="known").drop("customer_id")


@register(
    "period_enrich",
    """SELECT support_event_id, CAST(date_trunc('month', event_timestamp) AS DATE) AS event_month,
           m.customer_status AS status_then, m.customer_id IS NOT NULL AS is_matched
       FROM events_staged AS e LEFT JOIN months AS m ON m.customer_id = e.customer_id
           AND year(m.snapshot_month) = year(event_timestamp) AND month(m.snapshot_month) = month(event_timestamp)""",
)
def period_enrich(spark, folder):
    s = star(spark, folder)
    events = s[EVENTS].select("support_event_id", "customer_id", month_floor(F.col("event_timestamp")).alias("event_month"))
    months = s.months.select("customer_id", F.col("snapshot_month").alias("event_month"), F.col("customer_status").alias("status_then"))
    return left_lookup(events, months, ["customer_id", "event_month"], matched="is_matched").drop("customer_id")


@register(
    "const_cross",
    """SELECT monthly_snapshot_id, unknown_key, reason_key FROM months CROSS JOIN
       (SELECT md5('UNKNOWN') AS unknown_key, md5('Not Applicable-Not Applicable') AS reason_key) AS constants""",
)
def const_cross(spark, folder):
    """Constant keys next to every row: literals that Catalyst folds, so there is no join."""
    not_applicable = literal_key("Not Applicable", "Not Applicable")
    return star(spark, folder).months.select(
        "monthly_snapshot_id", unknown_key().alias("unknown_key"), not_applicable.alias("reason_key")
    )


@register(
    "fk_lookup",
    f"""SELECT monthly_snapshot_id, coalesce(customer_key, {UNKNOWN_KEY}) AS customer_key, customer_key IS NOT NULL AS is_customer_matched
        FROM months LEFT JOIN d_customer ON customer_key = {key('months.customer_id')}""",
)
def fk_lookup(spark, folder):
    s = star(spark, folder)
    keyed = s.months.select("monthly_snapshot_id", surrogate_key(F.col("customer_id")).alias("customer_key"))
    return resolve_key(keyed, s["dim_customer"], key="customer_key", unknown=unknown_key(), matched="is_customer_matched")


# A third of the months, or of the events, moved to one customer.
HOT_CUSTOMER = "C0000007"


def _skewed(rows: DataFrame, stamp: str) -> DataFrame:
    hot = F.when(F.month(stamp) <= 4, F.lit(HOT_CUSTOMER)).otherwise(F.col("customer_id"))
    return rows.withColumn("customer_id", hot)


def _skewed_sql(part: str, stamp: str) -> str:
    return f"(SELECT * REPLACE (CASE WHEN month({stamp}) <= 4 THEN '{HOT_CUSTOMER}' ELSE customer_id END AS customer_id) FROM {part})"


@register(
    "entity_360_skewed",
    f"""SELECT m.monthly_snapshot_id, c.zip_code, c.churn_reason, c.customer_id IS NOT NULL AS known
        FROM {_skewed_sql('months', 'snapshot_month')} AS m LEFT JOIN customers AS c ON c.customer_id = m.customer_id""",
)
def entity_360_skewed(spark, folder):
    """The hot customer is found by counting, its months are dealt out and its one row is repeated for them."""
    s = star(spark, folder)
    spine = _skewed(s.months, "snapshot_month").select("monthly_snapshot_id", "customer_id")
    taken = s.context.select("customer_id", "zip_code", "churn_reason")
    skew = {"spread_by": "monthly_snapshot_id", "heavy": heavy_keys(spine, ["customer_id"])}
    return left_lookup(spine, taken, ["customer_id"], matched="known", **skew).drop("customer_id")


@register(
    "period_enrich_skewed",
    f"""SELECT support_event_id, m.customer_status AS status_then, m.customer_id IS NOT NULL AS is_matched
        FROM {_skewed_sql('events_staged', 'event_timestamp')} AS e LEFT JOIN months AS m ON m.customer_id = e.customer_id
            AND year(m.snapshot_month) = year(event_timestamp) AND month(m.snapshot_month) = month(event_timestamp)""",
)
def period_enrich_skewed(spark, folder):
    s = star(spark, folder)
    events = _skewed(s[EVENTS], "event_timestamp")
    events = events.select("support_event_id", "customer_id", month_floor(F.col("event_timestamp")).alias("event_month"))
    # Read three times, to find heavy keys and to join: written down rather than staged anew each time.
    written = work_folder(spark, "events")
    events.write.parquet(written)
    events = spark.read.schema(events.schema).parquet(written)
    months = s.months.select("customer_id", F.col("snapshot_month").alias("event_month"), F.col("customer_status").alias("status_then"))
    on = ["customer_id", "event_month"]
    skew = {"spread_by": "support_event_id", "heavy": heavy_keys(events, on)}
    return left_lookup(events, months, on, matched="is_matched", **skew).drop(*on)


@register(
    "fk_lookup_skewed",
    f"""SELECT monthly_snapshot_id, coalesce(customer_key, {UNKNOWN_KEY}) AS customer_key, coalesce(geography_key, {UNKNOWN_KEY}) AS geography_key,
            customer_key IS NOT NULL AS is_customer_matched, geography_key IS NOT NULL AS is_geography_matched
        FROM {_skewed_sql('months', 'snapshot_month')} AS m LEFT JOIN customers AS c ON c.customer_id = m.customer_id
        LEFT JOIN d_customer ON customer_key = {key('m.customer_id')} LEFT JOIN d_geography ON geography_key = {key('c.zip_code')}""",
)
def fk_lookup_skewed(spark, folder):
    """Both lookups deal the rows of their heavy keys out, also those of the key that a missing ZIP hashes to."""
    s = star(spark, folder)
    months = _skewed(s.months, "snapshot_month").select("monthly_snapshot_id", "customer_id")
    heavy = facts.heavy_dimension_keys(months, s.customers)
    placed = left_lookup(months, s.customers.select("customer_id", "zip_code"), ["customer_id"], spread_by="monthly_snapshot_id")
    keyed = placed.select(
        "monthly_snapshot_id", surrogate_key(F.col("customer_id")).alias("customer_key"), surrogate_key(F.col("zip_code")).alias("geography_key")
    )
    for dimension, name, matched in (("dim_customer", "customer_key", "is_customer_matched"), ("dim_geography", "geography_key", "is_geography_matched")):
        skew = {"spread_by": "monthly_snapshot_id", "heavy": heavy[name]}
        keyed = resolve_key(keyed, s[dimension], key=name, unknown=unknown_key(), matched=matched, **skew)
    return keyed


@register("role_key_route", "SELECT monthly_snapshot_id, is_churned, churn_reason_key FROM f_month")
def role_key_route(spark, folder):
    months = star(spark, folder)["int_customer_monthly_360"]
    routed = routed_reason_key(*map(F.col, ("is_churned", "churn_category", "churn_reason")))
    return months.select("monthly_snapshot_id", "is_churned", routed.alias("churn_reason_key"))


@register(
    "count_compare",
    """SELECT a.n AS raw_row_count, b.n AS staged_row_count FROM (SELECT count(*) AS n FROM raw_month) AS a
       CROSS JOIN (SELECT count(*) AS n FROM months) AS b WHERE a.n <> b.n""",
)
def count_compare(spark, folder):
    s = star(spark, folder)
    return checks.unequal_counts(s.bronze.months, "raw_row_count", s.months, "staged_row_count")


# --- aggregations -------------------------------------------------------------------------


@register(
    "rep_min",
    """SELECT zip_code, min(city) AS city, min(latitude) AS latitude, min(longitude) AS longitude
       FROM customers GROUP BY zip_code HAVING zip_code IS NOT NULL""",
)
def rep_min(spark, folder):
    return entities.zip_attributes(star(spark, folder).customers)


@register("latest_per_key", "SELECT customer_id, max(snapshot_month) AS latest_snapshot_month FROM months GROUP BY customer_id")
def latest_per_key(spark, folder):
    return entities.latest_month(star(spark, folder).months)


@register("global_max", "SELECT max(updated_at) AS newest, CAST(max(updated_at) AS DATE) - 2 AS bound FROM raw_month")
def global_max(spark, folder):
    months = adapters.bronze(spark, folder).months
    newest = F.max("updated_at")
    return months.agg(newest.alias("newest"), F.date_sub(newest, 2).alias("bound"))


@register("dup_groups", "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_groups(spark, folder):
    return checks.repeated(adapters.raw(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@register(
    "count_distinct_groups",
    """SELECT o_custkey, count(*) AS n_rows, count(DISTINCT o_orderstatus) AS distinct_o_orderstatus,
           count(DISTINCT o_orderpriority) AS distinct_o_orderpriority
       FROM orders GROUP BY o_custkey
       HAVING count(*) > 1 OR count(DISTINCT o_orderstatus) > 1 OR count(DISTINCT o_orderpriority) > 1""",
)
def count_distinct_groups(spark, folder):
    counts = {c: f"distinct_{c}" for c in ("o_orderstatus", "o_orderpriority")}
    return checks.several_per_key(adapters.raw(spark, folder, "orders"), "o_custkey", counts)


@register("global_count", "SELECT 'orders' AS source, count(*) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem")
def global_count(spark, folder):
    counts = [adapters.raw(spark, folder, t).agg(F.lit(t).alias("source"), F.count("*").alias("n")) for t in ("orders", "lineitem")]
    return counts[0].unionByName(counts[1])


@register(
    "star_rollup",
    """SELECT snapshot_month, city, sum(customer_count) AS customers, sum(eligible_customer_count) AS eligible,
           sum(churned_customer_count) AS churned,
           sum(churned_customer_count)::DOUBLE / nullif(sum(eligible_customer_count), 0)::DOUBLE AS churn_rate,
           sum(monthly_revenue_lost) AS revenue_lost
       FROM f_month LEFT JOIN d_geography ON d_geography.geography_key = f_month.geography_key
       GROUP BY snapshot_month, city""",
)
def star_rollup(spark, folder):
    """Churn rate, eligible customers and revenue lost by month and city, from raw tables to report."""
    s = star(spark, folder)
    return facts.churn_by_month_and_city(s[facts.MONTH_FACT], s["dim_geography"])


# --- dimensions and set operations --------------------------------------------------------


@register("dim_with_unknown", "SELECT geography_key, zip_code, city, population, is_unknown_member FROM d_geography")
def dim_with_unknown(spark, folder):
    geography = star(spark, folder)["int_zipcode_geography"]
    keyed = geography.select(
        surrogate_key(F.col("zip_code")).alias("geography_key"), "zip_code", "city", "population", F.lit(False).alias("is_unknown_member")
    )
    return with_member(keyed, {"geography_key": unknown_key(), "zip_code": "UNKNOWN", "city": "Unknown", "is_unknown_member": True})


@register(
    "dim_distinct_profile",
    f"""SELECT service_profile_key, count(*) AS n_rows FROM
        (SELECT DISTINCT service_profile_key, offer, contract_type, internet_type, {', '.join(SERVICE)}, etl_source_system FROM services)
        GROUP BY service_profile_key""",
)
def dim_distinct_profile(spark, folder):
    services = star(spark, folder)["int_customer_service_profile"]
    distinct = services.select("service_profile_key", *entities.CONFIGURATION, "etl_source_system").distinct()
    return distinct.groupBy("service_profile_key").agg(F.count("*").alias("n_rows"))


@register("dim_pairs_special", "SELECT churn_category, churn_reason, member_type, is_unknown_member FROM d_reason")
def dim_pairs_special(spark, folder):
    return star(spark, folder)["dim_churn_reason"].select("churn_category", "churn_reason", "member_type", "is_unknown_member")


@register(
    "date_dim",
    """SELECT CAST(strftime(day, '%Y%m%d') AS INT) AS date_key, CAST(day AS DATE) AS calendar_date, dayname(day) AS day_name,
           isodow(day) % 7 + 1 AS day_of_week, week(day) AS week_of_year, isodow(day) >= 6 AS is_weekend
       FROM (SELECT unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                                           INTERVAL 1 DAY)) AS day
             FROM (SELECT least(min(o_orderdate), min(l_shipdate)) AS lo, greatest(max(o_orderdate), max(l_shipdate)) AS hi
                   FROM orders, lineitem WHERE o_orderkey = l_orderkey))""",
)
def date_dim(spark, folder):
    """Calendar over the full years that orders and shipments touch."""
    spans = (adapters.raw(spark, folder, "orders"), "o_orderdate"), (adapters.raw(spark, folder, "lineitem"), "l_shipdate")
    kept = ("date_key", "calendar_date", "day_name", "day_of_week", "week_of_year", "is_weekend")
    return days(whole_years(*spans)).select(*calendar_attributes()).select(*kept)


@register("union_all", "SELECT n_regionkey AS region, n_name AS name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region")
def union_all(spark, folder):
    nations = adapters.raw(spark, folder, "nation").select(F.col("n_regionkey").alias("region"), F.col("n_name").alias("name"))
    regions = adapters.raw(spark, folder, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("region"))
    return nations.unionByName(regions)


# --- incremental loading and storage ------------------------------------------------------

_BEFORE = f"coalesce(source_updated_at < TIMESTAMP '{FIRST_LOAD_BEFORE}', true)"


def _first_load(df: DataFrame, stamp: str = "updated_at") -> DataFrame:
    early = F.col(stamp) < F.lit(FIRST_LOAD_BEFORE).cast("timestamp")
    return df.filter(early | F.col(stamp).isNull())


@register(
    "hwm_read",
    f"""SELECT monthly_snapshot_id, source_updated_at FROM months WHERE coalesce(source_updated_at, TIMESTAMP '1900-01-01') >=
        (SELECT CAST(max(source_updated_at) AS DATE) - 2 FROM months WHERE source_updated_at < TIMESTAMP '{FIRST_LOAD_BEFORE}')""",
)
def hwm_read(spark, folder):
    """What a second load reads: the bound comes from the first load, midnight two days back."""
    months = star(spark, folder).months.select("monthly_snapshot_id", "source_updated_at")
    return since(months, "source_updated_at", watermark(_first_load(months, "source_updated_at"), "source_updated_at"))


def _lake(spark: SparkSession, purpose: str) -> Lake:
    return Lake(spark, work_folder(spark, purpose))


_EVENT_FIELDS = ("support_event_id", "customer_id", "event_timestamp", "resolution_status", "resolution_hours", "source_updated_at")


def _event_rows(bronze_events: DataFrame) -> DataFrame:
    staged = staging.stg_events(bronze_events, Audit.of_run())
    return staged.select(*_EVENT_FIELDS, month_floor(F.col("event_timestamp")).alias("event_month"))


_EVENT_MERGE = {"key": "support_event_id", "month": "event_month", "key_fixes_month": False}


_EVENTS_SQL = f"SELECT {', '.join(_EVENT_FIELDS)}, CAST(date_trunc('month', event_timestamp) AS DATE) AS event_month FROM events_staged"


@register("upsert", _EVENTS_SQL)
def upsert(spark, folder):
    """Two loads of the events into a table on storage, the second from the watermark.

    Later versions of an event move it to another month, so its old copy has to go.
    """
    events, lake = adapters.bronze(spark, folder).events, _lake(spark, "upsert")
    lake.merge(FACTS, "events", _event_rows(_first_load(events)), **_EVENT_MERGE)
    bound = watermark(lake.read(FACTS, "events"), "source_updated_at")
    lake.merge(FACTS, "events", _event_rows(since(events, "updated_at", bound)), **_EVENT_MERGE)
    return lake.read(FACTS, "events")


class _BreaksOff(Lake):
    """Publishes the first of the merged months and stops."""

    def _move_months(self, pending, current, folders):
        super()._move_months(pending, current, folders[:1])
        raise InterruptedError(folders[0])


@register("upsert_resumed", _EVENTS_SQL)
def upsert_resumed(spark, folder):
    """The two loads of ``upsert``, the second broken off after one month and finished by the next run."""
    events, lake = adapters.bronze(spark, folder).events, _lake(spark, "resumed")
    lake.merge(FACTS, "events", _event_rows(_first_load(events)), **_EVENT_MERGE)
    news = _event_rows(since(events, "updated_at", watermark(lake.read(FACTS, "events"), "source_updated_at")))
    with suppress(InterruptedError):
        _BreaksOff(spark, lake.root).merge(FACTS, "events", news, **_EVENT_MERGE)
    lake.recover(FACTS, "events")
    return lake.read(FACTS, "events")


@register(
    "staging_increment",
    f"SELECT {', '.join(_EVENT_FIELDS)} FROM events_staged",
)
def staging_increment(spark, folder):
    """Events staged in two steps as their raw rows are loaded: the second reads the later rows and the months they touch."""
    raw_tables, lake = adapters.bronze(spark, folder), _lake(spark, "staging")
    late = F.coalesce(F.col("updated_at") >= F.lit(FIRST_LOAD_BEFORE).cast("timestamp"), F.lit(False))
    loaded = F.when(late, F.col("etl_ingested_at") + F.expr("interval 1 day")).otherwise(F.col("etl_ingested_at"))
    events = raw_tables.events.withColumn("etl_ingested_at", loaded)
    for arriving in (events.filter(~late), events):
        restage(lake, EVENTS, Bronze(lambda: None, lambda: None, lambda: None, lambda rows=arriving: rows), Audit.of_run())
    return shown(lake.read(STAGING, EVENTS)).select(*_EVENT_FIELDS)


@register(
    "schema_sync",
    f"""SELECT monthly_snapshot_id, customer_status, CASE WHEN NOT {_BEFORE} THEN monthly_charge END AS monthly_charge FROM months""",
)
def schema_sync(spark, folder):
    """Merge into a table that lacks a new column and still has a removed one."""
    months = star(spark, folder).months
    fields = ("monthly_snapshot_id", "customer_status")
    old = _first_load(months, "source_updated_at").select(*fields, F.col("source_batch_id").alias("removed_column"))
    new = months.filter(F.col("source_updated_at") >= F.lit(FIRST_LOAD_BEFORE).cast("timestamp"))
    return merge_rows(old, new.select(*fields, "monthly_charge"), "monthly_snapshot_id")


@register("full_refresh", "SELECT monthly_snapshot_id, snapshot_month, monthly_charge, source_updated_at FROM months")
def full_refresh(spark, folder):
    """A partitioned table rebuilt from everything, whatever it held before."""
    lake, months = _lake(spark, "refresh"), star(spark, folder).months
    rows = months.select("monthly_snapshot_id", "snapshot_month", "monthly_charge", "source_updated_at")
    placed = {"key": "monthly_snapshot_id", "month": "snapshot_month"}
    lake.replace(FACTS, "months", _first_load(rows, "source_updated_at"), **placed)
    lake.replace(FACTS, "months", rows, **placed)
    return lake.read(FACTS, "months", rows.schema)


@register("dim_overwrite", "SELECT * FROM d_geography")
def dim_overwrite(spark, folder):
    """A dimension written in full twice; readers see the second version."""
    lake, geography = _lake(spark, "overwrite"), star(spark, folder)["dim_geography"]
    lake.overwrite(DIMENSIONS, "dim_geography", geography.filter("is_unknown_member"))
    return lake.overwrite(DIMENSIONS, "dim_geography", geography)


@register(
    "freshness",
    """SELECT max(updated_at) AS newest, date_sub('hour', max(updated_at), TIMESTAMP '2001-08-03 06:30:00') AS age_hours,
           CASE WHEN max(updated_at) + INTERVAL 73 HOUR <= TIMESTAMP '2001-08-03 06:30:00' THEN 'error'
                WHEN max(updated_at) + INTERVAL 25 HOUR <= TIMESTAMP '2001-08-03 06:30:00' THEN 'warn' ELSE 'pass' END AS freshness
       FROM raw_month""",
)
def fresh(spark, folder):
    return freshness(adapters.bronze(spark, folder).months, "updated_at", "2001-08-03 06:30:00")


@register("stream_upsert", f"SELECT {', '.join(_EVENT_FIELDS)}, CAST(date_trunc('month', event_timestamp) AS DATE) AS event_month FROM events_staged")
def stream_upsert(spark, folder):
    """Events appended in two steps, late ones first, each read as a stream and merged in batches."""
    events, lake = adapters.bronze(spark, folder).events, _lake(spark, "stream")
    landing = f"{lake.root}/landing"
    late = F.coalesce(F.col("updated_at") >= F.lit(FIRST_LOAD_BEFORE).cast("timestamp"), F.lit(False))
    for arrived in (events.filter(late), events.filter(~late)):
        arrived.write.mode("append").parquet(landing)
        stream = raw_stream(spark, landing, events.schema)
        merge_stream(stream, lake, "events", _event_rows, newer_by="source_updated_at", **_EVENT_MERGE)
    return lake.read(FACTS, "events")


# --- checks -------------------------------------------------------------------------------


def _report_query(chosen: list[checks.Check]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return checks.report(star(spark, folder), chosen)

    return run


def _literal(value) -> str:
    return f"'{value.replace(chr(39), chr(39) * 2)}'" if isinstance(value, str) else str(value).lower()


def check_sql(check: checks.Check) -> str:
    """Number of violations of a declared column check."""
    part, column = PART_OF[check.table], f'"{check.column}"' if " " in check.column else check.column
    source = f"(SELECT * FROM {part} WHERE {check.where})" if check.where else part
    if check.rule == "not_null" and check.column == "etl_updated_at":
        counted = "SELECT 0 AS n"
    elif check.rule == "not_null":
        counted = f"SELECT count(*) - count({column}) AS n FROM {source}"
    elif check.rule == "unique":
        counted = f"SELECT count(*) AS n FROM (SELECT {column} FROM {source} GROUP BY 1 HAVING count({column}) > 1)"
    elif check.rule == "accepted_values":
        counted = f"SELECT count(*) AS n FROM {source} WHERE {column} NOT IN ({', '.join(map(_literal, check.allowed))})"
    elif check.rule == "relationship":
        parent, field = check.parent
        known = f"SELECT {field} FROM {PART_OF[parent]} WHERE {field} IS NOT NULL"
        counted = f"SELECT count(*) AS n FROM {source} WHERE {column} NOT IN ({known})"
    else:
        limits = [f"{column} < {check.low}"] * (check.low is not None) + [f"{column} > {check.high}"] * (check.high is not None)
        counted = f"SELECT count(*) AS n FROM {source} WHERE {' OR '.join(limits)}"
    labels = f"'{check.name}' AS check_name, '{check.table}' AS table_name, '{check.column}' AS column_name"
    return f"SELECT {labels}, '{check.severity}' AS severity, n AS violations FROM ({counted})"


def _register_reports() -> None:
    """One report per rule, over every column it is declared for."""
    rules = {"chk_not_null": "not_null", "chk_unique": "unique", "chk_accepted_values": "accepted_values"}
    rules |= {"chk_relationship": "relationship", "chk_range": "range"}
    for name, rule in rules.items():
        chosen = [c for c in quality.column_checks() if c.rule == rule]
        for layer, tables in (("bronze", tuple(REQUIRED)), *LAYERS.items()):
            mine = [c for c in chosen if c.table in tables]
            if mine:
                qid = f"{name}_{layer.split('/')[-1]}"
                register(qid, " UNION ALL ".join(check_sql(c) for c in mine))(_report_query(mine))


@register(
    "chk_where",
    """SELECT support_event_id, satisfaction_score FROM events_staged
       WHERE resolution_status = 'Resolved' AND (satisfaction_score < 1 OR satisfaction_score > 5)""",
)
def chk_where(spark, folder):
    """A range check limited to some rows."""
    check = checks.Check(EVENTS, "range", "satisfaction_score", low=1, high=5, where="resolution_status = 'Resolved'")
    return check.violating({EVENTS: star(spark, folder)[EVENTS]}).select("support_event_id", "satisfaction_score")


@register(
    "chk_severity",
    """SELECT 'error' AS severity, count(*) FILTER (customer_status IS NULL) AS violations FROM customers
       UNION ALL SELECT 'warn', count(*) FILTER (gender NOT IN ('Male', 'Female'))
           + count(*) FILTER (internet_type NOT IN ('Fiber Optic', 'DSL', 'Cable')) FROM customers""",
)
def chk_severity(spark, folder):
    """Violations by severity; an error blocks, a warning only reports."""
    chosen = [c for c in quality.column_checks() if c.table == CUSTOMERS]
    chosen = [c for c in chosen if c.severity == checks.WARN or (c.rule, c.column) == ("not_null", "customer_status")]
    results = checks.report({CUSTOMERS: star(spark, folder).customers}, chosen)
    return results.groupBy("severity").agg(F.sum("violations").alias("violations"))


def _rule(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rule = next(c for c in quality.business_rules() if c.rule == name)
        return rule.query(star(spark, folder))

    return run


def _register_rules() -> None:
    grain = "SELECT customer_id, snapshot_month, count(*) AS n_rows FROM {} GROUP BY ALL HAVING n_rows > 1"
    event_grain = "SELECT support_event_id, count(*) AS n_rows FROM {} GROUP BY ALL HAVING n_rows > 1"
    parity = "SELECT * FROM (SELECT (SELECT count(*) FROM {0}) AS {1}, (SELECT count(*) FROM {2}) AS {3}) WHERE {1} <> {3}"
    states = (
        "customer_count <> 1 OR {counts} OR {one} + {two} + {three} > 1 OR monthly_revenue_lost IS DISTINCT FROM"
        " CAST(CASE WHEN is_churned AND monthly_charge > 0 THEN monthly_charge ELSE 0 END AS DECIMAL(18,2))"
    )

    def flags_sql(table: str, names: dict[str, str]) -> str:
        counts = " OR ".join(f"{n} <> {number(f)}" for n, f in names.items())
        one, two, three = map(number, ("is_churned", "is_stayed", "is_new_customer"))
        return f"SELECT * FROM {table} WHERE {states.format(counts=counts, one=one, two=two, three=three)}"

    def absent(model: str, part: str, row_key: str, keys: list[str]) -> str:
        shown = ", ".join(f"CAST({k} IS NULL AS VARCHAR)" for k in keys)
        any_absent = " OR ".join(f"{k} IS NULL" for k in keys)
        return f"SELECT '{model}' AS model, {row_key} AS row_key, concat_ws('|', {shown}) AS null_fk_flags FROM {part} WHERE {any_absent}"

    keys = quality.FACT_KEYS
    rules = {
        "duplicate_month_staged": ("chk_grain_month_staged", grain.format("months")),
        "duplicate_month_360": ("chk_grain_month_360", grain.format("month_360")),
        "duplicate_month_fact": ("chk_grain_month_fact", grain.format("f_month")),
        "duplicate_event_enriched": ("chk_grain_event_enriched", event_grain.format("enriched")),
        "duplicate_event_fact": ("chk_grain_event_fact", event_grain.format("f_event")),
        "month_row_parity": ("chk_row_parity_months", parity.format("month_360", "intermediate_row_count", "f_month", "fact_row_count")),
        "enriched_row_parity": ("chk_row_parity_enriched", parity.format("events_staged", "staging_row_count", "enriched", "enriched_row_count")),
        "event_row_parity": ("chk_row_parity_events", parity.format("events_staged", "staging_row_count", "f_event", "fact_row_count")),
        "status_flags_360": ("chk_flag_consistency_360", flags_sql("month_360", quality.COUNTED)),
        "status_flags_fact": ("chk_flag_consistency_fact", flags_sql("f_month", quality.COUNTED_IN_FACT)),
        "resolution_consistency": (
            "chk_conditional_null",
            """SELECT support_event_id, resolution_status, resolution_hours, satisfaction_score FROM events_staged
               WHERE CASE WHEN resolution_status = 'Pending' THEN (resolution_hours IS NOT NULL)::INT + (satisfaction_score IS NOT NULL)::INT
                          WHEN resolution_status IS NULL THEN 0
                          ELSE (resolution_hours IS NULL)::INT + (satisfaction_score IS NULL)::INT END > 0""",
        ),
        "revenue_reconciles": (
            "chk_tolerance",
            """SELECT customer_id, total_revenue, calculated_total_revenue, abs(total_revenue - calculated_total_revenue) AS revenue_gap
               FROM customers WHERE is_total_revenue_reconciled = false""",
        ),
        "fact_keys_present": (
            "chk_fk_flags",
            absent(quality.MONTH_FACT, "f_month", "customer_monthly_snapshot_key", keys)
            + " UNION ALL "
            + absent(quality.EVENT_FACT, "f_event", "support_event_key", [k for k in keys if k != "churn_reason_key"]),
        ),
        "single_place_per_zip": (
            "chk_single_mapping",
            """SELECT zip_code, count(*) AS n_rows, count(DISTINCT city) AS distinct_cities, count(DISTINCT latitude) AS distinct_latitudes,
                   count(DISTINCT longitude) AS distinct_longitudes
               FROM geography GROUP BY zip_code HAVING greatest(n_rows, distinct_cities, distinct_latitudes, distinct_longitudes) > 1""",
        ),
        "negative_charges": (
            "chk_anomaly_union",
            f"""SELECT '{CUSTOMERS}' AS model, customer_id AS entity_id, monthly_charge FROM customers WHERE monthly_charge < 0
                UNION ALL SELECT '{MONTHS}', monthly_snapshot_id, monthly_charge FROM months WHERE monthly_charge < 0""",
        ),
    }
    for rule, (name, sql) in rules.items():
        register(name, sql)(_rule(rule))


# Rows that the queries below spoil, in a table of months and in one of events.
SPOILED = {True: "month(snapshot_month) = 3", False: "satisfaction_score < 2"}


def _doubled(rows: DataFrame) -> DataFrame:
    """Spoiled rows twice, out of one pass over the table."""
    copies = f"if({SPOILED['snapshot_month' in rows.columns]}, array(1, 2), array(1))"
    return rows.select("*", F.explode(F.expr(copies)).alias("__copy")).drop("__copy")


def _thinned(rows: DataFrame) -> DataFrame:
    return rows.filter(f"coalesce(not ({SPOILED['snapshot_month' in rows.columns]}), true)")


def _miscounted(rows: DataFrame) -> DataFrame:
    count = f"if({SPOILED[True]} and is_churned, 2, customer_count)"
    return rows.withColumn("customer_count", F.expr(count).cast(rows.schema["customer_count"].dataType))


def _resited(places: DataFrame) -> DataFrame:
    return places.unionByName(places.filter("zip_code like '%1'").withColumn("city", F.concat("city", F.lit(" II"))))


def _spoiled_rule(name: str, table: str, spoil: Callable, partner: str | None, shown: tuple[str, ...]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rule = next(c for c in quality.business_rules() if c.rule == name)
        tables = star(spark, folder)
        given = {table: spoil(tables[table])} | ({partner: tables[partner]} if partner else {})
        found = rule.query(given)
        return found.select(*shown) if shown else found

    return run


def _register_spoiled_rules() -> None:
    """The rules that a right star never breaks, on tables spoiled on purpose, so that they find something."""
    spoiled_months, spoiled_events = SPOILED[True], SPOILED[False]
    doubled = "(SELECT {0} FROM {1} UNION ALL SELECT {0} FROM {1} WHERE {2})"
    month, event = "customer_id, snapshot_month", "support_event_id"
    for rule, table, part, key, spoiled in (
        ("duplicate_month_staged", MONTHS, "months", month, spoiled_months),
        ("duplicate_month_360", quality.MONTH_360, "month_360", month, spoiled_months),
        ("duplicate_month_fact", quality.MONTH_FACT, "f_month", month, spoiled_months),
        ("duplicate_event_enriched", quality.ENRICHED, "enriched", event, spoiled_events),
        ("duplicate_event_fact", quality.EVENT_FACT, "f_event", event, spoiled_events),
    ):
        sql = f"SELECT {key}, count(*) AS n_rows FROM {doubled.format(key, part, spoiled)} GROUP BY {key} HAVING count(*) > 1"
        register(f"chk_spoiled_{rule}", sql)(_spoiled_rule(rule, table, _doubled, None, ()))
    for rule, table, partner, whole, whole_name, part, part_name, spoiled in (
        ("month_row_parity", quality.MONTH_FACT, quality.MONTH_360, "month_360", "intermediate_row_count", "f_month", "fact_row_count", spoiled_months),
        ("enriched_row_parity", quality.ENRICHED, EVENTS, "events_staged", "staging_row_count", "enriched", "enriched_row_count", spoiled_events),
        ("event_row_parity", quality.EVENT_FACT, EVENTS, "events_staged", "staging_row_count", "f_event", "fact_row_count", spoiled_events),
    ):
        sql = f"""SELECT (SELECT count(*) FROM {whole}) AS {whole_name},
                      (SELECT count(*) - count(*) FILTER ({spoiled}) FROM {part}) AS {part_name}"""
        register(f"chk_spoiled_{rule}", sql)(_spoiled_rule(rule, table, _thinned, partner, ()))
    for rule, table, part in (("status_flags_360", quality.MONTH_360, "month_360"), ("status_flags_fact", quality.MONTH_FACT, "f_month")):
        sql = f"SELECT {month} FROM {part} WHERE {spoiled_months} AND is_churned"
        register(f"chk_spoiled_{rule}", sql)(_spoiled_rule(rule, table, _miscounted, None, ("customer_id", "snapshot_month")))
    register(
        "chk_spoiled_single_place_per_zip",
        """SELECT zip_code, 2 AS n_rows, count(DISTINCT city) + count(city) AS distinct_cities, count(DISTINCT latitude) AS distinct_latitudes,
               count(DISTINCT longitude) AS distinct_longitudes
           FROM geography WHERE zip_code LIKE '%1' GROUP BY zip_code""",
    )(_spoiled_rule("single_place_per_zip", "int_zipcode_geography", _resited, None, ()))


@register(
    "chk_single_mapping_staged",
    """SELECT zip_code, count(DISTINCT (city, latitude, longitude)) AS n_tuples FROM customers WHERE zip_code IS NOT NULL
       GROUP BY zip_code HAVING count(DISTINCT city) > 1 OR count(DISTINCT latitude) > 1 OR count(DISTINCT longitude) > 1""",
)
def chk_single_mapping_staged(spark, folder):
    """The place of a ZIP compared where it can still differ: on the customers."""
    customers = star(spark, folder).customers.filter("zip_code is not null")
    return checks.conflicting_tuples(customers, "zip_code", quality.PLACE)


FIXED_RANGE = ("1994-01-01", "1997-01-01")


@register(
    "chk_date_keys_fixed_range",
    "SELECT 'months' AS facts, count(*) FILTER (date_key NOT BETWEEN 19940101 AND 19961231) AS orphans FROM f_month"
    " UNION ALL SELECT 'events', count(*) FILTER (date_key NOT BETWEEN 19940101 AND 19961231) FROM f_event",
)
def chk_date_keys_fixed_range(spark, folder):
    """Facts whose date lies outside a calendar of stated range."""
    tables = Star(adapters.bronze(spark, folder), calendar=fixed_bounds(spark, *FIXED_RANGE))
    found = []
    for name, table in (("months", quality.MONTH_FACT), ("events", quality.EVENT_FACT)):
        (check,) = quality.points_to(table, "date_key", "dim_date")
        result = checks.report({t: tables[t] for t in (table, "dim_date")}, [check])
        found.append(result.select(F.lit(name).alias("facts"), F.col("violations").alias("orphans")))
    return found[0].unionByName(found[1])


def _register_extra_rules() -> None:
    chosen = [c for c in quality.extra_rules() if c.rule == "relationship"]
    register("chk_relationship_extra", " UNION ALL ".join(check_sql(c) for c in chosen))(_report_query(chosen))
    cut = [c for c in quality.extra_rules() if c.rule == "zip_cut"]
    one = """SELECT '{c.name}' AS check_name, '{c.table}' AS table_name, '{c.column}' AS column_name, '{c.severity}' AS severity,
                 count(*) FILTER ("Zip Code" > 99999) AS violations FROM {part}"""
    register("chk_zip_cut", " UNION ALL ".join(one.format(c=c, part=PART_OF[c.table]) for c in cut))(_report_query(cut))


_register_tables()
_register_reports()
_register_extra_rules()
_register_rules()
_register_spoiled_rules()
