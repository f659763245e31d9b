"""SQL for every table of the star over the test tables, as named parts of one WITH clause.

from the Spark plans, so that agreement means something.
"""

from __future__ import annotations

import re

from starloom.functions.keys import NULL_TOKEN
from starloom.sources.adapters import ANSWERS, FLAG_FIELDS, ISSUES, LOADED, LOADED_BEFORE

NEW, OLD = f"TIMESTAMP '{LOADED}'", f"TIMESTAMP '{LOADED_BEFORE}'"


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def pick(number: str, values) -> str:
    return f"([{', '.join(map(text, values))}])[CAST(({number}) % {len(values)} AS INT) + 1]"


def pad(number: str, width: int) -> str:
    return f"lpad(CAST({number} AS VARCHAR), {width}, '0')"


def cents(amount: str) -> str:
    return f"(CAST(({amount}) // 100 AS VARCHAR) || '.' || {pad(f'({amount}) % 100', 2)})"


def key(*columns: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_TOKEN}')" for c in columns)
    return f"md5(concat_ws('-', {parts}))"


def clean(column: str) -> str:
    return f"nullif(trim({column}), '')"


def money(column: str) -> str:
    return f"TRY_CAST({column} AS DECIMAL(18,2))"


def yes_no(column: str) -> str:
    return (
        f"CASE lower(trim({column})) WHEN 'yes' THEN true WHEN 'y' THEN true WHEN 'true' THEN true WHEN '1' THEN true"
        " WHEN 'no' THEN false WHEN 'n' THEN false WHEN 'false' THEN false WHEN '0' THEN false END"
    )


def number(flag: str) -> str:
    return f"CAST(coalesce({flag}, false) AS INT)"


def tenure_band(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL THEN 'Unknown' ELSE (['0-6 months', '7-12 months', '13-24 months', '25-48 months',"
        f" '49+ months'])[1 + CAST({column} > 6 AS INT) + CAST({column} > 12 AS INT) + CAST({column} > 24 AS INT)"
        f" + CAST({column} > 48 AS INT)] END"
    )


AGE_BAND = (
    "CASE WHEN age IS NULL THEN 'Unknown' ELSE (['18-29', '30-44', '45-59', '60+'])"
    "[1 + CAST(age >= 30 AS INT) + CAST(age >= 45 AS INT) + CAST(age >= 60 AS INT)] END"
)


def snake(name: str) -> str:
    return name.lower().replace(" ", "_")


CODE = "CASE WHEN {k} % 131 = 0 THEN 'X' ELSE 'C' END || " + pad("{k}", 7)
RAW_FLAGS = ", ".join(f'{pick(f"k + {7 * i}", ANSWERS)} AS "{f}"' for i, f in enumerate(FLAG_FIELDS))
CHARGES, REFUNDS = "(10000 + (k * 7919) % 900000)", "(CASE WHEN k % 7 = 0 THEN NULL ELSE (k * 31) % 5000 END)"
EXTRA, DISTANCE = "((k % 10) * 1000)", "((k * 17) % 200000)"
REVENUE = f"({CHARGES} - coalesce({REFUNDS}, 0) + {EXTRA} + {DISTANCE} + CASE WHEN k % 500 = 7 THEN 2 ELSE 0 END)"

HAS = [f"has_{snake(f)}" for f in FLAG_FIELDS if f not in ("Married", "Paperless Billing")]
TEXTS = (
    *("Gender", "City", "Offer", "Internet Type", "Contract", "Payment Method"),
    *("Customer Status", "Churn Category", "Churn Reason"),
)
AMOUNTS = (
    *("Avg Monthly Long Distance Charges", "Monthly Charge", "Total Charges", "Total Refunds"),
    *("Total Extra Data Charges", "Total Long Distance Charges", "Total Revenue"),
)
PLAIN = ("Age", "Number of Dependents", "Latitude", "Longitude", "Number of Referrals", "Avg Monthly GB Download")
SERVICE = [h.replace("has_device_protection_plan", "has_device_protection") for h in HAS]
BUNDLE = "service_count, has_any_streaming_service, has_streaming_bundle, has_security_bundle"
CHURN = {
    "is_churned": "customer_status = 'Churned'",
    "is_stayed": "customer_status = 'Stayed'",
    "is_new_customer": "customer_status = 'Joined'",
    "is_churn_eligible": "customer_status IN ('Churned', 'Stayed')",
}
LOST = "greatest(CASE WHEN customer_status = 'Churned' THEN coalesce(monthly_charge, 0) ELSE 0 END, 0)"
DELIVERY = "source_updated_at, source_batch_id, source_system, etl_source_system"
PLACE = "city, latitude, longitude, population, is_population_valid"
RECOMPUTED = (
    "coalesce(total_charges, 0) - coalesce(total_refunds, 0)"
    " + coalesce(total_extra_data_charges, 0) + coalesce(total_long_distance_charges, 0)"
)
UNKNOWN_KEY = "md5('UNKNOWN')"


def columns(pairs: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in pairs.items())


PARTS = {
    "raw_customer": f"""
        SELECT ' C' || {pad('k', 7)} || ' ' AS "Customer ID",
            CASE WHEN k % 97 = 0 THEN '  ' WHEN k % 2 = 0 THEN 'Female' ELSE 'Male' END AS "Gender",
            CAST(CASE WHEN k % 89 <> 0 THEN 16 + k % 70 END AS INT) AS "Age",
            CAST(k % 4 AS INT) AS "Number of Dependents", n_name || ' ' AS "City",
            CAST(CASE WHEN k % 211 = 0 THEN NULL WHEN k % 223 = 0 THEN 123456 ELSE 600 + n END AS INT) AS "Zip Code",
            CAST(n AS DOUBLE) * 1.5e0 - 20 AS "Latitude", CAST(n AS DOUBLE) * 2.25e0 - 30 AS "Longitude",
            CAST(k % 11 + 100 * (copy - 1) AS INT) AS "Number of Referrals",
            CAST(CASE WHEN k % 101 <> 0 THEN k % 73 END AS INT) AS "Tenure in Months",
            {pick('k', ('', 'Offer A', 'Offer B', 'Offer C', 'Offer D', 'Offer E'))} AS "Offer",
            CASE WHEN k % 131 = 0 THEN 'n/a' ELSE {cents('k % 5000')} END AS "Avg Monthly Long Distance Charges",
            {pick('k', ('', 'Fiber Optic', 'DSL', ' Cable '))} AS "Internet Type",
            CAST(k % 60 AS INT) AS "Avg Monthly GB Download", {RAW_FLAGS},
            {pick('k', ('Month-to-Month', 'One Year', 'Two Year'))} AS "Contract",
            {pick('k + 1', ('Bank Withdrawal', 'Credit Card', 'Mailed Check'))} AS "Payment Method",
            CASE WHEN k % 149 = 0 THEN 'abc' ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS "Monthly Charge",
            {cents(CHARGES)} AS "Total Charges", {cents(REFUNDS)} AS "Total Refunds",
            {cents(EXTRA)} AS "Total Extra Data Charges", {cents(DISTANCE)} AS "Total Long Distance Charges",
            CASE WHEN k % 303 <> 0 THEN {cents(REVENUE)} END AS "Total Revenue",
            CASE WHEN k % 401 = 0 THEN ' ' WHEN segment = 'MACHINERY' THEN 'Churned'
                 WHEN segment = 'BUILDING' THEN ' Joined' ELSE 'Stayed' END AS "Customer Status",
            CASE WHEN segment = 'MACHINERY' THEN {pick('k', ('Competitor', 'Dissatisfaction', 'Attitude', 'Price', ''))}
                 ELSE '' END AS "Churn Category",
            CASE WHEN segment = 'MACHINERY' THEN
                 {pick('k', ('Offer', 'Service', 'Staff', 'Cost', '', 'Offer', 'Network', 'Staff', 'Cost', 'Moved'))}
                 ELSE '' END AS "Churn Reason",
            CASE WHEN k % 20 = 0 AND copy = 2 THEN {OLD} ELSE {NEW} END AS etl_ingested_at,
            k * 10 + copy AS etl_file_row_number, 'crm.csv' AS etl_source_file, 'CRM' AS etl_source_system
        FROM (SELECT c_custkey AS k, c_nationkey AS n, n_name, c_mktsegment AS segment, c_acctbal,
                     unnest(CASE WHEN c_custkey % 10 = 0 THEN [1, 2] ELSE [1] END) AS copy
              FROM customer JOIN nation ON n_nationkey = c_nationkey)""",
    "raw_zip": f"""
        SELECT CAST(600 + n AS INT) AS "Zip Code",
            CASE n WHEN 3 THEN '0' WHEN 7 THEN 'unknown' ELSE CAST((n + 1) * 1000 + copy AS VARCHAR) END AS "Population",
            CASE copy WHEN 2 THEN {OLD} ELSE {NEW} END AS etl_ingested_at,
            CAST(n * 10 + copy AS BIGINT) AS etl_file_row_number, 'census.csv' AS etl_source_file, 'CENSUS' AS etl_source_system
        FROM (SELECT n_nationkey AS n, unnest(CASE WHEN n_nationkey % 5 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM nation)
        UNION ALL
        SELECT CAST(900 + r_regionkey AS INT), CAST(r_regionkey * 500 AS VARCHAR), {NEW},
            CAST(r_regionkey * 10 + 1000 AS BIGINT), 'census.csv', 'CENSUS' FROM region""",
    "raw_month": f"""
        SELECT ' ' || {CODE.format(k='c')} || strftime(day, '%Y%m') || ' ' AS monthly_snapshot_id,
            ' ' || {CODE.format(k='c')} || ' ' AS customer_id, CAST(day AS DATE) AS snapshot_month,
            CASE WHEN o % 307 = 0 THEN 'unknown' ELSE CAST(o % 60 AS VARCHAR) END AS tenure_months,
            {pick('o', ('Month-to-Month', ' One Year', 'Two Year', ''))} AS contract_type,
            {pick('c', ('Fiber Optic', 'DSL', 'Cable', ' '))} AS internet_type,
            CAST(price - 5000 AS VARCHAR) AS monthly_charge, CAST(price + 10 AS VARCHAR) AS monthly_revenue,
            CAST(price * 2 AS VARCHAR) AS total_revenue,
            CASE WHEN o % 317 = 0 THEN '' WHEN status = 'F' THEN 'Stayed' WHEN status = 'O' THEN 'Joined '
                 ELSE 'Churned' END AS customer_status,
            CASE WHEN o % 331 <> 0 THEN day END AS updated_at, 'B' || CAST(o % 12 AS VARCHAR) AS batch_id,
            ' billing ' AS source_system, {NEW} AS etl_ingested_at, o AS etl_file_row_number, 'billing.csv' AS etl_source_file, 'BILLING' AS etl_source_system
        FROM (SELECT o_orderkey AS o, o_custkey AS c, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
                     CAST(o_orderdate AS TIMESTAMP) AS day FROM orders)""",
    "raw_event": f"""
        SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS support_event_id,
            ' ' || {CODE.format(k='o_custkey')} || ' ' AS customer_id,
            CASE WHEN l_partkey % 1009 <> 0 THEN shipped END AS event_timestamp,
            {pick('l_partkey', ISSUES)} AS issue_category,
            {pick('l_suppkey', ('Chat', 'Phone ', 'Email', 'Self-Service'))} AS channel,
            {pick('l_linenumber', ('Critical', 'High', 'Medium', 'Low'))} AS priority, status AS resolution_status,
            CASE WHEN l_partkey % 197 = 0 THEN '-1' WHEN status <> 'Pending' OR l_partkey % 211 = 0
                 THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS resolution_hours,
            CASE WHEN status = 'Pending' THEN NULL WHEN l_partkey % 223 = 0 THEN '6'
                 ELSE CAST(1 + l_partkey % 5 AS VARCHAR) END AS satisfaction_score,
            shipped AS updated_at, 'B' || CAST(l_suppkey % 7 AS VARCHAR) AS batch_id, 'crm' AS source_system,
            {NEW} AS etl_ingested_at, l_partkey * 100000 + l_suppkey AS etl_file_row_number, 'crm.csv' AS etl_source_file, 'CRM' AS etl_source_system
        FROM (SELECT *, CAST(l_shipdate AS TIMESTAMP) AS shipped,
                     CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'Resolved' WHEN 'NF' THEN 'Resolved'
                          WHEN 'RF' THEN 'Escalated' WHEN 'AO' THEN ' Closed - Unresolved' ELSE 'Pending' END AS status
              FROM lineitem JOIN orders ON o_orderkey = l_orderkey)""",
    "customers": f"""
        SELECT *, CAST({RECOMPUTED} AS DECIMAL(18,2)) AS calculated_total_revenue,
            abs(total_revenue - ({RECOMPUTED})) <= 0.01 AS is_total_revenue_reconciled,
            monthly_charge >= 0 AS is_monthly_charge_valid
        FROM (
            SELECT trim("Customer ID") AS customer_id, {columns({snake(c): clean(f'"{c}"') for c in TEXTS})},
                {columns({snake(c): f'"{c}"' for c in PLAIN})},
                {columns({snake(c): money(f'"{c}"') for c in AMOUNTS})},
                {columns({h: yes_no(f'"{f}"') for h, f in zip(HAS, FLAG_FIELDS[1:])})},
                {yes_no('"Married"')} AS is_married, {yes_no('"Paperless Billing"')} AS is_paperless_billing,
                lpad(CAST("Zip Code" AS VARCHAR), 5, '0') AS zip_code, "Tenure in Months" AS tenure_months, etl_source_system
            FROM raw_customer
            QUALIFY row_number() OVER (PARTITION BY trim("Customer ID")
                ORDER BY etl_ingested_at DESC NULLS LAST, etl_file_row_number DESC NULLS LAST) = 1)""",
    "zips": """
        SELECT *, population > 0 AS is_population_valid
        FROM (SELECT lpad(CAST("Zip Code" AS VARCHAR), 5, '0') AS zip_code, TRY_CAST("Population" AS BIGINT) AS population,
                     etl_source_system
              FROM raw_zip
              QUALIFY row_number() OVER (PARTITION BY "Zip Code"
                  ORDER BY etl_ingested_at DESC NULLS LAST, etl_file_row_number DESC NULLS LAST) = 1)""",
    "months": f"""
        SELECT *, monthly_charge >= 0 AS is_monthly_charge_valid, {columns(CHURN)}
        FROM (
            SELECT trim(monthly_snapshot_id) AS monthly_snapshot_id, trim(customer_id) AS customer_id,
                CAST(date_trunc('month', snapshot_month) AS DATE) AS snapshot_month,
                TRY_CAST(tenure_months AS INT) AS tenure_months,
                {columns({c: clean(c) for c in ('contract_type', 'internet_type', 'customer_status', 'source_system')})},
                {columns({c: money(c) for c in ('monthly_charge', 'monthly_revenue', 'total_revenue')})},
                updated_at AS source_updated_at, {clean('batch_id')} AS source_batch_id, etl_source_system
            FROM raw_month
            QUALIFY row_number() OVER (PARTITION BY trim(raw_month.monthly_snapshot_id)
                ORDER BY updated_at DESC NULLS LAST, etl_ingested_at DESC NULLS LAST,
                         etl_file_row_number DESC NULLS LAST) = 1)""",
    "events_staged": f"""
        SELECT *, coalesce(resolution_hours >= 0, true) AS is_resolution_hours_valid,
            coalesce(satisfaction_score IN (1, 2, 3, 4, 5), true) AS is_satisfaction_score_valid,
            resolution_status = 'Resolved' AS is_resolved, resolution_status = 'Escalated' AS is_escalated
        FROM (
            SELECT trim(support_event_id) AS support_event_id, trim(customer_id) AS customer_id, event_timestamp,
                {columns({c: clean(c) for c in ('issue_category', 'channel', 'priority', 'resolution_status')})},
                {money('resolution_hours')} AS resolution_hours, TRY_CAST(satisfaction_score AS INT) AS satisfaction_score,
                updated_at AS source_updated_at, {clean('batch_id')} AS source_batch_id,
                {clean('source_system')} AS source_system, etl_source_system
            FROM raw_event
            QUALIFY row_number() OVER (PARTITION BY trim(raw_event.support_event_id)
                ORDER BY updated_at DESC NULLS LAST, etl_ingested_at DESC NULLS LAST,
                         etl_file_row_number DESC NULLS LAST) = 1)""",
    "profile": f"""
        SELECT customers.customer_id, gender, age, {AGE_BAND} AS age_band, is_married,
            number_of_dependents AS dependent_count, number_of_referrals AS referral_count, zip_code,
            CAST(latest + to_months(CAST(1 - tenure_months AS INT)) AS DATE) AS first_join_month,
            tenure_months AS current_tenure_months, {tenure_band('tenure_months')} AS current_tenure_band, etl_source_system
        FROM customers LEFT JOIN (SELECT customer_id, max(snapshot_month) AS latest FROM months GROUP BY ALL) AS last_seen
            ON last_seen.customer_id = customers.customer_id""",
    "services": f"""
        SELECT customer_id, {key('offer', 'contract_type', 'internet_type', *SERVICE)} AS service_profile_key,
            offer, contract_type, internet_type, {', '.join(SERVICE)}, avg_monthly_gb_download,
            avg_monthly_long_distance_charges AS avg_monthly_long_distance_charge,
            {' + '.join(map(number, SERVICE))} AS service_count,
            coalesce(greatest(has_streaming_tv, has_streaming_movies, has_streaming_music), false) AS has_any_streaming_service,
            {number('has_streaming_tv')} + {number('has_streaming_movies')} + {number('has_streaming_music')} > 1
                AS has_streaming_bundle,
            {number('has_online_security')} * {number('has_online_backup')} * {number('has_device_protection')} = 1
                AS has_security_bundle,
            etl_source_system
        FROM (SELECT * RENAME (contract AS contract_type, has_device_protection_plan AS has_device_protection) FROM customers)""",
    "financial": f"""
        SELECT customer_id, monthly_charge, total_charges, total_refunds, total_extra_data_charges,
            total_long_distance_charges, total_revenue, calculated_total_revenue,
            total_revenue - calculated_total_revenue AS revenue_reconciliation_difference,
            is_total_revenue_reconciled, is_monthly_charge_valid,
            CAST(CAST(CASE WHEN tenure_months <> 0 THEN sign(total_revenue) *
                ((2 * CAST(abs(total_revenue) * 100 AS BIGINT) + tenure_months) // (2 * tenure_months)) END AS DECIMAL(18,2))
                * 0.01 AS DECIMAL(18,2)) AS average_monthly_revenue,
            tenure_months, contract AS contract_type, payment_method, is_paperless_billing, etl_source_system
        FROM customers""",
    "status": f"""
        SELECT customer_id, customer_status, churn_category, churn_reason, {columns(CHURN)},
            CAST({LOST} AS DECIMAL(18,2)) AS monthly_revenue_lost_current, etl_source_system
        FROM customers""",
    "geography": """
        SELECT zips.zip_code, city, latitude, longitude, population, is_population_valid,
            CAST(NULL AS VARCHAR) AS state, CAST(NULL AS VARCHAR) AS region, zips.etl_source_system
        FROM zips LEFT JOIN (SELECT zip_code, min(city) AS city, min(latitude) AS latitude, min(longitude) AS longitude
                             FROM customers WHERE zip_code IS NOT NULL GROUP BY ALL) AS seen USING (zip_code)""",
    "month_360": f"""
        SELECT monthly_snapshot_id, m.customer_id, snapshot_month, m.tenure_months,
            {tenure_band('m.tenure_months')} AS tenure_band, m.customer_status, m.contract_type, m.internet_type,
            m.is_churned, m.is_stayed, m.is_new_customer, m.is_churn_eligible, status.churn_category, status.churn_reason,
            gender, age, age_band, is_married, dependent_count, referral_count, first_join_month,
            service_profile_key, offer, {', '.join(SERVICE)}, {BUNDLE}, profile.zip_code, {PLACE},
            m.monthly_charge, m.monthly_revenue, m.total_revenue, m.is_monthly_charge_valid,
            CAST({LOST.replace('customer_status', 'm.customer_status').replace('monthly_charge', 'm.monthly_charge')}
                AS DECIMAL(18,2)) AS monthly_revenue_lost,
            1 AS customer_count, {number('m.is_churn_eligible')} AS eligible_customer_count,
            {number('m.is_churned')} AS churned_customer_count, {number('m.is_stayed')} AS stayed_customer_count,
            {number('m.is_new_customer')} AS new_customer_count,
            CASE WHEN m.customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' WHEN snapshot_month IS NULL
                 THEN 'INVALID_SNAPSHOT_MONTH' WHEN m.is_monthly_charge_valid = false THEN 'INVALID_MONTHLY_CHARGE'
                 WHEN profile.zip_code IS NULL THEN 'MISSING_ZIP_CODE' ELSE 'VALID' END AS data_quality_status,
            source_updated_at, source_batch_id, source_system, m.etl_source_system
        FROM months AS m
        LEFT JOIN profile USING (customer_id) LEFT JOIN status USING (customer_id) LEFT JOIN services USING (customer_id)
        LEFT JOIN geography ON geography.zip_code = profile.zip_code""",
    "enriched": f"""
        SELECT support_event_id, e.customer_id, event_timestamp, CAST(event_timestamp AS DATE) AS event_date,
            CAST(date_trunc('month', event_timestamp) AS DATE) AS event_month, issue_category, channel, priority,
            resolution_status, resolution_hours, satisfaction_score, is_resolved, is_escalated,
            is_resolution_hours_valid, is_satisfaction_score_valid,
            m.customer_status AS customer_status_at_event_month, m.contract_type AS contract_type_at_event_month,
            m.internet_type AS internet_type_at_event_month, service_profile_key, zip_code, {PLACE},
            m.customer_id IS NOT NULL AS is_customer_snapshot_matched,
            e.source_updated_at, e.source_batch_id, e.source_system, e.etl_source_system
        FROM events_staged AS e LEFT JOIN month_360 AS m
            ON m.customer_id = e.customer_id AND m.snapshot_month = CAST(date_trunc('month', event_timestamp) AS DATE)""",
    "d_customer": f"""
        SELECT {key('customer_id')} AS customer_key, * EXCLUDE (zip_code), false AS is_unknown_member FROM profile
        UNION ALL BY NAME
        SELECT {UNKNOWN_KEY} AS customer_key, 'UNKNOWN' AS customer_id, 'Unknown' AS gender, 'Unknown' AS age_band,
            'Unknown' AS current_tenure_band, true AS is_unknown_member""",
    "d_geography": f"""
        SELECT {key('zip_code')} AS geography_key, *, false AS is_unknown_member FROM geography
        UNION ALL BY NAME
        SELECT {UNKNOWN_KEY} AS geography_key, 'UNKNOWN' AS zip_code, 'Unknown' AS city, true AS is_unknown_member""",
    "d_service": f"""
        SELECT DISTINCT service_profile_key, offer, contract_type, internet_type, {', '.join(SERVICE)}, {BUNDLE},
            false AS is_unknown_member, etl_source_system
        FROM services
        UNION ALL BY NAME
        SELECT {UNKNOWN_KEY} AS service_profile_key, 'Unknown' AS offer, 'Unknown' AS contract_type,
            'Unknown' AS internet_type, true AS is_unknown_member""",
    "d_reason": f"""
        SELECT {key('churn_category', 'churn_reason')} AS churn_reason_key, churn_category, churn_reason,
            'Real' AS member_type, false AS is_unknown_member, 'MAVEN_SYNTHETIC' AS etl_source_system
        FROM status WHERE is_churned AND NOT (churn_category IS NULL AND churn_reason IS NULL) GROUP BY ALL
        UNION ALL
        SELECT md5(label || '-' || label), label, label, label, label = 'Unknown', NULL
        FROM (VALUES ('Not Applicable'), ('Unknown')) AS special(label)""",
    "bounds": """
        SELECT date_trunc('year', min(day)) AS start, date_trunc('year', max(day)) + INTERVAL 1 YEAR AS stop
        FROM (SELECT CAST(snapshot_month AS TIMESTAMP) AS day FROM months UNION ALL SELECT event_timestamp FROM events_staged)""",
    "d_date": """
        SELECT CAST(strftime(day, '%Y%m%d') AS INT) AS date_key, day AS calendar_date, dayofmonth(day) AS day_of_month,
            dayname(day) AS day_name, dayofweek(day) + 1 AS day_of_week, weekofyear(day) AS week_of_year,
            month(day) AS month_number, monthname(day) AS month_name, quarter(day) AS quarter_number,
            'Q' || quarter(day) AS quarter_name, year(day) AS year_number, strftime(day, '%Y-%m') AS year_month,
            year(day) || '-Q' || quarter(day) AS year_quarter, CAST(date_trunc('month', day) AS DATE) AS month_start_date,
            last_day(day) AS month_end_date, day = date_trunc('month', day) AS is_month_start,
            day = last_day(day) AS is_month_end, dayofweek(day) IN (0, 6) AS is_weekend, 'DBT' AS etl_source_system
        FROM (SELECT CAST(unnest(generate_series(start, stop - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds)""",
    "f_month": f"""
        SELECT {key('m.customer_id', 'm.snapshot_month')} AS customer_monthly_snapshot_key,
            coalesce(customer_key, {UNKNOWN_KEY}) AS customer_key, coalesce(geography_key, {UNKNOWN_KEY}) AS geography_key,
            coalesce(d_service.service_profile_key, {UNKNOWN_KEY}) AS service_profile_key,
            CASE WHEN m.is_churned = false THEN md5('Not Applicable-Not Applicable')
                 WHEN m.is_churned AND m.churn_category IS NULL AND m.churn_reason IS NULL THEN md5('Unknown-Unknown')
                 ELSE {key('m.churn_category', 'm.churn_reason')} END AS churn_reason_key,
            CAST(strftime(snapshot_month, '%Y%m%d') AS INT) AS date_key,
            customer_key IS NOT NULL AS is_customer_matched, geography_key IS NOT NULL AS is_geography_matched,
            d_service.service_profile_key IS NOT NULL AS is_service_profile_matched,
            monthly_snapshot_id, m.customer_id, snapshot_month, tenure_months, monthly_charge, monthly_revenue,
            total_revenue, monthly_revenue_lost, customer_count, eligible_customer_count, churned_customer_count,
            stayed_customer_count, new_customer_count, is_churned, is_stayed, is_new_customer, is_churn_eligible,
            data_quality_status, source_updated_at, source_batch_id, source_system, m.etl_source_system
        FROM month_360 AS m
        LEFT JOIN d_customer ON customer_key = {key('m.customer_id')}
        LEFT JOIN d_geography ON geography_key = {key('m.zip_code')}
        LEFT JOIN d_service ON d_service.service_profile_key = m.service_profile_key""",
    "f_event": f"""
        SELECT {key('support_event_id')} AS support_event_key,
            coalesce(customer_key, {UNKNOWN_KEY}) AS customer_key, coalesce(geography_key, {UNKNOWN_KEY}) AS geography_key,
            coalesce(d_service.service_profile_key, {UNKNOWN_KEY}) AS service_profile_key,
            CAST(strftime(event_date, '%Y%m%d') AS INT) AS date_key,
            customer_key IS NOT NULL AS is_customer_matched, geography_key IS NOT NULL AS is_geography_matched,
            d_service.service_profile_key IS NOT NULL AS is_service_profile_matched, is_customer_snapshot_matched,
            support_event_id, e.customer_id, event_timestamp, event_date, event_month, issue_category, channel, priority,
            resolution_status, customer_status_at_event_month, contract_type_at_event_month, internet_type_at_event_month,
            1 AS event_count, resolution_hours, satisfaction_score, is_resolved, is_escalated, is_resolution_hours_valid,
            is_satisfaction_score_valid, source_updated_at, source_batch_id, source_system, e.etl_source_system
        FROM enriched AS e
        LEFT JOIN d_customer ON customer_key = {key('e.customer_id')}
        LEFT JOIN d_geography ON geography_key = {key('e.zip_code')}
        LEFT JOIN d_service ON d_service.service_profile_key = e.service_profile_key""",
}

# The SQL part that holds each table.
PART_OF = {
    "telecom_customer_churn": "raw_customer",
    "telecom_zipcode_population": "raw_zip",
    "customer_monthly_snapshot": "raw_month",
    "customer_support_events": "raw_event",
    "stg_telecom_customer_churn": "customers",
    "stg_telecom_zipcode_population": "zips",
    "stg_customer_monthly_snapshot": "months",
    "stg_customer_support_events": "events_staged",
    "int_customer_profile": "profile",
    "int_customer_service_profile": "services",
    "int_customer_financial": "financial",
    "int_customer_churn_status": "status",
    "int_zipcode_geography": "geography",
    "int_customer_monthly_360": "month_360",
    "int_support_event_enriched": "enriched",
    "dim_customer": "d_customer",
    "dim_geography": "d_geography",
    "dim_service_profile": "d_service",
    "dim_churn_reason": "d_reason",
    "dim_date": "d_date",
    "fct_customer_monthly_snapshot": "f_month",
    "fct_support_event": "f_event",
}


def _used(sql: str) -> set[str]:
    direct = {name for name in PARTS if re.search(rf"(FROM|JOIN) {name}\b", sql)}
    return direct.union(*[_used(PARTS[name]) for name in direct])


def query(sql: str) -> str:
    """``sql`` preceded by the parts it reads, directly or through others."""
    used = _used(sql)
    parts = ", ".join(f"{name} AS MATERIALIZED ({body})" for name, body in PARTS.items() if name in used)
    return f"WITH {parts} {sql}" if parts else sql
