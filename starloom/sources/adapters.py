"""Raw tables derived from the test data, with deliberate defects.

Integer arithmetic and text only, so that another engine derives the same bits. The rules of
each table are described in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.sources.bronze import Bronze

LOADED = "2002-01-01 00:00:00"
LOADED_BEFORE = "2001-12-31 00:00:00"

# The answers a yes/no field of the test customers cycles through.
ANSWERS = ("Yes", "Yes", "No", "No", " YES ", "n", "True", "0", "", "maybe", None)
FLAG_FIELDS = (
    "Married",
    "Phone Service",
    "Multiple Lines",
    "Internet Service",
    "Online Security",
    "Online Backup",
    "Device Protection Plan",
    "Premium Tech Support",
    "Streaming TV",
    "Streaming Movies",
    "Streaming Music",
    "Unlimited Data",
    "Paperless Billing",
)
ISSUES = (
    "Billing & Payment",
    "Account & Contract",
    "Internet Connectivity",
    "Slow Internet",
    "Device Setup",
    "Phone Service",
    "Cancellation Request",
    "Service Outage",
    "Other",
    "Competitor Offer",
    "Service Complaint",
    "Pricing Complaint",
    "Unlisted Issue",
)
CONTRACTS = ("Month-to-Month", "One Year", "Two Year")
PAYMENTS = ("Bank Withdrawal", "Credit Card", "Mailed Check")
OFFERS = ("", "Offer A", "Offer B", "Offer C", "Offer D", "Offer E")
CATEGORIES = ("Competitor", "Dissatisfaction", "Attitude", "Price", "")
REASONS = ("Offer", "Service", "Staff", "Cost", "", "Offer", "Network", "Staff", "Cost", "Moved")

_NEW, _OLD = f"timestamp'{LOADED}'", f"timestamp'{LOADED_BEFORE}'"


def _pick(number: str, values) -> str:
    """The value at position ``number % len(values)``."""
    listed = ", ".join("null" if v is None else f"'{v}'" for v in values)
    return f"elt(int(({number}) % {len(values)}) + 1, {listed})"


def _pad(number: str, width: int) -> str:
    return f"lpad(string({number}), {width}, '0')"


def _cents(amount: str) -> str:
    """A non-negative number of cents as text with two decimals."""
    return f"concat(({amount}) div 100, '.', {_pad(f'({amount}) % 100', 2)})"


def _customer_id(key: str) -> str:
    """Every 131st customer goes by an id the customer master does not know."""
    return f"concat(if({key} % 131 = 0, 'X', 'C'), {_pad(key, 7)})"


def customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Every tenth customer has a second copy, which is newer or, for every other one, older."""
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
        "c_custkey as k",
        "c_nationkey as n",
        "n_name",
        "c_mktsegment = 'MACHINERY' as churned",
        "c_mktsegment = 'BUILDING' as joined",
        "string(cast(c_acctbal as decimal(18,2))) as balance",
        "explode(if(c_custkey % 10 = 0, array(1, 2), array(1))) as copy",
    )
    priced = rows.selectExpr(
        "*",
        "10000 + (k * 7919) % 900000 as charges",
        "if(k % 7 = 0, null, (k * 31) % 5000) as refunds",
        "(k % 10) * 1000 as extra",
        "(k * 17) % 200000 as distance",
    )
    revenue = "charges - coalesce(refunds, 0) + extra + distance + if(k % 500 = 7, 2, 0)"
    columns = {
        "Customer ID": f"concat(' C', {_pad('k', 7)}, ' ')",
        "Gender": "case when k % 97 = 0 then '  ' when k % 2 = 0 then 'Female' else 'Male' end",
        "Age": "int(if(k % 89 = 0, null, 16 + k % 70))",
        "Number of Dependents": "int(k % 4)",
        "City": "concat(n_name, ' ')",
        "Zip Code": "int(case when k % 211 = 0 then null when k % 223 = 0 then 123456 else 600 + n end)",
        "Latitude": "double(n) * 1.5D - 20",
        "Longitude": "double(n) * 2.25D - 30",
        "Number of Referrals": "int(k % 11 + 100 * (copy - 1))",
        "Tenure in Months": "int(if(k % 101 = 0, null, k % 73))",
        "Offer": _pick("k", OFFERS),
        "Avg Monthly Long Distance Charges": f"if(k % 131 = 0, 'n/a', {_cents('k % 5000')})",
        "Internet Type": _pick("k", ("", "Fiber Optic", "DSL", " Cable ")),
        "Avg Monthly GB Download": "int(k % 60)",
        **{f: _pick(f"k + {7 * i}", ANSWERS) for i, f in enumerate(FLAG_FIELDS)},
        "Contract": _pick("k", CONTRACTS),
        "Payment Method": _pick("k + 1", PAYMENTS),
        "Monthly Charge": "if(k % 149 = 0, 'abc', balance)",
        "Total Charges": _cents("charges"),
        "Total Refunds": _cents("refunds"),
        "Total Extra Data Charges": _cents("extra"),
        "Total Long Distance Charges": _cents("distance"),
        "Total Revenue": f"if(k % 303 = 0, null, {_cents(revenue)})",
        "Customer Status": "case when k % 401 = 0 then ' ' when churned then 'Churned' when joined then ' Joined' else 'Stayed' end",
        "Churn Category": f"if(churned, {_pick('k', CATEGORIES)}, '')",
        "Churn Reason": f"if(churned, {_pick('k', REASONS)}, '')",
        "etl_ingested_at": f"if(k % 20 = 0 and copy = 2, {_OLD}, {_NEW})",
        "etl_file_row_number": "bigint(k * 10 + copy)",
        "etl_source_file": "'crm.csv'",
        "etl_source_system": "'CRM'",
    }
    return _select(priced, columns)


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expression} as `{name}`" for name, expression in columns.items()])


def zips(nation: DataFrame, region: DataFrame) -> DataFrame:
    """ZIPs of the nations (some twice) and, per region, one ZIP without customers."""
    copies = nation.selectExpr("n_nationkey as n", "explode(if(n_nationkey % 5 = 0, array(1, 2), array(1))) as copy")
    served = {
        "Zip Code": "int(600 + n)",
        "Population": "case n when 3 then '0' when 7 then 'unknown' else string((n + 1) * 1000 + copy) end",
        "etl_ingested_at": f"if(copy = 2, {_OLD}, {_NEW})",
        "etl_file_row_number": "bigint(n * 10 + copy)",
        "etl_source_file": "'census.csv'",
        "etl_source_system": "'CENSUS'",
    }
    unserved = {
        "Zip Code": "int(900 + r_regionkey)",
        "Population": "string(r_regionkey * 500)",
        "etl_ingested_at": _NEW,
        "etl_file_row_number": "bigint(r_regionkey * 10 + 1000)",
        "etl_source_file": "'census.csv'",
        "etl_source_system": "'CENSUS'",
    }
    return _select(copies, served).unionByName(_select(region, unserved))


def months(orders: DataFrame) -> DataFrame:
    price = "cast(o_totalprice as decimal(18,2))"
    who = _customer_id("o_custkey")
    status = "case o_orderstatus when 'F' then 'Stayed' when 'O' then 'Joined ' else 'Churned' end"
    columns = {
        "monthly_snapshot_id": f"concat(' ', {who}, year(o_orderdate) * 100 + month(o_orderdate), ' ')",
        "customer_id": f"concat(' ', {who}, ' ')",
        "snapshot_month": "date(o_orderdate)",
        "tenure_months": "if(o_orderkey % 307 = 0, 'unknown', string(o_orderkey % 60))",
        "contract_type": _pick("o_orderkey", ("Month-to-Month", " One Year", "Two Year", "")),
        "internet_type": _pick("o_custkey", ("Fiber Optic", "DSL", "Cable", " ")),
        "monthly_charge": f"string({price} - 5000)",
        "monthly_revenue": f"string({price} + 10)",
        "total_revenue": f"string({price} * 2)",
        "customer_status": f"if(o_orderkey % 317 = 0, '', {status})",
        "updated_at": "if(o_orderkey % 331 = 0, null, timestamp(o_orderdate))",
        "batch_id": "concat('B', o_orderkey % 12)",
        "source_system": "' billing '",
        "etl_ingested_at": _NEW,
        "etl_file_row_number": "o_orderkey",
        "etl_source_file": "'billing.csv'",
        "etl_source_system": "'BILLING'",
    }
    return _select(orders, columns)


def events(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items as support events of the customer who ordered; several versions of an event."""
    status = """case when l_linestatus = 'F' then if(l_returnflag = 'R', 'Escalated', 'Resolved')
                     when l_returnflag = 'A' then ' Closed - Unresolved' else 'Pending' end"""
    owned = lineitem.join(orders.select("o_orderkey", "o_custkey"), lineitem.l_orderkey == orders.o_orderkey)
    shipped = owned.selectExpr("*", f"{status} as status", "timestamp(l_shipdate) as shipped")
    columns = {
        "support_event_id": "concat(l_orderkey, '-', l_linenumber)",
        "customer_id": f"concat(' ', {_customer_id('o_custkey')}, ' ')",
        "event_timestamp": "if(l_partkey % 1009 = 0, null, shipped)",
        "issue_category": _pick("l_partkey", ISSUES),
        "channel": _pick("l_suppkey", ("Chat", "Phone ", "Email", "Self-Service")),
        "priority": _pick("l_linenumber", ("Critical", "High", "Medium", "Low")),
        "resolution_status": "status",
        "resolution_hours": """case when l_partkey % 197 = 0 then '-1'
            when status <> 'Pending' or l_partkey % 211 = 0 then string(int(l_quantity)) end""",
        "satisfaction_score": """case when status = 'Pending' then null
            when l_partkey % 223 = 0 then '6' else string(1 + l_partkey % 5) end""",
        "updated_at": "shipped",
        "batch_id": "concat('B', l_suppkey % 7)",
        "source_system": "'crm'",
        "etl_ingested_at": _NEW,
        "etl_file_row_number": "l_partkey * 100000 + l_suppkey",
        "etl_source_file": "'crm.csv'",
        "etl_source_system": "'CRM'",
    }
    return _select(shipped, columns)


# Columns of the test tables that are read here; stating them saves a look into every file.
TEST_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
}


def raw(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(TEST_SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")


def bronze(spark: SparkSession, folder: str) -> Bronze:
    def table(name: str) -> DataFrame:
        return raw(spark, folder, name)

    return Bronze(
        customers=lambda: customers(table("customer"), table("nation")),
        zips=lambda: zips(table("nation"), table("region")),
        months=lambda: months(table("orders")),
        events=lambda: events(table("lineitem"), table("orders")),
    )
