import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.functions import flags
from starloom.functions.audit import AUDIT_COLUMNS, Audit
from starloom.functions.dates import date_key, month_floor, months_before
from starloom.functions.keys import NULL_TOKEN, routed_reason_key, surrogate_key, unknown_key
from starloom.functions.numbers import agrees, amount_if, big_whole, moment, money, safe_ratio, signed_total, whole
from starloom.functions.text import clean_text, is_zip_cut, key_text, yes_no, zip5
from starloom.plans.entities import age_band, tenure_band


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_clean_text_trims_spaces_only(value):
    assert value(clean_text, "string", " a ", "", "   ", None, "\t") == ["a", None, None, None, "\t"]


def test_a_blank_key_survives(value):
    assert value(key_text, "string", " C1 ", "  ", None) == ["C1", "", None]


def test_yes_no_is_three_valued(value):
    words = ["Yes", " y ", "TRUE", "1", "no", "N", "False ", "0", "maybe", "", None]
    assert value(yes_no, "string", *words) == [True] * 4 + [False] * 4 + [None] * 3


def test_zip_is_padded_and_cut(value):
    assert value(zip5, "int", 601, 90210, 123456, None) == ["00601", "90210", "12345", None]
    assert value(is_zip_cut, "int", 601, 90210, 123456) == [False, False, True]


def test_safe_casts_give_null_instead_of_failing(value):
    assert value(money, "string", "1.005", "-3", "x", "1e30", None) == [Decimal("1.01"), Decimal("-3.00"), None, None, None]
    assert value(whole, "string", "12", "abc", "99999999999") == [12, None, None]
    assert value(big_whole, "string", "99999999999", "?") == [99999999999, None]
    assert value(moment, "string", "2025-01-02 03:04:05", "soon") == [dt.datetime(2025, 1, 2, 3, 4, 5), None]


def test_signed_total_reads_missing_parts_as_nothing(rows):
    df = rows("a decimal(18,2), b decimal(18,2)", (Decimal("5"), None), (None, Decimal("2")), (None, None))
    total = signed_total([F.col("a")], [F.col("b")])
    assert [r[0] for r in df.select(total).collect()] == [Decimal("5"), Decimal("-2"), Decimal("0")]


def test_agrees_within_a_cent(rows):
    pairs = [(Decimal("1.00"), Decimal("1.01")), (Decimal("1.00"), Decimal("1.02")), (None, Decimal("1"))]
    df = rows("a decimal(18,2), b decimal(18,2)", *pairs)
    assert [r[0] for r in df.select(agrees(F.col("a"), F.col("b"))).collect()] == [True, False, None]


def test_safe_ratio_survives_zero(rows):
    df = rows("a decimal(18,2), n int", (Decimal("10"), 3), (Decimal("10"), 0), (None, 2), (Decimal("1"), None))
    assert [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("n"))).collect()] == [Decimal("3.33"), None, None, None]


def test_amount_if_is_never_null_nor_negative(rows):
    data = [(True, Decimal("4")), (True, Decimal("-4")), (True, None), (False, Decimal("4")), (None, Decimal("4"))]
    df = rows("f boolean, a decimal(18,2)", *data)
    got = [r[0] for r in df.select(amount_if(F.col("f"), F.col("a"))).collect()]
    assert got == [Decimal("4")] + [Decimal("0")] * 4


def test_range_flags_have_two_null_policies(value):
    assert value(lambda c: flags.within(c, low=0), "int", 0, -1, None) == [True, False, None]
    assert value(lambda c: flags.within(c, above=0), "int", 1, 0, None) == [True, False, None]
    assert value(lambda c: flags.within(c, 1, 5, missing=True), "int", 0, 1, 5, 6, None) == [False, True, True, False, True]


def test_labels_match_exactly(value):
    assert value(lambda c: flags.is_label(c, "Stayed"), "string", "Stayed", "stayed", None) == [True, False, None]
    assert value(lambda c: flags.is_label(c, "a", "b"), "string", "b", "c", None) == [True, False, None]


def test_flag_arithmetic_reads_unknown_as_false(rows):
    df = rows("a boolean, b boolean, c boolean", (True, None, True), (None, None, None), (True, True, True))
    cols = [F.col(c) for c in "abc"]
    shown = [flags.true_count(*cols), flags.any_true(*cols), flags.at_least_true(2, *cols), flags.all_true(*cols)]
    assert [tuple(r) for r in df.select(*shown).collect()] == [(2, True, True, False), (0, False, False, False), (3, True, True, True)]


@pytest.mark.parametrize(
    "band, cases",
    [
        (age_band, {17: "18-29", 18: "18-29", 29: "18-29", 30: "30-44", 44: "30-44", 45: "45-59", 59: "45-59", 60: "60+", None: "Unknown"}),
        (
            tenure_band,
            {
                **{-1: "0-6 months", 0: "0-6 months", 6: "0-6 months", 7: "7-12 months", 12: "7-12 months"},
                **{13: "13-24 months", 24: "13-24 months", 25: "25-48 months", 48: "25-48 months", 49: "49+ months"},
                None: "Unknown",
            },
        ),
    ],
)
def test_bands_at_their_edges(value, band, cases):
    assert value(band, "int", *cases) == list(cases.values())


def test_months(value, rows):
    assert value(month_floor, "timestamp", dt.datetime(2025, 3, 31, 23), None) == [dt.date(2025, 3, 1), None]
    assert value(date_key, "date", dt.date(2025, 3, 9), None) == [20250309, None]
    df = rows("m date, t int", (dt.date(2025, 3, 1), 3), (dt.date(2025, 3, 1), 0), (dt.date(2025, 3, 1), None), (None, 3))
    got = [r[0] for r in df.select(months_before(F.col("m"), F.col("t"))).collect()]
    assert got == [dt.date(2025, 1, 1), dt.date(2025, 4, 1), None, None]


def test_surrogate_key_is_md5_over_joined_parts(rows):
    df = rows("a string, b boolean, d date", ("x", True, dt.date(2025, 1, 1)), (None, None, None))
    got = [r[0] for r in df.select(surrogate_key(F.col("a"), F.col("b"), F.col("d"))).collect()]
    assert got == [md5("x-true-2025-01-01"), md5("-".join([NULL_TOKEN] * 3))]


def test_key_parts_are_ambiguous_unless_prefixed(rows):
    df = rows("a string, b string", ("a-b", "c"), ("a", "b-c"))
    cols = F.col("a"), F.col("b")
    plain, prefixed = zip(*df.select(surrogate_key(*cols), surrogate_key(*cols, length_prefixed=True)).collect())
    assert len(set(plain)) == 1 and len(set(prefixed)) == 2


def test_an_id_that_spells_unknown_meets_the_unknown_member(value):
    assert value(surrogate_key, "string", "UNKNOWN") == [md5("UNKNOWN")]
    assert value(lambda c: unknown_key(), "string", "any") == [md5("UNKNOWN")]


def test_reason_routing(rows):
    data = [(False, "C", "R"), (True, "C", "R"), (True, None, "R"), (True, None, None), (None, "C", "R"), (None, None, None)]
    df = rows("churned boolean, c string, r string", *data)
    got = [r[0] for r in df.select(routed_reason_key(F.col("churned"), F.col("c"), F.col("r"))).collect()]
    assert got == [
        md5("Not Applicable-Not Applicable"),
        md5("C-R"),
        md5(f"{NULL_TOKEN}-R"),
        md5("Unknown-Unknown"),
        md5("C-R"),
        md5(f"{NULL_TOKEN}-{NULL_TOKEN}"),
    ]


def test_first_rule_takes_the_first(value):
    rules = lambda c: flags.first_rule([("neg", c < 0), ("small", c < 10)], "big")
    assert value(rules, "int", -1, 5, 50, None) == ["neg", "small", "big", "big"]


def test_audit_precedence(rows):
    env = {"DBT_ETL_JOB_ID": "env-job", "DBT_ETL_TASK_NAME": ""}
    audit = Audit.of_run({"etl_run_id": "run-1", "etl_job_id": ""}, environ=env)
    assert (audit.etl_job_id, audit.etl_run_id, audit.etl_task_name) == ("env-job", "run-1", "")
    assert Audit.of_run({}, environ={}).etl_task_name == "manual"
    stamped = audit.on(rows("a int", (1,), (2,)))
    assert stamped.columns == ["a", *AUDIT_COLUMNS]
    assert stamped.select("etl_updated_at").distinct().count() == 1
