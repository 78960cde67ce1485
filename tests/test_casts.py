import datetime as dt
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from claimweave.functions import casts
from claimweave.functions.names import name_part, organisation_name, split_full_name


def one(spark, value, make, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(make(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize("text, want", [
    ("1.0", 1), ("1.5", 2), ("2.5", 3), ("-1.5", -2), ("1e3", 1000), (" 7 ", 7), ("", None),
    ("abc", None), ("2147483648", None), (".5", 1), (None, None)])
def test_int(spark, text, want):
    assert one(spark, text, casts.to_int) == want


@pytest.mark.parametrize("text", [
    "2024-01-05", "2024/01/05", "2024-1-5", " 2024-01-05 ", "2024-01-05 10:00:00", "2024",
    "2024-01", "01/05/2024", "2024-02-30", "2024-01-05 xyz", "2024-01-05x", "2024 01 05",
    "2024-01/05", "", None])
def test_date_like_duckdb(spark, text):
    want = duckdb.execute("SELECT TRY_CAST(? AS DATE)", [text]).fetchall()[0][0]
    assert one(spark, text, casts.to_date) == want


@pytest.mark.parametrize("text", [
    "2024-01-05", "2024-01-05 10:00", "2024/01/05 10:00:00", "10:00", "2024-01-05 10",
    "2024-01-05  10:00:00", "2024-01-05T10:00:00.123", "2024-01-05 25:00:00", None])
def test_timestamp_like_duckdb(spark, text):
    want = duckdb.execute("SELECT TRY_CAST(? AS TIMESTAMP)", [text]).fetchall()[0][0]
    assert one(spark, text, casts.to_timestamp) == want


@pytest.mark.parametrize("text, want", [
    ("12.345", Decimal("12.35")), ("1e3", Decimal("1000.00")), ("$5", None), ("", None),
    ("99999999999.99", None), ("-0.005", Decimal("-0.01"))])
def test_money(spark, text, want):
    assert one(spark, text, lambda c: casts.to_decimal(c, 12, 2)) == want


@pytest.mark.parametrize("text, want", [
    ("N", False), ("Y", True), ("no", False), ("0", False), (" true ", None), ("2", None)])
def test_bool(spark, text, want):
    assert one(spark, text, casts.to_bool) is want


def test_title_case_and_lists(spark):
    assert one(spark, " mary ANN ", casts.title_case) == "Mary ann"
    assert one(spark, None, casts.title_case) == ""
    assert one(spark, " ED ", lambda c: casts.one_of(c, ("ed",))) == "ed"
    assert one(spark, "emergency", lambda c: casts.one_of(c, ("ed",))) is None
    assert one(spark, "x", lambda c: casts.one_of_or(c, ("M",), "U")) == "U"
    assert one(spark, None, lambda c: casts.one_of_or(c, ("M",), "U")) == "U"
    assert one(spark, " 1234567890", casts.npi) == "1234567890"
    assert one(spark, "123", casts.npi) is None
    assert one(spark, "(415) 555-1234", casts.digits_only) == "4155551234"
    assert one(spark, "---", casts.digits_only) == ""
    assert one(spark, "1-415-555-1234", casts.digits_only) == "14155551234"
    assert one(spark, "1-415-555-1234", lambda c: casts.digits_only(c, True)) == "4155551234"


@pytest.mark.parametrize("name, want, strict", [
    ("GRAND SPA", "GRAND S", False), ("GRAND SPA", "GRAND SPA", True),
    ("SMITH & CO, LLC", "SMITH & CO,", False), ("SMITH & CO, LLC", "SMITH & CO", True),
    ("Foo p.a.", "FOO", False), ("Firm 3 Inc ", "FIRM 3", False)])
def test_organisation_name(spark, name, want, strict):
    assert one(spark, name, lambda c: organisation_name(c, strict)) == want


def test_person_names(spark):
    assert one(spark, "Smith, Jane MD", lambda c: name_part(c, 1)) == "Smith,"
    assert one(spark, "Smith, Jane MD", lambda c: name_part(c, -1)) == "MD"
    assert one(spark, "Smith", lambda c: name_part(c, 1)) == "Unknown"
    assert one(spark, None, lambda c: name_part(c, -1)) == "Unknown"
    assert one(spark, "Ann Lee Jr", lambda c: split_full_name(c)[1]) == "Lee Jr"
    assert one(spark, "Ann", lambda c: split_full_name(c)[1]) == ""


def test_dim_date(spark):
    from claimweave.plans.dimensions import dim_date

    facts = spark.sql("SELECT date'2024-03-01' AS snapshot_date, CAST(NULL AS date) AS submitted_date")
    days = dim_date(facts)
    assert days.count() == 366
    row = days.filter("date_key = date'2024-01-07'").first()
    assert (row.day_of_week, row.day_name, row.month_name, row.is_weekend) == (
        0, "Sunday", "January", True)
    assert (row.fiscal_year, row.fiscal_quarter, row.fiscal_quarter_true) == (2024, 4, 2)
    last = days.filter("date_key = date'2024-12-30'").first()
    assert (last.week_of_year, last.fiscal_year, last.fiscal_quarter) == (1, 2025, 3)
    assert isinstance(last.date_key, dt.date)
