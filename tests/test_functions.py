from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from almsbook.functions import calendar, money, text
from almsbook.plans.calendar import date_spine, dim_date
from helpers import day


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_fiscal_period_of_every_day(spark):
    first = date(2023, 1, 1)
    days = [first + timedelta(n) for n in range(800)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    d = F.col("d")
    got = df.select("d", calendar.fiscal_year(d), calendar.fiscal_month(d), calendar.date_key(d)).collect()
    for when, year, month, key in got:
        assert year == (when.year + 1 if when.month > 6 else when.year)
        assert month == (when.month - 6 if when.month > 6 else when.month + 6)
        assert key == int(when.strftime("%Y%m%d"))


def test_date_key_round_trip(spark):
    days = [date(1995, 1, 1), date(2000, 2, 29), date(2026, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in df.select(calendar.key_date(calendar.date_key(F.col("d")))).collect()] == days


def test_fiscal_month_labels(spark):
    df = spark.createDataFrame([(m,) for m in [1, 6, 7, 12, 0, 13, None]], "m int")
    labels = [r[0] for r in df.select(calendar.fiscal_month_label(F.col("m"))).collect()]
    assert labels == ["Jul", "Dec", "Jan", "Jun", None, None, None]


def test_undated_rows_have_no_period(spark):
    df = spark.createDataFrame([(day("2024-07-01"),), (None,)], "d date")
    assert [tuple(r)[1:] for r in calendar.with_fiscal_period(df, "d").collect()] == [(2025, 1)]


def test_date_dimension(spark):
    window = spark.createDataFrame([(date(2023, 7, 1), date(2026, 6, 30))], "lo date, hi date")
    dates = dim_date(date_spine(window))
    assert dates.count() == 1096
    sample = dates.where("date_id in (20230701, 20240229, 20260630)").orderBy("date_id").collect()
    assert [tuple(r) for r in sample] == [
        (20230701, date(2023, 7, 1), 2024, 1, "July", 3),
        (20240229, date(2024, 2, 29), 2024, 8, "February", 1),
        (20260630, date(2026, 6, 30), 2026, 12, "June", 2),
    ]


def test_names(spark):
    cases = {
        "  HUMPHREY-ANDERSON  o'brien 3rd\tDDS ": ("Humphrey-Anderson O'Brien 3Rd Dds", "humphrey-anderson o'brien 3rd dds"),
        "Élan  éco": ("Élan Éco", "élan éco"),
        "mcclure": ("Mcclure", "mcclure"),
        "": ("", ""),
        "  ": ("", ""),
        None: (None, None),
    }
    df = spark.createDataFrame([(c,) for c in cases], "name string")
    got = df.select("name", text.display_name(F.col("name")), text.name_key(F.col("name"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == cases


def test_email(spark):
    assert one(spark, text.normal_email(F.lit("  Ann@Example.ORG "))) == "ann@example.org"


def test_percent_rounds_real_ties_up_and_guards_zero(spark):
    df = spark.createDataFrame(
        [(Decimal("1.005"), Decimal("100")), (Decimal("-0.25"), Decimal("200")), (Decimal("1"), Decimal("0")), (Decimal("1"), None)],
        "a decimal(18,3), b decimal(18,2)",
    )
    # 1.005 becomes 1.01 as money first; -0.125 % is a true tie.
    assert [r[0] for r in df.select(money.percent(F.col("a"), F.col("b"), 2)).collect()] == [1.01, -0.13, None, None]


def test_labels(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in ("1234.50", "-1234.50", "0.49", "-999999.99")], "v decimal(18,2)")
    got = [tuple(r) for r in df.select(money.dollars(F.col("v")), money.signed_dollars(F.col("v"))).collect()]
    assert got == [("$1,235", "+$1,235"), ("$-1,235", "-$1,235"), ("$0", "+$0"), ("$-1,000,000", "-$1,000,000")]
