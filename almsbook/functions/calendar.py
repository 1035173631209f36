"""Fiscal calendar as plain expressions of a date, so facts need no calendar join."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fiscal year starts in July and carries the year it ends in.
FISCAL_START_MONTH = 7
FISCAL_MONTH_LABELS = [
    "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
    "Jan", "Feb", "Mar", "Apr", "May", "Jun",
]


def fiscal_year(day: Column) -> Column:
    started = F.month(day) >= FISCAL_START_MONTH
    return F.year(day) + F.when(started, 1).otherwise(0)


def fiscal_month(day: Column) -> Column:
    return F.pmod(F.month(day) - FISCAL_START_MONTH, F.lit(12)) + 1


def date_key(day: Column) -> Column:
    """The date as a YYYYMMDD integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def key_date(key: Column) -> Column:
    """The date behind a YYYYMMDD integer."""
    year, month = (key / 10000).cast("int"), (key / 100).cast("int") % 100
    return F.make_date(year, month, key % 100)


def fiscal_month_label(month: Column) -> Column:
    """'Jul' for fiscal month 1 … 'Jun' for 12; NULL outside that range."""
    labels = F.array(*[F.lit(label) for label in FISCAL_MONTH_LABELS])
    return F.try_element_at(labels, F.when(month.between(1, 12), month.cast("int")))


def with_fiscal_period(df: DataFrame, day: str) -> DataFrame:
    """Add fiscal_year and fiscal_month; rows without a date belong to no period and drop out.

    A frame that has both already, such as sums per period, keeps them.
    """
    if {"fiscal_year", "fiscal_month"} <= set(df.columns):
        return df.where(F.col("fiscal_year").isNotNull())
    return df.where(F.col(day).isNotNull()).withColumns(
        {"fiscal_year": fiscal_year(F.col(day)), "fiscal_month": fiscal_month(F.col(day))}
    )
