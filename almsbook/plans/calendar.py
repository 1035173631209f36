"""Date spine and date dimension."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almsbook.functions.calendar import FISCAL_START_MONTH, date_key, fiscal_month, fiscal_year


def fiscal_window(*dates: tuple[DataFrame, str]) -> DataFrame:
    """One row (lo, hi): the whole fiscal years that the dates of all given (frame, column) pairs fall in.

    Each frame shrinks to its first and last day before they meet.
    """
    each = [df.agg(F.min(day).alias("first"), F.max(day).alias("last")) for df, day in dates]
    ends = reduce(DataFrame.unionByName, each).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    start = F.lit(FISCAL_START_MONTH)
    return ends.select(
        F.make_date(fiscal_year(F.col("first")) - 1, start, F.lit(1)).alias("lo"),
        F.date_sub(F.make_date(fiscal_year(F.col("last")), start, F.lit(1)), 1).alias("hi"),
    )


def date_spine(window: DataFrame) -> DataFrame:
    """One row per day of the one-row frame (lo, hi)."""
    return window.where("lo IS NOT NULL").select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("calendar_date")
    )


def dim_date(spine: DataFrame) -> DataFrame:
    day = F.col("calendar_date")
    return spine.select(
        date_key(day).alias("date_id"),
        day,
        fiscal_year(day).alias("fiscal_year"),
        fiscal_month(day).alias("fiscal_month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
    )
