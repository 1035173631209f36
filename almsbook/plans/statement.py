"""Per-period reconciliation statements from the flagged variances."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almsbook.functions.calendar import fiscal_month_label
from almsbook.functions.money import dollars, signed_dollars
from almsbook.plans.donors import newest_fiscal_year

PERIOD = ["fiscal_year", "fiscal_month"]


def statement_periods(flagged: DataFrame, gifts: DataFrame) -> DataFrame:
    """Periods with a flagged fund; with none at all, the first month of the newest fiscal year."""
    periods = flagged.select(*PERIOD).distinct()
    fallback = newest_fiscal_year(gifts).select("fiscal_year", F.lit(1).alias("fiscal_month"))
    nothing_flagged = flagged.agg(F.count("*")).scalar() == 0
    return periods.unionByName(fallback.where(F.col("fiscal_year").isNotNull() & nothing_flagged)).orderBy(*PERIOD)


def statement_header(periods: DataFrame, flagged: DataFrame) -> DataFrame:
    """One row per requested period, also where nothing is flagged."""
    counts = flagged.groupBy(*PERIOD).agg(F.count("*").alias("n"))
    label = F.concat(fiscal_month_label(F.col("fiscal_month")), F.lit(" FY"), F.col("fiscal_year").cast("string"))
    return periods.join(counts, PERIOD, "left").select(
        *PERIOD,
        F.format_string("FRS-%d%02d", "fiscal_year", "fiscal_month").alias("report_id"),
        label.alias("period_label"),
        F.coalesce("n", F.lit(0)).alias("n_flagged"),
    )


def statement_rows(flagged: DataFrame) -> DataFrame:
    return flagged.select(
        *PERIOD,
        F.col("fund_name").alias("fund"),
        dollars(F.col("gifts_recorded")).alias("gifts_label"),
        dollars(F.col("gl_posted")).alias("gl_label"),
        dollars(F.col("variance")).alias("variance_label"),
        signed_dollars(F.col("variance")).alias("variance_signed"),
        "status",
    )
