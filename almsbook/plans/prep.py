"""Manual adjustments: clean names, attach the fund, part valid rows from faulty ones."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almsbook.functions.text import display_name

# Reasons as the error log words them.
MISSING_AMOUNT = "Missing adjustment_amount"
UNKNOWN_FUND = "fund_id not found in dim_fund"

FUND_COLUMNS = ["fund_name", "fund_type", "restriction_type"]


def prep_joined(adjustments: DataFrame, funds: DataFrame) -> DataFrame:
    cleaned = adjustments.withColumn("donor_name", display_name(F.col("donor_name")))
    known = funds.select("fund_id", *FUND_COLUMNS, F.lit(True).alias("_known"))
    matched = F.col("_known").isNotNull().alias("fund_matched")
    return cleaned.join(known, "fund_id", "left").select(*adjustments.columns, *FUND_COLUMNS, matched)


def prep_valid(joined: DataFrame) -> DataFrame:
    return joined.where(F.col("adjustment_amount").isNotNull() & F.col("fund_matched")).drop("fund_matched")


def prep_errors(joined: DataFrame) -> DataFrame:
    """The remaining rows with one reason each; a missing amount comes before an unknown fund."""
    no_amount = F.col("adjustment_amount").isNull()
    reason = F.when(no_amount, MISSING_AMOUNT).when(~F.col("fund_matched"), UNKNOWN_FUND).otherwise("Unknown")
    return (
        joined.where(no_amount | ~F.col("fund_matched"))
        .withColumn("error_reason", reason)
        .drop("fund_matched")
    )


def prep_error_breakdown(errors: DataFrame) -> DataFrame:
    counts = errors.groupBy(F.col("error_reason").alias("reason")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "reason")
