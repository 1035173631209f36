"""Cleaning of the landed extracts. Everything here stays lazy.

Dimension sides carry no broadcast hint: Spark compares their size with its own threshold, and the
adaptive skew join takes over for a dimension beyond it.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almsbook.functions.money import money
from almsbook.functions.text import display_name, name_key, normal_email
from almsbook.operators.matching import survivor_map
from almsbook.operators.merging import first_per_group


def clean_names(contacts: DataFrame) -> DataFrame:
    return contacts.select(
        "donor_id",
        display_name(F.col("donor_name")).alias("name_display"),
        name_key(F.col("donor_name")).alias("name_key"),
    )


def stg_donors(contacts: DataFrame) -> DataFrame:
    """One donor per normalised name: the record with the smallest id survives."""
    kept = first_per_group(
        contacts.select("donor_id", "donor_name", "donor_type", "email", "first_gift_date", "state"),
        [name_key(F.col("donor_name"))],
        ["donor_id"],
    )
    return kept.withColumns(
        {"donor_name": display_name(F.col("donor_name")), "email": normal_email(F.col("email"))}
    )


def donor_survivor_map(contacts: DataFrame) -> DataFrame:
    """Every donor id with the id of the record that survives the dedupe."""
    return survivor_map(contacts, name_key(F.col("donor_name")), "donor_id", "survivor_id")


def stg_gifts(gifts: DataFrame, funds: DataFrame) -> DataFrame:
    return gifts.join(funds.select("fund_id"), "fund_id", "left_semi").select(gifts.columns)


def gifts_orphaned(gifts: DataFrame, funds: DataFrame) -> DataFrame:
    """Gifts whose fund is missing from the dimension or missing altogether."""
    return gifts.join(funds.select("fund_id"), "fund_id", "left_anti").select(gifts.columns)


def pledge_status(pledges: DataFrame) -> DataFrame:
    paid_up = F.col("paid_amount") >= F.col("pledged_amount")
    return pledges.withColumn("status", F.when(paid_up, "Paid in Full").otherwise("Active"))


def stg_pledges(pledges: DataFrame) -> DataFrame:
    return pledges.withColumn("has_overpayment_flag", F.col("paid_amount") > F.col("pledged_amount"))


def pledges_overpaid(pledges: DataFrame) -> DataFrame:
    return pledges.where(F.col("paid_amount") > F.col("pledged_amount"))


def stg_ledger(ledger: DataFrame) -> DataFrame:
    return ledger.select(
        "transaction_id", "line_no", "transaction_date", "account_number", "fund_id", "subsidiary_id",
        F.coalesce("debit_amount", money(F.lit(0))).alias("debit_amount"),
        F.coalesce("credit_amount", money(F.lit(0))).alias("credit_amount"),
        "memo", "source_gift_id",
    )
