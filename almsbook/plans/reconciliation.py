"""Gift revenue against posted ledger revenue by fund and fiscal month."""

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almsbook.functions.calendar import with_fiscal_period
from almsbook.functions.money import money, whole
from almsbook.operators.matching import without_match
from almsbook.operators.reconcile import ABSOLUTE_TOLERANCE, NEEDS_REVIEW, RELATIVE_TOLERANCE, reconcile
from almsbook.sources.storage import materialize

FUND_MONTH = ["fund_id", "fiscal_year", "fiscal_month"]


def gift_side(gifts: DataFrame) -> DataFrame:
    periods = with_fiscal_period(gifts, "gift_date")
    return periods.groupBy(*FUND_MONTH).agg(money(F.sum("gift_amount")).alias("amount"))


def gl_side(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    """Credits of income accounts. Lines are summed per account first, so the few accounts that nearly
    all lines carry meet the chart of accounts as one row per fund and month."""
    sums = with_fiscal_period(ledger, "transaction_date").groupBy("account_number", *FUND_MONTH).agg(
        F.sum("credit_amount").alias("amount")
    )
    # An inner join: Spark would move a semi-join below the sum again.
    income = accounts.where(F.col("account_type") == "Income").select("account_number").distinct()
    return sums.join(income, "account_number").groupBy(*FUND_MONTH).agg(money(F.sum("amount")).alias("amount"))


def fund_reconciliation(
    gifts: DataFrame,
    ledger: DataFrame,
    accounts: DataFrame,
    absolute: Decimal = ABSOLUTE_TOLERANCE,
    relative: Decimal = RELATIVE_TOLERANCE,
) -> DataFrame:
    return reconcile(
        gift_side(gifts).withColumnRenamed("amount", "gifts_recorded"),
        gl_side(ledger, accounts).withColumnRenamed("amount", "gl_posted"),
        FUND_MONTH, "gifts_recorded", "gl_posted", absolute, relative,
    )


def recon_status_counts(recon: DataFrame) -> DataFrame:
    return recon.groupBy("status").agg(F.count("*").alias("n"))


def variance_by_fund(recon: DataFrame, funds: DataFrame) -> DataFrame:
    """Net variance per fund name; funds without a name in the dimension are left out."""
    per_fund = recon.groupBy("fund_id").agg(F.sum("variance_amount").alias("variance"))
    return (
        per_fund.join(funds.select("fund_id", "fund_name"), "fund_id")
        .where(F.col("fund_name").isNotNull())
        .groupBy("fund_name")
        .agg(whole(F.sum("variance")).alias("variance"))
        .orderBy("variance", "fund_name")
    )


def flagged_variances(recon: DataFrame, funds: DataFrame, top_n: int | None = 15) -> DataFrame:
    """The largest variances needing review, with fund names; ``None`` keeps them all."""
    order = [F.abs("variance_amount").desc(), F.col("fund_id").asc_nulls_last(), "fiscal_year", "fiscal_month"]
    flagged = recon.where(F.col("status") == NEEDS_REVIEW)
    if top_n is not None:
        flagged = flagged.orderBy(*order).limit(top_n)
    return flagged.join(funds.select("fund_id", "fund_name"), "fund_id", "left").select(
        "fund_id", "fund_name", "fiscal_year", "fiscal_month", "gifts_recorded", "gl_posted",
        F.col("variance_amount").alias("variance"), "status",
    )


def recon_totals(recon: DataFrame) -> DataFrame:
    return recon.agg(
        money(F.sum("gifts_recorded")).alias("total_gifts"),
        money(F.sum("gl_posted")).alias("total_gl"),
        money(F.sum("variance_amount")).alias("net_variance"),
        F.count_if(F.col("status") == NEEDS_REVIEW).alias("needs_review"),
    )


def gifts_without_gl(gifts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Gifts that no ledger line refers to."""
    return without_match(gifts, ledger, "gift_id", "source_gift_id")


def missing_batch_window(gifts: DataFrame, ledger: DataFrame, first_day, last_day) -> DataFrame:
    """Gifts of a closed date range that never reached the ledger: a batch that failed to load.

    The range's keys are written first, so that the ledger is matched on those alone.
    """
    inside = gifts.where(F.col("gift_date").between(F.lit(first_day), F.lit(last_day)))
    keys = materialize(inside.select(F.col("gift_id").alias("source_gift_id")).distinct(), "window-keys")
    return gifts_without_gl(inside, ledger.select("source_gift_id").join(keys, "source_gift_id", "left_semi"))


def transaction_balances(ledger: DataFrame) -> DataFrame:
    """Debits less credits per transaction; the lines of one transaction combine before they move."""
    nothing = money(F.lit(0))
    line = F.coalesce("debit_amount", nothing) - F.coalesce("credit_amount", nothing)
    return ledger.groupBy("transaction_id").agg(money(F.sum(line)).alias("diff"))


def gl_unbalanced(ledger: DataFrame, tolerance: Decimal = Decimal("0.01")) -> DataFrame:
    return transaction_balances(ledger).where(F.abs("diff") > F.lit(tolerance))
