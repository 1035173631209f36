"""Double-entry posting of gifts: debit cash, credit contribution revenue; and what the ledger shows instead."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almsbook.functions.money import money

# Accounts of the posting rule.
CASH = "1000"
UNRESTRICTED_REVENUE = "4000"
RESTRICTED_REVENUE = "4100"


def _with_revenue_account(gifts: DataFrame, funds: DataFrame) -> DataFrame:
    """A gift to a fund the dimension lacks counts as restricted."""
    kinds = funds.select("fund_id", "restriction_type")
    kind = F.coalesce("restriction_type", F.lit("Restricted"))
    account = F.when(kind == "Restricted", RESTRICTED_REVENUE).otherwise(UNRESTRICTED_REVENUE)
    return gifts.join(kinds, "fund_id", "left").withColumn("revenue_account", account).drop("restriction_type")


def expected_revenue_account(gifts: DataFrame, funds: DataFrame) -> DataFrame:
    return _with_revenue_account(gifts, funds).select("gift_id", F.col("revenue_account").alias("account_number"))


def journal_exceptions(gifts: DataFrame, funds: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ledger lines that differ from what their gift should have posted, with what was expected.

    A gift is a debit of cash and a credit of contribution revenue, both of its amount, in its fund, on its
    day or later. Lines that name no gift of the books are left to the reconciliation.
    """
    expected = _with_revenue_account(gifts, funds).select(
        F.col("gift_id").alias("source_gift_id"), F.col("fund_id").alias("expected_fund"), "revenue_account", "gift_date", "gift_amount"
    )
    nothing = money(F.lit(0))
    debit, credit = F.coalesce("debit_amount", nothing), F.coalesce("credit_amount", nothing)
    account = F.when(F.col("line_no") == 1, CASH).otherwise(F.col("revenue_account"))
    amount = F.when(F.col("line_no") == 1, debit - credit).otherwise(credit - debit)
    problems = F.array_compact(F.array(
        F.when(~F.col("account_number").eqNullSafe(account), "account"),
        F.when(~F.col("fund_id").eqNullSafe(F.col("expected_fund")), "fund"),
        F.when(amount != F.col("gift_amount"), "amount"),
        F.when(F.col("transaction_date") < F.col("gift_date"), "date"),
    ))
    judged = ledger.join(expected, "source_gift_id").select(
        "transaction_id", "line_no", "account_number", account.alias("expected_account"), "fund_id", "expected_fund",
        money(amount - F.col("gift_amount")).alias("amount_off"), F.array_join(problems, ", ").alias("problems"),
    )
    return judged.where(F.col("problems") != "")


def line_differences(gifts: DataFrame, funds: DataFrame, ledger: DataFrame) -> DataFrame:
    """Where the lines a gift should have and the lines that name it are not the same: missing, repeated and surplus ones.

    Expected and posted lines stand in one table and are counted by gift, side, account, fund and amount. One grouped sum is
    the whole comparison, no join of the two books: equal lines combine before the shuffle, and the lines of a gift that very
    many name spread by their other columns. A line with both a debit and a credit counts on both sides, one with neither as
    an empty line. Lines that name no gift at all are none of the gifts' business; those of an unknown gift are surplus.
    ``first_transaction`` is the smallest transaction that posted the line.
    """
    posting = _with_revenue_account(gifts, funds)
    amount = money(F.col("gift_amount"))
    expected = posting.select("gift_id", "fund_id", F.inline(F.array(
        F.struct(F.lit("debit").alias("side"), F.lit(CASH).alias("account_number"), amount.alias("amount")),
        F.struct(F.lit("credit").alias("side"), F.col("revenue_account").alias("account_number"), amount.alias("amount")),
    )))
    sides = [
        F.when(F.col(f"{side}_amount") != 0, F.struct(F.lit(side).alias("side"), money(F.col(f"{side}_amount")).alias("amount")))
        for side in ("debit", "credit")
    ]
    empty = F.struct(F.lit("empty").alias("side"), money(F.lit(0)).alias("amount"))
    lines = F.array_compact(F.array(*sides))
    posted = ledger.where(F.col("source_gift_id").isNotNull()).select(
        F.col("source_gift_id").alias("gift_id"), "fund_id", "account_number", "transaction_id", F.inline(F.when(F.size(lines) > 0, lines).otherwise(F.array(empty)))
    )
    key = ["gift_id", "side", "account_number", "fund_id", "amount"]
    nothing = F.lit(None).cast(ledger.schema["transaction_id"].dataType)
    both = expected.select(*key, F.lit(1).alias("e"), F.lit(0).alias("p"), nothing.alias("t")).unionByName(
        posted.select(*key, F.lit(0).alias("e"), F.lit(1).alias("p"), F.col("transaction_id").alias("t"))
    )
    counted = both.groupBy(*key).agg(F.sum("e").alias("expected"), F.sum("p").alias("posted"), F.min("t").alias("first_transaction"))
    difference = F.when(F.col("posted") < F.col("expected"), "missing").when(F.col("expected") > 0, "repeated").otherwise("surplus")
    return counted.where("expected <> posted").select(*key, "expected", "posted", difference.alias("difference"), "first_transaction")
