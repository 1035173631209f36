"""Data-quality scorecard: six graded checks, their roll-ups, and hard expectations."""

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almsbook.operators.checks import Known, Unique, as_rows, check_row, expectation_row, rule_rows, within_tolerance
from almsbook.operators.matching import has_match
from almsbook.operators.reconcile import NEEDS_REVIEW
from almsbook.plans.reconciliation import transaction_balances

# Names, tables and severities of the checks as the scorecard shows them.
FUND_KNOWN = ("Fund ID references valid dim_fund (<1.0% tolerance)", "salesforce_opportunities", "critical")
GIFT_POSTED = ("Every gift has a matching GL entry (<1.5% tolerance)", "fact_gl_transactions", "critical")
NOT_OVERPAID = ("paid_amount <= pledged_amount (<0.5% tolerance)", "fact_pledges", "warning")
AMOUNT_POSITIVE = ("gift_amount is positive and not null", "fact_gifts", "critical")
BALANCED = ("GL transactions balance, debit=credit (<0.5% tolerance)", "fact_gl_transactions", "critical")
RECONCILES = ("Fund/month reconciliation within tolerance (<10% of fund-months)", "fund_reconciliation", "warning")
SEVERITIES = ["critical", "warning"]

ORPHAN_TOLERANCE = Decimal("0.01")
UNPOSTED_TOLERANCE = Decimal("0.015")
OVERPAID_TOLERANCE = Decimal("0.005")
UNBALANCED_TOLERANCE = Decimal("0.005")
REVIEW_TOLERANCE = Decimal("0.10")
BALANCE_EPSILON = Decimal("0.01")


def _bad_amount(amount: str) -> Column:
    return F.col(amount).isNull() | (F.col(amount) <= 0)


def _known(funds: DataFrame) -> DataFrame:
    return funds.select("fund_id").distinct().withColumn("known", F.lit(True))


def gift_checks(raw_gifts: DataFrame, funds: DataFrame) -> DataFrame:
    """Checks 1 and 4 from one pass over the gifts, reduced to a row per fund before the lookup."""
    per_fund = raw_gifts.groupBy("fund_id").agg(
        F.count("*").alias("n"), F.count_if(_bad_amount("gift_amount")).alias("bad")
    )
    facts = per_fund.join(_known(funds), "fund_id", "left").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)).alias("orphans"),
        F.sum(F.when(F.col("known"), F.col("bad")).otherwise(0)).alias("bad"),
    )
    orphans, bad = F.col("orphans"), F.coalesce("bad", F.lit(0))
    return as_rows(
        facts,
        check_row(1, *FUND_KNOWN, orphans, within_tolerance(orphans, F.col("total"), ORPHAN_TOLERANCE)),
        check_row(4, *AMOUNT_POSITIVE, bad, bad == 0),
    )


def posting_check(gifts: DataFrame, ledger: DataFrame) -> DataFrame:
    facts = has_match(gifts, ledger, "gift_id", "source_gift_id").agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("matched"), 0).otherwise(F.col("n"))).alias("bad")
    )
    passed = within_tolerance(F.col("bad"), F.col("total"), UNPOSTED_TOLERANCE)
    return as_rows(facts, check_row(2, *GIFT_POSTED, F.col("bad"), passed))


def pledge_check(pledges: DataFrame) -> DataFrame:
    facts = pledges.agg(
        F.count("*").alias("total"), F.count_if(F.col("paid_amount") > F.col("pledged_amount")).alias("bad")
    )
    passed = within_tolerance(F.col("bad"), F.col("total"), OVERPAID_TOLERANCE)
    return as_rows(facts, check_row(3, *NOT_OVERPAID, F.col("bad"), passed))


def balance_check(ledger: DataFrame) -> DataFrame:
    """Numerator and denominator both come from the rows per transaction: one shuffle for the two."""
    facts = transaction_balances(ledger).agg(
        F.count("transaction_id").alias("total"), F.count_if(F.abs("diff") > F.lit(BALANCE_EPSILON)).alias("bad")
    )
    passed = within_tolerance(F.col("bad"), F.col("total"), UNBALANCED_TOLERANCE)
    return as_rows(facts, check_row(5, *BALANCED, F.col("bad"), passed))


def review_check(recon: DataFrame) -> DataFrame:
    facts = recon.agg(F.count("*").alias("total"), F.count_if(F.col("status") == NEEDS_REVIEW).alias("bad"))
    passed = within_tolerance(F.col("bad"), F.col("total"), REVIEW_TOLERANCE)
    return as_rows(facts, check_row(6, *RECONCILES, F.col("bad"), passed))


def dq_results(
    raw_gifts: DataFrame,
    gifts: DataFrame,
    pledges: DataFrame,
    ledger: DataFrame,
    funds: DataFrame,
    recon: DataFrame,
) -> DataFrame:
    """The six checks. Only check 1 looks at gifts of unknown funds, all others at the cleaned ones."""
    return (
        gift_checks(raw_gifts, funds)
        .unionByName(posting_check(gifts, ledger))
        .unionByName(pledge_check(pledges))
        .unionByName(balance_check(ledger))
        .unionByName(review_check(recon))
    )


def dq_pass_rate(results: DataFrame) -> DataFrame:
    """Whole percent of checks passed; an ungraded check counts as not passed."""
    passed = F.count_if(F.col("passed"))
    return results.agg(
        F.round(F.try_divide((passed * 100).cast("decimal(18,0)"), F.count("*")), 0).cast("double").alias("pass_rate"),
        F.count("*").alias("total_checks"),
        passed.alias("passed_checks"),
    )


def dq_severity_failures(results: DataFrame) -> DataFrame:
    """Checks not passed per severity, with a zero for a severity that has none."""
    failed = [
        F.struct(
            F.lit(s).alias("severity"),
            F.count_if((F.col("severity") == s) & ~F.coalesce("passed", F.lit(False))).alias("n_failed"),
        )
        for s in SEVERITIES
    ]
    return results.agg(F.array(*failed).alias("rows")).select(F.inline("rows"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Number of key values that more than one row carries; one row."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return repeated.agg(F.count("*").alias("bad"))


def expectations(
    gifts: DataFrame,
    funds: DataFrame,
    ledger: DataFrame,
    pledges: DataFrame,
    first_day: date | Column,
    last_day: date | Column,
    orphan_share: Decimal = Decimal("0.01"),
    unbalanced_share: Decimal = Decimal("0.005"),
    overpaid_share: Decimal = Decimal("0.05"),
) -> DataFrame:
    """Hard rules on the landed extracts. Limits are shares of the rows, given by the caller and not read from the data."""
    low, high, bad, total = F.lit(first_day), F.lit(last_day), F.col("bad"), F.col("total")
    # One pass over the gifts, reduced to a row per fund before the fund is looked up.
    per_fund = gifts.groupBy("fund_id").agg(
        F.count("*").alias("n"),
        F.count_if(_bad_amount("gift_amount")).alias("bad_amounts"),
        F.count_if(F.col("donor_id").isNull()).alias("no_donor"),
        F.count_if(~F.col("gift_date").between(low, high)).alias("outside"),
    )
    facts = per_fund.join(_known(funds), "fund_id", "left").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("bad_amounts", "no_donor", "outside")],
        F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("orphans"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    on_gifts = as_rows(
        facts,
        expectation_row("gift amounts are positive", F.col("bad_amounts"), F.col("bad_amounts") == 0),
        expectation_row("donor ids are not null", F.col("no_donor"), F.col("no_donor") == 0),
        expectation_row("gift dates lie in the window", F.col("outside"), F.col("outside") == 0),
        expectation_row("orphaned gifts stay within the limit", F.col("orphans"), F.col("orphans") <= F.lit(orphan_share) * total),
    )
    unbalanced = transaction_balances(ledger).agg(
        F.count_if(F.abs("diff") > F.lit(BALANCE_EPSILON)).alias("bad"), F.count("*").alias("total")
    )
    overpaid = pledges.agg(F.count_if(F.col("paid_amount") > F.col("pledged_amount")).alias("bad"), F.count("*").alias("total"))
    single = [
        (duplicate_keys(gifts, "gift_id"), "gift ids are unique", bad == 0),
        (duplicate_keys(funds, "fund_id"), "fund ids are unique", bad == 0),
        (unbalanced, "unbalanced transactions stay within the limit", bad <= F.lit(unbalanced_share) * total),
        (overpaid, "overpaid pledges occur and stay below the limit", (bad > 0) & (bad < F.lit(overpaid_share) * total)),
    ]
    result = on_gifts
    for facts, name, passed in single:
        result = result.unionByName(as_rows(facts, expectation_row(name, bad, passed)))
    return result


# Keys of the mart tables and what the facts refer to. Gifts and pledges keep the source id of a donor, so
# they refer to the contacts; ledger lines may carry funds that no longer exist.
REFERENCES = [
    ("fact_gifts", "donor_id", "contacts", "donor_id"),
    ("fact_gifts", "fund_id", "dim_fund", "fund_id"),
    ("fact_gifts", "campaign_id", "dim_campaign", "campaign_id"),
    ("fact_gifts", "date_id", "dim_date", "date_id"),
    ("fact_pledges", "donor_id", "contacts", "donor_id"),
    ("fact_pledges", "date_id", "dim_date", "date_id"),
    ("fact_gl", "date_id", "dim_date", "date_id"),
    ("fact_gl", "account_number", "dim_account", "account_number"),
    ("fact_gl", "subsidiary_id", "dim_subsidiary", "subsidiary_id"),
]


def key_expectations(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """Keys that should be unique and references that should be known, a row each.

    ``tables`` holds the mart tables and ``contacts``; ``keys`` names the key of each mart table.
    """
    rules = [Unique(name, tuple(columns)) for name, columns in keys.items()] + [Known(*reference) for reference in REFERENCES]
    return rule_rows(tables, rules)


def fitting_expectations(misfits: DataFrame) -> DataFrame:
    """One row per landed table ``(table_name, n)``: all text fitted the declared types."""
    name = F.concat("table_name", F.lit(": every row fits its types"))
    return misfits.select(name.alias("name"), F.col("n").alias("observed"), (F.col("n") == 0).alias("passed"))
