"""Comparison of two sets of books by common keys."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almsbook.functions.money import money, percent

# Status names, and the tolerances of the reconciliation rule.
RECONCILED = "Reconciled"
TIMING = "Timing Difference (OK)"
NEEDS_REVIEW = "Needs Review"
ABSOLUTE_TOLERANCE = Decimal("500")
RELATIVE_TOLERANCE = Decimal("0.08")


def status_of(variance: Column, base: Column, absolute: Decimal, relative: Decimal) -> Column:
    """Small in money, else small relative to the base, else to be reviewed.

    A base that is missing, zero or negative can never make a difference small.
    """
    size = F.abs(variance)
    return (
        F.when(size < F.lit(absolute), RECONCILED)
        .when(size < F.lit(relative) * base, TIMING)
        .otherwise(NEEDS_REVIEW)
    )


def reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_amount: str,
    right_amount: str,
    absolute: Decimal = ABSOLUTE_TOLERANCE,
    relative: Decimal = RELATIVE_TOLERANCE,
) -> DataFrame:
    """Full outer join of two totals per key, with variance, percentage and status.

    Both inputs hold one row per key combination, so the join works on totals and never on lines.
    NULL keys match nothing and stay as one-sided rows.
    """
    joined = left.join(right, keys, "full")
    first = F.coalesce(money(F.col(left_amount)), money(F.lit(0)))
    second = F.coalesce(money(F.col(right_amount)), money(F.lit(0)))
    variance = money(first - second)
    return joined.select(
        *keys,
        first.alias(left_amount),
        second.alias(right_amount),
        variance.alias("variance_amount"),
        percent(variance, first, 2).alias("variance_pct"),
        status_of(variance, first, absolute, relative).alias("status"),
    )
