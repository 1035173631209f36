"""Exact money arithmetic and its labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(amount: Column) -> Column:
    return amount.cast(MONEY)


def whole(amount: Column) -> Column:
    """Rounded half-up to whole units, still typed as money."""
    return money(F.round(amount, 0))


def percent(part: Column, base: Column, digits: int) -> Column:
    """100 * part / base rounded half-up; NULL where the base is zero or missing.

    The quotient is taken on decimals, so a tie is a real tie and not a float artefact.
    """
    return F.round(F.try_divide(money(part) * 100, money(base)), digits).cast("double")


def dollars(amount: Column) -> Column:
    """'$1,234', and '$-1,234' below zero."""
    return F.concat(F.lit("$"), F.format_number(F.round(amount, 0), 0))


def signed_dollars(amount: Column) -> Column:
    """'+$1,234' or '-$1,234'."""
    sign = F.when(amount < 0, "-").otherwise("+")
    return F.concat(sign, F.lit("$"), F.format_number(F.abs(F.round(amount, 0)), 0))
