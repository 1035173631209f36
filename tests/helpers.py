"""Shorthands for small frames in tests."""

import contextlib
import io
from datetime import date
from decimal import Decimal


def dec(text):
    return None if text is None else Decimal(text)


def day(text):
    return None if text is None else date.fromisoformat(text)


def rows(df):
    """All rows as tuples in a stable order; NULLs first."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: [(v is not None, str(type(v)), v) if not isinstance(v, bool) else (True, "b", v) for v in r])


GIFT_SCHEMA = (
    "gift_id string, donor_id string, fund_id string, campaign_id string, gift_date date, "
    "gift_amount decimal(18,2), gift_type string"
)
LEDGER_SCHEMA = (
    "transaction_id string, line_no int, transaction_date date, account_number string, fund_id string, "
    "subsidiary_id string, debit_amount decimal(18,2), credit_amount decimal(18,2), memo string, source_gift_id string"
)


def gifts(spark, *items):
    """Items are (gift, donor, fund, date, amount)."""
    data = [(g, d, f, None, day(when), dec(amount), "Cash") for g, d, f, when, amount in items]
    return spark.createDataFrame(data, GIFT_SCHEMA)


def ledger(spark, *items):
    """Items are (transaction, line, date, account, fund, debit, credit, source)."""
    data = [
        (t, n, day(when), account, fund, "SUB-01", dec(debit), dec(credit), "memo", source)
        for t, n, when, account, fund, debit, credit, source in items
    ]
    return spark.createDataFrame(data, LEDGER_SCHEMA)


def funds(spark, *ids):
    data = [(f, f"Fund {f}", "Program", "Restricted") for f in ids]
    return spark.createDataFrame(data, "fund_id string, fund_name string, fund_type string, restriction_type string")


def accounts(spark):
    return spark.createDataFrame(
        [("1000", "Cash", "Bank"), ("4000", "Revenue", "Income"), ("5000", "Aid", "Expense")],
        "account_number string, account_name string, account_type string",
    )


def plan_of(df):
    """The physical plan as ``explain`` prints it."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()
