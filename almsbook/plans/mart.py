"""Star schema: the row shape of each table, and loading it without touching loaded keys."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almsbook.functions.calendar import date_key, fiscal_month, fiscal_year, key_date, with_fiscal_period
from almsbook.functions.money import money
from almsbook.operators.merging import insert_if_absent, upsert
from almsbook.sources.manifest import Manifest, is_versioned

# Primary key of each table.
KEYS = {
    "dim_date": ["date_id"],
    "dim_donor": ["donor_id"],
    "dim_fund": ["fund_id"],
    "dim_campaign": ["campaign_id"],
    "dim_account": ["account_number"],
    "dim_subsidiary": ["subsidiary_id"],
    "fact_gifts": ["gift_id"],
    "fact_pledges": ["pledge_id"],
    "fact_gl": ["transaction_id", "line_no"],
}


def dim_donor_public(donors: DataFrame) -> DataFrame:
    """Donors as the mart shows them: e-mail addresses stay in staging."""
    return donors.select("donor_id", "donor_name", "donor_type", "first_gift_date", "state")


def dim_fund(funds: DataFrame) -> DataFrame:
    return funds.select("fund_id", "fund_name", "fund_type", "restriction_type")


def dim_campaign(campaigns: DataFrame) -> DataFrame:
    return campaigns.select("campaign_id", "campaign_name", "goal_amount", "start_date", "end_date")


def dim_account(accounts: DataFrame) -> DataFrame:
    return accounts.select("account_number", "account_name", "account_type")


def dim_subsidiary(subsidiaries: DataFrame) -> DataFrame:
    return subsidiaries.select("subsidiary_id", "subsidiary_name")


def fact_gifts(gifts: DataFrame) -> DataFrame:
    return gifts.select(
        "gift_id", "donor_id", "fund_id", "campaign_id",
        date_key(F.col("gift_date")).alias("date_id"), "gift_amount", "gift_type",
    )


def fact_pledges(pledges: DataFrame) -> DataFrame:
    return pledges.select(
        "pledge_id", "donor_id", "fund_id", date_key(F.col("pledge_date")).alias("date_id"),
        "pledged_amount", "paid_amount", "status", "has_overpayment_flag",
    )


def fact_gl(ledger: DataFrame) -> DataFrame:
    return ledger.select(
        "transaction_id", "line_no", date_key(F.col("transaction_date")).alias("date_id"),
        "account_number", "fund_id", "subsidiary_id", "debit_amount", "credit_amount", "source_gift_id",
    )


def load(table: str, batch: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """``loaded`` plus the rows of ``batch`` with keys it lacks; a key comes out once in any case.

    The donor dimension differs: a known donor takes over the arriving name.
    """
    target = batch.limit(0) if loaded is None else loaded
    if table == "dim_donor" and loaded is not None:
        return upsert(target, batch, KEYS[table][0], ["donor_name"])
    return insert_if_absent(target, batch, KEYS[table])


def store(table: str, rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a mart table; facts lie in a folder per fiscal year, so that a period reads its years only.

    Rebalancing gathers the rows of a year into files of a good size and splits a large year.
    """
    if not table.startswith("fact_"):
        rows.write.mode(mode).parquet(path)
        return
    dated = rows.withColumn("fiscal_year", fiscal_year(key_date(F.col("date_id"))))
    dated.hint("rebalance", "fiscal_year").write.mode(mode).partitionBy("fiscal_year").parquet(path)


def current(spark: SparkSession, mart_dir: str, table: str, version: int | None = None) -> DataFrame:
    """A mart table as of ``version`` or the newest; facts keep the fiscal year they are stored by.

    A folder without versions is read as it is.
    """
    if not is_versioned(spark, mart_dir):
        return spark.read.parquet(f"{mart_dir}/{table}")
    return Manifest(spark, mart_dir).read(table, version).drop("load")


def stored(spark: SparkSession, mart_dir: str, table: str) -> DataFrame:
    """A mart table with its contract columns only."""
    rows = current(spark, mart_dir, table)
    return rows.drop("fiscal_year") if table.startswith("fact_") else rows


def _with_date(fact: DataFrame, day: str) -> DataFrame:
    """The fact with its date restored; one stored by fiscal year keeps that and gets the month."""
    dated = fact.withColumn(day, key_date(F.col("date_id")))
    return dated.withColumn("fiscal_month", fiscal_month(F.col(day))) if "fiscal_year" in fact.columns else dated


def gifts_of(fact: DataFrame) -> DataFrame:
    """The gift fact as the analyses take it."""
    return _with_date(fact, "gift_date")


def ledger_of(fact: DataFrame) -> DataFrame:
    return _with_date(fact, "transaction_date")


def gifts_by_fiscal_month_dimjoin(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Gift totals per fiscal month through the date dimension, reduced to one row per day first."""
    daily = fact.groupBy("date_id").agg(F.sum("gift_amount").alias("amount"), F.count("*").alias("n"))
    return (
        daily.join(dates.select("date_id", "fiscal_year", "fiscal_month"), "date_id")
        .groupBy("fiscal_year", "fiscal_month")
        .agg(money(F.sum("amount")).alias("amount"), F.sum("n").alias("n_gifts"))
    )


def fiscal_calendar(gifts: DataFrame) -> DataFrame:
    days = gifts.select(F.col("gift_date").alias("calendar_date")).distinct()
    return with_fiscal_period(days, "calendar_date")
