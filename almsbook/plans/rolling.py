"""The reconciliation kept up to date, batch by batch.

A batch of new gifts and ledger lines shrinks to sums per side, account, fund and fiscal month, which are kept as a load of
their own. Sums of sums are sums, so the fund-months a batch touches are judged from the kept sums alone, and no fact of an
earlier batch is read again; all other fund-months keep their judgement. Sums and judgements of a batch become visible
together. :meth:`RollingReconciliation.compact` folds all loads into one.
"""

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almsbook.functions.calendar import with_fiscal_period
from almsbook.functions.money import money
from almsbook.operators.reconcile import ABSOLUTE_TOLERANCE, RELATIVE_TOLERANCE, reconcile
from almsbook.plans.reconciliation import FUND_MONTH
from almsbook.sources.manifest import Manifest

SUMS, JUDGED = "sums", "judged"
GIFT, LEDGER = "gift", "ledger"


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(Column.__and__, [left[c].eqNullSafe(right[c]) for c in columns])


def batch_sums(gifts: DataFrame, ledger: DataFrame) -> DataFrame:
    """``(side, account_number, fund_id, fiscal_year, fiscal_month, amount)`` of both books; gifts have no account.

    Accounts stay apart, so that a changed chart of accounts needs no old line either.
    """
    given = with_fiscal_period(gifts, "gift_date").groupBy(*FUND_MONTH).agg(F.sum("gift_amount").alias("amount"))
    posted = with_fiscal_period(ledger, "transaction_date").groupBy("account_number", *FUND_MONTH).agg(F.sum("credit_amount").alias("amount"))
    kind = ledger.schema["account_number"].dataType
    return given.select(F.lit(GIFT).alias("side"), F.lit(None).cast(kind).alias("account_number"), *FUND_MONTH, money(F.col("amount")).alias("amount")).unionByName(
        posted.select(F.lit(LEDGER).alias("side"), "account_number", *FUND_MONTH, money(F.col("amount")).alias("amount"))
    )


class RollingReconciliation:
    """Sums and judgements below a folder, in versions."""

    def __init__(self, spark: SparkSession, root: str, absolute: Decimal = ABSOLUTE_TOLERANCE, relative: Decimal = RELATIVE_TOLERANCE) -> None:
        self.spark, self.root, self.absolute, self.relative = spark, root, absolute, relative
        self.manifest = Manifest(spark, root)

    def batches(self) -> set[str]:
        """Ids of the recorded batches."""
        if not self.manifest.version():
            return set()
        return {r["batch"] for r in self.manifest.read(SUMS).where("side IS NULL").select("batch").collect()}

    def record(self, batch: str, gifts: DataFrame, ledger: DataFrame, accounts: DataFrame) -> int:
        """Add a batch of rows that no earlier batch held; returns the version. A batch that is known adds nothing."""
        version = self.manifest.version()
        if batch in self.batches():
            return version
        self.manifest.sweep(keep=2)
        load = version + 1
        path = self.manifest.path(SUMS, load)
        own = batch_sums(gifts, ledger).withColumn("batch", F.lit(batch))
        # Fund-months are few beside facts: one file, with a row at least for a batch without any, so that its id is known.
        mark = self.spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name != "batch" else F.lit(batch).alias("batch") for f in own.schema])
        own.unionByName(mark).coalesce(1).write.mode("overwrite").parquet(path)
        new = self.spark.read.schema(own.schema).parquet(path)
        sums = self.manifest.read(SUMS).drop("load").unionByName(new) if version else new
        touched = new.where("side IS NOT NULL").select(*FUND_MONTH).distinct()
        self.judge(sums.join(touched, _same(sums, touched, FUND_MONTH), "left_semi"), accounts).coalesce(1).write.mode("overwrite").parquet(
            self.manifest.path(JUDGED, load)
        )
        return self.manifest.commit({SUMS: [load], JUDGED: [load]})

    def judge(self, sums: DataFrame, accounts: DataFrame) -> DataFrame:
        """The reconciliation of the fund-months that ``sums`` holds."""
        income = accounts.where(F.col("account_type") == "Income").select("account_number").distinct()

        def side(name: str, rows: DataFrame) -> DataFrame:
            return rows.groupBy(*FUND_MONTH).agg(money(F.sum("amount")).alias(name))

        given = side("gifts_recorded", sums.where(F.col("side") == GIFT))
        posted = side("gl_posted", sums.where(F.col("side") == LEDGER).join(income, "account_number"))
        return reconcile(given, posted, FUND_MONTH, "gifts_recorded", "gl_posted", self.absolute, self.relative)

    def current(self) -> DataFrame:
        """The reconciliation of all batches: every fund-month as it was judged last."""
        judged = self.manifest.read(JUDGED)
        newest = judged.groupBy(*FUND_MONTH).agg(F.max("load").alias("load"))
        # A missing fund matches nothing, so its month can have a row for either side: whole months are taken, not single rows.
        return judged.join(newest, _same(judged, newest, [*FUND_MONTH, "load"]), "left_semi").drop("load")

    def compact(self, accounts: DataFrame) -> int:
        """Fold all loads into one and judge every fund-month anew, with the chart of accounts as it is now."""
        before, load = self.manifest.loads(), self.manifest.version() + 1
        sums = self.manifest.read(SUMS).drop("load")
        key = [c for c in sums.columns if c not in ("amount", "batch")]
        folded = sums.where("side IS NOT NULL").groupBy(*key).agg(money(F.sum("amount")).alias("amount"), F.lit(None).cast("string").alias("batch"))
        marks = sums.where("side IS NULL").distinct()
        folded.select(sums.columns).unionByName(marks).write.mode("overwrite").parquet(self.manifest.path(SUMS, load))
        self.judge(sums, accounts).write.mode("overwrite").parquet(self.manifest.path(JUDGED, load))
        version = self.manifest.commit({SUMS: [load], JUDGED: [load]}, before)
        self.manifest.sweep(keep=2)
        return version
