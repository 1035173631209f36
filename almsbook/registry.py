"""Every deliverable as a callable over a folder of test tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almsbook import schemas
from almsbook.plans import calendar, document, donors, jobs, journal, mart, overview, prep, quality, reconciliation
from almsbook.plans import staging, statement
from almsbook.plans.rolling import RollingReconciliation
from almsbook.operators import merging
from almsbook.operators.changesets import ChangeSets
from almsbook.session import tuned
from almsbook.sources import crm, files, landing
from almsbook.sources.storage import materialize, scratch_path
from almsbook.testbed import BOOKS, MISSING_BATCH, Testbed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Testbed], DataFrame]) -> Callable[[Testbed], DataFrame]:
    """Register ``build`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Testbed(tuned(spark), sf_dir))

    run.__name__ = run.__qualname__ = build.__name__
    QUERIES[build.__name__] = run
    return build


def _gifts(t: Testbed) -> DataFrame:
    return staging.stg_gifts(t.raw_gifts, t.funds)


def _ledger(t: Testbed) -> DataFrame:
    return staging.stg_ledger(t.raw_ledger)


def _pledges(t: Testbed) -> DataFrame:
    return staging.stg_pledges(staging.pledge_status(t.raw_pledges))


def _donors(t: Testbed) -> DataFrame:
    return mart.dim_donor_public(staging.stg_donors(t.contacts))


# Reconciliation


@query
def fund_reconciliation(t):
    return reconciliation.fund_reconciliation(_gifts(t), _ledger(t), t.accounts)


@query
def reconciliation_by_batches(t):
    """The books in three batches, each judged from kept sums: the same as all at once."""
    rolling = RollingReconciliation(t.spark, scratch_path(t.spark, "rolling"))
    gifts, ledger = _gifts(t), _ledger(t)
    for batch in range(3):
        rolling.record(
            f"batch-{batch}", gifts.where(F.pmod("gift_id", F.lit(3)) == batch),
            ledger.where(F.pmod(F.dayofyear("transaction_date"), F.lit(3)) == batch), t.accounts,
        )
    return rolling.current()


@query
def gift_side(t):
    return reconciliation.gift_side(_gifts(t))


@query
def gl_side(t):
    return reconciliation.gl_side(_ledger(t), t.accounts)


@query
def recon_status_counts(t):
    return reconciliation.recon_status_counts(fund_reconciliation(t))


@query
def variance_by_fund(t):
    return reconciliation.variance_by_fund(fund_reconciliation(t), t.funds)


@query
def flagged_variances(t):
    return reconciliation.flagged_variances(fund_reconciliation(t), t.funds)


@query
def recon_totals(t):
    return reconciliation.recon_totals(fund_reconciliation(t))


@query
def gifts_without_gl(t):
    return reconciliation.gifts_without_gl(_gifts(t), t.raw_ledger)


@query
def missing_batch_window(t):
    first, last = (F.lit(day).cast("date") for day in MISSING_BATCH)
    return reconciliation.missing_batch_window(t.raw_gifts, t.raw_ledger, first, last)


@query
def gl_unbalanced(t):
    return reconciliation.gl_unbalanced(_ledger(t))


# Staging


@query
def clean_names(t):
    return staging.clean_names(t.contacts)


@query
def stg_donors(t):
    return staging.stg_donors(t.contacts)


@query
def donor_survivor_map(t):
    return staging.donor_survivor_map(t.contacts)


@query
def stg_gifts(t):
    return _gifts(t)


@query
def gifts_orphaned(t):
    return staging.gifts_orphaned(t.raw_gifts, t.funds)


@query
def stg_gl(t):
    return _ledger(t)


@query
def pledge_status(t):
    return staging.pledge_status(t.raw_pledges)


@query
def stg_pledges(t):
    return _pledges(t)


@query
def pledges_overpaid(t):
    return staging.pledges_overpaid(t.raw_pledges)


# Calendar and mart


@query
def date_spine(t):
    return calendar.date_spine(calendar.fiscal_window(
        (t.raw_gifts, "gift_date"), (t.raw_pledges, "pledge_date"), (t.raw_ledger, "transaction_date")
    ))


@query
def dim_date(t):
    return mart.load("dim_date", calendar.dim_date(date_spine(t)))


@query
def fiscal_calendar(t):
    return mart.fiscal_calendar(t.raw_gifts)


@query
def dim_donor(t):
    return mart.load("dim_donor", _donors(t))


@query
def dim_donor_public(t):
    return _donors(t)


@query
def dim_fund(t):
    return mart.load("dim_fund", mart.dim_fund(t.funds))


@query
def dim_campaign(t):
    return mart.load("dim_campaign", mart.dim_campaign(t.campaigns))


@query
def dim_account(t):
    return mart.load("dim_account", mart.dim_account(t.accounts))


@query
def dim_subsidiary(t):
    return mart.load("dim_subsidiary", mart.dim_subsidiary(t.subsidiaries))


@query
def fact_gifts(t):
    return mart.load("fact_gifts", mart.fact_gifts(_gifts(t)))


@query
def fact_pledges(t):
    return mart.load("fact_pledges", mart.fact_pledges(_pledges(t)))


@query
def fact_gl(t):
    return mart.load("fact_gl", mart.fact_gl(_ledger(t)))


@query
def upsert_dim_donor(t):
    return merging.upsert(t.existing_donors, _donors(t), "donor_id", ["donor_name"])


@query
def donor_change_sets(t):
    """The same merge as two change sets, the first of them folded in."""
    donors = _donors(t)
    table = ChangeSets(t.spark, scratch_path(t.spark, "change-sets"), t.existing_donors.schema, "donor_id", ["donor_name"], buckets=8)
    table.create(t.existing_donors)
    table.merge(donors.where("donor_id % 3 = 0"))
    table.compact()
    table.merge(donors.where("donor_id % 3 <> 0"))
    return table.read()


@query
def insert_if_absent(t):
    return merging.insert_if_absent(t.existing_donors, _donors(t), ["donor_id"])


@query
def gifts_by_fiscal_month_dimjoin(t):
    return mart.gifts_by_fiscal_month_dimjoin(mart.fact_gifts(_gifts(t)), calendar.dim_date(date_spine(t)))


# Donors


@query
def donor_fy(t):
    return donors.donor_fy(_gifts(t))


@query
def donor_summary(t):
    return donors.donor_summary(_gifts(t))


@query
def donor_segments(t):
    return donors.donor_segments(_gifts(t))


@query
def donor_segments_tvf(t):
    summary = materialize(donor_summary(t), "donor-summary")
    donors.register_segments_of_summary(summary, summary.schema["donor_id"].dataType.simpleString())
    return donors.segmented(t.spark, summary.agg(F.max("last_fy").alias("fiscal_year")))


@query
def segment_counts(t):
    return donors.segment_counts(donor_segments(t))


@query
def revenue_at_risk(t):
    return donors.revenue_at_risk(donor_segments(t))


@query
def retention_by_fy(t):
    return donors.retention_by_fy(_gifts(t))


@query
def fund_segment_matrix(t):
    return donors.fund_segment_matrix(_gifts(t), t.funds)


def _scores(t: Testbed) -> DataFrame:
    return donors.rfm_scores(donor_summary(t))


@query
def rfm_scores(t):
    return _scores(t).select("donor_id", "recency_rank", "freq_rank", "monetary_rank", "rfm_score")


@query
def top_donors(t):
    scores = _scores(t)
    return donors.top_donors(scores, t.contacts, scores.agg(F.max("last_fy")).scalar())


# Headline figures


@query
def executive_kpis(t):
    return overview.executive_kpis(_gifts(t), t.campaigns)


@query
def monthly_trend(t):
    return overview.monthly_trend(_gifts(t))


@query
def top_funds(t):
    return overview.top_funds(_gifts(t), t.funds)


@query
def gift_type_mix(t):
    return overview.gift_type_mix(_gifts(t))


# Data quality


@query
def dq_results(t):
    return quality.dq_results(
        t.raw_gifts, _gifts(t), t.raw_pledges, _ledger(t), t.funds, fund_reconciliation(t)
    )


@query
def dq_pass_rate(t):
    return quality.dq_pass_rate(dq_results(t))


@query
def dq_severity_failures(t):
    return quality.dq_severity_failures(dq_results(t))


@query
def expectations(t):
    first_day, last_day = (F.lit(day).cast("date") for day in BOOKS)
    return quality.expectations(t.raw_gifts, t.funds, t.raw_ledger, t.raw_pledges, first_day, last_day)


@query
def key_expectations(t):
    tables = {
        "dim_date": calendar.dim_date(date_spine(t)), "dim_donor": _donors(t), "dim_fund": t.funds, "dim_campaign": t.campaigns,
        "dim_account": t.accounts, "dim_subsidiary": t.subsidiaries, "fact_gifts": mart.fact_gifts(_gifts(t)),
        "fact_pledges": mart.fact_pledges(_pledges(t)), "fact_gl": mart.fact_gl(_ledger(t)), "contacts": t.contacts,
    }
    return quality.key_expectations(tables, mart.KEYS)


@query
def dq_log(t):
    """Two runs put into one log, one of them twice, and read back without the time of the run."""
    path = scratch_path(t.spark, "dq-log")
    results = materialize(dq_results(t), "dq-results")
    for run in ("first", "second", "first"):
        jobs.append_quality(results, path, run)
    return t.spark.read.parquet(path).drop("run_at", "run")


# Manual adjustments


@query
def prep_joined(t):
    return prep.prep_joined(t.adjustments, t.funds)


@query
def prep_valid(t):
    return prep.prep_valid(prep_joined(t))


@query
def prep_errors(t):
    return prep.prep_errors(prep_joined(t))


@query
def prep_files(t):
    """Both CSV files of the prep flow, read back under their side."""
    path = scratch_path(t.spark, "prep")
    jobs.write_prep(prep_joined(t), path)
    sides = []
    for name, fields in (("clean_donor_adjustments", schemas.PREPARED), ("errors_log", schemas.REJECTED)):
        side = files.scan_csv(t.spark, f"{path}/{name}", fields).drop(files.CORRUPT)
        sides.append(side.withColumn("file", F.lit(name)))
    return sides[0].unionByName(sides[1], allowMissingColumns=True)


@query
def prep_error_breakdown(t):
    return prep.prep_error_breakdown(prep_errors(t))


# Statements


def _flagged(t: Testbed) -> DataFrame:
    """The flagged rows, written once because periods and counts both read them."""
    return materialize(flagged_variances(t), "flagged")


@query
def statement_periods(t):
    return statement.statement_periods(_flagged(t), _gifts(t))


@query
def statement_header(t):
    flagged = _flagged(t)
    return statement.statement_header(statement.statement_periods(flagged, _gifts(t)), flagged)


@query
def statement_rows(t):
    return statement.statement_rows(flagged_variances(t))


@query
def statement_files(t):
    """Header and rows of the statements, written by period and read back."""
    path = scratch_path(t.spark, "statements")
    flagged = _flagged(t)
    jobs.write_statement_files(flagged, statement.statement_periods(flagged, _gifts(t)), path)
    header, body = (t.spark.read.parquet(f"{path}/{part}") for part in ("header", "rows"))
    return header.join(body, statement.PERIOD, "left").select(
        *statement.PERIOD, "report_id", "period_label", "n_flagged", "fund", "gifts_label", "gl_label", "variance_signed", "status"
    )


# Journal


@query
def expected_revenue_account(t):
    return journal.expected_revenue_account(t.raw_gifts, t.funds)


@query
def journal_exceptions(t):
    return journal.journal_exceptions(t.raw_gifts, t.funds, t.raw_ledger)


@query
def journal_line_differences(t):
    """The ledger with lines dropped and transactions posted twice, held against the gifts."""
    ledger = t.raw_ledger.where("NOT (line_no = 2 AND source_gift_id % 619 = 4)").unionByName(t.raw_ledger.where("source_gift_id % 577 = 2"))
    return journal.line_differences(t.raw_gifts, t.funds, ledger)


# Files that are written to the shared scratch folder and read back


@query
def scan_csv_adjustments(t):
    path = scratch_path(t.spark, "adjustments-csv")
    files.write_csv(t.adjustments, path)
    return files.contract(files.scan_csv(t.spark, path, schemas.ADJUSTMENTS), schemas.ADJUSTMENTS)


@query
def land_raw(t):
    path = scratch_path(t.spark, "raw-gifts")
    landing.land(t.raw_gifts, path)
    landed = t.spark.read.parquet(path)
    return landed.select(*t.raw_gifts.columns, F.col(landing.LOADED_AT).isNotNull().alias("is_loaded"))


def _land_json(t: Testbed, kind: str, records: DataFrame) -> str:
    path = scratch_path(t.spark, f"crm-{kind}")
    records.withColumn("attributes", F.struct(F.lit(kind).alias("type"))).write.json(path)
    return path


@query
def crm_contacts(t):
    first_gift = F.when(F.col("donor_id") % 7 != 0, F.col("first_gift_date"))
    path = _land_json(t, "Contact", t.contacts.select(
        F.col("donor_id").cast("string").alias("Id"), F.col("donor_name").alias("Name"), F.col("email").alias("Email"),
        F.col("state").alias("MailingState"), first_gift.alias("npsp__First_Gift_Date__c"),
    ))
    return crm.crm_contacts(t.spark, path)


@query
def crm_opportunities(t):
    stage = F.when(F.col("gift_id") % 9 == 0, "Prospecting").otherwise("Closed Won")
    path = _land_json(t, "Opportunity", t.raw_gifts.select(
        F.col("gift_id").cast("string").alias("Id"), F.col("donor_id").cast("string").alias("ContactId"),
        F.col("gift_amount").alias("Amount"), F.col("gift_date").alias("CloseDate"), F.col("gift_type").alias("Type"),
        stage.alias("StageName"), F.col("fund_id").cast("string").alias("Fund__c"),
        F.col("campaign_id").cast("string").alias("CampaignId"),
    ))
    return crm.crm_opportunities(t.spark, path)


@query
def crm_campaigns(t):
    path = _land_json(t, "Campaign", t.campaigns.select(
        F.col("campaign_id").cast("string").alias("Id"), F.col("campaign_name").alias("Name"),
        F.col("goal_amount").alias("ExpectedRevenue"), F.col("start_date").alias("StartDate"),
        F.col("end_date").alias("EndDate"),
    ))
    return crm.crm_campaigns(t.spark, path)


@query
def crm_quarantine(t):
    """Gifts as CRM lines, some cut short, with an amount in words or without an id: lines by reason, sound ones too."""
    path = scratch_path(t.spark, "crm-lines")
    gifts = t.raw_gifts.select("gift_id", F.col("gift_date").alias("CloseDate"), F.col("gift_amount").cast("string").alias("amount"))
    amount = F.when(F.col("gift_id") % 17 == 0, F.lit('"' + "ten" + '"')).otherwise(F.col("amount"))
    own_id = F.when(F.col("gift_id") % 19 == 0, F.lit("null")).otherwise(F.concat(F.lit('"'), F.col("gift_id").cast("string"), F.lit('"')))
    line = F.concat(
        F.lit('{"attributes":{"type":"Opportunity"},"Id":'), own_id, F.lit(',"Amount":'), amount,
        F.lit(',"CloseDate":"'), F.col("CloseDate").cast("string"), F.lit('","StageName":"Closed Won"}'),
    )
    gifts.select(F.when(F.col("gift_id") % 13 == 0, F.left(line, F.lit(40))).otherwise(line).alias("value")).write.text(path)
    found = crm.records(t.spark, path, schemas.CRM_OPPORTUNITIES)
    return found.groupBy(F.coalesce("reason", F.lit("sound")).alias("reason")).agg(F.count("*").alias("n"))


@query
def metrics_document(t):
    # What the sections on gifts start from is summed and written once; no section reads the gifts again.
    gifts, ledger = _gifts(t), _ledger(t)
    giving = materialize(donors.giving(gifts), "giving")
    books = document.Books(
        contacts=t.contacts, raw_gifts=t.raw_gifts, gifts=gifts, giving=giving, pledges=t.raw_pledges, ledger=ledger,
        funds=t.funds, campaigns=t.campaigns,
        recon=materialize(reconciliation.fund_reconciliation(giving, ledger, t.accounts), "recon"),
        scores=materialize(donors.rfm_scores(donors.donor_summary(giving)), "scores"),
    )
    parts = document.sections(books)
    path = scratch_path(t.spark, "metrics")
    document.write_document(parts, path)
    return document.read_document(t.spark, path, parts)
