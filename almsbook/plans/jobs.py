"""Jobs a user runs: land, load the warehouse, grade, report.

Each job reads and writes folders. Views of the staging layer are never stored; the raw layer, the
mart and the reconciliation are, because several reports read them.
"""

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almsbook.operators.merging import absent
from almsbook.plans import calendar, document, donors, mart, prep, quality, reconciliation, staging, statement
from almsbook.schemas import ADJUSTMENTS, FUNDS, RAW
from almsbook.sources import crm
from almsbook.sources.files import contract, scan_csv, write_csv
from almsbook.sources.landing import land_csv, misfits, read_raw
from almsbook.sources.manifest import Manifest
from almsbook.sources.storage import materialize, remove


def land_raw(spark: SparkSession, csv_by_table: dict[str, str], raw_dir: str) -> None:
    for table, source in csv_by_table.items():
        land_csv(spark, table, source, raw_dir)


def mart_tables(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """The batch each mart table receives from the raw layer."""

    def raw(table: str) -> DataFrame:
        return read_raw(spark, table, raw_dir)

    gifts = staging.stg_gifts(raw("gifts"), raw("funds"))
    return {
        "dim_date": calendar.dim_date(calendar.date_spine(calendar.fiscal_window(
            (raw("gifts"), "gift_date"), (raw("pledges"), "pledge_date"), (raw("ledger"), "transaction_date")))),
        "dim_donor": mart.dim_donor_public(staging.stg_donors(raw("contacts"))),
        "dim_fund": mart.dim_fund(raw("funds")),
        "dim_campaign": mart.dim_campaign(raw("campaigns")),
        "dim_account": mart.dim_account(raw("accounts")),
        "dim_subsidiary": mart.dim_subsidiary(raw("subsidiaries")),
        "fact_gifts": mart.fact_gifts(gifts),
        "fact_pledges": mart.fact_pledges(staging.stg_pledges(raw("pledges"))),
        "fact_gl": mart.fact_gl(staging.stg_ledger(raw("ledger"))),
    }


def load_mart(spark: SparkSession, raw_dir: str, mart_dir: str, loaded_dir: str | None = None) -> None:
    """Write a fresh mart: what ``loaded_dir`` holds plus what the raw layer adds.

    Its first version is there once all tables are.
    """
    manifest = Manifest(spark, mart_dir)
    if manifest.version():
        raise ValueError(f"{mart_dir} holds a mart already")
    manifest.sweep()  # what a failed load left
    batches = mart_tables(spark, raw_dir)
    for table, batch in batches.items():
        loaded = mart.stored(spark, loaded_dir, table) if loaded_dir else None
        mart.store(table, mart.load(table, batch, loaded), manifest.path(table, 1))
    manifest.commit({table: [1] for table in batches})


def extend_mart(spark: SparkSession, raw_dir: str, mart_dir: str, keep: int = 1) -> int:
    """Add what the raw layer has over the mart, as its next version; returns the version.

    Rows with new keys become a load of their own, so the loaded facts are read by key but never rewritten.
    Only the donor dimension is, since known donors may change their name. All tables change together when the
    manifest is written: until then, and if the job fails, readers see the version before. Running it again adds
    nothing. The ``keep`` newest versions stay readable.
    """
    manifest = Manifest(spark, mart_dir)
    before, version = manifest.loads(), manifest.version()
    if not version:
        raise ValueError(f"{mart_dir} holds no version to extend")
    manifest.sweep(keep)
    added: dict[str, list[int]] = {}
    dropped: dict[str, list[int]] = {}
    for table, batch in mart_tables(spark, raw_dir).items():
        loaded = mart.stored(spark, mart_dir, table)
        path = manifest.path(table, version + 1)
        if table == "dim_donor":
            mart.store(table, mart.load(table, batch, loaded), path)
            dropped[table] = before[table]
        else:
            new = absent(loaded, batch, mart.KEYS[table])
            mart.store(table, new, path)
            if spark.read.schema(loaded.schema).parquet(path).isEmpty():
                continue
        added[table] = [version + 1]
    manifest.commit(added, dropped)
    manifest.sweep(keep)
    return version + 1


def check_keys(spark: SparkSession, raw_dir: str, mart_dir: str, crm_paths: dict[str, str] | None = None) -> DataFrame:
    """Keys and references of a loaded mart, and landed rows that did not fit their types; those of CRM extracts on request."""
    tables = {name: mart.current(spark, mart_dir, name) for name in mart.KEYS}
    tables["contacts"] = read_raw(spark, "contacts", raw_dir)
    landed = [table for table in RAW if table != "adjustments"]
    fitting = misfits(spark, raw_dir, landed)
    if crm_paths:
        fitting = fitting.unionByName(crm.misfits(spark, crm_paths))
    return quality.key_expectations(tables, mart.KEYS).unionByName(quality.fitting_expectations(fitting))


def books_of(spark: SparkSession, raw_dir: str, mart_dir: str) -> document.Books:
    """Shared frames over a loaded mart; reconciliation and donor scores are computed once."""

    def table(name: str) -> DataFrame:
        return mart.current(spark, mart_dir, name)

    gifts = mart.gifts_of(table("fact_gifts"))
    ledger = mart.ledger_of(table("fact_gl"))
    giving = materialize(donors.giving(gifts), "giving")
    recon = reconciliation.fund_reconciliation(giving, ledger, table("dim_account"))
    return document.Books(
        # Gifts keep the id of the record they came with, so names come from all records.
        contacts=read_raw(spark, "contacts", raw_dir),
        raw_gifts=read_raw(spark, "gifts", raw_dir),
        gifts=gifts,
        giving=giving,
        pledges=table("fact_pledges"),
        ledger=ledger,
        funds=table("dim_fund"),
        campaigns=table("dim_campaign"),
        recon=materialize(recon, "recon"),
        scores=materialize(donors.rfm_scores(donors.donor_summary(giving)), "scores"),
    )


def register_views(spark: SparkSession, raw_dir: str, mart_dir: str) -> list[str]:
    """Offer the staging views, the mart and the reconciliation to SQL; returns the view names.

    ``donor_segments_of(fiscal_year)`` comes along as a table function.
    """

    def raw(table: str) -> DataFrame:
        return read_raw(spark, table, raw_dir)

    views = {name: mart.current(spark, mart_dir, name) for name in mart.KEYS}
    gifts, ledger = mart.gifts_of(views["fact_gifts"]), mart.ledger_of(views["fact_gl"])
    views |= {
        "stg_donors": staging.stg_donors(raw("contacts")),
        "stg_gifts": staging.stg_gifts(raw("gifts"), raw("funds")),
        "stg_gifts_orphaned": staging.gifts_orphaned(raw("gifts"), raw("funds")),
        "stg_pledges": staging.stg_pledges(raw("pledges")),
        "stg_gl_transactions": staging.stg_ledger(raw("ledger")),
        "fund_reconciliation": reconciliation.fund_reconciliation(gifts, ledger, views["dim_account"]),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    donors.register_segment_function(gifts)
    return list(views)


def log_quality(books: document.Books, log_dir: str, run_id: str | None = None) -> str:
    """Grade the books and append the result to the log; returns the id of the run."""
    run = run_id or uuid4().hex
    results = quality.dq_results(
        books.raw_gifts, books.gifts, books.pledges, books.ledger, books.funds, books.recon
    )
    append_quality(results, log_dir, run)
    return run


def append_quality(results: DataFrame, log_dir: str, run: str) -> None:
    """Put the results of a run into the log, in place of what the same run put there before.

    A run has a folder of its own; its id is also a column, since names of folders lose their type.
    """
    stamped = results.withColumns({"run_id": F.lit(run), "run_at": F.current_timestamp(), "run": F.concat(F.lit("run-"), F.lit(run))})
    stamped.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(log_dir)


def write_metrics(books: document.Books, out_dir: str) -> None:
    """The sections as datasets of their own, and the nested document built from them."""
    parts = document.sections(books)
    document.write_document(parts, f"{out_dir}/sections")
    spark = books.gifts.sparkSession
    written = {name: document.read_section(spark, f"{out_dir}/sections", name, part) for name, part in parts.items()}
    document.nested_document(written).coalesce(1).write.mode("overwrite").text(f"{out_dir}/document")


def write_statements(books: document.Books, out_dir: str, top_n: int | None = 15) -> None:
    """Header and rows of every statement, one folder per period."""
    flagged = materialize(reconciliation.flagged_variances(books.recon, books.funds, top_n), "flagged")
    write_statement_files(flagged, statement.statement_periods(flagged, books.giving), out_dir)


def write_statement_files(flagged: DataFrame, periods: DataFrame, out_dir: str) -> None:
    """The statements of ``periods``, in place of what was written for them before; other periods keep their files."""
    spark = flagged.sparkSession
    body = statement.statement_rows(flagged.join(periods.select(*statement.PERIOD), statement.PERIOD, "left_semi"))
    for name, part in (("header", statement.statement_header(periods, flagged)), ("rows", body)):
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*statement.PERIOD).parquet(f"{out_dir}/{name}")
    # A period that has no flagged rows any more writes none over the old ones. Periods are months, so few.
    for year, month in periods.select(*statement.PERIOD).join(flagged, statement.PERIOD, "left_anti").collect():
        remove(spark, f"{out_dir}/rows/fiscal_year={year}/fiscal_month={month}")


def run_prep(spark: SparkSession, adjustments_csv: str, funds_csv: str, out_dir: str) -> DataFrame:
    """Clean the manual adjustments into a valid and an error file; returns the error breakdown."""
    adjustments = contract(scan_csv(spark, adjustments_csv, ADJUSTMENTS), ADJUSTMENTS)
    funds = contract(scan_csv(spark, funds_csv, FUNDS), FUNDS)
    return write_prep(prep.prep_joined(adjustments, funds), out_dir)


def write_prep(joined: DataFrame, out_dir: str) -> DataFrame:
    joined = joined.persist()
    errors = prep.prep_errors(joined)
    write_csv(prep.prep_valid(joined), f"{out_dir}/clean_donor_adjustments")
    write_csv(errors, f"{out_dir}/errors_log")
    breakdown = materialize(prep.prep_error_breakdown(errors), "breakdown")
    joined.unpersist()
    return breakdown
