"""The whole flow over files: land, load twice, grade, report."""

import json
import os
from datetime import date

import pytest

from almsbook import schemas
from almsbook.plans import document, jobs, mart, overview, prep, quality, reconciliation, staging
from almsbook.sources import crm, files, landing
from almsbook.sources.manifest import Manifest
from helpers import accounts, day, dec, funds, gifts, ledger, plan_of, rows


@pytest.fixture(scope="module")
def extracts(spark, tmp_path_factory):
    """CSV extracts of a small foundation, with an orphan gift, an unposted gift and a cent too much."""
    given = gifts(
        spark,
        ("g1", "d1", "A", "2024-07-05", "1000.00"), ("g2", "d2", "A", "2025-02-01", "250.50"),
        ("g3", "d3", "B", "2025-07-09", "75.00"), ("g4", "d1", "B", "2025-08-01", "2000.00"),
        ("g5", "d1", "OLD", "2025-08-01", "10.00"),
    )
    books = ledger(
        spark,
        ("t1", 1, "2024-07-05", "1000", "A", "1000.00", None, "g1"), ("t1", 2, "2024-07-05", "4000", "A", None, "1000.00", "g1"),
        ("t2", 1, "2025-02-02", "1000", "A", "250.50", None, "g2"), ("t2", 2, "2025-02-02", "4000", "A", None, "250.52", "g2"),
        ("t3", 1, "2025-07-10", "1000", "B", "75.00", None, "g3"), ("t3", 2, "2025-07-10", "4000", "B", None, "75.00", "g3"),
    )
    contacts = spark.createDataFrame(
        [("d1", " ANN  LEE ", "Individual", "Ann@x.org ", day("2024-07-05"), "WA"),
         ("d9", "ann lee", "Individual", "ann@x.org", None, "WA"),
         ("d2", "Bo Ray", "Organization", None, day("2025-02-01"), None), ("d3", "Cy, Inc.", "Organization", None, None, "OR")],
        schemas.CONTACTS,
    )
    frames = {
        "contacts": contacts,
        "gifts": given,
        "pledges": spark.createDataFrame(
            [("p1", "d1", "A", day("2024-07-01"), dec("10.00"), dec("12.00"), "Paid in Full")], schemas.PLEDGES),
        "ledger": books,
        "accounts": accounts(spark),
        "subsidiaries": spark.createDataFrame([("SUB-01", "Main")], schemas.SUBSIDIARIES),
        "funds": funds(spark, "A", "B"),
        "campaigns": spark.createDataFrame([("c1", "Drive", dec("4000.00"), None, None)], schemas.CAMPAIGNS),
    }
    base = tmp_path_factory.mktemp("extracts")
    for name, frame in frames.items():
        files.write_csv(frame, f"{base}/{name}")
    return {name: f"{base}/{name}" for name in frames}


@pytest.fixture(scope="module")
def warehouse(spark, extracts, tmp_path_factory):
    base = tmp_path_factory.mktemp("warehouse")
    jobs.land_raw(spark, extracts, f"{base}/raw")
    jobs.load_mart(spark, f"{base}/raw", f"{base}/mart")
    return str(base)


@pytest.fixture(scope="module")
def books(spark, warehouse):
    return jobs.books_of(spark, f"{warehouse}/raw", f"{warehouse}/mart")


def test_landed_rows_keep_types_and_gain_a_load_time(spark, warehouse):
    landed = spark.read.parquet(f"{warehouse}/raw/gifts")
    assert landed.where("_loaded_at is null").count() == 0
    raw = landing.read_raw(spark, "gifts", f"{warehouse}/raw")
    assert raw.schema == schemas.GIFTS and raw.count() == 5


def test_mart_tables(spark, warehouse):
    def table(name):
        return spark.read.parquet(f"{warehouse}/mart/{name}")

    assert table("dim_date").count() == 365 * 2
    assert rows(table("dim_donor").select("donor_id", "donor_name")) == [("d1", "Ann Lee"), ("d2", "Bo Ray"), ("d3", "Cy, Inc.")]
    assert [r[0] for r in rows(table("fact_gifts"))] == ["g1", "g2", "g3", "g4"]
    assert table("fact_gl").where("debit_amount is null or credit_amount is null").count() == 0
    for name, keys in mart.KEYS.items():
        frame = table(name)
        assert frame.count() == frame.select(keys).distinct().count()
        assert "email" not in frame.columns


def test_every_fact_has_a_calendar_row(spark, tmp_path):
    """A gift of June is posted in July, and a pledge is older than all gifts."""
    raw, store = f"{tmp_path}/raw", f"{tmp_path}/mart"
    frames = {
        "gifts": gifts(spark, ("g1", "d1", "A", "2024-06-28", "10.00")),
        "ledger": ledger(spark, ("t1", 1, "2024-07-05", "1000", "A", "10.00", None, "g1"), ("t1", 2, "2024-07-05", "4000", "A", None, "10.00", "g1")),
        "pledges": spark.createDataFrame([("p1", "d1", "A", day("2022-08-01"), dec("10.00"), dec("1.00"), "Active")], schemas.PLEDGES),
        "contacts": spark.createDataFrame([("d1", "Ann", None, None, None, None)], schemas.CONTACTS),
        "accounts": accounts(spark), "subsidiaries": spark.createDataFrame([("SUB-01", "Main")], schemas.SUBSIDIARIES),
        "funds": funds(spark, "A"), "campaigns": spark.createDataFrame([], schemas.CAMPAIGNS),
    }
    for name, frame in frames.items():
        landing.land(frame, f"{raw}/{name}")
    jobs.load_mart(spark, raw, store)
    assert spark.read.parquet(f"{store}/dim_date").count() == 365 * 2 + 366
    rules = {r["name"]: r["observed"] for r in jobs.check_keys(spark, raw, store).collect()}
    assert len(rules) == 18 + 8 and not any(rules.values())
    assert spark.read.parquet(f"{store}/fact_gl").join(spark.read.parquet(f"{store}/dim_date"), "date_id").count() == 2


def test_rows_that_do_not_fit_are_counted(spark, tmp_path):
    (tmp_path / "funds.csv").write_text("fund_id,fund_name,fund_type,restriction_type\nA,B,C,D\n")
    (tmp_path / "campaigns.csv").write_text("campaign_id,campaign_name,goal_amount,start_date,end_date\nc,D,ten,2024-01-01,\nd,E,5,2024-01-01,\n")
    for name in ("funds", "campaigns"):
        landing.land_csv(spark, name, str(tmp_path / f"{name}.csv"), f"{tmp_path}/raw")
    assert rows(landing.misfits(spark, f"{tmp_path}/raw", ["funds", "campaigns"])) == [("campaigns", 1), ("funds", 0)]


def test_the_best_donor_keeps_the_name_of_a_merged_record(spark, extracts, tmp_path):
    raw, store = f"{tmp_path}/raw", f"{tmp_path}/mart"
    jobs.land_raw(spark, extracts, raw)
    landing.land(gifts(spark, ("g1", "d9", "A", "2024-07-05", "9000.00"), ("g2", "d2", "A", "2024-07-06", "1.00")), f"{raw}/gifts")
    jobs.load_mart(spark, raw, store)
    best = document.sections(jobs.books_of(spark, raw, store))["top_donors"].orderBy("rfm_score", ascending=False).first()
    assert (best["donor_id"], best["donor_name"]) == ("d9", "ann lee")


def test_a_period_reads_its_years_only(spark, warehouse):
    fact = mart.gifts_of(spark.read.parquet(f"{warehouse}/mart/fact_gifts"))
    assert {r[0] for r in fact.select("fiscal_year").distinct().collect()} == {2025, 2026}
    plan = plan_of(overview.two_years(fact))
    assert "PartitionFilters: [isnotnull(fiscal_year" in plan and ">= (Subquery" in plan


def test_scratch_folders_go_with_their_job(spark, tmp_path):
    from almsbook.sources.storage import materialize, scratch_scope

    with scratch_scope(spark):
        made = materialize(spark.range(3), "gone")
        assert made.count() == 3
        path = made.inputFiles()[0].removeprefix("file:")
        assert os.path.exists(path)
    assert not os.path.exists(os.path.dirname(path))


def test_loading_again_adds_nothing(spark, warehouse):
    jobs.load_mart(spark, f"{warehouse}/raw", f"{warehouse}/mart2", loaded_dir=f"{warehouse}/mart")
    for name in mart.KEYS:
        assert rows(spark.read.parquet(f"{warehouse}/mart2/{name}")) == rows(spark.read.parquet(f"{warehouse}/mart/{name}"))


def test_extending_in_place(spark, warehouse, extracts, tmp_path):
    raw, store = f"{tmp_path}/raw", f"{tmp_path}/mart"
    jobs.land_raw(spark, extracts, raw)
    jobs.load_mart(spark, raw, store)
    gifts_before = {r[0]: r for r in spark.read.parquet(f"{store}/fact_gifts").collect()}
    late = gifts(spark, ("g1", "d1", "A", "2024-07-05", "9999.00"), ("g7", "d9", "B", "2026-07-01", "5.00"))
    landing.land(late, f"{raw}/gifts")
    renamed = spark.createDataFrame([("d2", "Bo R. Ray", "Organization", None, None, "CA")], schemas.CONTACTS)
    landing.land(renamed, f"{raw}/contacts")
    for _ in range(2):  # the second run finds nothing to add
        jobs.extend_mart(spark, raw, store)
        facts = {r[0]: r for r in spark.read.parquet(f"{store}/fact_gifts").collect()}
        assert spark.read.parquet(f"{store}/fact_gifts").count() == len(facts) == 5
        assert {k: facts[k] for k in gifts_before} == gifts_before
        donors = rows(spark.read.parquet(f"{store}/dim_donor").select("donor_id", "donor_name", "state"))
        assert donors == [("d1", "Ann Lee", "WA"), ("d2", "Bo R. Ray", None), ("d3", "Cy, Inc.", "OR")]
        assert spark.read.parquet(f"{store}/dim_date").count() == 365 * 3
        assert spark.read.parquet(f"{store}/fact_gl").count() == 6


def test_a_load_is_visible_whole_or_not(spark, warehouse, tmp_path, monkeypatch):
    store, names = f"{tmp_path}/mart", ["dim_donor", "fact_gifts", "fact_pledges"]
    all_tables = jobs.mart_tables(spark, f"{warehouse}/raw")
    late = mart.fact_gifts(gifts(spark, ("g7", "d9", "B", "2026-07-01", "5.00")))
    renamed = spark.createDataFrame([("d2", "Bo R. Ray", "Organization", None, "CA")], all_tables["dim_donor"].schema)
    write, batches = mart.store, {name: all_tables[name] for name in names}
    monkeypatch.setattr(jobs, "mart_tables", lambda *_: batches)

    def store_or_fail(table, *rest):
        if table == "fact_pledges":
            raise OSError("the disk is full")
        write(table, *rest)

    def state(version=None):
        return {name: rows(mart.current(spark, store, name, version)) for name in names}

    jobs.load_mart(spark, "", store)
    before = state()
    batches |= {"fact_gifts": late, "dim_donor": renamed}
    monkeypatch.setattr(mart, "store", store_or_fail)
    with pytest.raises(OSError):  # between two tables, one of them written anew
        jobs.extend_mart(spark, "", store)
    monkeypatch.setattr(mart, "store", write)
    assert os.path.isdir(f"{store}/dim_donor/load=2") and state() == before
    assert jobs.extend_mart(spark, "", store, keep=2) == 2
    after = state()
    assert len(after["fact_gifts"]) == 5 and [r[1] for r in after["dim_donor"]] == ["Ann Lee", "Bo R. Ray", "Cy, Inc."]
    assert state(version=1) == before
    # Nothing new: the facts gain no load, and the donors' first one is out of reach.
    assert jobs.extend_mart(spark, "", store, keep=2) == 3 and state() == after
    assert Manifest(spark, store).loads() == {"dim_donor": [3], "fact_gifts": [1, 2], "fact_pledges": [1]}
    assert sorted(os.listdir(f"{store}/dim_donor")) == ["load=2", "load=3"]
    with pytest.raises(ValueError, match="already"):
        jobs.load_mart(spark, "", store)


def test_reconciliation_from_the_mart_equals_staging(spark, warehouse, books):
    raw = lambda name: landing.read_raw(spark, name, f"{warehouse}/raw")
    direct = reconciliation.fund_reconciliation(
        staging.stg_gifts(raw("gifts"), raw("funds")), staging.stg_ledger(raw("ledger")), raw("accounts")
    )
    assert rows(books.recon) == rows(direct)


def test_sql_over_the_views(spark, warehouse, books):
    names = jobs.register_views(spark, f"{warehouse}/raw", f"{warehouse}/mart")
    for name in names:
        assert spark.table(name).count() > 0
    assert rows(spark.sql("SELECT * FROM fund_reconciliation")) == rows(books.recon)
    got = spark.sql("SELECT donor_id, segment FROM donor_segments_of(2026) ORDER BY donor_id").collect()
    assert [tuple(r) for r in got] == [("d1", "Active"), ("d2", "Lapsing"), ("d3", "New")]
    for name in names:
        spark.catalog.dropTempView(name)


def test_quality_log_grows_by_six_rows_per_run(spark, books, tmp_path):
    log = f"{tmp_path}/dq_results"
    first = jobs.log_quality(books, log, "first")
    jobs.log_quality(books, log)
    logged = spark.read.parquet(log)
    assert first == "first" and logged.count() == 12 and logged.select("run_id").distinct().count() == 2
    got = {r["check_no"]: r["row_count_affected"] for r in logged.where("run_id = 'first'").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 0, 5: 1, 6: 1}


def test_a_repeated_run_is_logged_once(spark, books, tmp_path):
    log = f"{tmp_path}/log"
    for run in ("7", "8", "7"):
        jobs.log_quality(books, log, run)
    logged = spark.read.parquet(log)
    assert rows(logged.groupBy("run_id").count()) == [("7", 6), ("8", 6)]


def test_statements_of_one_period_leave_the_others(spark, tmp_path):
    def write(*flags):
        flagged = spark.createDataFrame(
            [(f, f"Fund {f}", year, month, dec("900.00"), dec("1.00"), dec("899.00"), "Needs Review") for f, year, month in flags],
            "fund_id string, fund_name string, fiscal_year int, fiscal_month int, gifts_recorded decimal(18,2), gl_posted decimal(18,2), "
            "variance decimal(18,2), status string",
        )
        return flagged

    out = f"{tmp_path}/statements"
    first = write(("A", 2025, 1), ("B", 2025, 2), ("C", 2025, 2))
    jobs.write_statement_files(first, first.select("fiscal_year", "fiscal_month").distinct(), out)
    january = sorted(os.listdir(f"{out}/rows/fiscal_year=2025/fiscal_month=1"))
    # February is written anew; what is flagged elsewhere does not touch January.
    second = write(("B", 2025, 2), ("Z", 2025, 1))
    february = spark.createDataFrame([(2025, 2)], "fiscal_year int, fiscal_month int")
    jobs.write_statement_files(second, february, out)
    assert rows(spark.read.parquet(f"{out}/rows").select("fiscal_month", "fund")) == [(1, "Fund A"), (2, "Fund B")]
    assert rows(spark.read.parquet(f"{out}/header").select("fiscal_month", "n_flagged")) == [(1, 1), (2, 1)]
    assert sorted(os.listdir(f"{out}/rows/fiscal_year=2025/fiscal_month=1")) == january
    # Nothing is flagged in February any more: its rows go, its statement stays.
    jobs.write_statement_files(write(), february, out)
    assert rows(spark.read.parquet(f"{out}/rows").select("fiscal_month", "fund")) == [(1, "Fund A")]
    assert rows(spark.read.parquet(f"{out}/header").select("fiscal_month", "n_flagged")) == [(1, 1), (2, 0)]


def test_metrics_document_reads_back_what_was_computed(spark, books, tmp_path):
    parts = document.sections(books)
    document.write_document(parts, f"{tmp_path}/doc")
    for name, part in parts.items():
        assert rows(document.read_section(spark, f"{tmp_path}/doc", name, part)) == rows(part)
    kpis = document.read_section(spark, f"{tmp_path}/doc", "executive_kpis", parts["executive_kpis"]).first()
    assert (kpis["current_fy"], kpis["ytd_total"], kpis["goal_attainment_pct"]) == (2026, dec("2075.00"), 51.9)


def test_nested_document(spark, books, tmp_path):
    jobs.write_metrics(books, str(tmp_path))
    (text,) = [r[0] for r in spark.read.text(f"{tmp_path}/document").collect()]
    doc = json.loads(text)
    assert (doc["meta"]["current_fy"], doc["meta"]["prior_fy"]) == (2026, 2025)
    first, second, third, fourth = (doc[k] for k in (
        "page1_overview", "page2_retention", "page3_reconciliation", "page4_dataquality"))
    assert [t["fy_label"] for t in first["monthly_trend"]] == ["Prior FY", "Current FY"]
    assert first["monthly_trend"][1]["values"] == [75, 2000] + [0] * 10
    assert first["top_funds"] == [{"fund": "Fund B", "amount": 2075}, {"fund": "Fund A", "amount": 1251}]
    assert (first["ytd_total"], first["yoy_growth"], first["donor_count"], first["avg_gift"]) == (2075, 65.9, 2, 1037.5)
    assert second["segment_counts"] == {"Active": 1, "Lapsing": 1, "New": 1} and second["revenue_at_risk"] == 251
    assert second["matrix"] == {
        "funds": ["Fund A", "Fund B"], "segments": ["Active", "Lapsed", "Lapsing", "New"],
        "values": [[1000, 0, 251, 0], [2000, 0, 0, 75]],
    }
    assert second["retention_by_fy"] == [{"fiscal_year": 2026, "retention_rate": 50.0}]
    # Names as the records carry them, of merged records too.
    assert [d["donor"] for d in second["top_donors"]] == [" ANN  LEE ", "Bo Ray", "Cy, Inc."]
    assert third["status_counts"] == {"Needs Review": 1, "Reconciled": 3}
    assert third["flagged"] == [{
        "fund": "Fund B", "fiscal_year": 2026, "fiscal_month": 2, "gifts_recorded": 2000, "gl_posted": 0,
        "variance": 2000, "status": "Needs Review",
    }]
    assert [c["affected"] for c in fourth["checks"]] == [1, 1, 1, 0, 1, 1]
    assert (fourth["pass_rate"], fourth["total_checks"], fourth["passed_checks"]) == (17.0, 6, 1)


def test_statements_per_period(spark, books, tmp_path):
    jobs.write_statements(books, f"{tmp_path}/statements")
    header = spark.read.parquet(f"{tmp_path}/statements/header")
    assert rows(header.select("report_id", "period_label", "n_flagged")) == [("FRS-202602", "Aug FY2026", 1)]
    body = spark.read.parquet(f"{tmp_path}/statements/rows/fiscal_year=2026/fiscal_month=2")
    assert rows(body.select("fund", "variance_signed")) == [("Fund B", "+$2,000")]


def test_text_that_does_not_fit_is_kept_aside(spark, tmp_path):
    (tmp_path / "a.csv").write_text("adjustment_id,donor_name,fund_id,adjustment_amount,reason\nx, Bo ,F,ten,r\ny,Cy,F,10,r\n")
    scanned = files.scan_csv(spark, str(tmp_path / "a.csv"), schemas.ADJUSTMENTS).cache()
    assert rows(scanned.select("adjustment_id", "donor_name", "adjustment_amount", files.CORRUPT)) == [
        ("x", " Bo ", None, "x, Bo ,F,ten,r"), ("y", "Cy", dec("10.00"), None),
    ]
    joined = prep.prep_joined(files.contract(scanned, schemas.ADJUSTMENTS), funds(spark, "F"))
    assert rows(prep.prep_errors(joined).select("adjustment_id", "error_reason")) == [("x", prep.MISSING_AMOUNT)]


def test_crm_extracts_lose_their_envelope(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        '{"attributes":{"type":"Contact","url":"/c/1"},"Id":"1","Name":"Ann","AccountId":"a","Email":"e",'
        '"MailingState":"WA","npsp__First_Gift_Date__c":"2024-01-02"}\n'
        '{"attributes":{"type":"Contact"},"Id":"2","Name":"Bo","npsp__First_Gift_Date__c":null}\n'
    )
    assert rows(crm.crm_contacts(spark, str(tmp_path / "c.json"))) == [("1", "Ann", None, "e", date(2024, 1, 2), "WA")]
    (tmp_path / "o.json").write_text(
        '{"attributes":{},"Id":"g1","ContactId":"1","Amount":10.5,"CloseDate":"2024-01-02","Type":"Cash","StageName":"Closed Won","Fund__c":"A"}\n'
        '{"attributes":{},"Id":"g2","ContactId":"1","Amount":99,"CloseDate":"2024-03-02","Type":"Stock","StageName":"Closed Won","CampaignId":"c"}\n'
        '{"attributes":{},"Id":"g3","ContactId":"1","Amount":1,"CloseDate":"2024-01-02","StageName":"Prospecting"}\n'
    )
    got = [tuple(r) for r in crm.crm_opportunities(spark, str(tmp_path / "o.json")).collect()]
    assert got == [
        ("g2", "1", None, "c", date(2024, 3, 2), dec("99.00"), "Stock"),
        ("g1", "1", "A", None, date(2024, 1, 2), dec("10.50"), "Cash"),
    ]
    (tmp_path / "k.json").write_text('{"attributes":{},"Id":"c","Name":"Drive","ExpectedRevenue":5,"StartDate":"2024-05-01"}\n')
    assert rows(crm.crm_campaigns(spark, str(tmp_path / "k.json"))) == [("c", "Drive", dec("5.00"), date(2024, 5, 1), None)]


def test_crm_lines_that_are_no_records_are_kept_aside(spark, tmp_path):
    lines = {
        '{"Id":"g1","ContactId":"1","Amount":10.5,"CloseDate":"2024-01-02","StageName":"Closed Won"}': None,
        '{"Id":"g2","Amount":"ten","CloseDate":"2024-01-02","StageName":"Closed Won"}': crm.MISFIT,
        '{"Id":"g3","Amount":1,"CloseDate":"yesterday","StageName":"Closed Won"}': crm.MISFIT,
        '{"Id":"g4","Amount":1,"CloseDate":"2024-01-02","StageNa': crm.NOT_JSON, "total: 4 records": crm.NOT_JSON, '["g5", 1]': crm.NOT_JSON, "7": crm.NOT_JSON,
        '{"Amount":1,"CloseDate":"2024-01-02","StageName":"Closed Won"}': crm.NO_ID, '{"Id":"","Amount":1,"StageName":"Closed Won"}': crm.NO_ID,
        '{"Id":"g6","Amount":null,"StageName":"Prospecting"}': None, "   ": "blank",
    }
    (tmp_path / "o.json").write_text("\n".join(lines) + "\n\n")
    kept = crm.rejected(spark, str(tmp_path / "o.json"), "opportunities")
    assert kept.columns == ["kind", "file", "reason", "line"] and all(r["file"].endswith("/o.json") for r in kept.collect())
    assert {r["line"]: r["reason"] for r in kept.collect()} == {line: reason for line, reason in lines.items() if reason not in (None, "blank")}
    assert [r[0] for r in rows(crm.crm_opportunities(spark, str(tmp_path / "o.json")))] == ["g1"]
    found = crm.records(spark, str(tmp_path / "o.json"), schemas.CRM_OPPORTUNITIES)
    assert found.count() == len(lines) - 1 == kept.count() + found.where("reason IS NULL").count()
    counted = crm.misfits(spark, {"opportunities": str(tmp_path / "o.json")})
    assert rows(quality.fitting_expectations(counted)) == [("crm opportunities: every row fits its types", 8, False)]


def test_command_line(spark, extracts, tmp_path):
    from almsbook.__main__ import run

    source = tmp_path / "extracts"
    source.mkdir()
    for name, path in extracts.items():
        (source / f"{name}.csv").symlink_to(path)
    raw, store = f"{tmp_path}/raw", f"{tmp_path}/mart"
    run(spark, ["land", "--extracts", str(source), "--raw", raw])
    run(spark, ["load", "--raw", raw, "--mart", store])
    run(spark, ["extend", "--raw", raw, "--mart", store])
    run(spark, ["grade", "--raw", raw, "--mart", store, "--out", f"{tmp_path}/log"])
    run(spark, ["statements", "--raw", raw, "--mart", store, "--out", f"{tmp_path}/statements"])
    assert spark.read.parquet(f"{tmp_path}/log").count() == 6
    assert spark.read.parquet(f"{tmp_path}/statements/header").count() == 1
