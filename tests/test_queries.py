"""Registered queries against DuckDB, their invariants, and the shape of their plans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from almsbook.registry import QUERIES
from almsbook.sources.storage import scratch_path
from compare import connect, difference
from helpers import plan_of


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert QUERIES.keys() <= entry.queries().keys()
    assert QUERIES.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


def test_valid_and_orphaned_gifts_make_up_the_input(spark, sf_dir):
    parts = [QUERIES[name](spark, sf_dir).count() for name in ("stg_gifts", "gifts_orphaned")]
    assert sum(parts) == QUERIES["land_raw"](spark, sf_dir).count()


def test_valid_and_faulty_adjustments_make_up_the_input(spark, sf_dir):
    parts = [QUERIES[name](spark, sf_dir).count() for name in ("prep_valid", "prep_errors")]
    assert sum(parts) == QUERIES["prep_joined"](spark, sf_dir).count()


def test_segments_partition_the_donors(spark, sf_dir):
    counted = QUERIES["segment_counts"](spark, sf_dir).agg(F.sum("n")).first()[0]
    assert counted == QUERIES["donor_summary"](spark, sf_dir).count()


def test_statuses_partition_the_fund_months(spark, sf_dir):
    counted = QUERIES["recon_status_counts"](spark, sf_dir).agg(F.sum("n")).first()[0]
    assert counted == QUERIES["fund_reconciliation"](spark, sf_dir).count()


def test_journal_exceptions_are_the_spoiled_lines(spark, sf_dir):
    """The test books spoil one gift in 400 by fund, one in 461 by account, and credits of every 300th and 700th gift."""
    spoiled = set()
    for line in QUERIES["stg_gl"](spark, sf_dir).where("line_no = 2").collect():
        gift = line["source_gift_id"]
        if gift % 400 == 0 and line["fund_id"] is not None or gift % 461 == 3 or gift % 300 == 0 or gift % 700 == 0:
            spoiled.add(gift)
    found = {(r["transaction_id"], r["line_no"]) for r in QUERIES["journal_exceptions"](spark, sf_dir).collect()}
    assert found == {(gift, 2) for gift in spoiled}


def test_nothing_is_cut(spark, sf_dir):
    size = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet").count() for name in ("orders", "nation", "customer")}
    assert QUERIES["land_raw"](spark, sf_dir).count() == QUERIES["stg_pledges"](spark, sf_dir).count() == size["orders"]
    assert QUERIES["dim_fund"](spark, sf_dir).count() == size["nation"]
    assert QUERIES["prep_joined"](spark, sf_dir).count() == size["customer"]


def test_scratch_space_is_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# Queries whose plan only holds once their inputs were written and read back.
WRITES_FIRST = {"rfm_scores", "metrics_document"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in WRITES_FIRST])
def test_no_plan_gathers_or_crosses_facts(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "InPandas" not in plan
    # A window without partitions may only see one row per fiscal year.
    for line in plan.splitlines():
        if "Window [" in line and re.search(r"windowspecdefinition\((\w+#\d+ ASC)", line):
            assert name == "retention_by_fy" and "fiscal_year" in line


@pytest.mark.parametrize(
    "name, most",
    [
        ("stg_gifts", 0), ("gifts_orphaned", 0), ("stg_gl", 0), ("stg_pledges", 0),
        ("prep_valid", 0), ("prep_errors", 0), ("gift_side", 1), ("gl_side", 3), ("gl_unbalanced", 1),
        ("stg_donors", 1), ("donor_fy", 1), ("gift_type_mix", 1), ("fund_reconciliation", 4), ("donor_summary", 1),
        ("upsert_dim_donor", 2), ("fact_gifts", 0), ("gifts_without_gl", 0), ("donor_survivor_map", 0),
    ],
)
def test_shuffle_budget(spark, sf_dir, name, most):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single|RoundRobin)", plan)) <= most


def test_scans_read_only_what_they_need(spark, sf_dir):
    plan = plan_of(QUERIES["gift_side"](spark, sf_dir))
    orders = next(line for line in plan.splitlines() if "FileScan" in line and "o_orderkey" in line)
    assert "o_orderpriority" not in orders and "o_orderstatus" not in orders
    assert "o_totalprice" in orders and "o_orderdate" in orders


def test_ledger_lines_meet_no_account_before_they_are_summed(spark, sf_dir):
    """The join with the accounts stands above the first grouping."""
    plan = plan_of(QUERIES["gl_side"](spark, sf_dir))
    assert re.search(r"Join \[account_number", plan).start() < plan.index("keys=[account_number")


def test_segments_read_the_gifts_once(spark, sf_dir):
    """What is left to run only reads the summary written before."""
    plan = plan_of(QUERIES["donor_segments"](spark, sf_dir))
    assert "o_orderdate" not in plan and "donor-summary" in plan


def test_first_loads_move_keys_only(spark, sf_dir):
    """No row of a batch with unique keys is shuffled or aggregated; the special keys were written before."""
    plan = plan_of(QUERIES["fact_gl"](spark, sf_dir))
    assert "Aggregate" not in plan and not re.search(r"(?<!Broadcast)Exchange (?:hash|range)", plan)
