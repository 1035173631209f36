"""The reconciliation kept up to date against the one computed at once."""

import random

import pytest

from almsbook.plans import reconciliation, rolling
from almsbook.sources.manifest import Manifest
from helpers import accounts, gifts, ledger, plan_of, rows


def books(spark, seed, count):
    rng = random.Random(seed)
    day = lambda: f"20{rng.choice(['24', '25'])}-{rng.choice(['01', '02', '07'])}-{rng.randint(10, 28)}"
    fund = lambda: rng.choice(["A", "B", None])
    given = [(f"g{seed}-{i}", "d", fund(), day(), rng.choice(["100.00", "450.50", "-20.00", None])) for i in range(count)]
    posted = [(f"t{seed}-{i}", 1, day(), rng.choice(["1000", "4000", "4000", "5000", None]), fund(), None, rng.choice(["100.00", "450.50", None]), "g") for i in range(count)]
    return gifts(spark, *given), ledger(spark, *posted)


def test_batches_equal_the_whole(spark, tmp_path):
    kept = rolling.RollingReconciliation(spark, f"{tmp_path}/kept")
    all_gifts, all_lines = books(spark, 0, 0)
    chart = accounts(spark)
    for seed, count in ((1, 12), (2, 1), (3, 0), (4, 20)):
        given, posted = books(spark, seed, count)
        all_gifts, all_lines = all_gifts.unionByName(given), all_lines.unionByName(posted)
        version = kept.record(f"b{seed}", given, posted, chart)
        assert kept.record(f"b{seed}", given, posted, chart) == version  # a known batch adds nothing
        assert rows(kept.current()) == rows(reconciliation.fund_reconciliation(all_gifts, all_lines, chart))
    assert kept.batches() == {"b1", "b2", "b3", "b4"}
    # Revenue moves to another account: only the kept sums are needed.
    other = chart.replace({"Income": "Expense", "Expense": "Income"}, subset="account_type")
    kept.compact(other)
    assert rows(kept.current()) == rows(reconciliation.fund_reconciliation(all_gifts, all_lines, other))
    assert kept.manifest.loads() == {"judged": [5], "sums": [5]}


def test_only_touched_months_are_judged_and_no_old_fact_is_read(spark, tmp_path):
    kept = rolling.RollingReconciliation(spark, f"{tmp_path}/kept")
    chart = accounts(spark)
    facts = f"{tmp_path}/facts"
    old_gifts, old_lines = books(spark, 5, 15)
    old_gifts.write.parquet(f"{facts}/gifts")
    kept.record("old", spark.read.parquet(f"{facts}/gifts"), old_lines, chart)
    kept.record("new", gifts(spark, ("g", "d", "A", "2025-02-11", "9000.00")), ledger(spark), chart)
    judged = spark.read.parquet(Manifest(spark, f"{tmp_path}/kept").path("judged", 2))
    assert rows(judged.select("fund_id", "fiscal_year", "fiscal_month")) == [("A", 2025, 8)]
    sums = kept.manifest.read("sums").drop("load")
    assert facts not in plan_of(kept.judge(sums, chart)) and facts not in plan_of(kept.current())


def test_a_failed_batch_is_not_seen(spark, tmp_path, monkeypatch):
    kept = rolling.RollingReconciliation(spark, f"{tmp_path}/kept")
    chart, (given, posted) = accounts(spark), books(spark, 6, 8)
    kept.record("a", given, posted, chart)
    before = rows(kept.current())
    monkeypatch.setattr(rolling.RollingReconciliation, "judge", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        kept.record("b", given, posted, chart)
    monkeypatch.undo()
    assert rows(kept.current()) == before and kept.batches() == {"a"}
    kept.record("b", given, posted, chart)
    assert rows(kept.current()) == rows(reconciliation.fund_reconciliation(given.unionByName(given), posted.unionByName(posted), chart))
