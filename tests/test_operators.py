import random
from decimal import Decimal

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from almsbook.operators import matching, merging, ranking, reconcile
from almsbook.operators.checks import within_tolerance
from helpers import dec, plan_of, rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, some without a key, the rest spread out."""
    data = [(7 if i % 3 == 0 else None if i % 50 == 1 else i, i) for i in range(600)]
    return spark.createDataFrame(data, "k int, v int")


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_without_match_equals_anti_join(spark, skewed, broadcast):
    right = spark.createDataFrame([(k,) for k in range(0, 600, 7)] + [(None,)], "other int")
    expected = rows(skewed.join(right, skewed.k == right.other, "left_anti"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        assert rows(matching.without_match(skewed, right, "k", "other")) == expected
        nothing = right.where("false")
        assert rows(matching.without_match(skewed, nothing, "k", "other")) == rows(skewed)
        assert matching.without_match(skewed.where("false"), right, "k", "other").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")


def test_survivor_map_keeps_every_row(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (5, None), (4, None), (6, ""), (None, "c")], "id int, g string")
    got = rows(matching.survivor_map(df, F.col("g"), "id", "to_id"))
    assert got == [(None, None), (1, 1), (2, 2), (3, 1), (4, 4), (5, 4), (6, 6)]


def test_has_match_counts_every_left_row(spark, skewed):
    right = spark.createDataFrame([(7,), (7,), (10,), (None,)], "other int")
    got = matching.has_match(skewed, right, "k", "other")
    totals = got.groupBy("matched").agg(F.sum("n")).collect()
    # 200 rows share key 7, which also is the key of row 7; row 10 matches by its own key.
    expected = {True: 200 + 1 + 1, False: 600 - 202}
    assert dict(map(tuple, totals)) == expected


def test_first_per_group(spark):
    df = spark.createDataFrame(
        [("b", 2, "x"), ("a", 2, "y"), (None, 1, "z"), ("c", 1, None), ("c", 1, "w"), (None, 3, "v")],
        "id string, g int, note string",
    )
    # Smallest id wins, a missing id loses, equal ids fall back to the other columns.
    assert rows(merging.first_per_group(df, [F.col("g")], ["id"])) == rows(
        spark.createDataFrame([("a", 2, "y"), ("c", 1, None), (None, 3, "v")], "id string, g int, note string")
    )


def test_insert_if_absent(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    batch = spark.createDataFrame([(2, "new"), (3, "b"), (3, "a"), (4, "c")], "k int, v string")
    assert rows(merging.insert_if_absent(target, batch, ["k"])) == [(1, "old"), (2, "old"), (3, "a"), (4, "c")]


def test_insert_if_absent_two_column_key(spark):
    target = spark.createDataFrame([("t", 1, 5)], "t string, n int, v int")
    batch = spark.createDataFrame([("t", 1, 6), ("t", 2, 7)], "t string, n int, v int")
    assert rows(merging.insert_if_absent(target, batch, ["t", "n"])) == [("t", 1, 5), ("t", 2, 7)]


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, "c", "z")], "id int, name string, kind string")
    batch = spark.createDataFrame([("B", 2, "new"), (None, 3, "new"), ("D", 4, None)], "name string, id int, kind string")
    assert rows(merging.upsert(target, batch, "id", ["name"])) == [
        (1, "a", "x"), (2, "B", None), (3, None, "z"), (4, "D", None),
    ]


def test_upsert_refuses_a_key_twice(spark):
    target = spark.createDataFrame([(1, "a")], "id int, name string")
    batch = spark.createDataFrame([(2, "b"), (2, "c")], "id int, name string")
    with pytest.raises(Exception, match="several rows to merge for key 2"):
        merging.upsert(target, batch, "id", ["name"]).collect()


def _rank(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v decimal(18,2)")
    got = ranking.global_rank(df, ["v", "id"], "r", "n").collect()
    return {row["id"]: (row["r"], row["n"]) for row in got}


@pytest.mark.parametrize("kind", ["spread", "one heavy value", "all equal", "single"])
def test_global_rank(spark, kind):
    pick = random.Random(5)
    values = {
        "spread": [Decimal(pick.randrange(10**6)) / 100 for _ in range(3000)],
        "one heavy value": [Decimal(3) if i % 3 else Decimal(pick.randrange(9)) for i in range(3000)],
        "all equal": [Decimal(1)] * 500,
        "single": [Decimal(1)],
    }[kind]
    order = sorted(range(len(values)), key=lambda i: (values[i], i))
    assert _rank(spark, values) == {i: (place + 1, len(values)) for place, i in enumerate(order)}


def test_global_rank_of_text_ids(spark):
    data = [(f"d{i:04d}", i % 3) for i in range(1000)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "id string, v int")
    got = {r["id"]: r["r"] for r in ranking.global_rank(df, ["v", "id"], "r", "n").collect()}
    assert got == {d: i + 1 for i, (d, _) in enumerate(sorted(data, key=lambda x: (x[1], x[0])))}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 11, 24, 99, 100, 101, 1203, 4999])
def test_bins_of_rank_match_quantile_cut(spark, n):
    got = (
        spark.range(1, n + 1).select(F.col("id").alias("r"), F.lit(n).cast("bigint").alias("n"))
        .select("r", ranking.equal_bins_of_rank("r", "n", 5).alias("b")).orderBy("r").collect()
    )
    if n == 1:
        assert [r["b"] for r in got] == [0]
    else:
        assert [r["b"] for r in got] == pd.qcut(pd.Series(range(1, n + 1)), 5, labels=False).tolist()


@pytest.mark.parametrize("kind, ids", [("spread", "number"), ("one heavy value", "text"), ("all equal", "text"), ("missing", "number")])
def test_rows_at_ranks_and_bins_by_position(spark, kind, ids, monkeypatch):
    """Brackets of few rows, so that ties are searched over several rounds; the same bins as by the global rank."""
    monkeypatch.setattr(ranking, "FETCHED", 40)
    pick = random.Random(7)
    values = {
        "spread": [Decimal(pick.randrange(10**6)) / 100 for _ in range(300)],
        "one heavy value": [Decimal(3) if i % 3 else Decimal(pick.randrange(9)) for i in range(300)],
        "all equal": [Decimal(1)] * 500,
        "missing": [None if i % 4 else Decimal(i % 5) for i in range(300)],
    }[kind]
    data = [(i if ids == "number" else f"d{i:04d}", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, f"id {'int' if ids == 'number' else 'string'}, v decimal(18,2)")
    in_order = sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    ranks = sorted({1, len(data) // 2, len(data) // 2 + 1, len(data)})
    assert [(r["id"], r["v"]) for r in ranking.rows_at_ranks(df, ["v", "id"], ranks)] == [in_order[r - 1] for r in ranks]
    binned = df.select("id", ranking.bins_by_position(df, ["v", "id"], 5).alias("b"))
    by_rank = ranking.global_rank(df, ["v", "id"], "r", "n").select("id", ranking.equal_bins_of_rank("r", "n", 5).alias("b"))
    assert sorted(map(tuple, binned.collect())) == sorted(map(tuple, by_rank.collect()))
    assert "Sort" not in plan_of(binned) and "Exchange" not in plan_of(binned)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 11])
def test_bins_by_position_of_few_rows(spark, n):
    df = spark.createDataFrame([(i, i % 2) for i in range(n)], "id int, v int")
    got = [r["b"] for r in df.select("v", "id", ranking.bins_by_position(df, ["v", "id"], 5).alias("b")).orderBy("v", "id").collect()]
    assert got == ([0] * n if n < 2 else pd.qcut(pd.Series(range(1, n + 1)), 5, labels=False).tolist())


def test_rows_at_ranks_that_are_not_there_or_not_apart(spark, monkeypatch):
    with pytest.raises(ValueError, match="beyond"):
        ranking.rows_at_ranks(spark.range(3).toDF("id"), ["id"], [4])
    twice = spark.range(4).toDF("id").unionByName(spark.range(4).toDF("id"))
    assert [r["id"] for r in ranking.rows_at_ranks(twice, ["id"], list(range(1, 9)))] == [0, 0, 1, 1, 2, 2, 3, 3]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1990, 1999), min_size=1, max_size=60))
def test_bins_of_value_match_quantile_cut(spark, years):
    df = spark.createDataFrame([(i, y) for i, y in enumerate(years)], "id int, y int")
    edged = df.withColumn("_edges", ranking.quantile_edges(df, "y", 5))
    got = edged.select("id", ranking.bin_of_value("y", F.col("_edges")).alias("b")).orderBy("id").collect()
    series = pd.Series(years)
    bins = min(5, series.nunique())
    # Exact edges: pandas' own grid holds 0.6000000000000001, which can split one edge into two.
    edges = sorted({series.quantile(step / bins) for step in range(bins + 1)})
    assert [r["b"] for r in got] == [max(0, sum(e < y for e in edges) - 1) for y in years]


def _statuses(spark, cases):
    left = spark.createDataFrame([(i, dec(g)) for i, (g, _) in enumerate(cases) if g is not None], "k int, g decimal(18,2)")
    right = spark.createDataFrame([(i, dec(p)) for i, (_, p) in enumerate(cases) if p is not None], "k int, p decimal(18,2)")
    got = reconcile.reconcile(left, right, ["k"], "g", "p").orderBy("k").collect()
    return [(r["variance_amount"], r["variance_pct"], r["status"]) for r in got]


def test_reconcile_boundaries(spark):
    good, timing, review = reconcile.RECONCILED, reconcile.TIMING, reconcile.NEEDS_REVIEW
    cases = [
        ("1000.00", "500.01"),   # 499.99 off
        ("1000.00", "500.00"),   # exactly 500 off
        ("10000.00", "9200.00"),  # exactly 8 %
        ("10000.00", "9200.01"),  # just under 8 %
        ("10000.00", "10799.99"),
        (None, "499.99"),
        (None, "500.00"),
        ("0.00", "700.00"),
        ("-9000.00", "-8400.00"),  # a negative base never excuses
        ("600.00", None),
        ("1.00", "700.00"),
    ]
    assert _statuses(spark, cases) == [
        (Decimal("499.99"), 50.0, good),
        (Decimal("500.00"), 50.0, review),
        (Decimal("800.00"), 8.0, review),
        (Decimal("799.99"), 8.0, timing),
        (Decimal("-799.99"), -8.0, timing),
        (Decimal("-499.99"), None, good),
        (Decimal("-500.00"), None, review),
        (Decimal("-700.00"), None, review),
        (Decimal("-600.00"), 6.67, review),
        (Decimal("600.00"), 100.0, review),
        (Decimal("-699.00"), -69900.0, review),
    ]


def test_reconcile_null_keys_stay_apart(spark):
    left = spark.createDataFrame([(None, Decimal(9))], "k int, g decimal(18,2)")
    right = spark.createDataFrame([(None, Decimal(5))], "k int, p decimal(18,2)")
    got = rows(reconcile.reconcile(left, right, ["k"], "g", "p").select("k", "g", "p"))
    assert got == [(None, Decimal("0.00"), Decimal("5.00")), (None, Decimal("9.00"), Decimal("0.00"))]


def test_reconcile_takes_other_tolerances(spark):
    left = spark.createDataFrame([(1, Decimal(100))], "k int, g decimal(18,2)")
    right = spark.createDataFrame([(1, Decimal(95))], "k int, p decimal(18,2)")
    strict = reconcile.reconcile(left, right, ["k"], "g", "p", Decimal(1), Decimal("0.05"))
    assert strict.first()["status"] == reconcile.NEEDS_REVIEW


def test_tolerance_is_strict_and_ungraded_when_empty(spark):
    df = spark.createDataFrame([(1, 100), (0, 100), (0, 0)], "bad int, n int")
    got = [r[0] for r in df.select(within_tolerance(F.col("bad"), F.col("n"), Decimal("0.01"))).collect()]
    assert got == [False, True, None]


def test_absent_with_a_hot_key(spark):
    """One key holds a third of the batch, some keys are known, some are missing: as the least-row choice over all rows."""
    data = [(7 if i % 3 == 0 else None if i % 50 == 1 else i, i, f"v{i % 4}") for i in range(600)]
    batch = spark.createDataFrame(data, "k int, v int, w string")
    target = spark.createDataFrame([(k, 0, "old") for k in (4, 5, 10, 1000)], "k int, v int, w string")
    wanted = merging.first_per_group(batch, [F.col("k")], ["k"]).where("k is null or k not in (4, 5, 10, 1000)")
    assert rows(merging.absent(target, batch, ["k"])) == rows(wanted)
    assert rows(merging.absent(target.where("false"), batch, ["k"])) == rows(merging.first_per_group(batch, [F.col("k")], ["k"]))
    assert merging.absent(batch, batch, ["k"]).count() == 0
