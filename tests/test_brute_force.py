"""Donor figures against straightforward pandas on the collected gifts of the test tables."""

import pandas as pd
import pytest

from almsbook.plans import donors
from almsbook.registry import QUERIES


@pytest.fixture(scope="module")
def collected(spark, sf_dir):
    frame = QUERIES["stg_gifts"](spark, sf_dir).toPandas()
    dates = pd.to_datetime(frame["gift_date"])
    frame["fy"] = dates.dt.year + (dates.dt.month > 6)
    frame["cents"] = [int(a * 100) for a in frame["gift_amount"]]
    return frame


@pytest.fixture(scope="module")
def by_donor(collected):
    grouped = collected.groupby("donor_id")
    summary = pd.DataFrame({"last": grouped["fy"].max(), "years": grouped["fy"].nunique(), "cents": grouped["cents"].sum()})
    return summary.sort_index()


def test_scores_match_quantile_cuts(spark, sf_dir, by_donor):
    got = QUERIES["rfm_scores"](spark, sf_dir).toPandas().set_index("donor_id").sort_index()
    bins = min(5, by_donor["last"].nunique())
    assert got["recency_rank"].tolist() == pd.qcut(by_donor["last"], bins, labels=False, duplicates="drop").tolist()
    for column, source in (("freq_rank", "years"), ("monetary_rank", "cents")):
        place = by_donor[source].rank(method="first")
        assert got[column].tolist() == pd.qcut(place, 5, labels=False).tolist()


def test_retention_matches_donor_sets(spark, sf_dir, collected):
    givers = {year: set(part["donor_id"]) for year, part in collected.groupby("fy")}
    years = sorted(givers)
    expected = {
        year: round(100 * len(givers[year] & givers[before]) / len(givers[before]) + 1e-9, 1)
        for before, year in zip(years, years[1:])
    }
    got = {r["fiscal_year"]: r["retention_rate"] for r in QUERIES["retention_by_fy"](spark, sf_dir).collect()}
    assert got == expected


def test_matrix_matches_a_cross_tabulation(spark, sf_dir, collected):
    segments = QUERIES["donor_segments"](spark, sf_dir).toPandas().set_index("donor_id")["segment"]
    names = {r["fund_id"]: r["fund_name"] for r in QUERIES["dim_fund"](spark, sf_dir).collect()}
    table = pd.crosstab(
        collected["fund_id"].map(names), collected["donor_id"].map(segments), values=collected["cents"], aggfunc="sum"
    ).fillna(0)
    for row in QUERIES["fund_segment_matrix"](spark, sf_dir).collect():
        for segment in donors.SEGMENTS:
            cents = int(table.loc[row["fund_name"]].get(segment, 0))
            assert row[segment] == (cents + 50) // 100
