"""Results stay whole when one donor, one fund, one day and one name hold a third of the rows or more."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import connect, difference

QUERIES = [
    "fund_reconciliation", "gift_side", "gl_side", "gifts_without_gl", "gl_unbalanced", "stg_donors", "donor_survivor_map",
    "gifts_orphaned", "donor_summary", "donor_segments", "retention_by_fy", "fund_segment_matrix", "rfm_scores", "top_donors",
    "executive_kpis", "dq_results", "upsert_dim_donor", "gifts_by_fiscal_month_dimjoin", "prep_errors",
]


@pytest.fixture(scope="module")
def hot_dir(sf_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("hot")
    changed = {
        "orders": """SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey,
            CASE WHEN o_orderkey % 7 < 3 THEN TIMESTAMP '2000-09-01' ELSE o_orderdate END AS o_orderdate) FROM source""",
        "customer": """SELECT * REPLACE (CASE WHEN c_custkey % 2 = 0 THEN 'One Name' ELSE c_name END AS c_name,
            CASE WHEN c_custkey % 2 = 0 THEN 'AUTO' ELSE c_mktsegment END AS c_mktsegment,
            CASE WHEN c_custkey % 3 < 2 THEN 5 ELSE c_nationkey END AS c_nationkey) FROM source""",
    }
    con = duckdb.connect()
    for table in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE OR REPLACE VIEW source AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        con.execute(f"COPY ({changed.get(table, 'SELECT * FROM source')}) TO '{base}/{table}.parquet'")
    return str(base)


@pytest.mark.parametrize("name", QUERIES)
def test_hot_keys(spark, hot_dir, name):
    """Without broadcasts, and with thresholds low enough for the skew join to split partitions."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        assert difference(entry.queries()[name](spark, hot_dir), connect(hot_dir), entry.oracle_sql()[name]) is None
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
