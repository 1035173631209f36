"""Contract frames derived from the star-schema test tables.

The texts are plain SQL that Spark and DuckDB read alike; ``{name}`` stands for another frame. Only
the two-line expansion of the ledger is spelled differently, see ``SPARK_LINES``.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The rules below are the test books' own; the chart of accounts alone holds fixed values of the contract.
TEXTS = {
    "dim_fund": """
        SELECT n_nationkey AS fund_id, n_name AS fund_name, r_name AS fund_type,
               CASE WHEN n_regionkey = 0 THEN 'Unrestricted' ELSE 'Restricted' END AS restriction_type
        FROM {nation} JOIN {region} ON r_regionkey = n_regionkey""",
    "dim_campaign": """
        SELECT r_regionkey AS campaign_id, r_name AS campaign_name,
               CAST(100000 * (r_regionkey + 1) AS DECIMAL(18,2)) AS goal_amount,
               DATE '2000-07-01' AS start_date, DATE '2001-06-30' AS end_date
        FROM {region}""",
    # The ten general accounts, and one expense account per supplier.
    "dim_account": """
        SELECT * FROM (VALUES
          ('1000','Cash - Operating','Bank'), ('1100','Cash - Investment Pool','Bank'),
          ('4000','Contribution Revenue - Unrestricted','Income'), ('4100','Contribution Revenue - Restricted','Income'),
          ('4200','Pledge Revenue','Income'), ('4300','Investment Income','Income'),
          ('5000','Scholarship Disbursements','Expense'), ('5100','Grant Expense','Expense'),
          ('5200','Administrative Expense','Expense'), ('5300','Fundraising Expense','Expense')
        ) AS t(account_number, account_name, account_type)
        UNION ALL
        SELECT '6-' || CAST(s_suppkey AS STRING), s_name, 'Expense' FROM {supplier}""",
    # The head office, one subsidiary for urgent gifts, and one per nation that suppliers sit in.
    "dim_subsidiary": """
        SELECT * FROM (VALUES ('SUB-01','Main'), ('SUB-02','Urgent appeals')) AS t(subsidiary_id, subsidiary_name)
        UNION ALL
        SELECT DISTINCT 'SUB-N' || CAST(n_nationkey AS STRING), n_name
        FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey""",
    # Every 25th name is padded and in capitals; every 80th donor has a second record.
    "contacts": """
        SELECT c_custkey AS donor_id,
               CASE WHEN c_custkey % 25 = 0 THEN '  ' || upper(c_name || ' o''neil-' || c_mktsegment) || '  '
                    ELSE c_name || '  o''neil-' || lower(c_mktsegment) END AS donor_name,
               'Type ' || substr(c_mktsegment, 1, 1) AS donor_type,
               ' User' || CAST(c_custkey AS STRING) || '@Example.org ' AS email,
               CAST(DATE '1995-01-01' AS DATE) AS first_gift_date,
               substr(c_mktsegment, 1, 2) AS state
        FROM {customer}
        UNION ALL
        SELECT c_custkey + 10000000, lower(c_name || ' o''neil-' || c_mktsegment), 'Type 2',
               ' User' || CAST(c_custkey AS STRING) || '@Example.org ', CAST(DATE '1995-01-01' AS DATE),
               substr(c_mktsegment, 1, 2)
        FROM {customer} WHERE c_custkey % 80 = 0""",
    # Each order is a gift to the fund of the customer's nation; one in 331 has no fund, another one a fund that is gone.
    "gifts_raw": """
        SELECT o_orderkey AS gift_id, o_custkey AS donor_id,
               CASE WHEN o_orderkey % 331 = 5 THEN NULL WHEN o_orderkey % 331 = 6 THEN 99 ELSE c_nationkey END AS fund_id,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 5 END AS campaign_id,
               CAST(o_orderdate AS DATE) AS gift_date,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.001 AS DECIMAL(18,2)) AS gift_amount,
               o_orderpriority AS gift_type
        FROM {orders} JOIN {customer} ON c_custkey = o_custkey""",
    # Every gift backs a pledge; what is paid follows the priority, and one in 331 is paid a dollar too much.
    "pledges_raw": """
        SELECT gift_id AS pledge_id, donor_id, fund_id, gift_date AS pledge_date, gift_amount AS pledged_amount,
               CAST(CASE WHEN gift_id % 331 = 7 THEN gift_amount + 1.00 WHEN gift_type IN ('1-URGENT', '2-HIGH') THEN gift_amount
                    WHEN gift_type = '3-MEDIUM' THEN gift_amount * 0.5 ELSE 0.00 END AS DECIMAL(18,2)) AS paid_amount
        FROM {gifts_raw}""",
    # Two lines per gift, posted within a week. Spoiled on purpose: a week that never arrived, lines on the
    # wrong fund (one gift in 400) or account (one in 461), and credits one or two cents too high.
    "gl_export": """
        SELECT g.gift_id AS transaction_id, line_no, g.gift_date + CAST(g.gift_id % 7 AS INT) AS transaction_date,
               CASE WHEN line_no = 1 THEN '1000' WHEN g.gift_id % 461 = 3 THEN '4200'
                    WHEN f.restriction_type = 'Unrestricted' THEN '4000' ELSE '4100' END AS account_number,
               CASE WHEN line_no = 2 AND g.gift_id % 400 = 0 THEN (g.fund_id + 1) % 25 ELSE g.fund_id END AS fund_id,
               CASE WHEN g.gift_type = '1-URGENT' THEN 'SUB-02' ELSE 'SUB-01' END AS subsidiary_id,
               CASE WHEN line_no = 1 THEN g.gift_amount ELSE NULL END AS debit_amount,
               CASE WHEN line_no = 2 THEN CAST(g.gift_amount + CASE WHEN g.gift_id % 700 = 0 THEN 0.02
                     WHEN g.gift_id % 300 = 0 THEN 0.01 ELSE 0.00 END AS DECIMAL(18,2)) ELSE NULL END AS credit_amount,
               'Gift receipt ' || CAST(g.gift_id AS STRING) AS memo, g.gift_id AS source_gift_id
        FROM {gifts_raw} g LEFT JOIN {dim_fund} f ON f.fund_id = g.fund_id {lines}
        WHERE g.gift_date NOT BETWEEN DATE '1998-03-10' AND DATE '1998-03-16'""",
    # Names padded and in capitals, or with quotes and a comma; small balances count as a missing amount.
    "adjustments": """
        SELECT c_custkey AS adjustment_id,
               CASE c_custkey % 3 WHEN 0 THEN '  ' || upper(c_name || ' mc-' || c_mktsegment) || '  '
                    WHEN 1 THEN c_name || ' "the ' || lower(c_mktsegment) || '", jr' ELSE c_name || ' mc-' || c_mktsegment END AS donor_name,
               CASE WHEN c_custkey % 50 = 0 THEN 99 ELSE c_nationkey END AS fund_id,
               CASE WHEN c_acctbal < 500 THEN NULL ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS adjustment_amount,
               'review of ' || lower(c_mktsegment) AS reason
        FROM {customer}""",
    "dim_donor_existing": """
        SELECT c_custkey AS donor_id, 'STALE ' || c_name AS donor_name, 'Legacy' AS donor_type,
               CAST(DATE '1990-01-01' AS DATE) AS first_gift_date, 'ZZ' AS state
        FROM {customer} WHERE c_custkey % 2 = 0""",
}
SPARK_LINES = "LATERAL VIEW explode(array(1, 2)) AS line_no"
DUCKDB_LINES = "CROSS JOIN (VALUES (1), (2)) AS v(line_no)"

MISSING_BATCH = ("1998-03-10", "1998-03-16")
# The days that gifts may carry.
BOOKS = ("1995-01-01", "2001-12-31")


# Schemas of the tables read so far, so that a session opens the footers of a table once.
_schemas: dict[tuple[str, str], StructType] = {}


class Testbed:
    """The frames over one folder of test tables, each built once."""

    __test__ = False  # not a test class, whatever its name suggests to pytest

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        known = (self.spark.sparkContext.applicationId, path)
        if known not in _schemas:
            _schemas[known] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[known]).parquet(path)

    def _frame(self, name: str, *tables: str, **frames: DataFrame) -> DataFrame:
        text = TEXTS[name].replace("{lines}", SPARK_LINES)
        return self.spark.sql(text, **{t: self._table(t) for t in tables}, **frames)

    @cached_property
    def funds(self) -> DataFrame:
        return self._frame("dim_fund", "nation", "region")

    @cached_property
    def campaigns(self) -> DataFrame:
        return self._frame("dim_campaign", "region")

    @cached_property
    def accounts(self) -> DataFrame:
        return self._frame("dim_account", "supplier")

    @cached_property
    def subsidiaries(self) -> DataFrame:
        return self._frame("dim_subsidiary", "supplier", "nation")

    @cached_property
    def contacts(self) -> DataFrame:
        return self._frame("contacts", "customer")

    @cached_property
    def raw_gifts(self) -> DataFrame:
        return self._frame("gifts_raw", "orders", "customer")

    @cached_property
    def raw_pledges(self) -> DataFrame:
        return self._frame("pledges_raw", gifts_raw=self.raw_gifts)

    @cached_property
    def raw_ledger(self) -> DataFrame:
        return self._frame("gl_export", gifts_raw=self.raw_gifts, dim_fund=self.funds)

    @cached_property
    def adjustments(self) -> DataFrame:
        return self._frame("adjustments", "customer")

    @cached_property
    def existing_donors(self) -> DataFrame:
        return self._frame("dim_donor_existing", "customer")
