"""The metrics document: small sections of JSON lines, and their long form."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from almsbook.functions.money import whole
from almsbook.plans import donors, overview, quality, reconciliation


@dataclass
class Books:
    """Frames that the sections share. ``gifts`` holds the gifts of known funds only, ``giving`` their sums."""

    contacts: DataFrame
    raw_gifts: DataFrame
    gifts: DataFrame
    giving: DataFrame
    pledges: DataFrame
    ledger: DataFrame
    funds: DataFrame
    campaigns: DataFrame
    recon: DataFrame
    scores: DataFrame


def sections(books: Books) -> dict[str, DataFrame]:
    current = donors.latest_fiscal_year(books.giving)
    segments = books.scores.select(
        "donor_id",
        donors.segment_of(F.col("first_fy"), F.col("last_fy"), current).alias("segment"),
        F.col("last_fy").alias("last_gift_fy"),
        F.col("lifetime").alias("lifetime_giving"),
    )
    checks = quality.dq_results(
        books.raw_gifts, books.gifts, books.pledges, books.ledger, books.funds, books.recon
    )
    return {
        "executive_kpis": overview.executive_kpis(books.giving, books.campaigns),
        "monthly_trend": overview.monthly_trend(books.giving),
        "top_funds": overview.top_funds(books.giving, books.funds),
        "gift_type_mix": overview.gift_type_mix(books.giving),
        "segment_counts": donors.segment_counts(segments),
        "revenue_at_risk": donors.revenue_at_risk(segments).select(whole(F.col("amount")).alias("amount")),
        "retention_by_fy": donors.retention_by_fy(books.giving),
        "top_donors": donors.top_donors(books.scores, books.contacts, current),
        "fund_segment_matrix": donors.fund_segment_matrix(books.giving, books.funds, current),
        "recon_status_counts": reconciliation.recon_status_counts(books.recon),
        "variance_by_fund": reconciliation.variance_by_fund(books.recon, books.funds),
        "flagged_variances": reconciliation.flagged_variances(books.recon, books.funds),
        "recon_totals": reconciliation.recon_totals(books.recon),
        "dq_results": checks,
    }


# Columns that name an entry of a section; all other columns are its measures.
ENTRY_KEYS = {
    "executive_kpis": [],
    "monthly_trend": ["fy_label", "fiscal_month"],
    "top_funds": ["fund_name"],
    "gift_type_mix": ["gift_type"],
    "segment_counts": ["segment"],
    "revenue_at_risk": [],
    "retention_by_fy": ["fiscal_year"],
    "top_donors": ["donor_id"],
    "fund_segment_matrix": ["fund_name"],
    "recon_status_counts": ["status"],
    "variance_by_fund": ["fund_name"],
    "flagged_variances": ["fund_id", "fiscal_year", "fiscal_month"],
    "recon_totals": [],
    "dq_results": ["check_no"],
}


def write_document(parts: dict[str, DataFrame], path: str) -> None:
    """One folder of JSON lines per section.

    All sections go into one job, so they run side by side and share the exchanges they have in common.
    """
    lines = [
        part.select(
            F.lit(name).alias("section"),
            F.to_json(F.struct(*part.columns), {"ignoreNullFields": "false"}).alias("value"),
        )
        for name, part in parts.items()
    ]
    # Sections are reports of a few rows; the repartition gathers each into one file.
    reduce(DataFrame.unionByName, lines).repartition("section").write.mode("overwrite").partitionBy("section").text(path)


def read_section(spark: SparkSession, path: str, name: str, like: DataFrame) -> DataFrame:
    lines = spark.read.schema("value string, section string").text(path).where(F.col("section") == name)
    return lines.select(F.from_json("value", like.schema).alias("row")).select("row.*")


def _entries(part: DataFrame, order: list[Column], entry: Column) -> Column:
    """The rows of a section as one ordered array, as a scalar subquery."""
    placed = F.array_sort(F.collect_list(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], entry.alias("entry"))))
    return part.agg(F.transform(placed, lambda row: row["entry"]).alias("entries")).scalar()


def _record(**fields: str | Column) -> Column:
    """A struct of renamed columns."""
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in fields.items()])


def _tally(part: DataFrame, key: str) -> Column:
    return part.agg(F.map_from_entries(F.collect_list(F.struct(key, "n"))).alias("tally")).scalar()


def nested_document(parts: dict[str, DataFrame]) -> DataFrame:
    """All sections as one JSON text with a part per report page; one row.

    Page and field names are fixed values: readers of the document look them up.
    """
    kpis = parts["executive_kpis"].select(F.struct("*").alias("kpis")).scalar()
    totals = parts["recon_totals"].select(F.struct("*").alias("totals")).scalar()
    rate = quality.dq_pass_rate(parts["dq_results"]).select(F.struct("*").alias("rate")).scalar()
    by_month = F.array_sort(F.collect_list(F.struct("fiscal_month", "amount")))
    trend = parts["monthly_trend"].groupBy("fy_label").agg(F.transform(by_month, lambda m: m["amount"]).alias("values"))
    matrix, segments = parts["fund_segment_matrix"], donors.SEGMENTS
    cells = F.array(*[F.col(s) for s in segments])

    def of(struct: Column, *names: str) -> list[Column]:
        return [struct[name].alias(name) for name in names]

    meta = F.struct(*of(kpis, "current_fy", "prior_fy"), F.current_timestamp().cast("string").alias("generated_at"))
    overview_page = F.struct(
        *of(kpis, "ytd_total", "prior_total", "yoy_growth", "donor_count", "avg_gift", "total_goal", "goal_attainment_pct"),
        _entries(trend, [F.col("fy_label") == "Current FY"], _record(fy_label="fy_label", values="values")).alias("monthly_trend"),
        _entries(parts["top_funds"], [-F.col("amount"), F.col("fund_name")], _record(fund="fund_name", amount="amount"))
        .alias("top_funds"),
        _entries(parts["gift_type_mix"], [F.col("gift_type")], _record(type="gift_type", amount="amount")).alias("gift_type_mix"),
    )
    best = _record(donor="donor_name", segment="segment", lifetime=whole(F.col("lifetime")), rfm_score="rfm_score")
    retention_page = F.struct(
        _tally(parts["segment_counts"], "segment").alias("segment_counts"),
        parts["revenue_at_risk"].scalar().alias("revenue_at_risk"),
        _entries(parts["retention_by_fy"], [F.col("fiscal_year")], F.struct("fiscal_year", "retention_rate"))
        .alias("retention_by_fy"),
        _entries(parts["top_donors"], [-F.col("rfm_score"), -F.col("lifetime"), F.col("donor_id")], best).alias("top_donors"),
        F.struct(
            _entries(matrix, [F.col("fund_name")], F.col("fund_name")).alias("funds"),
            F.array(*[F.lit(s) for s in segments]).alias("segments"),
            _entries(matrix, [F.col("fund_name")], cells).alias("values"),
        ).alias("matrix"),
    )
    flagged = _record(
        fund="fund_name", fiscal_year="fiscal_year", fiscal_month="fiscal_month", gifts_recorded=whole(F.col("gifts_recorded")),
        gl_posted=whole(F.col("gl_posted")), variance=whole(F.col("variance")), status="status",
    )
    largest = [-F.abs("variance"), F.col("fund_id").isNull(), F.col("fund_id"), F.col("fiscal_year"), F.col("fiscal_month")]
    by_fund = _record(fund="fund_name", variance="variance")
    reconciliation_page = F.struct(
        _tally(parts["recon_status_counts"], "status").alias("status_counts"),
        _entries(parts["variance_by_fund"], [F.col("variance"), F.col("fund_name")], by_fund).alias("by_fund_variance"),
        _entries(parts["flagged_variances"], largest, flagged).alias("flagged"),
        whole(totals["total_gifts"]).alias("total_gifts"),
        whole(totals["total_gl"]).alias("total_gl"),
    )
    check = _record(name="check_name", table="table_name", severity="severity", affected="row_count_affected", passed="passed")
    quality_page = F.struct(
        _entries(parts["dq_results"], [F.col("check_no")], check).alias("checks"),
        *of(rate, "pass_rate", "total_checks", "passed_checks"),
    )
    pages = F.struct(
        meta.alias("meta"),
        overview_page.alias("page1_overview"),
        retention_page.alias("page2_retention"),
        reconciliation_page.alias("page3_reconciliation"),
        quality_page.alias("page4_dataquality"),
    )
    one_row = parts["executive_kpis"].sparkSession.range(1)
    return one_row.select(F.to_json(pages, {"ignoreNullFields": "false"}).alias("value"))


def long_form(name: str, part: DataFrame) -> DataFrame:
    """A section as (section, entry, measure, number, label) rows, so all sections fit one table."""
    keys = ENTRY_KEYS[name]
    entry = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]) if keys else F.lit("")
    numeric = {"int", "bigint", "double"}

    def measure(field: StructField) -> Column:
        kind = field.dataType.simpleString()
        is_number = kind in numeric or kind.startswith("decimal")
        value = F.col(field.name)
        return F.struct(
            F.lit(field.name).alias("measure"),
            (value if is_number else F.lit(None)).cast("double").alias("number"),
            (F.lit(None) if is_number else value).cast("string").alias("label"),
        )

    measures = [measure(f) for f in part.schema if f.name not in keys]
    return part.select(F.lit(name).alias("section"), entry.alias("entry"), F.inline(F.array(*measures)))


def read_document(spark: SparkSession, path: str, parts: dict[str, DataFrame]) -> DataFrame:
    """All sections read back from their files in long form."""
    rows = [long_form(name, read_section(spark, path, name, part)) for name, part in parts.items()]
    return reduce(DataFrame.unionByName, rows)
