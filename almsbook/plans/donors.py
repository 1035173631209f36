"""Donor segments, retention and the scoring of donors."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almsbook.functions.calendar import fiscal_year, with_fiscal_period
from almsbook.functions.money import MONEY, money, percent, whole
from almsbook.operators.ranking import bin_of_value, bins_by_position, quantile_edges
from almsbook.sources.storage import materialize

# Segment names in report order.
SEGMENTS = ["Active", "Lapsed", "Lapsing", "New"]


def newest_fiscal_year(gifts: DataFrame) -> DataFrame:
    """The fiscal year of the newest gift as a one-row frame."""
    if "fiscal_year" in gifts.columns:
        return gifts.agg(F.max("fiscal_year").alias("fiscal_year"))
    return gifts.agg(F.max("gift_date").alias("day")).select(fiscal_year(F.col("day")).alias("fiscal_year"))


def latest_fiscal_year(gifts: DataFrame) -> Column:
    """The fiscal year of the newest gift, as a scalar subquery over the date column."""
    return newest_fiscal_year(gifts).scalar()


def by_survivor(gifts: DataFrame, survivors: DataFrame) -> DataFrame:
    """The gifts under the id that survives the donor dedupe, for figures per person instead of per record."""
    moved = survivors.where(F.col("survivor_id") != F.col("donor_id"))
    donor = F.coalesce("survivor_id", "donor_id").alias("donor_id")
    kept = [donor if c == "donor_id" else F.col(c) for c in gifts.columns]
    return gifts.join(moved, "donor_id", "left").select(*kept)


def donor_fy(gifts: DataFrame) -> DataFrame:
    periods = with_fiscal_period(gifts, "gift_date")
    return periods.groupBy("donor_id", "fiscal_year").agg(money(F.sum("gift_amount")).alias("fy_total"))


def donor_summary(gifts: DataFrame) -> DataFrame:
    """One row per donor; frequency counts the fiscal years with a gift.

    One shuffle: the set of years has an entry per fiscal year at most, however many gifts there are.
    """
    return with_fiscal_period(gifts, "gift_date").groupBy("donor_id").agg(
        F.max("fiscal_year").alias("last_fy"),
        F.min("fiscal_year").alias("first_fy"),
        F.size(F.collect_set("fiscal_year")).cast("bigint").alias("frequency"),
        money(F.sum("gift_amount")).alias("lifetime"),
    )


def _placed(rows: DataFrame, name: str, current_fy: int | Column | None) -> tuple[DataFrame, Column]:
    """``rows``, which have a ``last_fy``, and the year to judge them by.

    Without a given year it is the newest one in ``rows``. They are written then, so that both come from
    one pass over the gifts.
    """
    if current_fy is None:
        rows = materialize(rows, name)
        return rows, rows.agg(F.max("last_fy")).scalar()
    return rows, current_fy if isinstance(current_fy, Column) else F.lit(current_fy)


def segment_of(first_fy: Column, last_fy: Column, current_fy: Column) -> Column:
    """New, active, lapsing, else lapsed — so a donor seen only after ``current_fy`` is lapsed."""
    return (
        F.when(first_fy == current_fy, "New")
        .when(last_fy == current_fy, "Active")
        .when(last_fy == current_fy - 1, "Lapsing")
        .otherwise("Lapsed")
    )


def donor_segments(gifts: DataFrame, current_fy: int | Column | None = None) -> DataFrame:
    summary, year = _placed(donor_summary(gifts), "donor-summary", current_fy)
    segment = segment_of(F.col("first_fy"), F.col("last_fy"), year)
    return summary.select(
        "donor_id",
        segment.alias("segment"),
        F.col("last_fy").alias("last_gift_fy"),
        F.col("lifetime").alias("lifetime_giving"),
    )


def register_segment_function(gifts: DataFrame, name: str = "donor_segments_of") -> None:
    """Offer the segmentation to SQL as a table function of the fiscal year."""
    register_segments_of_summary(donor_summary(gifts), gifts.schema["donor_id"].dataType.simpleString(), name)


def register_segments_of_summary(summary: DataFrame, id_type: str, name: str = "donor_segments_of") -> None:
    spark = summary.sparkSession
    summary.createOrReplaceTempView(f"{name}_donors")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(current_fy INT)
        RETURNS TABLE (donor_id {id_type}, segment STRING,
                       last_gift_fy INT, lifetime_giving {MONEY})
        RETURN SELECT donor_id,
                      CASE WHEN first_fy = current_fy THEN 'New'
                           WHEN last_fy = current_fy THEN 'Active'
                           WHEN last_fy = current_fy - 1 THEN 'Lapsing'
                           ELSE 'Lapsed' END,
                      last_fy, lifetime
               FROM {name}_donors
    """)


def segmented(spark: SparkSession, current_fy: int | DataFrame, name: str = "donor_segments_of") -> DataFrame:
    """Call the table function; the year may also be a one-row, one-column frame."""
    if isinstance(current_fy, DataFrame):
        return spark.sql(f"SELECT * FROM {name}((SELECT * FROM {{year}}))", year=current_fy)
    return spark.sql(f"SELECT * FROM {name}({int(current_fy)})")


def segment_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count("*").alias("n"))


def revenue_at_risk(segments: DataFrame) -> DataFrame:
    at_risk = F.sum(F.when(F.col("segment") == "Lapsing", F.col("lifetime_giving")))
    return segments.agg(money(F.coalesce(at_risk, F.lit(0))).alias("amount"))


def retention_by_fy(gifts: DataFrame) -> DataFrame:
    """Share of the donors of one giving year who gave again in the next one.

    Donors meet their own previous year by ``lag`` over distinct (donor, year) rows, of which a donor
    has one per fiscal year at most. What follows works on counts per pair of years.
    """
    periods = with_fiscal_period(gifts, "gift_date").select("donor_id", "fiscal_year").distinct()
    own_years = Window.partitionBy("donor_id").orderBy("fiscal_year")
    moves = (
        periods.withColumn("from_fy", F.lag("fiscal_year").over(own_years))
        .groupBy("fiscal_year", "from_fy")
        .agg(F.count("*").alias("n"))
    )
    yearly = moves.groupBy("fiscal_year").agg(
        F.sum("n").alias("donors"), F.collect_list(F.struct("from_fy", "n")).alias("arrivals")
    )
    # One row per fiscal year from here on.
    by_year = Window.orderBy("fiscal_year")
    paired = yearly.withColumns(
        {"prev_fy": F.lag("fiscal_year").over(by_year), "prev_donors": F.lag("donors").over(by_year)}
    ).where(F.col("prev_fy").isNotNull())
    stayed = F.filter("arrivals", lambda move: move["from_fy"] == F.col("prev_fy"))
    returning = F.coalesce(F.try_element_at(stayed, F.lit(1))["n"], F.lit(0))
    return paired.select(
        "fiscal_year",
        percent(returning, F.greatest("prev_donors", F.lit(1)), 1).alias("retention_rate"),
    )


def fund_segment_matrix(gifts: DataFrame, funds: DataFrame, current_fy: int | Column | None = None) -> DataFrame:
    """Giving per fund name and donor segment, one column per segment.

    Gifts shrink to one row per donor and fund before the donor's segment is worked out over them,
    so neither a very active donor nor a popular fund gathers gift rows in one task.
    """
    giving = (
        with_fiscal_period(gifts, "gift_date")
        .groupBy("donor_id", "fund_id")
        .agg(
            F.sum("gift_amount").alias("amount"),
            F.min("fiscal_year").alias("first_fy"),
            F.max("fiscal_year").alias("last_fy"),
        )
    )
    giving, year = _placed(giving, "donor-funds", current_fy)
    donor = Window.partitionBy("donor_id")
    segment = segment_of(F.min("first_fy").over(donor), F.max("last_fy").over(donor), year)
    by_fund = giving.select("fund_id", "amount", segment.alias("segment")).groupBy("fund_id").agg(
        *[F.sum(F.when(F.col("segment") == name, F.col("amount"))).alias(name) for name in SEGMENTS]
    )
    return (
        by_fund.join(funds.select("fund_id", "fund_name"), "fund_id")
        .where(F.col("fund_name").isNotNull())
        .groupBy("fund_name")
        .agg(*[whole(F.coalesce(F.sum(name), F.lit(0))).alias(name) for name in SEGMENTS])
    )


def rfm_scores(summary: DataFrame, bins: int = 5) -> DataFrame:
    """Recency, frequency and monetary bins of each donor and their mean.

    Recency is binned by value, the other two by position, where equal values rank by donor id. Donors are
    never sorted: the few at the cut points are searched, and every donor is held against them.
    """
    summary = materialize(summary, "donors-to-score")
    total = summary.count()
    # The edges get a column of their own: a higher-order function takes no subquery.
    edged = summary.withColumn("_edges", quantile_edges(summary, "last_fy", bins))
    binned = edged.select(
        "*",
        bin_of_value("last_fy", F.col("_edges")).alias("recency_rank"),
        bins_by_position(summary, ["frequency", "donor_id"], bins, total).alias("freq_rank"),
        bins_by_position(summary, ["lifetime", "donor_id"], bins, total).alias("monetary_rank"),
    )
    points = (F.col("recency_rank") + F.col("freq_rank") + F.col("monetary_rank")).cast("decimal(9,0)")
    return binned.select(
        *summary.columns, "recency_rank", "freq_rank", "monetary_rank",
        F.round(points / 3, 2).cast("double").alias("rfm_score"),
    )


def top_donors(scores: DataFrame, contacts: DataFrame, current_fy: Column | int, top_n: int = 10) -> DataFrame:
    """Best scores first, then lifetime giving; only the chosen rows, settled once, look up a name."""
    year = current_fy if isinstance(current_fy, Column) else F.lit(current_fy)
    best = materialize(scores.orderBy(F.desc("rfm_score"), F.desc("lifetime"), "donor_id").limit(top_n), "top-donors")
    names = contacts.select("donor_id", "donor_name").join(F.broadcast(best.select("donor_id")), "donor_id", "left_semi")
    return best.join(names, "donor_id", "left").select(
        "donor_id", "donor_name",
        segment_of(F.col("first_fy"), F.col("last_fy"), year).alias("segment"),
        "lifetime", "rfm_score",
    )


def giving(gifts: DataFrame) -> DataFrame:
    """The gifts summed per donor, fund, type and fiscal month, with their number: what every report on gifts can start from."""
    return with_fiscal_period(gifts, "gift_date").groupBy("donor_id", "fund_id", "gift_type", "fiscal_year", "fiscal_month").agg(
        money(F.sum("gift_amount")).alias("gift_amount"), F.count("*").alias("n_gifts")
    )
