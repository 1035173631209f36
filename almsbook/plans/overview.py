"""Headline figures of the current fiscal year."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almsbook.functions.calendar import with_fiscal_period
from almsbook.functions.money import money, percent, whole
from almsbook.plans.donors import latest_fiscal_year


def gift_count(gifts: DataFrame) -> Column:
    """Number of gifts, also where each row sums up several."""
    return F.sum("n_gifts") if "n_gifts" in gifts.columns else F.count("*")


def two_years(gifts: DataFrame) -> DataFrame:
    """The gifts of the newest fiscal year (``_now``) and the one before.

    The newest date comes from that column alone; the filter on its result reaches the scan, and prunes a
    fact that is stored by fiscal year.
    """
    periods = with_fiscal_period(gifts, "gift_date").withColumn("_now", latest_fiscal_year(gifts))
    return periods.where(F.col("fiscal_year") >= F.col("_now") - 1)


def executive_kpis(gifts: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Totals of the newest fiscal year against the year before and the campaign goals; one row.

    Only the two years are read; donors are told apart in the newer one alone.
    """
    now = F.col("_now")
    yearly = two_years(gifts).groupBy("fiscal_year").agg(
        F.sum("gift_amount").alias("total"),
        gift_count(gifts).alias("gifts"),
        F.count_distinct(F.when(F.col("fiscal_year") == now, F.col("donor_id"))).alias("donors"),
    )
    years = yearly.agg(
        F.max("fiscal_year").alias("current_fy"),
        F.map_from_entries(F.collect_list(F.struct("fiscal_year", F.struct("total", "gifts", "donors")))).alias("by_year"),
    )
    current = F.try_element_at("by_year", F.col("current_fy"))
    prior = F.try_element_at("by_year", F.col("current_fy") - 1)
    zero = money(F.lit(0))
    goal = campaigns.agg(money(F.coalesce(F.sum("goal_amount"), F.lit(0)))).scalar()
    picked = years.select(
        "current_fy",
        F.coalesce(money(current["total"]), zero).alias("total"),
        F.coalesce(money(prior["total"]), zero).alias("before"),
        F.coalesce(current["gifts"], F.lit(0)).alias("gifts"),
        F.coalesce(current["donors"], F.lit(0)).alias("donors"),
        goal.alias("goal"),
    )
    return picked.select(
        "current_fy",
        (F.col("current_fy") - 1).alias("prior_fy"),
        whole(F.col("total")).alias("ytd_total"),
        whole(F.col("before")).alias("prior_total"),
        percent(F.col("total") - F.col("before"), F.col("before"), 1).alias("yoy_growth"),
        F.col("donors").alias("donor_count"),
        money(F.round(F.col("total") / F.greatest("gifts", F.lit(1)), 2)).alias("avg_gift"),
        whole(F.col("goal")).alias("total_goal"),
        percent(F.col("total"), F.col("goal"), 1).alias("goal_attainment_pct"),
    )


def monthly_trend(gifts: DataFrame) -> DataFrame:
    """Twelve months of the prior and of the current fiscal year; months without gifts show zero."""
    monthly = two_years(gifts).groupBy("fiscal_year", "fiscal_month").agg(
        F.sum("gift_amount").alias("amount")
    )
    slot = F.struct("fiscal_year", "fiscal_month")
    # The months of all years: a few rows per year of history.
    history = monthly.agg(
        F.max("fiscal_year").alias("current_fy"),
        F.map_from_entries(F.collect_list(F.struct(slot, F.col("amount")))).alias("amounts"),
    ).where(F.col("current_fy").isNotNull())
    years = F.array(
        F.struct(F.lit("Prior FY").alias("fy_label"), (F.col("current_fy") - 1).alias("fiscal_year")),
        F.struct(F.lit("Current FY").alias("fy_label"), F.col("current_fy").alias("fiscal_year")),
    )
    grid = history.select("amounts", F.inline(years)).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("fiscal_month")
    )
    amount = F.coalesce(F.try_element_at("amounts", slot), F.lit(0))
    return grid.select("fy_label", "fiscal_month", whole(amount).alias("amount"))


def top_funds(gifts: DataFrame, funds: DataFrame, top_n: int = 8) -> DataFrame:
    """Funds by gift total over all years; gifts are summed per fund before any name is looked up."""
    per_fund = gifts.groupBy("fund_id").agg(F.sum("gift_amount").alias("amount"))
    return (
        per_fund.join(funds.select("fund_id", "fund_name"), "fund_id")
        .where(F.col("fund_name").isNotNull())
        .groupBy("fund_name")
        .agg(F.sum("amount").alias("exact"))
        .orderBy(F.desc("exact"), "fund_name")
        .limit(top_n)
        .select("fund_name", whole(F.col("exact")).alias("amount"))
    )


def gift_type_mix(gifts: DataFrame) -> DataFrame:
    kinds = gifts.where(F.col("gift_type").isNotNull())
    return kinds.groupBy("gift_type").agg(whole(F.sum("gift_amount")).alias("amount"))
