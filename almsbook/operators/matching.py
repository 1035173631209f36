"""Matching two large tables by key, with hot keys on either side."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almsbook.sources.storage import materialize


def has_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Per key of ``left``: how many rows it has there and whether ``right`` knows it.

    Both sides go into one grouped aggregate of the key alone, so a frequent key on either side is
    reduced to one row per task before anything is shuffled. NULL keys never match.
    """
    sides = left.select(F.col(left_key).alias("key"), F.lit(1).alias("n"), F.lit(False).alias("known")).unionByName(
        right.select(F.col(right_key).alias("key"), F.lit(0).alias("n"), F.lit(True).alias("known"))
    )
    matched: Column = F.col("key").isNotNull() & F.max("known")
    return sides.groupBy("key").agg(F.sum("n").alias("n"), matched.alias("matched")).where("n > 0")


def without_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Whole rows of ``left`` whose key ``right`` does not know, rows without a key included.

    The unknown keys are settled first, on keys alone, and written. Knowing their size, Spark
    broadcasts them when they are few, and then the rows of ``left`` never shuffle. When they are
    many, both join inputs are plain scans, which the adaptive skew join can split at a hot key.
    """
    verdict = has_match(left, right, left_key, right_key)
    unknown = verdict.where(F.col("key").isNotNull() & ~F.col("matched")).select(F.col("key").alias(left_key))
    lone = left.join(materialize(unknown, "unknown-keys"), left_key, "left_semi").select(left.columns)
    return lone.unionByName(left.where(F.col(left_key).isNull()))


def survivor_map(df: DataFrame, group: Column, key: str, survivor: str) -> DataFrame:
    """Each ``key`` with the smallest one of its group.

    Only groups of several rows take part in the join, written first as in ``without_match``; a row
    alone in its group survives itself. Rows without a group name form one group.
    """
    # The prefix keeps the group without a name apart from one with an empty name.
    token = F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("_group")
    grouped = df.select(F.col(key), token)
    shared = grouped.groupBy("_group").agg(F.min(key).alias(survivor), F.count("*").alias("_n")).where("_n > 1")
    joined = grouped.join(materialize(shared.drop("_n"), "shared-groups"), "_group", "left")
    return joined.select(key, F.coalesce(survivor, key).alias(survivor))
