"""Dedupe, upsert and insert-if-absent as full rewrites of a table."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almsbook.sources.storage import materialize


def first_per_group(df: DataFrame, group: list[Column], order: list[str]) -> DataFrame:
    """One whole row per group: the least by ``order`` (NULLs last), ties broken by the other columns.

    A minimum over a struct combines map-side, so one huge group never meets in one task.
    """
    lead = [part for c in order for part in (F.col(c).isNull().alias(f"_null_{c}"), F.col(c))]
    row = F.struct(*lead, *[F.col(c) for c in df.columns if c not in order])
    groups = {f"_group_{i}": g for i, g in enumerate(group)}
    best = (
        df.select(*[g.alias(name) for name, g in groups.items()], row.alias("_row"))
        .groupBy(*groups)
        .agg(F.min("_row").alias("_row"))
    )
    return best.select(*[F.col(f"_row.{c}").alias(c) for c in df.columns])


def absent(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """One row of ``batch`` for each key that ``target`` lacks.

    Keys alone are shuffled: one grouped sum over both sides tells which keys of the batch are known or
    come more than once. These are written, so Spark knows their size and broadcasts them if they are
    few. All other rows pass without being moved, and only those of repeated keys go through the choice
    of the least row. A key without a value counts as one key, as in a grouping.
    """
    rows = batch.select(target.columns)
    names = {k: f"_key_{i}" for i, k in enumerate(keys)}
    sides = rows.select(*[F.col(k).alias(n) for k, n in names.items()], F.lit(1).alias("_n"), F.lit(False).alias("_known"))
    sides = sides.unionByName(
        target.select(*[F.col(k).alias(n) for k, n in names.items()], F.lit(0).alias("_n"), F.lit(True).alias("_known"))
    )
    settled = sides.groupBy(*names.values()).agg(F.sum("_n").alias("_n"), F.max("_known").alias("_known"))
    special = materialize(settled.where("_n > 1 OR (_known AND _n > 0)"), "special-keys")

    def same(other: DataFrame) -> Column:
        return reduce(Column.__and__, [rows[k].eqNullSafe(other[n]) for k, n in names.items()])

    plain = rows.join(special, same(special), "left_anti")
    twice = special.where("_n > 1 AND NOT _known")
    if not twice.take(1):
        return plain
    repeated = rows.join(twice, same(twice), "left_semi")
    return plain.unionByName(first_per_group(repeated, [F.col(k) for k in keys], keys))


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``target``, its rows untouched, plus one row for each key of ``batch`` that it lacks."""
    return target.unionByName(absent(target, batch, keys))


def upsert(target: DataFrame, batch: DataFrame, key: str, update: list[str]) -> DataFrame:
    """Insert the rows of ``batch`` with a new key; for known keys overwrite only ``update`` columns.

    One grouped pass over the tagged union, no join. A key that either side holds twice is an error,
    as it is for a relational merge.
    """
    payload = [c for c in target.columns if c != key]
    row = F.struct(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in payload])
    row_type = target.select(row.alias("row")).schema["row"].dataType
    missing = F.lit(None).cast(row_type)
    both = (
        target.select(key, row.alias("_old"), missing.alias("_new"))
        .unionByName(batch.select(key, missing.alias("_old"), row.alias("_new")))
        .groupBy(key)
        .agg(
            F.max("_old").alias("_old"),
            F.max("_new").alias("_new"),
            F.greatest(F.count("_old"), F.count("_new")).alias("_times"),
        )
    )
    twice = F.raise_error(F.concat(F.lit("several rows to merge for key "), F.col(key).cast("string")))
    # As a filter the check survives whatever columns the caller goes on to select.
    checked = both.where(F.when(F.col("_times") > 1, twice.cast("boolean")).otherwise(True))

    def merged(name: str) -> Column:
        keep_old = F.col("_new").isNull() if name in update else F.col("_old").isNotNull()
        return F.when(keep_old, F.col(f"_old.{name}")).otherwise(F.col(f"_new.{name}")).alias(name)

    return checked.select(key, *[merged(c) for c in payload]).select(target.columns)
