"""Graded data-quality checks and hard expectations as rows."""

from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within_tolerance(affected: Column, total: Column, tolerance: Decimal) -> Column:
    """affected / total < tolerance without dividing; NULL where there is nothing to grade."""
    return F.when(total > 0, affected < F.lit(tolerance) * total)


def check_row(number: int, name: str, table: str, severity: str, affected: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(number).alias("check_no"),
        F.lit(name).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(severity).alias("severity"),
        F.coalesce(affected, F.lit(0)).cast("bigint").alias("row_count_affected"),
        passed.alias("passed"),
    )


def expectation_row(name: str, observed: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        F.coalesce(observed, F.lit(0)).cast("bigint").alias("observed"),
        F.coalesce(passed, F.lit(True)).alias("passed"),
    )


def as_rows(facts: DataFrame, *rows: Column) -> DataFrame:
    """One output row per struct, computed from the one-row frame ``facts``."""
    return facts.select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class Unique:
    """No two rows of a table have the same values in ``columns``; missing values are values."""

    table: str
    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{self.table}: {', '.join(self.columns)} is unique"


@dataclass(frozen=True)
class Known:
    """Every value of ``column`` is among the ``key`` values of ``other``; a missing value refers to nothing."""

    table: str
    column: str
    other: str
    key: str

    @property
    def name(self) -> str:
        return f"{self.table}: {self.column} is known to {self.other}"


def rule_counts(tables: dict[str, DataFrame], rules: list[Unique | Known]) -> DataFrame:
    """One row with ``bad_0``, ``bad_1``, …: repeated values or rows with unknown references per rule.

    Each table is read once, whatever the number of its rules: a row becomes one (rule, value) pair for each, and the keys that
    references are held against are pairs as well. All pairs of all tables meet in one grouped sum, which combines a hot value
    before the shuffle, and a second sum makes the counts. So there are two exchanges beside those of the tables themselves.
    """

    def pairs(name: str, frame: DataFrame) -> DataFrame | None:
        found = []
        for i, rule in enumerate(rules):
            if rule.table == name:
                columns = rule.columns if isinstance(rule, Unique) else (rule.column,)
                found.append(_pair(i, columns, 1, False, isinstance(rule, Known)))
            if isinstance(rule, Known) and rule.other == name:
                found.append(_pair(i, (rule.key,), 0, True, True))
        return frame.select(F.inline(F.array(*found))).where("rule IS NOT NULL") if found else None

    stacked = reduce(DataFrame.unionByName, [p for name, frame in tables.items() if (p := pairs(name, frame)) is not None])
    settled = stacked.groupBy("rule", "value").agg(F.sum("n").alias("n"), F.max("known").alias("known"))
    counts = []
    for i, rule in enumerate(rules):
        own = F.col("rule") == i
        count = F.count_if(own & (F.col("n") > 1)) if isinstance(rule, Unique) else F.sum(F.when(own & ~F.col("known"), F.col("n")))
        counts.append(F.coalesce(count, F.lit(0)).alias(f"bad_{i}"))
    return settled.agg(*counts)


def _pair(rule: int, columns: tuple[str, ...], n: int, known: bool, skip_missing: bool) -> Column:
    value = F.array(*[F.col(c).cast("string") for c in columns])
    pair = F.struct(F.lit(rule).alias("rule"), value.alias("value"), F.lit(n).alias("n"), F.lit(known).alias("known"))
    return F.when(F.col(columns[0]).isNotNull(), pair) if skip_missing else pair


def rule_rows(tables: dict[str, DataFrame], rules: list[Unique | Known]) -> DataFrame:
    """An expectation per rule, all of them also over empty tables."""
    bad = [F.col(f"bad_{i}") for i in range(len(rules))]
    return as_rows(rule_counts(tables, rules), *[expectation_row(rule.name, n, n == 0) for rule, n in zip(rules, bad, strict=True)])
