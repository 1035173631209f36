"""Exact global ranks, rows at given ranks and quantile labels without a one-task window."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from almsbook.sources.storage import materialize


def global_rank(df: DataFrame, order: list[str], rank: str, total: str) -> DataFrame:
    """Add each row's 1-based position in the total order ``order`` and the number of rows.

    Spark range-partitions and sorts the rows; a row's id then tells its partition (upper bits) and
    its place therein (lower 33 bits). The placed rows are written once, so the counts per partition
    and the rows they are added to come from the same placement. ``order`` has to end in a unique
    column, which also lets a frequent leading value spread over many partitions.
    """
    placed = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_slot", F.monotonically_increasing_id()),
        f"rank-{rank}",
    )
    part = F.shiftright("_slot", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    # One row per range partition, so both windows below see a few thousand rows at most.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy()).alias(total),
    )
    place = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(rank, F.col("_before") + place + 1)
        .drop("_part", "_slot", "_before")
    )


def equal_bins_of_rank(rank: str, total: str, bins: int) -> Column:
    """0-based bin of a rank when 1..total is cut at its linearly interpolated quantiles.

    Bins are right-closed, so this is not ``ntile``: the bin is the number of inner edges
    1 + k * (total - 1) / bins lying strictly below the rank.
    """
    edge_steps = F.expr(f"({bins} * ({rank} - 1) + {total} - 2) div ({total} - 1)")
    return F.when(F.col(total) == 1, 0).otherwise(F.greatest(F.lit(0), edge_steps - 1)).cast("int")


# Rows that a bracket may hold when its rows are fetched, and about how many pivots split one that holds more.
FETCHED = 20_000
PIVOTS = 24


def _in_order(row: Row) -> tuple:
    """Spark's order of numbers, text and dates, missing values first."""
    return tuple((v is not None, v) for v in row)


def rows_at_ranks(df: DataFrame, order: list[str], ranks: list[int], total: int | None = None) -> list[Row]:
    """The values of ``order`` of the rows at the 1-based ``ranks``, ascending, without sorting ``df``; missing values come first.

    Each rank lies in a bracket of rows, at first all of them. A round takes a few rows of every bracket as pivots (by a hash, about
    ``PIVOTS``, whatever their number), counts the rows between them in one pass, and keeps for every rank the stretch that
    holds it. So a bracket shrinks by about that factor a round, and once it holds ``FETCHED`` rows at most, these are
    fetched. What reaches the driver is bounded by the number of ranks. ``order`` has to tell rows apart, as with a global
    rank; more than ``FETCHED`` rows that are equal in all of it are an error.

    ``df`` is read once or twice a round: give a written table.
    """
    ranks = sorted(set(ranks))
    own = df.select(F.struct(*order).alias("row"))
    kind = own.schema["row"].dataType
    # Brackets are open below and closed above; None is no bound. Before: the number of rows up to the lower bound.
    total = own.count() if total is None else total
    brackets = {rank: (None, None, 0, total) for rank in ranks}
    if any(not 1 <= rank <= held for rank, (_, _, _, held) in brackets.items()):
        raise ValueError("a rank beyond the rows")

    def bound(row: Row) -> Column:
        return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in kind])

    def inside(lower: Row | None, upper: Row | None) -> Column:
        parts = [F.col("row") > bound(lower)] if lower is not None else []
        parts += [F.col("row") <= bound(upper)] if upper is not None else []
        return reduce(Column.__and__, parts, F.lit(True))

    found: dict[int, Row] = {}
    seed = 0
    while brackets:
        if seed > 60:
            raise ValueError(f"too many rows are equal in {', '.join(order)}")
        stretches = {}
        for lower, upper, _, held in brackets.values():
            stretches[lower, upper] = held
        numbered = list(stretches.items())
        which = reduce(lambda rest, i: F.when(inside(*numbered[i][0]), i).otherwise(rest), range(len(numbered)), F.lit(None).cast("int"))
        candidates = own.withColumn("bracket", which).where("bracket IS NOT NULL")
        # Of a small bracket all rows are wanted, of a large one about as many as pivots; equal rows count once.
        sizes = F.array(*[F.lit(1 if held <= FETCHED else -(-held // PIVOTS)).cast("bigint") for _, held in numbered])
        chosen = F.pmod(F.xxhash64(*[F.col("row")[c] for c in order], F.lit(seed)), F.get(sizes, F.col("bracket"))) == 0
        taken = candidates.where(chosen).groupBy("bracket", "row").agg(F.count("*").alias("n")).collect()
        pivots = {i: sorted(((r["row"], r["n"]) for r in taken if r["bracket"] == i), key=lambda p: _in_order(p[0])) for i in range(len(numbered))}
        small = {key for key, held in stretches.items() if held <= FETCHED}
        counts = {}
        if split := [p for i, (key, _) in enumerate(numbered) if key not in small for p, _ in pivots[i]]:
            # Pivots of all brackets are in order, since brackets do not overlap.
            below = F.aggregate(F.array(*[bound(p) for p in split]), F.lit(0), lambda n, p: n + F.when(p < F.col("row"), 1).otherwise(0))
            large = reduce(Column.__or__, [F.col("bracket") == i for i, (key, _) in enumerate(numbered) if key not in small])
            counted = candidates.where(large).groupBy("bracket", below.alias("place")).agg(F.count("*").alias("n"))
            counts = {(r["bracket"], r["place"]): r["n"] for r in counted.collect()}
        index = {key: i for i, (key, _) in enumerate(numbered)}
        offsets, at = {}, 0
        for i, (key, _) in enumerate(numbered):
            offsets[i] = at
            at += len(pivots[i]) if key not in small else 0
        following = {}
        for rank, (lower, upper, before, held) in brackets.items():
            i = index[lower, upper]
            if (lower, upper) in small:
                for row, n in pivots[i]:
                    before += n
                    if before >= rank:
                        found[rank] = row
                        break
                continue
            edges = [lower, *[p for p, _ in pivots[i]], upper]
            for k in range(len(edges) - 1):
                n = counts.get((i, offsets[i] + k), 0)
                if before + n >= rank:
                    following[rank] = (edges[k], edges[k + 1], before, n)
                    break
                before += n
        brackets, seed = following, seed + 1
    return [found[rank] for rank in ranks]


def bins_by_position(df: DataFrame, order: list[str], bins: int, total: int | None = None) -> Column:
    """0-based bin of every row's position in the total order ``order``, cut at the interpolated quantiles of the positions.

    A bin is the number of inner edges 1 + k * (total - 1) / bins that lie strictly below the position; so it is enough
    to know the last row up to each edge, and rows need no position of their own.
    """
    total = df.count() if total is None else total
    if total < 2:
        return F.lit(0)
    last = [1 + k * (total - 1) // bins for k in range(1, bins)]
    at = dict(zip(sorted(set(last)), rows_at_ranks(df, order, last, total), strict=True))
    row = F.struct(*order)
    edges = [F.struct(*[F.lit(at[rank][c]).cast(df.schema[c].dataType).alias(c) for c in order]) for rank in last]
    return reduce(Column.__add__, [F.when(row > edge, 1).otherwise(0) for edge in edges], F.lit(0)).cast("int")


def quantile_edges(df: DataFrame, value: str, max_bins: int) -> Column:
    """Distinct interpolated quantile edges of ``value`` as one array, as a scalar subquery.

    The number of bins is the number of distinct values, at most ``max_bins``. The percentiles read
    a histogram, so the state is one entry per distinct value and not per row.
    """
    histogram = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_n"))
    by_bins = [
        F.percentile(value, [step / bins for step in range(bins + 1)], F.col("_n"))
        for bins in range(1, max_bins + 1)
    ]
    chosen = F.try_element_at(F.array(*by_bins), F.least(F.lit(max_bins), F.count("*")).cast("int"))
    return histogram.agg(F.array_distinct(chosen).alias("edges")).scalar()


def bin_of_value(value: str, edges: Column) -> Column:
    """0-based right-closed bin of ``value`` between ``edges``; the lowest edge belongs to bin 0."""
    below = F.size(F.filter(edges, lambda edge: edge < F.col(value)))
    return F.greatest(F.lit(0), below - 1).cast("int")
