"""A table that takes merges as change sets and folds them in later.

The base lies in buckets by the hash of its key. A merge writes the rows that arrive, and only those, as a change set in the
same buckets; what it means is settled on reading: the first row of a key gives its columns, the newest one those that a
merge updates, as :func:`almsbook.operators.merging.upsert` has it. Buckets without changes are read as they are, the others
are grouped by key. Compaction rewrites the buckets that have changes and no others. All of it goes by versions of a
:class:`~almsbook.sources.manifest.Manifest`, so a merge or a compaction is visible whole or not at all.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from almsbook.sources.manifest import Manifest
from almsbook.sources.storage import folders

BASE, CHANGES, BUCKET = "base", "changes", "bucket"


class ChangeSets:
    """A keyed table below ``root``; merges overwrite the ``update`` columns of known keys and insert unknown ones."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str, update: list[str], buckets: int = 64) -> None:
        self.spark, self.root, self.schema, self.key, self.update, self.buckets = spark, root, schema, key, update, buckets
        self.manifest = Manifest(spark, root)

    def _write(self, table: str, load: int, rows: DataFrame) -> list[int]:
        """Write a load in buckets; returns the buckets it has rows in."""
        path = self.manifest.path(table, load)
        placed = rows.select(self.schema.names).withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))
        placed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        return sorted(int(name.split("=")[1]) for name in folders(self.spark, path) if name.startswith(f"{BUCKET}="))

    def _once(self, rows: DataFrame) -> DataFrame:
        """``rows``, or an error if a key comes twice."""
        payload = F.struct(*[F.col(c).cast(f.dataType).alias(c) for c, f in zip(self.schema.names, self.schema, strict=True)])
        grouped = rows.groupBy(self.key).agg(F.count("*").alias("_times"), F.min(payload).alias("_row"))
        twice = F.raise_error(F.concat(F.lit("several rows to merge for key "), F.col(self.key).cast("string")))
        return grouped.where(F.when(F.col("_times") > 1, twice.cast("boolean")).otherwise(True)).select("_row.*")

    def create(self, rows: DataFrame) -> int:
        """The first base."""
        if self.manifest.version():
            raise ValueError(f"{self.root} holds a table already")
        self.manifest.sweep()
        held = self._write(BASE, 1, self._once(rows))
        return self.manifest.commit({BASE: [1]} | {f"{BUCKET}={b}": [1] for b in held})

    def merge(self, batch: DataFrame) -> int:
        """Take over ``batch``: its rows are written, the table is not read."""
        load = self.manifest.version() + 1
        self._write(CHANGES, load, self._once(batch))
        return self.manifest.commit({CHANGES: [load]})

    def _files(self, table: str, paths: list[str]) -> DataFrame:
        """Rows of some bucket folders of a table, with their load."""
        stored = StructType([*self.schema.fields, StructField("load", LongType()), StructField(BUCKET, IntegerType())])
        if not paths:
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).option("basePath", f"{self.root}/{table}").parquet(*paths)

    def _parts(self, version: int | None) -> tuple[list[str], list[str], list[str], list[int]]:
        """Folders of untouched and of touched base buckets, folders of changes, and the touched buckets: a few per bucket at most."""
        loads = self.manifest.loads(version)
        base = {int(name.split("=")[1]): own[-1] for name, own in loads.items() if name.startswith(f"{BUCKET}=")}
        changes = [
            (int(name.split("=")[1]), f"{self.manifest.path(CHANGES, load)}/{name}")
            for load in loads.get(CHANGES, []) for name in folders(self.spark, self.manifest.path(CHANGES, load)) if name.startswith(f"{BUCKET}=")
        ]
        touched = sorted({bucket for bucket, _ in changes})
        paths = {bucket: f"{self.manifest.path(BASE, load)}/{BUCKET}={bucket}" for bucket, load in sorted(base.items())}
        return [p for b, p in paths.items() if b not in touched], [p for b, p in paths.items() if b in touched], [p for _, p in changes], touched

    def _merged(self, base: list[str], changes: list[str]) -> DataFrame:
        """One row per key of some buckets: the oldest row with the update columns of the newest."""
        rows = self._files(BASE, base).withColumn("load", F.lit(0).cast("long")).unionByName(self._files(CHANGES, changes))
        others = [c for c in self.schema.names if c != self.key]
        settled = rows.groupBy(self.key).agg(
            F.min_by(F.struct(*others), "load").alias("_first"), F.max_by(F.struct(*others), "load").alias("_newest")
        )
        columns = [F.col(self.key) if c == self.key else F.col(f"{'_newest' if c in self.update else '_first'}.{c}").alias(c) for c in self.schema.names]
        return settled.select(*columns)

    def read(self, version: int | None = None) -> DataFrame:
        """The merged table as of ``version`` or the newest; only buckets with changes are shuffled."""
        untouched, base, changes, _ = self._parts(version)
        plain = self._files(BASE, untouched).select(self.schema.names)
        return plain.unionByName(self._merged(base, changes)) if changes else plain

    def compact(self) -> int:
        """Fold the changes into the buckets they touch; returns the version, the old one if there is nothing to fold."""
        _, base, changes, touched = self._parts(None)
        if not changes:
            return self.manifest.version()
        loads, load = self.manifest.loads(), self.manifest.version() + 1
        held = self._write(BASE, load, self._merged(base, changes))
        moved = {f"{BUCKET}={b}": [load] for b in held}
        kept = {own[-1] for name, own in loads.items() if name.startswith(f"{BUCKET}=") and name not in moved}
        dropped = {name: loads[name] for name in moved if name in loads} | {CHANGES: loads[CHANGES], BASE: [x for x in loads[BASE] if x not in kept]}
        version = self.manifest.commit({BASE: [load]} | moved, dropped)
        self.manifest.sweep(keep=2)
        return version
