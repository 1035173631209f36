"""Tables in versions: which loads make up each table is one small file per version, written last.

A load of a table is a folder ``<root>/<table>/load=<version>`` that is never changed once written. A version is a file
below ``<root>/_manifest/version=<version>`` that names the loads it adds and drops. It appears in one rename after all
loads are written, so a version is visible whole or not at all: whatever a failed job left is in no version and goes
with the next one. Readers follow the manifest; a version whose loads are still there can be read beside the newest.

One writer at a time. Folders without a manifest are read as they are.
"""

from pyspark.sql import DataFrame, SparkSession

from almsbook.sources.storage import folders, remove

LOG = "table string, load long, added boolean, version long"


def is_versioned(spark: SparkSession, root: str) -> bool:
    return bool(folders(spark, f"{root}/_manifest"))


class Manifest:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self) -> list[tuple[str, int, bool, int]]:
        """All changes, oldest first: a row per load, not per file, so a small list at any size of the tables."""
        if not is_versioned(self.spark, self.root):
            return []
        log = self.spark.read.schema(LOG).parquet(f"{self.root}/_manifest")
        return sorted((tuple(r) for r in log.collect()), key=lambda r: (r[3], r[0], r[1]))

    def version(self) -> int:
        """The newest version; 0 before the first."""
        return max((version for *_, version in self._log()), default=0)

    def loads(self, version: int | None = None) -> dict[str, list[int]]:
        """Loads by table, as of ``version`` or the newest."""
        return self._loads(self._log(), version)

    @staticmethod
    def _loads(log: list[tuple[str, int, bool, int]], version: int | None) -> dict[str, list[int]]:
        kept = {(table, load): added for table, load, added, at in log if version is None or at <= version}
        out: dict[str, list[int]] = {}
        for table, load in sorted(key for key, added in kept.items() if added):
            out.setdefault(table, []).append(load)
        return out

    def path(self, table: str, load: int) -> str:
        return f"{self.root}/{table}/load={load}"

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """The rows of a table with their ``load``, as of ``version`` or the newest."""
        loads = self.loads(version).get(table)
        if not loads:
            raise ValueError(f"no version of {self.root} holds {table}")
        return self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*[self.path(table, load) for load in loads])

    def commit(self, added: dict[str, list[int]], dropped: dict[str, list[int]] | None = None) -> int:
        """Make the written loads the next version; returns its number."""
        version = self.version() + 1
        rows = [(t, load, True) for t, loads in added.items() for load in loads]
        rows += [(t, load, False) for t, loads in (dropped or {}).items() for load in loads]
        log = self.spark.createDataFrame(rows, "table string, load long, added boolean")
        # Only a job that failed here before can have left this folder.
        log.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_manifest/version={version}")
        return version

    def sweep(self, keep: int = 1) -> None:
        """Remove loads that none of the ``keep`` newest versions names."""
        log = self._log()
        newest = max((version for *_, version in log), default=0)
        wanted: dict[str, set[int]] = {}
        for version in range(max(1, newest - keep + 1), newest + 1):
            for table, loads in self._loads(log, version).items():
                wanted.setdefault(table, set()).update(loads)
        for table in folders(self.spark, self.root):
            for name in folders(self.spark, f"{self.root}/{table}"):
                if name.startswith("load=") and int(name[5:]) not in wanted.get(table, ()):
                    remove(self.spark, f"{self.root}/{table}/{name}")
