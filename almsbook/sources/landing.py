"""Raw layer: untouched copies of the extracts with a load time."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almsbook.schemas import RAW
from almsbook.sources.files import CORRUPT, contract, scan_csv

LOADED_AT = "_loaded_at"


def land(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a raw copy as Parquet. Readers name their columns, so the load time never leaks on."""
    df.withColumn(LOADED_AT, F.current_timestamp()).write.mode(mode).parquet(path)


def land_csv(spark: SparkSession, table: str, source: str, raw_dir: str) -> None:
    land(scan_csv(spark, source, RAW[table]), f"{raw_dir}/{table}")


def misfits(spark: SparkSession, raw_dir: str, tables: list[str]) -> DataFrame:
    """``(table_name, n)``: landed rows whose text did not fit the declared types, a row per table."""
    counted = []
    for table in tables:
        stored = spark.read.parquet(f"{raw_dir}/{table}")
        bad = F.count(CORRUPT) if CORRUPT in stored.columns else F.lit(0).cast("bigint")
        counted.append(stored.agg(bad.alias("n")).select(F.lit(table).alias("table_name"), "n"))
    return reduce(DataFrame.unionByName, counted)


def read_raw(spark: SparkSession, table: str, raw_dir: str) -> DataFrame:
    return contract(spark.read.parquet(f"{raw_dir}/{table}"), RAW[table])
