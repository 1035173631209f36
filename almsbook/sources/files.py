"""CSV extracts in and CSV results out."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from almsbook.sources.csv_ranges import CsvRanges

CORRUPT = "_corrupt_record"


# A quote within a quoted value is doubled, as spreadsheets and databases write it.
DIALECT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


# How both readers below take the text of a value.
VALUES = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "dateFormat": "yyyy-MM-dd"}


def scan_csv(spark: SparkSession, path: str, schema: StructType, multi_line: bool = True) -> DataFrame:
    """Scan with a declared schema, columns found by the names in the header.

    The order of the columns is free, unknown ones are left out, a missing one is an error, and so is a
    file with another header than the first. Text that does not fit goes to ``_corrupt_record``. Padding
    stays in the values: trimming names is a decision of the cleaning step. Lines end with a line feed, or
    a return and a line feed. Values may hold line breaks, and large files are still read in parallel, see
    :mod:`almsbook.sources.csv_ranges`; without ``multi_line`` they may not, which saves a pass over the
    files. Files with quotes in other places than at the borders of values are read by one task each.
    """
    header = spark.read.csv(path, header=True, inferSchema=False, multiLine=multi_line, **DIALECT).columns
    fields = {f.name: f for f in schema}
    if missing := [name for name in fields if name not in header]:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    stored = StructType([*[fields.get(name, StructField(name, StringType())) for name in header], StructField(CORRUPT, StringType())])
    if not multi_line:
        return scan_whole(spark, path, stored, False).select(*schema.names, CORRUPT)
    ranges = CsvRanges(spark, path)
    scanned = _parsed(ranges.records(), header, stored)
    if ranges.irregular:
        scanned = scanned.unionByName(scan_whole(spark, ranges.irregular, stored))
    return scanned.select(*schema.names, CORRUPT)


def scan_whole(spark: SparkSession, path: str | list[str], stored: StructType, multi_line: bool = True) -> DataFrame:
    """Spark's own reader: with ``multi_line`` one task a file, whatever its size."""
    return spark.read.csv(path, schema=stored, header=True, enforceSchema=False, multiLine=multi_line, **VALUES, **DIALECT)


def _parsed(records: DataFrame, header: list[str], stored: StructType) -> DataFrame:
    """Records of :class:`CsvRanges` as rows; those that lead their file are held against the header and left out."""
    dialect = {k: str(v).lower() for k, v in DIALECT.items()} | {"multiLine": "true"}
    names = F.from_csv("record", ", ".join(f"c{i} string" for i in range(len(header))), dialect)
    differs = reduce(Column.__or__, [~F.lower(names[f"c{i}"]).eqNullSafe(F.lit(name.lower())) for i, name in enumerate(header)])
    another = F.raise_error(F.concat(F.lit("a file with another header: "), "record")).cast("boolean")
    rows = records.where(F.when(~F.col("first"), True).when(differs, another).otherwise(False))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored)
    parsed = rows.select("returns", F.from_csv("record", fields, VALUES | dialect).alias("row"))

    def value(field: StructField) -> Column:
        own = F.col("row")[field.name]
        if field.name == CORRUPT or not isinstance(field.dataType, StringType):
            return own.alias(field.name)
        # Where a return is part of every line break, one within a value is a plain line feed, as in the one-task reader.
        return F.when(F.col("returns"), F.replace(own, F.lit("\r\n"), F.lit("\n"))).otherwise(own).alias(field.name)

    return parsed.select(*[value(f) for f in stored])


def contract(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the declared columns, in order, whatever lineage columns travel along."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path, header=True, dateFormat="yyyy-MM-dd", **DIALECT)
