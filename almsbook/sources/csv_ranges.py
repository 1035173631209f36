"""CSV records out of byte ranges, where quoted values may hold line breaks.

Spark's line reader cuts files into ranges and lines, but a line may begin within a quoted value. Whether it does is a
matter of parity: the quotes before it are odd in number. So each range counts its quotes, a running sum over the
ranges of a file (one small row each) tells in which state each range begins, and then every range finds its own record
ends, the line feeds outside quotes. A record over the border of two or more ranges is put together from their ends.

Parity is only right if quotes stand where a writer puts them: an opening one at the start of a value, a closing one at
its end, doubled in between. The count also looks at the neighbours of every quote, for both states a range can begin
in. Files where a quote stands elsewhere, or that end within quotes, are named by :meth:`CsvRanges.irregular`; for
them there is no way around reading from the start.
"""

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from almsbook.sources.storage import materialize

QUOTE, COMMA, LINE_FEED, RETURN = b'",\n\r'
RANGE = ["file", "start"]

_SUMMARY = pa.schema([
    ("file", pa.string()), ("start", pa.int64()), ("quotes", pa.int64()), ("misplaced_0", pa.int64()), ("misplaced_1", pa.int64()), ("returns", pa.bool_()),
])
_RECORDS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("part", pa.int8()), ("first", pa.bool_()), ("returns", pa.bool_()), ("record", pa.binary())])
# What a range holds of a record: all of it, its last lines, lines from within, or its first lines.
WHOLE, LAST, WITHIN, FIRST = range(4)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The stretches of a batch that lie in one range. A task reads its ranges one after the other, each in order."""
    files, starts = batch.column("file").dictionary_encode(), batch.column("start").to_numpy()
    codes = files.indices.to_numpy()
    breaks = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
    for lo, hi in zip([0, *breaks], [*breaks, batch.num_rows], strict=True):
        if hi > lo:
            yield (files.dictionary[int(codes[lo])].as_py(), int(starts[lo])), batch.slice(lo, hi - lo)


def _text(column: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The lines of a slice with a line feed after each, as bytes, and where each line begins, with the end of all."""
    lines = column.to_pylist()
    ends = np.cumsum(np.array([0] + [len(line) + 1 for line in lines]))
    return np.frombuffer(b"".join(line + b"\n" for line in lines), np.uint8), ends


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        for key, run in _runs(batch):
            if key not in held:
                held[key] = [0, 0, 0, key[1] == 0 and run.column("value")[0].as_py().endswith(b"\r")]
            total = held[key]
            text, _ = _text(run.column("value"))
            places = np.flatnonzero(text == QUOTE)
            if len(places):
                before = np.where(places > 0, text[places - 1], LINE_FEED)
                after = text[places + 1]
                # At the end of a line a return belongs to the line break.
                after = np.where((after == RETURN) & (text[np.minimum(places + 2, len(text) - 1)] == LINE_FEED), LINE_FEED, after)
                opens_well = (before == COMMA) | (before == LINE_FEED) | (before == QUOTE)
                closes_well = (after == COMMA) | (after == LINE_FEED) | (after == QUOTE)
                opens = (total[0] + np.arange(len(places))) % 2 == 0
                total[1] += int((~np.where(opens, opens_well, closes_well)).sum())
                total[2] += int((~np.where(opens, closes_well, opens_well)).sum())
                total[0] += len(places)
    if held:
        rows = [(*key, *total) for key, total in held.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SUMMARY, strict=True)], schema=_SUMMARY)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and the ends of records that cross the border of a range."""
    key: tuple[str, int] | None = None
    open_lines: list[bytes] = []
    inside = had_start = first = returns = False
    out: list[tuple[int, bool, bytes]] = []

    def batch_of(rows: list[tuple[int, bool, bytes]]) -> pa.RecordBatch:
        parts, firsts, records = zip(*rows, strict=True)
        file, start = key
        return pa.RecordBatch.from_arrays([
            pa.array([file] * len(rows)), pa.array([start] * len(rows), pa.int64()), pa.array(parts, pa.int8()), pa.array(firsts),
            pa.array([returns] * len(rows)), pa.array(records, pa.binary()),
        ], schema=_RECORDS)

    def rest() -> list[tuple[int, bool, bytes]]:
        """Lines of a record that goes on in the next range."""
        return [(FIRST if had_start else WITHIN, first, b"\n".join(open_lines))] if open_lines else []

    for batch in batches:
        for own, run in _runs(batch):
            if own != key:
                if key is not None and open_lines:
                    yield batch_of(rest())
                key, open_lines = own, []
                inside = bool(run.column("inside")[0].as_py())
                # A range that begins within quotes begins within a record.
                had_start, first = not inside, own[1] == 0
                returns = run.column("returns")[0].as_py()
            lines = run.column("value").to_pylist()
            text, ends = _text(run.column("value"))
            closed = (inside + np.searchsorted(np.flatnonzero(text == QUOTE), ends[1:])) % 2 == 0
            out = []
            for line, ends_here in zip(lines, closed, strict=True):
                if ends_here and not open_lines and had_start:
                    out.append((WHOLE, first, line))
                    # The first line that holds anything leads its file.
                    first = first and line in (b"", b"\r")
                    continue
                open_lines.append(line)
                if ends_here:
                    out.append((WHOLE if had_start else LAST, first, b"\n".join(open_lines)))
                    open_lines, had_start, first = [], True, False
            inside = not bool(closed[-1])
            if out:
                yield batch_of(out)
    if key is not None and open_lines:
        yield batch_of(rest())


class CsvRanges:
    """The ranges of CSV files below a path, with the state each begins in."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        lines = spark.read.text(path, lineSep="\n")
        self.lines = lines.select(
            F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
        )

    @cached_property
    def ranges(self) -> DataFrame:
        """``(file, start, misplaced, inside, left_open, returns)``, one row per range that holds a line, counted once and written.

        ``returns`` marks the first range of a file whose first line ends in a return and a line feed.
        """
        counted = self.lines.mapInArrow(_summarise, "file string, start long, quotes long, misplaced_0 long, misplaced_1 long, returns boolean")
        # One row per range, not per record, however long the file.
        before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        stated = counted.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
        return materialize(stated.select(
            *RANGE, F.when(F.col("inside"), F.col("misplaced_1")).otherwise(F.col("misplaced_0")).alias("misplaced"), "inside",
            ((F.col("quotes") + F.col("inside").cast("long")) % 2 == 1).alias("left_open"), "returns",
        ), "csv-ranges")

    @cached_property
    def _judged(self) -> Row:
        """What the driver has to know: the files parity cannot judge, and whether any range needs its state looked up."""
        ends = F.max_by("left_open", "start").alias("left_open")
        files = self.ranges.groupBy("file").agg(F.sum("misplaced").alias("misplaced"), ends, F.max("inside").alias("inside"), F.max("returns").alias("returns"))
        irregular = F.when((F.col("misplaced") > 0) | F.col("left_open"), F.col("file"))
        return files.agg(F.sort_array(F.collect_list(irregular)).alias("irregular"), F.max("inside").alias("inside"), F.max("returns").alias("returns")).first()

    @property
    def irregular(self) -> list[str]:
        """Files with quotes that parity cannot judge; the driver has a list of all files anyway."""
        return self._judged["irregular"]

    def records(self) -> DataFrame:
        """``(record, first, returns)`` of all regular files.

        Records are text without their line break; ``first`` marks those that lead their file, ``returns`` those of
        files whose lines end in a return and a line feed.
        """
        lines = self.lines.where(~F.col("file").isin(self.irregular)) if self.irregular else self.lines
        stated = lines.withColumns({"inside": F.lit(False), "returns": F.lit(False)})
        if self._judged["inside"]:
            # A row per range that begins within quotes, at most one per spark.sql.files.maxPartitionBytes of input.
            states = self.ranges.where("inside").select(*RANGE, "inside")
            stated = stated.drop("inside").join(F.broadcast(states), RANGE, "left").fillna(False, "inside")
        if self._judged["returns"]:
            # One row per file, and the driver has a list of all files anyway.
            returning = self.ranges.where("returns").select("file", "returns")
            stated = stated.drop("returns").join(F.broadcast(returning), "file", "left").fillna(False, "returns")
        stated = stated.select("value", *RANGE, "inside", "returns")
        shape = "file string, start long, part byte, first boolean, returns boolean, record binary"
        whole = stated.mapInArrow(_assemble, shape).where(F.col("part") == WHOLE).select("record", "first", "returns")
        if self._judged["inside"]:
            whole = whole.unionByName(self._across(stated, shape))
        # A byte order mark belongs to the file, a return before the line feed to the line break.
        text = F.col("record").cast("string")
        text = F.when(F.col("first"), F.regexp_replace(text, "^\ufeff", "")).otherwise(text)
        ended = whole.select(text.alias("text"), "first", "returns")
        record = F.when(F.col("text").endswith("\r"), F.substring("text", 1, F.length("text") - 1)).otherwise(F.col("text"))
        return ended.select(record.alias("record"), "first", "returns").where("record <> ''")

    def _across(self, stated: DataFrame, shape: str) -> DataFrame:
        """Records over the border of ranges. Only ranges next to such a border are looked at again."""
        touched = self.ranges.where("inside OR left_open").select(*RANGE)
        ends = stated.join(F.broadcast(touched), RANGE, "left_semi").mapInArrow(_assemble, shape).where(F.col("part") != WHOLE)
        # Two rows a range at most. A record's lines follow each other; each first part begins another record.
        in_order = Window.partitionBy("file").orderBy("start", "part")
        numbered = ends.withColumn("record_no", F.sum(F.when(F.col("part") == FIRST, 1).otherwise(0)).over(in_order))
        # The last part of one record and the first of the next lie in one range: the last one sorts before.
        lines = F.array_sort(F.collect_list(F.struct("start", "part", F.col("record").cast("string").alias("line"), "first", "returns")))
        joined = numbered.groupBy("file", "record_no").agg(lines.alias("lines"))
        flags = [F.exists(f"lines.{c}", lambda f: f).alias(c) for c in ("first", "returns")]
        return joined.select(F.concat_ws("\n", "lines.line").cast("binary").alias("record"), *flags)
