"""What several operators share: table access, word splitting and hashing in numpy."""

import gc
from collections.abc import Callable, Hashable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MASK64 = (1 << 64) - 1
State = TypeVar("State")
_state: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_state(key: Hashable, make: Callable[[], State]) -> State:
    """What a Python worker keeps between its tasks: the last state asked for, made anew if the key is another.

    Operators that run one after the other share their workers, so states of all of them would add up.
    """
    if key not in _state:
        _state.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _state[key] = make()
    return _state[key]


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator works on, so other columns cannot clash with its own."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space (``[^\\x20\\x09-\\x0D]+``) as UTF-8; none for a null text."""
    return text.encode("utf-8", "replace").split() if text else []


def per_text(rows: Callable[[int | None, str | None], list], schema: pa.Schema, every: int = 50_000):
    """A ``mapInArrow`` function that calls ``rows(doc_id, text)`` for each input row.

    Output leaves in batches of about ``every`` rows, so memory does not follow the partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for i, doc_id in enumerate(ids):
                held.extend(rows(doc_id, texts[i].as_py()))
                if len(held) >= every:
                    yield to_batch(held, schema)
                    held = []
        if held:
            yield to_batch(held, schema)

    return run


def to_batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type, from_pandas=False) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit hashes (multiply and xor-shift); a bijection."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd base modulo 2**64 and their inverses, grown on demand."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            inverse = pow(self.BASE, -1, 1 << 64)
            steps = np.full(size, self.BASE, np.uint64), np.full(size, inverse, np.uint64)
            for s in steps:
                s[0] = 1
            with np.errstate(over="ignore"):
                self.up, self.down = np.multiply.accumulate(steps[0]), np.multiply.accumulate(steps[1])


class Runs:
    """Hashes of any run of consecutive items of one sequence, from prefix sums of ``hash * base**i``."""

    def __init__(self, hashes: np.ndarray, powers: Powers) -> None:
        powers.reach(len(hashes) + 1)
        self.powers = powers
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(hashes * powers.up[: len(hashes)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hash of items ``start[i]`` to ``end[i]`` (exclusive), the length taken in."""
        with np.errstate(over="ignore"):
            h = (self.sums[end] - self.sums[start]) * self.powers.down[start]
            return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64).view(np.int64)
