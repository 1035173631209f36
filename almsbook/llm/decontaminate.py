"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur in a document with up to k errors (insertions, deletions,
substitutions). Cut into k + 1 pieces, at least one piece of it is then there unchanged. All pieces of
a block of items go into one automaton that finds exact hits in one pass over a text; around each hit
Myers' bit-parallel distance decides. k is ``max_error`` of m, less where pieces would fall below
``least_piece`` characters, which would hit by chance.

Texts compare lower-cased with runs of white space as one blank. The items are a stated query set: they
are streamed in blocks of at most ``block_chars`` characters, and each block is matched against all rows.

Defined results: null or blank documents and items match nothing; repeated items are reported under each
of their ids, an item without id under a null one; repeated rows each for themselves, rows without an id under a
null one; an empty documents table gives no rows; no items leave the documents as they are; an item shorter than
two pieces has to occur exactly; other columns travel along with the documents that stay and are not looked at.
"""

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almsbook.llm.common import id_and_text, per_text, worker_state

HITS = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("errors", pa.int32()), ("first", pa.int64()), ("last", pa.int64())
])


def plain(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def budget(length: int, max_error: float, least_piece: int) -> int:
    return max(0, min(int(length * max_error), length // least_piece - 1))


class Pattern:
    """One item for Myers' algorithm: a bit mask per character, forwards and backwards."""

    def __init__(self, text: str, errors: int) -> None:
        self.text, self.size, self.errors = text, len(text), errors
        self.masks = self._masks(text)
        self.back = self._masks(text[::-1])

    @staticmethod
    def _masks(text: str) -> dict[str, int]:
        masks: dict[str, int] = {}
        for i, c in enumerate(text):
            masks[c] = masks.get(c, 0) | 1 << i
        return masks

    def _scan(self, masks: dict[str, int], text: str, anchored: bool) -> tuple[int, int]:
        """Least distance of the pattern to a piece of ``text``, and where that ends first.

        Anchored, the piece has to begin at the first character.
        """
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        up, down, score = full, 0, self.size
        best, at = score, 0
        for i, c in enumerate(text, 1):
            equal = masks.get(c, 0)
            vertical = equal | down
            across = (((equal & up) + up) ^ up) | equal
            plus = down | ~(across | up) & full
            minus = up & across
            if plus & top:
                score += 1
            elif minus & top:
                score -= 1
            plus = plus << 1 | anchored
            minus <<= 1
            up = (minus | ~(vertical | plus)) & full
            down = plus & vertical & full
            if score < best:
                best, at = score, i
        return best, at

    def search(self, text: str, start: int, end: int) -> tuple[int, int, int] | None:
        """Errors, first and last character of the best match within ``text[start:end]``."""
        best, at = self._scan(self.masks, text[start:end], False)
        if best > self.errors or not at:
            return None
        head = text[max(start, start + at - self.size - self.errors) : start + at]
        _, size = self._scan(self.back, head[::-1], True)
        return best, start + at - size, start + at - 1


class Matcher:
    """All items of one block."""

    def __init__(self, items: list[tuple[int, str]], max_error: float, least_piece: int) -> None:
        ids: dict[str, set[int]] = {}
        for item_id, text in items:
            ids.setdefault(text, set()).add(item_id)
        self.ids = [sorted(i) for i in ids.values()]
        self.patterns = [Pattern(text, budget(len(text), max_error, least_piece)) for text in ids]
        pieces: dict[str, list[tuple[int, int]]] = {}
        for no, p in enumerate(self.patterns):
            cuts = [len(p.text) * i // (p.errors + 1) for i in range(p.errors + 2)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                pieces.setdefault(p.text[a:b], []).append((no, b))
        self.automaton = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.automaton.add_word(piece, where)
        self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """``(item id, errors, first, last)`` of every place that holds an item."""
        text = plain(text)
        starts: dict[int, set[int]] = {}
        for end, where in self.automaton.iter(text):
            for no, offset in where:
                starts.setdefault(no, set()).add(end + 1 - offset)
        out = []
        for no, found in starts.items():
            p = self.patterns[no]
            places: dict[tuple[int, int, int], None] = {}
            # Hits whose starts lie within the error budget of each other belong to one place.
            line = np.sort(np.fromiter(found, np.int64, len(found)))
            for group in np.split(line, np.flatnonzero(np.diff(line) > p.errors) + 1):
                lo, hi = int(group[0]) - p.errors, int(group[-1]) + p.size + p.errors
                if match := p.search(text, max(0, lo), min(len(text), hi)):
                    places[match] = None
            out.extend((item_id, *match) for match in places for item_id in self.ids[no])
        return sorted(out, key=lambda hit: (hit[0] is None, hit))


def blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items, normalised, in blocks that a broadcast may hold; they pass through the driver one by one."""
    block: list[tuple[int, str]] = []
    size = 0
    for item_id, text in id_and_text(items, id_col, text_col).toLocalIterator():
        if text := plain(text):
            if block and size + len(text) > block_chars:
                yield block
                block, size = [], 0
            block.append((item_id, text))
            size += len(text)
    if block:
        yield block


class Shared:
    """A block of items as a broadcast; each Python worker builds its automaton once."""

    def __init__(self, spark, block, max_error: float, least_piece: int) -> None:
        self.items = spark.sparkContext.broadcast(block)
        self.key, self.rules = self.items._jbroadcast.id(), (max_error, least_piece)

    def __getstate__(self):
        return self.items, self.key, self.rules

    def __setstate__(self, state) -> None:
        self.items, self.key, self.rules = state

    def matcher(self) -> Matcher:
        return worker_state(("decontaminate", self.key), lambda: Matcher(self.items.value, *self.rules))


def find_items(
    docs: DataFrame, items: DataFrame, max_error: float = 0.05, least_piece: int = 16, block_chars: int = 1 << 20,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``(doc_id, item_id, errors, first, last)``: every place of a document that holds a test item.

    ``first`` and ``last`` count characters of the normalised document.
    """
    spark = docs.sparkSession
    out = spark.createDataFrame([], "doc_id long, item_id long, errors int, first long, last long")
    for block in blocks(items, item_col, item_text_col, block_chars):
        shared = Shared(spark, block, max_error, least_piece)

        def rows(doc_id, text, shared=shared):
            return [(doc_id, *hit) for hit in shared.matcher().find(text)]

        found = id_and_text(docs, id_col, text_col).mapInArrow(per_text(rows, HITS), out.schema)
        out = out.unionByName(found)
    return out


def drop_contaminated(
    docs: DataFrame, items: DataFrame, max_error: float = 0.05, least_piece: int = 16, block_chars: int = 1 << 20,
    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold no test item, all columns as they are. No shuffle."""
    for block in blocks(items, item_col, item_text_col, block_chars):
        shared = Shared(docs.sparkSession, block, max_error, least_piece)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    part = batch.slice(at, 1000)
                    texts = part.column(part.schema.get_field_index(text_col))
                    yield part.filter(pa.array([not shared.matcher().find(texts[i].as_py()) for i in range(part.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of the query; the id columns and the error budget are the defaults."""
    return find_items(docs, items).select("doc_id", "item_id", "errors", F.col("first"), F.col("last"))
