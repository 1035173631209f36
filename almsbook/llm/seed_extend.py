"""Substring dedup by seed and extend: repeats of ``least`` or more consecutive words across documents.

Seeds are winnowed: of the hashes of all ``seed``-word pieces that start in one window of ``least`` words
the smallest is the window's anchor, so equal windows have equal anchors and any shared run of ``least``
words holds a shared anchor. Consecutive windows with the same anchor form a run of windows.

1. Anchors found in one document only are dropped; the rest join back as seeds.
2. Seeds extend as far as their run of windows: runs with equal words form a class, and in all but its
   first document the whole run is a repeat. This settles whole copies without any pair.
3. Where an anchor has several classes, those that differ to the left or right of it, the seed extends
   window by window: each class is represented by its first document, and a window is a repeat if an
   earlier representative holds the same words.
4. Repeated windows of a document melt into maximal repeats.

No step pairs up the members of a group: a passage in n documents costs n rows per anchor in it.
Windows compare by 64-bit hashes of all their words.

Defined results: a null text has no words; a row without an id neither gives nor takes a repeat; rows
that share an id are one document and no repeats of each other; an empty table gives no rows; other
columns are not looked at.
"""

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almsbook.llm.common import Powers, Runs, id_and_text, per_text, signed, to_batch, words_of
from almsbook.sources.storage import materialize

RUNS = pa.schema([(n, pa.int64()) for n in ("doc_id", "text_hash", "anchor", "span")] + [("first", pa.int32()), ("last", pa.int32())])
WINDOWS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("window", pa.int64()), ("first", pa.int32())])
KEPT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
    ("kept", pa.string()), ("repeats", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
])
_powers = Powers()


def hashed_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def text_hash(text: str) -> int:
    """As Spark's ``xxhash64`` of the string."""
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"), 42)
    return h - (1 << 64) if h >> 63 else h


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, have = values, 1
    while 2 * have <= width:
        out, have = np.minimum(out[:-have], out[have:]), 2 * have
    if have < width:
        more = width - have
        out = np.minimum(out[:-more], out[more:])
    return out


def window_runs(runs: Runs, n: int, least: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first and last window start of every run of windows of a sequence of ``n`` words."""
    starts = np.arange(n - seed + 1)
    anchors = sliding_least(runs.hash(starts, starts + seed), least - seed + 1)
    first = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
    last = np.concatenate((first[1:], [len(anchors)])) - 1
    return anchors[first], first, last


def seeds(docs: DataFrame, least: int, seed: int) -> DataFrame:
    """Every run of windows: its anchor, the hash of the words it spans, and where it starts and ends."""

    def rows(doc_id, text):
        words = words_of(text)
        if doc_id is None or len(words) < least:
            return []
        runs = Runs(hashed_words(words), _powers)
        anchors, first, last = window_runs(runs, len(words), least, seed)
        spans = runs.hash(first, last + least)
        key = text_hash(text)
        return [(doc_id, key, *r) for r in zip(signed(anchors).tolist(), signed(spans).tolist(), first.tolist(), last.tolist(), strict=True)]

    return docs.mapInArrow(per_text(rows, RUNS), "doc_id long, text_hash long, anchor long, span long, first int, last int")


def extend(docs: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """Hashes of the windows in the ``wanted`` runs, computed from the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list = []
            for row in range(batch.num_rows):
                doc_id, text = batch.column("doc_id")[row].as_py(), batch.column("text")[row].as_py()
                found = batch.column("found")[row].values
                runs = Runs(hashed_words(words_of(text)), _powers)
                spans = zip(found.field("first").to_pylist(), found.field("last").to_pylist(), strict=True)
                at = np.unique(np.concatenate([np.arange(f, e + 1) for f, e in spans]))
                windows, key = signed(runs.hash(at, at + least)).tolist(), text_hash(text)
                held.extend((doc_id, key, w, f) for w, f in zip(windows, at.tolist(), strict=True))
                if len(held) > 100_000:
                    yield to_batch(held, WINDOWS)
                    held = []
            if held:
                yield to_batch(held, WINDOWS)

    lists = wanted.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "last")).alias("found"))
    return with_text(docs, materialize(lists, "wanted-runs"), "inner").mapInArrow(
        run, "doc_id long, text_hash long, window long, first int"
    )


def with_text(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Texts with the list of their document; a list is as long as its own text has runs at most."""
    keyed = docs.withColumn("text_hash", F.xxhash64("text"))
    return keyed.join(lists, ["doc_id", "text_hash"], how).select("doc_id", "text", "found")


def repeated_windows(docs: DataFrame, least: int = 50, seed: int = 10) -> DataFrame:
    """``(doc_id, text_hash, first, last)``: ranges of window starts whose words occur in an earlier document."""
    docs = id_and_text(docs, "doc_id", "text")
    runs = materialize(seeds(docs, least, seed), "runs")
    shared = (
        runs.groupBy("anchor")
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min("span").alias("s"), F.max("span").alias("t"))
        .where("lo < hi")
        .select("anchor", (F.col("s") != F.col("t")).alias("several"))
    )
    # Each sum is written before it joins back: the adaptive skew join only splits inputs that come
    # straight from a shuffle or a scan.
    hits = materialize(runs.join(materialize(shared, "shared-anchors"), "anchor"), "hits")
    origin = materialize(hits.groupBy("span").agg(F.min("doc_id").alias("origin")), "origins")
    placed = materialize(hits.join(origin, "span"), "placed")
    whole = placed.where("origin < doc_id").select("doc_id", "text_hash", "first", "last")
    borders = placed.where("origin = doc_id and several").select("doc_id", "text_hash", "first", "last")
    windows = materialize(extend(docs, borders, least), "windows")
    earliest = windows.groupBy("window").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    partial = windows.join(materialize(earliest, "earliest"), "window").where("lo < doc_id")
    return whole.unionByName(partial.select("doc_id", "text_hash", "first", F.col("first").alias("last")))


def maximal(first: np.ndarray, last: np.ndarray, n: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Word ranges (end exclusive) that the windows of a text of ``n`` words cover together."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, first, 1)
    np.add.at(depth, last + least, -1)
    edge = np.diff(np.concatenate(([0], (np.cumsum(depth)[:n] > 0).astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def remove_repeats(docs: DataFrame, least: int = 50, seed: int = 10) -> DataFrame:
    """One row per document: word counts, the kept words and their digest, and the maximal repeats (word ranges)."""
    found = repeated_windows(docs, least, seed)
    lists = found.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "last")).alias("found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list = []
            size = 0
            for row in range(batch.num_rows):
                words = words_of(batch.column("text")[row].as_py())
                total, spans = len(words), []
                if batch.column("found")[row].is_valid:
                    ranges = batch.column("found")[row].values
                    a, b = maximal(
                        ranges.field("first").to_numpy(zero_copy_only=False),
                        ranges.field("last").to_numpy(zero_copy_only=False), total, least,
                    )
                    keep = np.ones(total, bool)
                    for s, e in zip(a.tolist(), b.tolist(), strict=True):
                        keep[s:e] = False
                        spans.append({"first": s, "last": e - 1})
                    words = list(compress(words, keep.tolist()))
                kept = b" ".join(words)
                held.append((
                    batch.column("doc_id")[row].as_py(), total, total - len(words), hashlib.sha256(kept).hexdigest(),
                    kept.decode("utf-8"), spans,
                ))
                size += len(kept)
                if size > 8_000_000:
                    yield to_batch(held, KEPT)
                    held, size = [], 0
            if held:
                yield to_batch(held, KEPT)

    kept = with_text(id_and_text(docs, "doc_id", "text"), materialize(lists, "repeats"), "left")
    return kept.mapInArrow(
        run,
        "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, repeats array<struct<first:long,last:long>>",
    )


def digest(docs: DataFrame) -> DataFrame:
    """Rows of the query."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


# Every window by itself, without seeds.
SQL = r"""
WITH texts AS (
  SELECT doc_id, [w FOR w IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS k
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM texts)
), origins AS (
  SELECT k, min(doc_id) AS origin FROM windows GROUP BY k
), hits AS (
  SELECT doc_id, i FROM windows JOIN origins USING (k) WHERE origin < doc_id
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM hits
), words AS (
  SELECT doc_id, generate_subscripts(words, 1) AS p, unnest(words) AS word FROM texts
), kept AS (
  SELECT w.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY w.p) AS kept
  FROM words w LEFT JOIN covered c ON c.doc_id = w.doc_id AND c.p = w.p WHERE c.p IS NULL GROUP BY w.doc_id
)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON k.doc_id = t.doc_id
"""
