"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, connected groups.

Two fingerprints of 64 bits that differ in at most ``max_bits`` bits agree on at least one of
``max_bits + 1`` blocks. Distinct fingerprints meet per block value; a block value shared by more than
``room`` of them is split again by the same rule on the bits it does not fix, so no group grows with the
data. Inside a group every pair is compared in numpy, but only a spanning set of links leaves it.

Defined results: a null or wordless text has fingerprint zero and links like any other; rows with the
same fingerprint are one node, however many they are; a row with a null id gets the smallest id it is
linked to, or null; an empty table gives no rows; other columns are not looked at.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almsbook.llm.common import id_and_text, per_text, words_of
from almsbook.llm.graph import components
from almsbook.operators.merging import first_per_group
from almsbook.sources.storage import materialize

SEED = 42
ONES = np.uint64(0x0101010101010101)
PRINTS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def majority(hashes: np.ndarray) -> int:
    """64 bits, each set if more than half of the hashes have it.

    Eight bits are counted at a time in the eight bytes of one word; 255 hashes fill a byte at most.
    """
    blocks = np.arange(0, len(hashes), 255)
    out = 0
    for low in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(low)) & ONES, blocks)
        counts = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in range(8):
            if 2 * int(counts[byte]) > len(hashes):
                out |= 1 << (8 * byte + low)
    return out


def simhash(words: list[bytes], shingle: int) -> int:
    """Fingerprint of lower-cased words; shingles count as often as they occur."""
    if not words:
        return 0
    joined = b" ".join(words)
    hashed = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hashed(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    pieces = [hashed(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    return majority(np.array(pieces, np.uint64))


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)`` of every row; ``fp`` holds the 64 bits as a signed long."""

    def rows(doc_id, text):
        fp = simhash([w.lower() for w in words_of(text)] if text else [], shingle)
        return [(doc_id, fp - (1 << 64) if fp >> 63 else fp)]

    return id_and_text(docs, id_col, text_col).mapInArrow(per_text(rows, PRINTS), "doc_id long, fp long")


def split_mask(mask: int, parts: int) -> list[int]:
    """``mask`` widened by each of ``parts`` even shares of the bits it leaves open."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | sum(1 << b for b in share.tolist()) for share in np.array_split(np.array(free), parts) if len(share)]


def as_long(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def linked_in_group(prints: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """Spanning links of the fingerprints of one group: each with the first of its local component."""
    n = len(prints)
    near = np.empty((n, n), bool)
    for i in range(0, n, 256):
        near[i : i + 256] = np.bitwise_count(prints[i : i + 256, None] ^ prints[None, :]) <= max_bits
    label = np.full(n, -1)
    for first in np.flatnonzero(near.sum(axis=1) > 1):
        if label[first] >= 0:
            continue
        front = np.array([first])
        label[first] = first
        while len(front):
            front = np.flatnonzero(near[front].any(axis=0) & (label < 0))
            label[front] = first
    for i in np.flatnonzero((label >= 0) & (label != np.arange(n))):
        yield int(prints[label[i]]), int(prints[i])


def block_links(prints: DataFrame, max_bits: int = 3, room: int = 2048) -> DataFrame:
    """``(a, b)``: links between distinct fingerprints ``prints (fp)`` that span every component."""
    spark = prints.sparkSession

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list = []
            for group in batch.column("group"):
                values = group.values.to_numpy(zero_copy_only=False).view(np.uint64)
                found += linked_in_group(np.sort(values), max_bits)
            links = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], schema=LINKS)

    masks = [0]
    at = prints.select("fp", F.lit(0).cast("long").alias("mask"))
    out = None
    while True:
        # (max_bits + 1) ** level masks: a short list that only the depth of splitting decides.
        step = [(as_long(m), [as_long(x) for x in split_mask(m, max_bits + 1)]) for m in masks]
        wider = F.broadcast(spark.createDataFrame(step, "mask long, wider array<long>"))
        keyed = at.join(wider, "mask").select("fp", F.explode("wider").alias("mask"))
        # One row per fingerprint and mask, whichever way led there.
        keyed = materialize(keyed.withColumn("value", F.col("fp").bitwiseAND(F.col("mask"))).distinct(), "blocks")
        sizes = keyed.groupBy("mask", "value").agg(F.count("*").alias("n")).where("n > 1")
        # Written first, so that the adaptive skew join can split a crowded block.
        met = materialize(keyed.join(materialize(sizes, "block-sizes"), ["mask", "value"]), "met")
        groups = met.where(F.col("n") <= room).groupBy("mask", "value").agg(F.collect_list("fp").alias("group"))
        links = groups.select("group").mapInArrow(solve, "a long, b long")
        out = links if out is None else out.unionByName(links)
        crowded = met.where(F.col("n") > room).select("fp", "mask")
        if not crowded.take(1):
            return out.distinct()
        masks = sorted({x for m in masks for x in split_mask(m, max_bits + 1)})
        at = crowded


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row: component is the smallest id reachable over links."""
    prints = materialize(fingerprints(docs, shingle, id_col, text_col), "prints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(block_links(nodes.select("fp"), max_bits))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = materialize(placed, "placed")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = materialize(placed.join(materialize(least, "least"), "root").select("fp", "component_id"), "groups")
    return prints.join(groups, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates: the one with the smallest id.

    Rows that repeat that id count as copies too: the least of them stays. Rows without an id have no
    place in the order; all of them stay.
    """
    found = near_duplicates(docs, shingle, max_bits)
    chosen = materialize(
        found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("_times")), "chosen"
    )
    lone, several = chosen.where("_times = 1").select("doc_id"), chosen.where("_times > 1").select("doc_id")
    kept = docs.join(lone, "doc_id", "left_semi").select(docs.columns)
    if several.take(1):
        repeated = docs.join(several, "doc_id", "left_semi").select(docs.columns)
        kept = kept.unionByName(first_per_group(repeated, [F.col("doc_id")], ["doc_id"]))
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))


def digest(docs: DataFrame) -> DataFrame:
    """Rows of the query: fingerprint as 16 hexadecimal digits."""
    return near_duplicates(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
