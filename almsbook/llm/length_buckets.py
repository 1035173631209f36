"""Packing into length buckets whose boundaries waste least padding.

Sequences are texts in subword ids, cut into pieces of at most ``longest`` ids. The histogram over all
pieces, in steps of ``step`` ids (each length for itself, unless the caller says otherwise), has ``longest / step`` rows at most whatever the input; dynamic
programming over it finds the ``buckets`` boundaries with the least total padding. Inside a bucket of
boundary b, batches hold ``budget // b`` pieces each, in order of document id; only the last may be short.

Defined results: a null text or one without tokens has a row without bucket and batch; repeated rows are
pieces each; rows without an id come first within a bucket; an empty table gives no rows; other columns
are not looked at.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almsbook.llm.common import id_and_text
from almsbook.llm.token_records import encoder, in_parts, tokenizer_path
from almsbook.sources.storage import materialize

LENGTHS = pa.schema([("doc_id", pa.int64()), ("length", pa.int64())])


def token_lengths(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, length)``: number of subword ids of every text, 0 for a null one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        for batch in batches:
            texts = batch.column("text")
            sizes = [len(ids) for part in in_parts(texts) for ids in words.encode(texts.slice(part.start, len(part)))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64())], schema=LENGTHS)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, length long")


def pieces(lengths: DataFrame, longest: int) -> DataFrame:
    """``(doc_id, piece, n_tokens)``: sequences longer than ``longest`` in consecutive pieces."""
    count = F.greatest(F.lit(1), F.ceil(F.col("length") / longest)).cast("int")
    return lengths.select("doc_id", "length", F.explode(F.sequence(F.lit(0), count - 1)).alias("piece")).select(
        "doc_id", "piece", F.least(F.lit(longest), F.col("length") - F.col("piece") * longest).cast("long").alias("n_tokens")
    )


def best_boundaries(histogram: dict[int, tuple[int, int]], buckets: int) -> list[int]:
    """Boundaries with the least padding, at most ``buckets``; of equal ones the first found.

    ``histogram`` maps a length class (its upper edge) to the number of sequences and of tokens in it.
    """
    edges = sorted(histogram)
    if not edges:
        return []
    upper = np.array(edges, float)
    counts = np.concatenate(([0], np.cumsum([histogram[e][0] for e in edges], dtype=float)))
    tokens = np.concatenate(([0], np.cumsum([histogram[e][1] for e in edges], dtype=float)))
    n = len(edges)

    def waste(at: slice) -> np.ndarray:
        """Row i, column j: padding if classes i to j share the boundary of class j; some columns at a time bound the memory."""
        own = (counts[None, 1:][:, at] - counts[:-1, None]) * upper[None, at] - (tokens[None, 1:][:, at] - tokens[:-1, None])
        own[np.arange(n)[:, None] > np.arange(n)[None, at]] = np.inf
        return own

    least, cuts = counts[1:] * upper - tokens[1:], [np.zeros(n, int)]
    for _ in range(min(buckets, n) - 1):
        ahead, cut, lower = np.concatenate(([0.0], least[:-1]))[:, None], np.zeros(n, int), np.empty(n)
        for lo in range(0, n, 256):
            at = slice(lo, min(lo + 256, n))
            both = ahead + waste(at)
            cut[at], lower[at] = both.argmin(axis=0), both.min(axis=0)
        cuts.append(cut)
        least = lower
    out, j = [], n - 1
    for cut in reversed(cuts):
        out.append(edges[j])
        if cut[j] == 0:
            break
        j = int(cut[j]) - 1
    return out[::-1]


def boundaries_of(parts: DataFrame, buckets: int, step: int) -> list[int]:
    edge = (F.ceil(F.col("n_tokens") / step) * step).cast("long").alias("edge")
    rows = parts.where("n_tokens > 0").groupBy(edge).agg(F.count("*").alias("n"), F.sum("n_tokens").alias("tokens")).collect()
    return best_boundaries({r["edge"]: (r["n"], r["tokens"]) for r in rows}, buckets)


def batches_of(parts: DataFrame, boundaries: list[int], budget: int) -> DataFrame:
    """Add ``bucket`` (its boundary), ``batch`` (from 0 in each bucket) and ``padding`` to every piece.

    Range partitions in order of bucket and document, a row's place within its partition, and the rows
    of its bucket in earlier partitions: no window sees more than one row per partition and bucket.
    """
    bucket = F.coalesce(*[F.when(F.col("n_tokens") <= b, F.lit(b)) for b in boundaries]) if boundaries else F.lit(None)
    sized = parts.withColumn("bucket", F.when(F.col("n_tokens") > 0, bucket).cast("long"))
    empty = sized.where("bucket IS NULL").select("doc_id", "piece", "n_tokens", "bucket", F.lit(None).cast("long").alias("batch"))
    order = ["bucket", "doc_id", "piece", "n_tokens"]
    placed = materialize(
        sized.where("bucket IS NOT NULL").repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("slot", F.monotonically_increasing_id()),
        "bucketed",
    )
    part = F.shiftright("slot", 33).alias("part")
    counts = placed.groupBy(part, "bucket").agg(F.count("*").alias("n"), F.min("slot").alias("lowest"))
    earlier = Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "bucket", "lowest", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    place = F.col("ahead") + F.col("slot") - F.col("lowest")
    full = placed.withColumn("part", part).join(starts, ["part", "bucket"]).select(
        "doc_id", "piece", "n_tokens", "bucket", F.floor(place / F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket")))).alias("batch")
    )
    return full.unionByName(empty).withColumn("padding", F.col("bucket") - F.col("n_tokens"))


def pack(
    docs: DataFrame, vocabulary: str | None = None, longest: int = 4096, step: int = 1, buckets: int = 8, budget: int = 65_536,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, piece, n_tokens, bucket, batch, padding)`` of every piece of every text."""
    lengths = token_lengths(docs, vocabulary or tokenizer_path(), id_col, text_col)
    parts = materialize(pieces(lengths, longest), "pieces")
    return batches_of(parts, boundaries_of(parts, buckets, step), budget)
