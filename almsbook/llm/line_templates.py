"""Line dedup with a log-template tree of fixed depth.

The tree sorts a line first by its number of tokens, then by its leading ``depth`` tokens; tokens with a
digit count as the variable ``<*>`` from the start. Within a leaf, a token without a digit that stands at
its position in at least ``least_docs`` documents is constant, any other is a variable field, be it a number or a
rare word. Lines with the same constants and variables share a template if the constants make up ``least_share``
of the tokens without a digit; a line with fewer is only like itself, and a line of variables alone only like lines
of the same unmasked tokens. Unlike a parser that meets lines one by one, this does not depend on their order, and
each step is a grouped sum: a frequent line is one row per task before it is shuffled.

A template found in ``least_docs`` or more documents is dropped from all of them but the one with the
smallest id, so that text which only comes in copies is not lost altogether.

Defined results: a null text has no lines and stays null; blank lines stay; rows without an id are not
counted and stay as they are; rows that share an id are one document; an empty table gives no rows;
other columns travel along and cannot clash, as only ``doc_id`` and ``text`` enter the tree.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almsbook.llm.common import id_and_text, per_text, to_batch
from almsbook.sources.storage import materialize

LINES = pa.schema([("doc_id", pa.int64()), ("leaf", pa.int64()), ("line", pa.int64())])
TOKENS = pa.schema([("leaf", pa.int64()), ("line", pa.int64()), ("n", pa.int32()), ("literal", pa.bool_()), ("cell", pa.int64())])
DIGEST = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())])
DIGIT = re.compile(rb"[0-9]")
VARIABLE = b"<*>"


def hash64(data: bytes) -> int:
    h = xxhash.xxh64_intdigest(data)
    return h - (1 << 64) if h >> 63 else h


def tokens_of(line: bytes) -> list[bytes]:
    """Tokens of a line, those with a digit masked."""
    tokens = line.split()
    return [VARIABLE if DIGIT.search(t) else t for t in tokens] if DIGIT.search(line) else tokens


def place(line: bytes, tokens: list[bytes], depth: int) -> tuple[int, int]:
    """Leaf of the tree and identity of the line; without a literal token its text as it is."""
    own = tokens if tokens.count(VARIABLE) < len(tokens) else line.split()
    return hash64(b"%d " % len(tokens) + b" ".join(tokens[:depth])), hash64(b" ".join(own))


def lines_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").split(b"\n") if text is not None else []


def occurrences(docs: DataFrame, depth: int) -> DataFrame:
    """Distinct ``(doc_id, leaf, line)``."""

    def rows(doc_id, text):
        if doc_id is None or text is None:
            return []
        found = {place(line, tokens, depth) for line in lines_of(text) if (tokens := tokens_of(line))}
        return [(doc_id, *at) for at in found]

    return docs.mapInArrow(per_text(rows, LINES), "doc_id long, leaf long, line long").distinct()


def cells(docs: DataFrame, examples: DataFrame, depth: int) -> DataFrame:
    """One row per token of every example line: a hash of its position and the token; ``n`` tokens of the line are literal.

    Lists of lines grow with the texts, so they meet them by a sorted join at every size.
    """
    lists = materialize(examples.groupBy("doc_id").agg(F.collect_set("line").alias("found")), "example-lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list = []
            for row in range(batch.num_rows):
                wanted = set(batch.column("found")[row].as_py())
                for line in lines_of(batch.column("text")[row].as_py()):
                    tokens = tokens_of(line)
                    if not tokens:
                        continue
                    leaf, key = place(line, tokens, depth)
                    if key in wanted:
                        wanted.remove(key)
                        n = len(tokens) - tokens.count(VARIABLE)
                        held.extend((leaf, key, n, t != VARIABLE, hash64(b"%d " % i + t)) for i, t in enumerate(tokens))
                if len(held) > 50_000:
                    yield to_batch(held, TOKENS)
                    held = []
            if held:
                yield to_batch(held, TOKENS)

    found = docs.join(lists.hint("merge"), "doc_id").select("text", "found").mapInArrow(run, "leaf long, line long, n int, literal boolean, cell long")
    # Rows that share the id of the example may hold the line as well.
    return materialize(found.distinct(), "cells")


def recurring_lines(docs: DataFrame, depth: int = 3, least_docs: int = 3, least_share: float = 0.7) -> DataFrame:
    """``(doc_id, line)`` of the lines to drop."""
    docs = id_and_text(docs, "doc_id", "text")
    seen = materialize(occurrences(docs, depth), "lines")
    leaves = (
        seen.groupBy("leaf").agg(F.count("*").alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        .where((F.col("n") >= least_docs) & (F.col("lo") < F.col("hi"))).select("leaf")
    )
    # Sums are written before they join back, so that the adaptive skew join can split a hot leaf.
    seen = materialize(seen.join(materialize(leaves, "leaves"), "leaf"), "shared-leaves")
    lines = materialize(
        seen.groupBy("leaf", "line").agg(F.count("*").alias("docs"), F.min("doc_id").alias("doc_id")), "distinct-lines"
    )
    tokens = cells(docs, lines.select("doc_id", "line"), depth).join(lines.select("leaf", "line", "docs"), ["leaf", "line"])
    tokens = materialize(tokens, "tokens")
    constant = tokens.where("literal").groupBy("leaf", "cell").agg(F.sum("docs").alias("m")).where(F.col("m") >= least_docs)
    wide = (F.col("n") > 0) & (F.col("constants") >= F.col("n") * F.lit(least_share))
    parsed = (
        tokens.join(materialize(constant, "constants"), ["leaf", "cell"], "left")
        .groupBy("leaf", "line", "n")
        .agg(
            F.count("m").alias("constants"),
            F.bit_xor(F.when(F.col("m").isNotNull(), F.col("cell"))).alias("pattern"),
        )
        .select(
            "leaf", "line",
            F.when(wide, F.struct(F.lit(True).alias("wide"), F.col("leaf"), F.col("pattern"), F.col("constants")))
            .otherwise(F.struct(
                F.lit(False).alias("wide"), F.col("leaf"), F.col("line").alias("pattern"), F.lit(0).cast("long").alias("constants")
            )).alias("template"),
        )
    )
    placed = materialize(
        seen.join(materialize(parsed, "parsed"), ["leaf", "line"]).select("doc_id", "line", "template"), "templates"
    )
    found = (
        placed.select("template", "doc_id").distinct().groupBy("template")
        .agg(F.count("*").alias("docs"), F.min("doc_id").alias("origin")).where(F.col("docs") >= least_docs)
    )
    return placed.join(materialize(found, "found-templates"), "template").where("doc_id <> origin").select("doc_id", "line")


def with_dropped(docs: DataFrame, depth: int, least_docs: int, least_share: float) -> DataFrame:
    """``docs`` with the lines to drop from each text as the last column, whatever its name has to be."""
    name = "dropped_lines"
    while name in docs.columns:
        name += "_"
    dropped = recurring_lines(docs, depth, least_docs, least_share)
    lists = materialize(dropped.groupBy("doc_id").agg(F.collect_set("line").alias(name)), "dropped-lines")
    return docs.join(lists.hint("merge"), "doc_id", "left").select(*[docs[c] for c in docs.columns], name)


def keep_lines(text: str | None, dropped: list[int] | None, depth: int) -> list[bytes]:
    lines = lines_of(text)
    if not dropped:
        return lines
    gone = set(dropped)
    return [line for line in lines if not (tokens := tokens_of(line)) or place(line, tokens, depth)[1] not in gone]


def drop_lines(docs: DataFrame, depth: int = 3, least_docs: int = 3, least_share: float = 0.7) -> DataFrame:
    """``docs``, all columns, with recurring lines taken out of ``text``."""
    both = with_dropped(docs, depth, least_docs, least_share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts, dropped = batch.column(at), batch.column(batch.num_columns - 1)
            kept = [
                b"\n".join(keep_lines(texts[i].as_py(), dropped[i].as_py(), depth)).decode() if dropped[i].is_valid else texts[i].as_py()
                for i in range(batch.num_rows)
            ]
            columns = [pa.array(kept, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns - 1)]
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return both.mapInArrow(run, docs.schema)


def digest(docs: DataFrame, depth: int = 3, least_docs: int = 3, least_share: float = 0.7) -> DataFrame:
    """Rows of the query: lines, dropped lines and a digest of the kept lines joined by line feeds (null text: no lines)."""
    both = with_dropped(id_and_text(docs, "doc_id", "text"), depth, least_docs, least_share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list = []
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                lines = lines_of(text)
                kept = keep_lines(text, batch.column("dropped_lines")[i].as_py(), depth)
                digest = hashlib.sha256(b"\n".join(kept)).hexdigest()
                held.append((batch.column("doc_id")[i].as_py(), len(lines), len(lines) - len(kept), digest))
            if held:
                yield to_batch(held, DIGEST)

    return both.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


# Lists in place of hashes; the wide templates hold NULL for a variable field.
SQL = r"""
WITH numbered AS (
  SELECT doc_id, generate_subscripts(lines, 1) AS line_no, unnest(lines) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL)
), tokenised AS (
  SELECT doc_id, line_no, line,
         [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END
          FOR t IN regexp_split_to_array(line, '[\x20\x09-\x0D]+') IF t <> ''] AS tokens,
         [t FOR t IN regexp_split_to_array(line, '[\x20\x09-\x0D]+') IF t <> ''] AS unmasked
  FROM numbered
), named AS (
  SELECT *, md5(array_to_string(CASE WHEN len([t FOR t IN tokens IF t <> '<*>']) > 0 THEN tokens ELSE unmasked END, ' ')) AS k,
         len(tokens) AS n, tokens[1:3] AS lead FROM tokenised
), lines AS (
  SELECT k, any_value(tokens) AS tokens, any_value(n) AS n, any_value(lead) AS lead, count(DISTINCT doc_id) AS docs
  FROM named WHERE n > 0 GROUP BY k
), cells AS (
  SELECT k, docs, n, lead, generate_subscripts(tokens, 1) AS pos, unnest(tokens) AS token FROM lines
), weighed AS (
  SELECT *, token <> '<*>' AND sum(docs) OVER (PARTITION BY n, lead, pos, token) >= 3 AS constant FROM cells
), patterns AS (
  SELECT k, count(*) FILTER (token <> '<*>') > 0 AND count(*) FILTER (constant) >= count(*) FILTER (token <> '<*>') * 0.7 AS wide,
         list(CASE WHEN constant THEN token END ORDER BY pos) AS pattern
  FROM weighed GROUP BY k
), templates AS (
  SELECT k, wide, CASE WHEN wide THEN lead || pattern ELSE [k] END AS template FROM patterns JOIN lines USING (k)
), found AS (
  SELECT wide, template, count(DISTINCT doc_id) AS docs, min(doc_id) AS origin
  FROM named JOIN templates USING (k) GROUP BY wide, template
), gone AS (
  SELECT k, origin FROM templates t JOIN found f ON t.wide = f.wide AND t.template = f.template WHERE docs >= 3
), judged AS (
  SELECT doc_id, line_no, line, g.k IS NOT NULL AND doc_id <> origin AS dropped FROM named LEFT JOIN gone g USING (k)
)
SELECT d.doc_id, count(line_no) AS n_lines, count(line_no) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT dropped), '')) AS kept_sha256
FROM documents d LEFT JOIN judged j ON j.doc_id = d.doc_id GROUP BY d.doc_id
"""
