"""What each filter of a set does, alone and behind the others, shared out fairly.

Removing documents is a game: a coalition of filters removes every document that one of its members fails. The
Hart-Mas-Colell potential of that game is worked out recursively over all coalitions, the potential of a coalition
being what it removes plus the potentials of the coalitions with one member less, over its size. A filter's Shapley
value is the potential of all filters minus the potential without it. Multiplied by the number of orders, this is how
many documents the filter removes summed over all orders. What a single step of an order removes is the difference of
two coalitions: the filters up to the step and those before it.

Only counts enter the game. Documents shrink to one small row (id, part, what they fail, digest of the text), then to a
count per part and set of failed filters, at most 32 a part for five filters, combined before the shuffle. Copies are
found by the smallest id per digest, also combined before the shuffle; only digests held by different ids are joined
back, and the adaptive skew join can split a digest or an id that very many rows share. The small rows are written once,
so texts are read a single time.

Defined results: a null text is the empty text (and a copy of any other empty one); a null part is the empty string, one
part with empty ones; rows without an id are never copies and make none, nor have labels; repeated rows count each, and
rows of one id are no copies of each other; several labels of one id count as one document, good or toxic if any label
says so; labels of unknown ids and null labels count for nothing; an empty table gives no rows; other columns are not
looked at.
"""

from collections.abc import Callable, Iterator
from functools import cache
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almsbook.sources.storage import materialize

# The filters of the digest, as their failure conditions. E is the copy of an earlier document.
FEWEST_WORDS = 50
LEAST_DISTINCT = 65
MOST_CAPITALS = 5
ODD_CHARACTERS = "[#$%&*|]"
COPY = "E"

WHITE_SPACE = "[\\x20\\x09-\\x0D]+"


def text_failures(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions by letter, of a text that is not null and its words."""
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < FEWEST_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * LEAST_DISTINCT,
        "C": capitals * 100 > F.length(text) * MOST_CAPITALS,
        "D": text.rlike(ODD_CHARACTERS),
    }


def failed_sets(
    docs: DataFrame, labels: DataFrame, failures: Callable[[Column, Column], dict[str, Column]] = text_failures, copy: str | None = COPY,
    id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
) -> tuple[DataFrame, str]:
    """``(part, mask, n, good, toxic)`` and the letters: documents by the set of filters they fail, bit i for letter i.

    ``copy`` names the filter that fails every document whose text a smaller id also has, or is None for no such filter.
    """
    own = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    # Only a text's first and last piece can be empty; both are no words.
    split = own.withColumn("words", F.array_remove(F.split("text", WHITE_SPACE), ""))
    conditions = failures(F.col("text"), F.col("words"))
    letters = "".join(conditions) + (copy or "")
    bits = [F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)) for i, failed in enumerate(conditions.values())]
    mask = sum(bits[1:], bits[0]) if bits else F.lit(0)
    small = materialize(split.select("id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")), "failures")
    if copy:
        ids = small.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
        copies = materialize(ids.where("first < last").select("digest", "first"), "copies")
        is_copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
        small = small.join(copies, "digest", "left").withColumn("mask", F.col("mask") + F.when(is_copy, 1 << len(conditions)).otherwise(0))
    flags = labels.groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    told = small.select("id", "part", "mask").join(flags, "id", "left")
    counted = told.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")
    )
    return counted, letters


def removed_by(counts: list[int]) -> list[int]:
    """For each coalition, the documents that fail any of its members, from the counts per set of failed filters."""
    return [sum(n for failed, n in enumerate(counts) if failed & coalition) for coalition in range(len(counts))]


def potentials(worth: list[int]) -> list[int]:
    """Hart-Mas-Colell potential of every coalition, times the factorial of the number of players, which makes it whole."""
    players = (len(worth) - 1).bit_length()
    scale = factorial(players)

    @cache
    def potential(coalition: int) -> int:
        if not coalition:
            return 0
        members = [i for i in range(players) if coalition >> i & 1]
        return (scale * worth[coalition] + sum(potential(coalition & ~(1 << i)) for i in members)) // len(members)

    return [potential(coalition) for coalition in range(len(worth))]


STEPS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
_SCHEMA = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())] + [
    (name, pa.int64()) for name in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
])


def steps_of(part: str, letters: str, counts: list[int], good: list[int], toxic: list[int]) -> Iterator[tuple]:
    """All steps of all orders of one part."""
    gone, good_gone, toxic_gone = removed_by(counts), removed_by(good), removed_by(toxic)
    value = potentials(gone)
    everyone, total = len(counts) - 1, sum(counts)
    for order in permutations(range(len(letters))):
        name, before = "".join(letters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            alone = 1 << i
            after = before | alone
            yield (
                part, name, step, total - gone[after], gone[after] - gone[before], gone[alone] + gone[before] - gone[after], counts[alone],
                good_gone[after] - good_gone[before], toxic_gone[after] - toxic_gone[before], value[everyone] - value[everyone & ~alone],
            )
            before = after


def audit(counted: DataFrame, letters: str) -> DataFrame:
    """Every order and step per part, from :func:`failed_sets`: ``(part, filter_order, step, kept, removed, …, shapley)``.

    A part has as many input entries as there are sets of filters, so its rows are worked out as one small row.
    """
    sets = 1 << len(letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts, good, toxic = ([0] * sets for _ in range(3))
                for entry in row["entries"]:
                    counts[entry["mask"]], good[entry["mask"]], toxic[entry["mask"]] = entry["n"], entry["good"], entry["toxic"]
                columns = zip(*steps_of(row["part"], letters, counts, good, toxic), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)

    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("entries"))
    return parts.mapInArrow(run, STEPS)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(*failed_sets(docs, labels))


# The same by walking every order over every document, without the game.
SQL = r"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), firsts AS (
    SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text
), split AS (
    SELECT t.*, f.first_id, regexp_extract_all(t.text, '[^\x20\x09-\x0D]+') AS words
    FROM texts t JOIN firsts f ON t.text = f.text
), marks AS (
    SELECT doc_id AS id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failing AS (
    SELECT part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
        coalesce(doc_id > first_id, false) AS e, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM split LEFT JOIN marks ON doc_id = id
), failed AS (
    SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
        CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails,
        count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
    FROM failing GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT concat(p.x, q.x, r.x, s.x, t.x) AS filter_order FROM letters p, letters q, letters r, letters s, letters t
    WHERE p.x NOT IN (q.x, r.x, s.x, t.x) AND q.x NOT IN (r.x, s.x, t.x) AND r.x NOT IN (s.x, t.x) AND s.x <> t.x
), steps AS (
    SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before
    FROM orders, range(1, 6) AS places(step)
), counted AS (
    SELECT part, filter_order, step, letter,
        CAST(sum(n) FILTER (NOT hit AND NOT gone) AS BIGINT) AS kept, CAST(sum(n) FILTER (hit AND NOT gone) AS BIGINT) AS removed,
        CAST(sum(n) FILTER (hit AND gone) AS BIGINT) AS redundant, CAST(sum(n) FILTER (fails = letter) AS BIGINT) AS unique_fails,
        CAST(sum(good) FILTER (hit AND NOT gone) AS BIGINT) AS good_lost, CAST(sum(toxic) FILTER (hit AND NOT gone) AS BIGINT) AS toxic_lost
    FROM (
        SELECT failed.*, steps.*, contains(fails, letter) AS hit, length(translate(fails, before, '')) < length(fails) AS gone
        FROM failed, steps
    ) GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant,
    coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
    CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
