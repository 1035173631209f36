"""Language identification by words first, character n-grams second.

Per language, words and n-grams of ``longest`` down to 1 characters have a log frequency. A known word is
scored by its frequency in each language; an unseen one falls back to its longest n-grams of which any is
known, then to shorter ones. What a language lacks costs ``penalty`` (negative log10). The language with
the least total wins, ties go to the smaller name; the score is its share of the probability mass.

The classifier is fitted on a bounded sample: about ``sample_rows`` labelled rows of each language, chosen
by a hash of the id, and keeps the ``vocabulary`` most frequent words and n-grams of each length. That
bounds what is sent to the driver and broadcast. Prediction reads every whole text and shuffles nothing.

Defined results: ``und`` with score 0 for a null text, one without letters, or a model that learned no
language; rows without a language or id teach nothing; repeated rows are predicted each for themselves;
an empty table gives no rows; other columns are not looked at.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almsbook.llm.common import id_and_text, to_batch, worker_state

UNKNOWN = "und"
RUN = re.compile(r"[^\W\d_]+")
GRAMS = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("gram", pa.string()), ("n", pa.int64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def letters(run: str) -> list[str]:
    """Words of letters only; a run may also hold other numeric signs."""
    return [run] if run.isalpha() else ["".join(g) for alpha, g in groupby(run, str.isalpha) if alpha]


def grams_of(word: str, size: int) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + size] for i in range(len(padded) - size + 1)] if size > 1 else list(word)


@dataclass
class Model:
    """Languages, and per word or n-gram the costs in each of them."""

    langs: list[str]
    tables: list[dict[str, int]]  # words, then n-grams by length 1, 2, …: row of ``costs``
    costs: np.ndarray
    penalty: float


class Scorer:
    """A model with the costs of the words met so far; ``room`` bounds what is remembered."""

    def __init__(self, model: Model, room: int = 300_000) -> None:
        self.model, self.room = model, room
        self.rows: dict[str, int] = {}
        self.costs = np.zeros((room, len(model.langs)))
        self.sizes = np.zeros(room, np.int64)

    def word(self, word: str) -> np.ndarray:
        m = self.model
        if (row := m.tables[0].get(word)) is not None:
            return m.costs[row]
        for size in range(len(m.tables) - 1, 0, -1):
            known = [row for g in grams_of(word, size) if (row := m.tables[size].get(g)) is not None]
            if known:
                return m.costs[known].mean(axis=0)
        return np.full(len(m.langs), m.penalty)

    def score(self, text: str | None) -> tuple[str, float]:
        counts = Counter(RUN.findall(text.lower())) if text and self.model.langs else {}
        total, seen = np.zeros(len(self.model.langs)), 0
        runs = list(counts)
        for at in range(0, len(runs), self.room):
            part = runs[at : at + self.room]
            if len(self.rows) + len(part) > self.room:
                self.rows.clear()
            rows = []
            for run in part:
                row = self.rows.get(run)
                if row is None:
                    row = self.rows[run] = len(self.rows)
                    words = letters(run)
                    self.sizes[row] = len(words)
                    self.costs[row] = sum(map(self.word, words)) if words else 0
                rows.append(row)
            weight = np.array([counts[r] for r in part], float)
            total += weight @ self.costs[rows]
            seen += int(weight @ self.sizes[rows])
        if not seen:
            return UNKNOWN, 0.0
        best = int(total.argmin())
        return self.model.langs[best], float(1 / np.power(10.0, total[best] - total).sum())


def fit(
    docs: DataFrame, sample_rows: int = 2000, vocabulary: int = 10_000, longest: int = 5, penalty: float = 7.0,
    most_langs: int = 1000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Model:
    """Learn from the labelled rows of ``docs``; at most the ``most_langs`` most frequent languages."""
    labelled = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).dropna()
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_langs).collect()
    if not sizes:
        return Model([], [{} for _ in range(longest + 1)], np.zeros((0, 0)), penalty)
    # A row's hash is its place between 0 and 1; the share of a language decides how far is read.
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, sample_rows / r["count"])) for r in sizes], "lang string, share double")
    unit = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 32)) / F.lit(float(1 << 32))
    sample = labelled.join(F.broadcast(shares), "lang").where(unit < F.col("share")).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            grams: Counter = Counter()
            for (lang, word), n in held.items():
                grams[lang, 0, word] += n
                for size in range(1, longest + 1):
                    for g in grams_of(word, size):
                        grams[lang, size, g] += n
            held.clear()
            return to_batch([(*key, n) for key, n in grams.items()], GRAMS)

        for batch in batches:
            langs, texts = batch.column("lang"), batch.column("text")
            for i in range(batch.num_rows):
                lang = langs[i].as_py()
                held.update((lang, w) for run in RUN.findall(texts[i].as_py().lower()) for w in letters(run))
                if len(held) > 20_000:
                    yield out()
        if held:
            yield out()

    counted = sample.mapInArrow(count, "lang string, size int, gram string, n long").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    table = Window.partitionBy("lang", "size")
    ranked = counted.select(
        "*", F.sum("n").over(table).alias("total"), F.row_number().over(table.orderBy(F.desc("n"), "gram")).alias("place")
    )
    top = ranked.where(F.col("place") <= vocabulary).select("lang", "size", "gram", "n", "total").collect()
    langs = sorted(r["lang"] for r in sizes)
    column = {lang: i for i, lang in enumerate(langs)}
    rows = {key: i for i, key in enumerate(sorted({(r["size"], r["gram"]) for r in top}))}
    tables: list[dict[str, int]] = [{} for _ in range(longest + 1)]
    for (size, gram), i in rows.items():
        tables[size][gram] = i
    costs = np.full((len(rows), len(langs)), penalty)
    for r in top:
        costs[rows[r["size"], r["gram"]], column[r["lang"]]] = min(penalty, -np.log10(r["n"] / r["total"]))
    return Model(langs, tables, costs, penalty)


class Shared:
    """A model as a broadcast, with one scorer per Python worker."""

    def __init__(self, spark, model: Model) -> None:
        self.model = spark.sparkContext.broadcast(model)
        self.key = self.model._jbroadcast.id()

    def __getstate__(self):
        return self.model, self.key

    def __setstate__(self, state) -> None:
        self.model, self.key = state

    def scorer(self) -> Scorer:
        return worker_state(("language_id", self.key), lambda: Scorer(self.model.value))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row."""
    shared = Shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.scorer()
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            if ids:
                yield to_batch([(doc_id, *scorer.score(texts[i].as_py())) for i, doc_id in enumerate(ids)], FOUND)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose language is known with at least ``least_score``."""
    shared = Shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.scorer()
        for batch in batches:
            # Whole rows leave in small batches, so that no second copy of a large one is held here or in the executor.
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column(part.schema.get_field_index(text_col))
                found = [scorer.score(texts[i].as_py()) for i in range(part.num_rows)]
                yield part.filter(pa.array([lang != UNKNOWN and score >= least_score for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def remainder(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % of


def digest(docs: DataFrame) -> DataFrame:
    """Rows of the query: a quarter of the ids is held out, and nothing is learned from it or from rows without id."""
    model = fit(docs.where(remainder("doc_id", 4) != 2))
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return predict(docs, model).select("doc_id", held_out, "lang_pred", "score")
