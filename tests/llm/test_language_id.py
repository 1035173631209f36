import zlib

import numpy as np
import pytest

from almsbook.llm import language_id as li
from frames import docs


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, "the cat and the dog saw 2 birds", "en") for i in range(5)] + [(10 + i, "le chat et le chien ont vu", "fr") for i in range(5)]
    return li.fit(docs(spark, *rows, (20, "nothing known", None), (None, "der hund", "de"), (21, None, "es")))


def test_learns_only_labelled_rows_with_id_and_text(model):
    assert model.langs == ["en", "fr"]


def test_known_words_decide_first(model):
    scorer = li.Scorer(model)
    assert scorer.score("THE Dog")[0] == "en" and scorer.score("chien!")[0] == "fr"
    words = {"the": 10, "cat": 5, "and": 5, "dog": 5, "saw": 5, "birds": 5}
    own = -np.log10(words["cat"] / sum(words.values()))
    p = 10 ** (own - model.penalty)
    assert scorer.score("cat") == ("en", pytest.approx(1 / (1 + p)))


def test_unseen_words_fall_back_to_shorter_pieces(model):
    scorer = li.Scorer(model)
    assert scorer.score("chienne")[0] == "fr"  # " chie" and others of five letters
    assert scorer.score("dogs")[0] == "en"
    assert scorer.word("zzz").tolist() == [model.penalty] * 2
    assert scorer.score("zzz") == ("en", pytest.approx(0.5))  # a tie goes to the smaller name


def test_what_has_no_letters(model):
    scorer = li.Scorer(model)
    for text in (None, "", "123 ... !!", "²³ ①", "_ _"):
        assert scorer.score(text) == (li.UNKNOWN, 0.0)
    assert li.Scorer(li.Model([], [{}] * 6, np.zeros((0, 0)), 7.0)).score("text") == (li.UNKNOWN, 0.0)


def test_a_full_memory_changes_nothing(model):
    text = "the chat and chien saw zzz qqq birds " * 3
    assert li.Scorer(model, 2).score(text) == (li.Scorer(model).score(text)[0], pytest.approx(li.Scorer(model).score(text)[1]))


def test_rows_and_filter(spark, model):
    rows = [(1, "the cat"), (1, "the cat"), (2, None), (3, ""), (None, "le chien"), (4, "le chat " * 50_000)]
    found = sorted((str(r["doc_id"]), r["lang_pred"]) for r in li.predict(docs(spark, *rows), model).collect())
    assert found == [("1", "en"), ("1", "en"), ("2", "und"), ("3", "und"), ("4", "fr"), ("None", "fr")]
    kept = li.keep_identified(docs(spark, *rows), model)
    assert kept.columns == docs(spark).columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "4", "None"]
    assert li.digest(docs(spark)).collect() == []


def test_held_out_accuracy(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in table.collect()}
    rows = [r for r in li.digest(table).collect()]
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    judged = [r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"] and truth[r["doc_id"]]]
    assert np.mean(judged) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
