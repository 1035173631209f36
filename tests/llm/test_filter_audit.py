import random
import re
from collections import defaultdict
from itertools import permutations

import duckdb
import pytest
from pyspark.sql import functions as F

from almsbook.llm import filter_audit as fa
from compare import connect, difference
from frames import docs, prose

LABELS = "doc_id long, quality int, toxic int, good int, id long"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def plain_failures(rows):
    """(part, failed letters, id) per document, by the rules read one after the other."""
    texts = defaultdict(list)
    for doc_id, text, _ in rows:
        texts[text or ""].append(doc_id)
    for doc_id, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        yield part or "", "".join(letter for letter, failed in (
            ("A", len(words) < 50), ("B", 100 * len(set(words)) < 65 * len(words)), ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)),
            ("D", re.search(r"[#$%&*|]", text)), ("E", doc_id is not None and any(i is not None and i < doc_id for i in texts[text])),
        ) if failed), doc_id


def plain_audit(rows, labels):
    """Every order walked over every document."""
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    by_part = defaultdict(list)
    for part, failed, doc_id in plain_failures(rows):
        by_part[part].append((failed, doc_id))
    out = []
    for part, found in by_part.items():
        steps, total = [], defaultdict(int)
        for order in permutations("ABCDE"):
            left = found
            for step, letter in enumerate(order, 1):
                gone = [(f, i) for f, i in left if letter in f]
                left = [(f, i) for f, i in left if letter not in f]
                total[letter] += len(gone)
                failing = sum(letter in f for f, _ in found)
                steps.append((part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(f == letter for f, _ in found),
                              sum(i in good for _, i in gone), sum(i in toxic for _, i in gone)))
        out += [(*s, total[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def random_rows(seed, count):
    rng = random.Random(seed)
    texts = [None, "", " \n", "A", "a$", "WORD " * 60, prose(1, 49), prose(1, 50), prose(2, 60) + " #", "É" * 50, prose(3, 20_000), "x y " * 30]
    texts += [prose(i, rng.randint(40, 70)).title() if i % 3 else prose(i, 60) for i in range(4, 14)]
    rows = [(rng.choice([None, *range(count)]), rng.choice(texts), rng.choice([None, "", "s1", "s2"])) for _ in range(count)]
    labels = [(rng.choice([None, *range(2 * count)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(count)]
    return rows + rows[:5], labels


def run(spark, rows, labels):
    frame = docs(spark, *[(i, t) for i, t, _ in rows]).limit(0)
    frame = spark.createDataFrame([(i, t, None, p, 1, 7, "x", "y", "z", "w") for i, t, p in rows], frame.schema) if rows else frame
    return fa.digest(frame, spark.createDataFrame([(*x, 5, 6) for x in labels], LABELS))


@pytest.mark.parametrize("seed", range(4))
def test_against_walking_every_order(spark, seed):
    rows, labels = random_rows(seed, 60)
    found = run(spark, rows, labels)
    assert found.columns == COLUMNS and dict(found.dtypes)["step"] == "int" and dict(found.dtypes)["shapley"] == "bigint"
    assert sorted(map(tuple, found.collect())) == plain_audit(rows, labels)


def test_one_text_and_one_id_a_thousand_times(spark):
    rows = [(i, "same text", "s") for i in range(2000)] + [(7, prose(1, 60), "s")] * 1000 + [(None, "same text", "t")] * 500
    assert sorted(map(tuple, run(spark, rows, [(7, 1, 1)] * 300).collect())) == plain_audit(rows, [(7, 1, 1)])


def test_empty_tables(spark):
    assert run(spark, [], []).collect() == []
    assert len(run(spark, [(1, None, None)], []).collect()) == 600


def test_potentials_give_the_mean_over_all_orders():
    rng = random.Random(5)
    for players in (0, 1, 2, 4, 5):
        counts = [rng.randint(0, 50) for _ in range(1 << players)]
        worth = fa.removed_by(counts)
        value = fa.potentials(worth)
        for i in range(players):
            marginal = 0
            for order in permutations(range(players)):
                before = sum(1 << p for p in order[: order.index(i)])
                marginal += worth[before | 1 << i] - worth[before]
            assert value[-1] - value[len(value) - 1 - (1 << i)] == marginal


def test_other_filters(spark):
    frame = docs(spark, (1, "a"), (2, "b"), (3, "ab"), (4, "c"))
    counted, letters = fa.failed_sets(frame, spark.createDataFrame([], LABELS), lambda text, words: {"X": text.contains("a"), "Y": text.contains("b")}, None)
    assert letters == "XY"
    steps = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in fa.audit(counted, letters).collect()}
    assert steps == {("XY", 1): (2, 2, 0, 1, 3), ("XY", 2): (1, 1, 1, 1, 3), ("YX", 1): (2, 2, 0, 1, 3), ("YX", 2): (1, 1, 1, 1, 3)}


def test_sql_agrees(spark, sf_dir):
    con = connect(sf_dir)
    assert difference(fa.digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")), con, fa.SQL) is None


def test_sql_agrees_on_small_rows(spark):
    rows, labels = random_rows(9, 60)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    assert difference(run(spark, rows, labels).orderBy(F.rand(1)), con, fa.SQL) is None
