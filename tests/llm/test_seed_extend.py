import hashlib
import random

import duckdb
import numpy as np
import pytest

from almsbook.llm import seed_extend as se
from frames import docs, prose


def brute(rows, least):
    first = {}
    for doc_id, text in rows:
        words = se.words_of(text)
        for i in range(len(words) - least + 1):
            key = tuple(words[i : i + least])
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        words = se.words_of(text)
        gone = set()
        for i in range(len(words) - least + 1):
            if doc_id is not None and first[tuple(words[i : i + least])] < doc_id:
                gone.update(range(i, i + least))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((str(doc_id), len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_one_row_very_many_times(spark):
    """Ranges are settled once per text, so the lists do not grow with its copies."""
    text = prose(1, 120)
    rows = [(1, text[:300])] + [(2, text)] * 300 + [(3, prose(3, 20) + " " + text)] * 2
    seen = se.repeated_windows(docs(spark, *rows), 10, 4)
    lists = seen.groupBy("doc_id", "text_hash").agg(se.F.size(se.F.collect_set(se.F.struct("first", "last"))).alias("n")).collect()
    assert max(r["n"] for r in lists) <= 140
    assert found(spark, rows, 10, 4) == brute(rows, 10)


def found(spark, rows, least, seed):
    out = se.remove_repeats(docs(spark, *rows), least, seed).collect()
    for r in out:
        assert sum(x["last"] - x["first"] + 1 for x in r["repeats"]) == r["n_removed"]
        assert all(x["last"] - x["first"] + 1 >= least for x in r["repeats"])
        assert hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out)


@pytest.mark.parametrize("seed, least, anchor", [(1, 6, 2), (2, 5, 5), (3, 8, 3), (4, 4, 1)])
def test_against_brute_force_on_few_words(spark, seed, least, anchor):
    """Two to four different words give repeats of every kind, within texts and between them."""
    rng = random.Random(seed)
    rows = [(rng.randint(0, 30), " ".join(rng.choices("ab" if i % 2 else "abcd", k=rng.randint(0, 40)))) for i in range(40)]
    rows = list({i: (i, t) for i, t in rows}.values()) + [(None, "a b " * 20), (99, None), (98, "")]
    assert found(spark, rows, least, anchor) == brute(rows, least)


def test_against_brute_force_on_shared_passages(spark):
    rng = random.Random(5)
    passages = [prose(100 + i, n) for i, n in enumerate((49, 50, 51, 90))]
    rows = []
    for i in range(40):
        parts = [prose(1000 + i, rng.randint(0, 60))]
        for p in rng.sample(passages, rng.randint(0, 3)):
            parts += [p, prose(2000 + 10 * i + len(parts), rng.randint(0, 30))]
        rows.append((i, "\n".join(parts)))
    rows += [(100 + i, rows[3][1]) for i in range(5)] + [(200, prose(9, 20_000)), (201, " ".join(["same"] * 500)), (202, " ".join(["same"] * 400))]
    assert found(spark, rows, 50, 10) == brute(rows, 50)


def test_rows_that_share_an_id_are_one_document(spark):
    text = prose(1, 80)
    rows = [(5, text), (5, text), (7, "x " + text)]
    assert [r[:3] for r in found(spark, rows, 50, 10)] == [("5", 80, 0), ("5", 80, 0), ("7", 81, 80)]


def test_sql_on_the_tables(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    rows = [tuple(r) for r in se.digest(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()]
    assert sorted(rows) == sorted(con.execute(se.SQL).fetchall())


def test_empty_table(spark):
    assert se.digest(docs(spark)).collect() == []


def test_sliding_least():
    values = np.array([5, 1, 4, 2, 8, 0, 7], np.uint64)
    for width in range(1, 8):
        assert se.sliding_least(values, width).tolist() == [min(values[i : i + width]) for i in range(len(values) - width + 1)]
