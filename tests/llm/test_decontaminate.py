import random

import pytest

from almsbook.llm import decontaminate as dc
from frames import docs, edited, prose


def distance_in(pattern, text):
    """Least edit distance of the pattern to any piece of the text, row by row."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def items_frame(spark, *rows):
    return spark.createDataFrame([(i, t, "other") for i, t in rows], "item_id long, text string, doc_id string")


ITEMS = [(1, prose(1, 40)), (2, prose(2, 25)), (3, "Short Item"), (4, prose(1, 40)), (5, None), (6, "  "), (None, prose(8, 30))]


def test_against_plain_edit_distance(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        item = ITEMS[rng.randrange(3)][1]
        middle = edited(item, i, rng.randint(0, 16)) if i % 3 else prose(900 + i, 20)
        rows.append((i, prose(i, rng.randint(0, 30)) + "\n " + middle.upper() + "  " + prose(i + 500, 5)))
    found = {}
    for r in dc.find_items(docs(spark, *rows), items_frame(spark, *ITEMS)).collect():
        key = (r["doc_id"], r["item_id"])
        found[key] = min(found.get(key, 99), r["errors"])
        text = dc.plain(dict(rows)[r["doc_id"]])[r["first"] : r["last"] + 1]
        assert distance_in(dc.plain(dict((k, v) for k, v in ITEMS if k)[r["item_id"]]), text) == r["errors"]
    wanted = {}
    for doc_id, text in rows:
        for item_id, item in ITEMS:
            if item_id and dc.plain(item):
                p = dc.plain(item)
                d = distance_in(p, dc.plain(text))
                if d <= dc.budget(len(p), 0.05, 16):
                    wanted[doc_id, item_id] = d
    assert found == wanted and len({k for k, d in wanted.items() if d}) > 3


def test_rows_and_filter(spark):
    item = ITEMS[0][1]
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, "x " + item), (4, item[:-30]), (5, item + " and " + item), (6, prose(77, 30_000))]
    found = sorted((str(r["doc_id"]), r["item_id"], r["errors"]) for r in dc.find_items(docs(spark, *rows), items_frame(spark, *ITEMS)).collect())
    assert found == sorted([("3", 1, 0), ("3", 4, 0)] * 2 + [("5", 1, 0), ("5", 4, 0)] * 2 + [("None", 1, 0), ("None", 4, 0)])
    kept = dc.drop_contaminated(docs(spark, *rows), items_frame(spark, *ITEMS))
    assert kept.columns == docs(spark).columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "4", "6"]


def test_blocks_give_the_same(spark):
    rows = [(i, prose(i, 10) + " " + ITEMS[i % 2][1]) for i in range(10)]
    one = dc.find_items(docs(spark, *rows), items_frame(spark, *ITEMS)).collect()
    many = dc.find_items(docs(spark, *rows), items_frame(spark, *ITEMS), block_chars=100).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) and len(one) == 15
    assert dc.drop_contaminated(docs(spark, *rows, (99, "clean")), items_frame(spark, *ITEMS), block_chars=100).count() == 1


def test_items_without_an_id_count(spark):
    nameless = prose(8, 30)
    rows = [(1, "a " + nameless), (2, "clean text"), (3, nameless + " " + ITEMS[2][1])]
    found = sorted((r["doc_id"], str(r["item_id"])) for r in dc.find_items(docs(spark, *rows), items_frame(spark, *ITEMS)).collect())
    assert found == [(1, "None"), (3, "3"), (3, "None")]
    assert [r["doc_id"] for r in dc.drop_contaminated(docs(spark, *rows), items_frame(spark, *ITEMS)).collect()] == [2]


def test_empty_tables(spark):
    assert dc.digest(docs(spark), items_frame(spark, *ITEMS)).collect() == []
    assert dc.digest(docs(spark, (1, "text")), items_frame(spark)).collect() == []
    assert dc.drop_contaminated(docs(spark, (1, "text")), items_frame(spark)).count() == 1


@pytest.mark.parametrize("length, errors", [(10, 0), (31, 0), (81, 4), (320, 16), (100, 5)])
def test_budget(length, errors):
    assert dc.budget(length, 0.05, 16) == errors
