import itertools
import random

import pytest

from almsbook.llm import length_buckets as lb
from almsbook.llm.token_records import tokenizer_path
from frames import docs, prose


def waste(edges, histogram):
    return sum(n * min(b for b in edges if b >= e) - tokens for e, (n, tokens) in histogram.items())


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_against_all_choices(seed):
    rng = random.Random(seed)
    histogram = {}
    for e in rng.sample(range(16, 400, 16), 9):
        n = rng.randint(1, 50)
        histogram[e] = (n, sum(rng.randint(e - 15, e) for _ in range(n)))
    for buckets in (1, 2, 3, 9, 20):
        found = lb.best_boundaries(histogram, buckets)
        assert len(found) <= buckets and found[-1] == max(histogram) and found == sorted(found)
        choices = itertools.chain.from_iterable(itertools.combinations(sorted(histogram), k) for k in range(1, min(buckets, 9) + 1))
        assert waste(found, histogram) == min(waste(c, histogram) for c in choices if c[-1] == max(histogram))
    assert lb.best_boundaries({}, 4) == []


ROWS = [(i, prose(i, 3 + (i * 37) % 400)) for i in range(120)] + [(None, "no id"), (500, None), (501, ""), (7, prose(7, 40)), (7, prose(7, 40)), (502, prose(9, 5000))]


def test_packing(spark):
    rows = lb.pack(docs(spark, *ROWS), longest=512, step=16, buckets=4, budget=2048).collect()
    lengths = {}
    for r in lb.token_lengths(docs(spark, *ROWS), tokenizer_path()).collect():
        lengths.setdefault(r["doc_id"], []).append(r["length"])
    per_doc = {}
    for r in rows:
        per_doc[r["doc_id"]] = per_doc.get(r["doc_id"], 0) + r["n_tokens"]
    assert per_doc == {i: sum(x) for i, x in lengths.items()}
    empty = [r for r in rows if r["n_tokens"] == 0]
    assert sorted(r["doc_id"] for r in empty) == [500, 501] and all(r["bucket"] is None and r["batch"] is None for r in empty)
    full = [r for r in rows if r["n_tokens"]]
    edges = sorted({r["bucket"] for r in full})
    assert len(edges) <= 4 and all(r["n_tokens"] <= r["bucket"] and r["padding"] == r["bucket"] - r["n_tokens"] for r in full)
    for edge in edges:
        own = sorted((r for r in full if r["bucket"] == edge), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["piece"]))
        assert all(r["bucket"] == min(b for b in edges if b >= r["n_tokens"]) for r in own)
        assert [r["batch"] for r in own] == [i // (2048 // edge) for i in range(len(own))]
    histogram = {}
    for r in full:
        e = -(-r["n_tokens"] // 16) * 16
        n, tokens = histogram.get(e, (0, 0))
        histogram[e] = (n + 1, tokens + r["n_tokens"])
    assert edges == lb.best_boundaries(histogram, 4)


def test_boundaries_waste_least_over_the_exact_lengths(spark):
    full = [r for r in lb.pack(docs(spark, *ROWS), buckets=4).collect() if r["n_tokens"]]
    histogram = {}
    for r in full:
        n, tokens = histogram.get(r["n_tokens"], (0, 0))
        histogram[r["n_tokens"]] = (n + 1, tokens + r["n_tokens"])
    edges = lb.best_boundaries(histogram, 4)
    assert {r["bucket"] for r in full} == set(edges) and any(e % 16 for e in edges)
    assert sum(r["padding"] for r in full) == waste(edges, histogram)


def test_empty_table(spark):
    assert lb.pack(docs(spark)).collect() == []
    assert [tuple(r) for r in lb.pack(docs(spark, (1, None))).collect()] == [(1, 0, 0, None, None, None)]
