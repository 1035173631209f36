import random

import pytest
import xxhash

from almsbook.llm import simhash as sh
from almsbook.llm.graph import components
from frames import docs, edited, prose


def plain_print(text):
    words = [] if text is None else [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
    pieces = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in pieces]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints):
    """Smallest reachable value per node of the graph of near values."""
    nodes = sorted(set(prints))
    root = {}
    for n in nodes:
        if n in root:
            continue
        todo, group = [n], {n}
        while todo:
            at = todo.pop()
            near = {m for m in nodes if m not in group and (at ^ m).bit_count() <= 3}
            group |= near
            todo += near
        root.update({m: group for m in group})
    return root


BASE = prose(1, 400)
ROWS = (
    [(i, edited(BASE, i, i % 4)) for i in range(30, 60)] + [(i, prose(i, 60)) for i in range(60, 80)]
    + [(5, None), (6, ""), (7, " \n"), (8, "two words"), (9, "Two WORDS"), (9, "Two WORDS"), (None, "two words"), (None, "alone here now"),
       (10, "Été été A b c"), (11, prose(3, 30_000)), (12, "word " * 1000)]
)


def test_fingerprints(spark):
    found = sorted((str(r["doc_id"]), r["fp"] % (1 << 64)) for r in sh.fingerprints(docs(spark, *ROWS)).collect())
    assert found == sorted((str(i), plain_print(t)) for i, t in ROWS)


def test_components_of_documents(spark):
    groups = plain_roots([plain_print(t) for _, t in ROWS])
    least = {p: min((i for i, t in ROWS if i is not None and plain_print(t) in g), default=None) for p, g in groups.items()}
    found = sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in sh.digest(docs(spark, *ROWS)).collect())
    assert found == sorted((str(i), f"{plain_print(t):016x}", str(least[plain_print(t)])) for i, t in ROWS)


@pytest.mark.parametrize("room", [4, 2048])
def test_links_span_what_all_pairs_span(spark, room):
    """Crowded blocks are split again and again with little room, and give the same groups."""
    rng = random.Random(room)
    centres = [rng.getrandbits(64) for _ in range(12)] + [0]
    prints = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 3))) & ((1 << 64) - 1) for c in centres for _ in range(25)}
    frame = spark.createDataFrame([(sh.as_long(p),) for p in prints], "fp long")
    found = {(r["node"] % (1 << 64)): r["root"] for r in components(sh.block_links(frame, 3, room)).collect()}
    groups = plain_roots(prints)
    assert set(found) == {p for p, g in groups.items() if len(g) > 1}
    for p, root in found.items():
        assert root == min(sh.as_long(m) for m in groups[p])


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (200, 201)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(path, "a long, b long")).collect())
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_one_of_each_group_stays(spark):
    frame = docs(spark, *ROWS)
    kept = sh.keep_one(frame)
    assert kept.columns == frame.columns
    components_of = {(r["doc_id"], r["component_id"]) for r in sh.digest(frame).collect()}
    wanted = sorted(str(i) for i, c in components_of if i == c and i is not None) + ["None", "None"]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(wanted)


def test_empty_table(spark):
    assert sh.digest(docs(spark)).collect() == [] and sh.keep_one(docs(spark)).collect() == []
