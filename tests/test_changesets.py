"""Merges as change sets against the full rewrite."""

import os
import random

import pytest
from pyspark.sql import types as T

from almsbook.operators.changesets import ChangeSets
from almsbook.operators.merging import upsert
from helpers import rows

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType()), T.StructField("kind", T.IntegerType())])


def batch(rng, count):
    return [(f"k{i}", rng.choice(["a", "b", None]), rng.choice([1, 2, None])) for i in rng.sample(range(40), count)]


@pytest.mark.parametrize("seed", range(1))
def test_sequences_of_batches_equal_the_full_rewrite(spark, tmp_path, seed):
    rng = random.Random(seed)
    table = ChangeSets(spark, f"{tmp_path}/t", SCHEMA, "id", ["name"], buckets=4)
    first = batch(rng, 15)
    table.create(spark.createDataFrame(first, SCHEMA))
    whole = {k: (k, name, kind) for k, name, kind in first}
    versions = {}
    for step in range(5):
        new = batch(rng, rng.choice([0, 1, 3, 12]))
        table.merge(spark.createDataFrame(new, SCHEMA))
        whole |= {k: (k, name, whole[k][2] if k in whole else kind) for k, name, kind in new}
        versions[table.manifest.version()] = dict(whole)
        if rng.random() < 0.4:
            table.compact()
    assert rows(table.read()) == rows(spark.createDataFrame(list(whole.values()), SCHEMA))
    by_rewrite = upsert(spark.createDataFrame(first, SCHEMA), spark.createDataFrame([("k1", "z", 9), ("new", "y", 8)], SCHEMA), "id", ["name"])
    other = ChangeSets(spark, f"{tmp_path}/u", SCHEMA, "id", ["name"], buckets=4)
    other.create(spark.createDataFrame(first, SCHEMA))
    other.merge(spark.createDataFrame([("k1", "z", 9), ("new", "y", 8)], SCHEMA))
    assert rows(other.read()) == rows(by_rewrite)
    version = other.manifest.version()
    other.compact()
    assert rows(other.read()) == rows(by_rewrite) == rows(other.read(version))


def test_cost_follows_the_batch(spark, tmp_path):
    table = ChangeSets(spark, f"{tmp_path}/t", SCHEMA, "id", ["name"], buckets=16)
    table.create(spark.createDataFrame([(f"k{i}", "old", i) for i in range(500)], SCHEMA))
    before = {f for f in _files(tmp_path)}
    table.merge(spark.createDataFrame([("k7", "new", None)], SCHEMA))
    written = [f for f in _files(tmp_path) - before if "_manifest" not in f]
    assert len(written) == 1 and "changes/load=2/bucket=" in written[0]
    bucket = written[0].split("/")[-2]
    # Only the touched bucket is grouped, and only it is rewritten.
    found = {r["id"]: tuple(r)[1:] for r in table.read().collect()}
    assert found["k7"] == ("new", 7) and len(found) == 500
    assert table.compact() == 3 and os.listdir(f"{tmp_path}/t/base/load=3").count(bucket) == 1
    assert [n for n in os.listdir(f"{tmp_path}/t/base/load=3") if n.startswith("bucket=")] == [bucket]
    assert {r["id"]: tuple(r)[1:] for r in table.read().collect()} == found and table.compact() == 3


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_repeated_keys_and_failures(spark, tmp_path, monkeypatch):
    table = ChangeSets(spark, f"{tmp_path}/t", SCHEMA, "id", ["name"], buckets=4)
    with pytest.raises(Exception, match="several rows to merge"):
        table.create(spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], SCHEMA))
    table.create(spark.createDataFrame([("a", "x", 1), (None, "n", 2)], SCHEMA))
    with pytest.raises(Exception, match="several rows to merge"):
        table.merge(spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], SCHEMA))
    table.merge(spark.createDataFrame([("a", None, 5), (None, "m", 5)], SCHEMA))
    monkeypatch.setattr(type(table.manifest), "commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.compact()
    monkeypatch.undo()
    assert rows(table.read()) == [(None, "m", 2), ("a", None, 1)] and rows(table.read(1)) == [(None, "n", 2), ("a", "x", 1)]
    table.compact()
    assert rows(table.read()) == [(None, "m", 2), ("a", None, 1)]
