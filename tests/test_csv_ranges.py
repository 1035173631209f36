"""CSV in parallel ranges against Spark's one-task reader."""

import random

import pytest
from pyspark.sql import types as T

from almsbook.sources import files
from almsbook.sources.csv_ranges import CsvRanges
from helpers import plan_of

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("n", T.IntegerType())])
STORED = T.StructType([*SCHEMA, T.StructField(files.CORRUPT, T.StringType())])


@pytest.fixture
def small_ranges(spark):
    """Ranges of a few bytes, so that records cross many borders."""
    names = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {name: spark.conf.get(name, None) for name in names}

    def set_to(size):
        for name, value in (names | {"spark.sql.files.maxPartitionBytes": str(size)}).items():
            spark.conf.set(name, value)

    yield set_to
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def both(spark, path):
    """Rows in ranges, and rows by the one-task reader."""
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    found = files.scan_csv(spark, str(path), SCHEMA)
    assert found.columns == STORED.names
    return sorted(map(tuple, found.collect()), key=key), sorted(map(tuple, files.scan_whole(spark, str(path), STORED).collect()), key=key)


def value(rng):
    plain = "".join(rng.choices("xyz é;'\\\t", k=rng.randint(0, 9)))
    kind = rng.randrange(6)
    if kind < 3:
        return plain
    inner = "".join(rng.choice(["x", "y", ",", "\n", "\r\n", '""', " ", "\n\n", '"",""']) for _ in range(rng.randint(0, 30 if kind == 5 else 5)))
    return f'"{inner}"'


def text_of(rng, end, last=True):
    lines = ["a,b,n"] + [f"{value(rng)},{value(rng)},{rng.choice(['1', '22', '', 'x', chr(34) + '7' + chr(34)])}" for _ in range(rng.randint(0, 20))]
    lines += [rng.choice(["", "only", "a,b,1,2", ",,"]) for _ in range(3)]
    rng.shuffle(rest := lines[1:])
    return end.join([lines[0], *rest]) + (end if last else "")


@pytest.mark.parametrize("seed", range(8))
def test_equal_to_the_one_task_reader(spark, small_ranges, tmp_path, seed):
    rng = random.Random(seed)
    small_ranges(rng.choice([30, 64, 64, 200, 1 << 20]))
    for i in range(rng.randint(1, 2)):
        (tmp_path / f"{i}.csv").write_bytes(text_of(rng, rng.choice(["\n", "\r\n"]), rng.random() < 0.5).encode())
    found, wanted = both(spark, tmp_path)
    assert found == wanted
    assert CsvRanges(spark, str(tmp_path)).irregular == []


@pytest.mark.parametrize("text", [
    "a,b,n\n", "a,b,n", 'a,b,n\r\n"x\r\ny",z,1\r\n', '﻿a,b,n\n1,2,3\n', 'n,extra,b,a\n1,e,"b\nb",a\n', "\n\na,b,n\n\n1,2,3\n\n", 'a,b,n\n"' + "long\n" * 40 + '",x,1\n"y",z,2',
    'a,b,n\n"","""",1\n"a""b",",\n,",2\n', 'a,b,n\n"\n","\n",3',
])
def test_odd_files(spark, small_ranges, tmp_path, text):
    small_ranges(16)
    (tmp_path / "x.csv").write_text(text, encoding="utf-8", newline="")
    found, wanted = both(spark, tmp_path) if "extra" not in text else (sorted(map(tuple, files.scan_csv(spark, str(tmp_path), SCHEMA).collect())), [("a", "b\nb", 1, None)])
    assert found == wanted


@pytest.mark.parametrize("text", ['a,b,n\n5" pipe,x,1\n6",y,2\nu,v,3\n', 'a,b,n\nx,"never closed\n1,2,3\n', 'a,b,n\n"x" y,z,1\n"p\nq",r,2\n', 'a,b,n\n "x\n",z,1\n'])
def test_files_that_parity_cannot_judge(spark, small_ranges, tmp_path, text):
    small_ranges(16)
    (tmp_path / "bad.csv").write_text(text)
    (tmp_path / "good.csv").write_text('a,b,n\n"good\n1",2,3\n')
    found, wanted = both(spark, tmp_path)
    assert found == wanted and ("good\n1", "2", 3, None) in found
    assert [f.rsplit("/", 1)[1] for f in CsvRanges(spark, str(tmp_path)).irregular] == ["bad.csv"]


def test_one_file_has_as_many_tasks_as_ranges(spark, small_ranges, tmp_path):
    small_ranges(1 << 16)
    rng = random.Random(1)
    body = "".join(f'{i},"{"w" * rng.randint(0, 40)}\n{rng.choice(["", chr(34) * 2])}{i}",{i}\n' for i in range(20_000))
    (tmp_path / "large.csv").write_text("a,b,n\n" + body)
    scanned = files.scan_csv(spark, str(tmp_path / "large.csv"), SCHEMA)
    ranges = CsvRanges(spark, str(tmp_path / "large.csv")).ranges
    size = (tmp_path / "large.csv").stat().st_size
    assert ranges.count() == -(-size // (1 << 16)) and scanned.rdd.getNumPartitions() >= ranges.count() > 10
    assert ranges.where("inside").count() > 2
    found, wanted = both(spark, tmp_path / "large.csv")
    assert found == wanted and len(found) == 20_000
    assert "Exchange SinglePartition" not in plan_of(scanned)


def test_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b,n\n1,2,3\n")
    (tmp_path / "2.csv").write_text("b,a,n\n1,2,3\n")
    with pytest.raises(Exception, match="another header"):
        files.scan_csv(spark, str(tmp_path), SCHEMA).collect()
    (tmp_path / "3.csv").write_text("a,c,n\n1,2,3\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        files.scan_csv(spark, str(tmp_path / "3.csv"), SCHEMA)


def test_no_rows(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b,n\n")
    assert files.scan_csv(spark, str(tmp_path), SCHEMA).collect() == []
