import hashlib

import duckdb
import pytest

from almsbook.llm import line_templates as lt
from frames import docs, prose


def log(user, n):
    return f"connection from host {user} closed after {n} ms by the remote side"


ROWS = [
    (1, log("alpha", 5) + "\n" + prose(1, 20)), (2, prose(2, 20) + "\n" + log("beta", 7)), (3, log("gamma", 9) + "\n\n" + log("delta", 1)),
    (4, "same line here\n" + prose(4, 10)), (5, "same line here"), (6, prose(6, 5) + "\nsame  line\there\nsame line here"), (6, "same line here"),
    (7, "rare line here\ntwice rare"), (8, "rare line here"), (9, None), (10, ""), (11, "\n \n"), (None, "same line here"), (12, prose(12, 30_000)),
]


# A place that numbers fill in some documents and rare words in others, and lines of numbers alone or nearly so.
FIELDS = [f"alpha beta gamma {w} delta epsilon zeta eta theta iota" for w in ("101", "102", "103", "qux", "bar", "foo")]
NUMBERS = ["12 45 78", "2003 7 9", "5 5 5", "5  5 5", "5 5 5\nkept", "<*> <*> <*>", *(f"1{i} 2 3 {i} 5 6 7 one{'xyz'[i]} two{'xyz'[i]} three{'xyz'[i]}" for i in range(3))]


def kept(spark, rows, **options):
    out = lt.drop_lines(docs(spark, *rows), **options)
    assert out.columns == docs(spark).columns
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or "") for r in out.collect()))


def test_variable_fields_and_copies(spark):
    found = {(i, t) for _, i, _, t in kept(spark, ROWS)}
    assert (1, ROWS[0][1]) in found and (2, prose(2, 20)) in found and (3, "") in found  # the template stays in document 1
    assert (4, ROWS[3][1]) in found and (5, "") in found and (6, prose(6, 5)) in found and (6, "") in found
    assert (7, ROWS[7][1]) in found and (8, ROWS[8][1]) in found  # two documents are not enough
    assert (11, "\n \n") in found and (12, ROWS[13][1]) in found and (0, "same line here") in found


def test_nothing_is_lost_or_added(spark):
    assert len(kept(spark, ROWS)) == len(ROWS)
    assert [t for has, i, full, t in kept(spark, ROWS) if i == 9] == [""] and not any(full for _, i, full, _ in kept(spark, ROWS) if i == 9)


def test_digest_equals_sql_on_small_rows(spark):
    rows = [r for r in ROWS if r[0] is not None and r != ROWS[6]] + [(20 + i, t) for i, t in enumerate(FIELDS + NUMBERS)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(r[:2]) for r in rows])
    found = [tuple(r) for r in lt.digest(docs(spark, *rows)).collect()]
    # A null text has no line; the one line of an empty text is blank.
    assert sorted(found) == sorted(con.execute(lt.SQL).fetchall())


def test_digest_equals_sql_on_the_tables(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    found = [tuple(r) for r in lt.digest(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()]
    assert sorted(found) == sorted(con.execute(lt.SQL).fetchall()) and sum(r[2] for r in found) > 0


def test_numbers_are_not_what_makes_lines_alike(spark):
    rows = [(1, "12 45 78"), (2, "2003 7 9"), (3, "1 2 3"), (4, "5 5 5"), (5, "5  5 5"), (6, "5 5 5\nkept"),
            *((10 + i, f"1{i} 2 3 {i} 5 6 7 one{'xyz'[i]} two{'xyz'[i]} three{'xyz'[i]}") for i in range(3))]
    gone = {5: "", 6: "kept"}  # the same numbers in three documents are a copy
    assert {i: t for _, i, _, t in kept(spark, rows)} == {i: gone.get(i, t) for i, t in rows}


def test_a_field_of_numbers_and_of_rare_words_is_one_field(spark):
    rows = list(enumerate(FIELDS, 1))
    assert [t for *_, t in kept(spark, rows)] == [FIELDS[0]] + [""] * 5


def test_empty_table(spark):
    assert kept(spark, []) == [] and lt.digest(docs(spark)).collect() == []


@pytest.mark.parametrize("line, masked", [(b"a1 b", [b"<*>", b"b"]), (b"  \t ", []), ("٣ x".encode(), ["٣".encode(), b"x"])])
def test_digits_are_variable(line, masked):
    assert lt.tokens_of(line) == masked


def test_digest_is_that_of_the_kept_lines(spark):
    rows = {r["doc_id"]: r for r in lt.digest(docs(spark, *ROWS[:4])).collect()}
    assert rows[4]["kept_sha256"] == hashlib.sha256(ROWS[3][1].encode()).hexdigest()
