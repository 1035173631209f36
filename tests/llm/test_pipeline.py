import os
import subprocess
import sys
import weakref

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as cp
from almsbook.llm import decontaminate, language_id, line_templates, simhash, token_records
from frames import docs, prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean prose, copies, near copies, shared lines, leaks, junk and rows with nulls."""
    out = tmp_path_factory.mktemp("pipeline")
    leak = prose(5000, 40)
    rows = [(i, prose(i, 120) + "\n" + prose(i + 300, 30), "en", "s", 0) for i in range(40)]
    rows += [(100 + i, rows[3][1], "en", "s", 0) for i in range(2)]
    rows += [(110 + i, rows[4][1].replace(" ", "  "), "en", "s", None) for i in range(1)]
    rows += [(120 + i, prose(120 + i, 50) + "\nShared footer of the site", "en", None, 0) for i in range(6)]
    rows += [(130 + i, prose(130 + i, 20) + " " + leak + " " + prose(140 + i, 20), None, "s", 0) for i in range(3)]
    rows += [(150, None, "en", "s", None), (151, "", "en", "s", 0), (152, "123 --- 456", "en", "s", 0), (None, prose(999, 50), "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out), rows


def test_stages_one_by_one(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in cp.STAGES[:-1]:
        docs = cp.materialize(stage(spark, docs, path), name)
        assert docs.columns == columns
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
    ids = {r[0] for r in rows}
    assert set(seen["language_id"]) == ids - {150, 151, 152}
    footers = [i for i in range(120, 126) if "Shared footer" in seen["line_dedup"][i]["text"]]
    assert footers == [120]
    assert all(r["n_chars"] == len(r["text"]) for r in seen["line_dedup"].values())
    assert set(seen["line_dedup"]) == set(seen["language_id"])
    # Three copies: their lines recur in three documents and stay in the first, so two texts are empty, and one of them stays.
    assert ids - {150, 151, 152} - set(seen["simhash_dedup"]) == {101, 110}
    assert set(seen["simhash_dedup"]) - set(seen["decontamination"]) == {130, 131, 132}
    for i in range(40):
        assert seen["decontamination"][i]["text"] == rows[i][1]


def test_each_stage_is_its_operator(spark, folder):
    path, _ = folder
    docs = cp.materialize(cp.identify_language(spark, spark.read.parquet(f"{path}/documents.parquet"), path), "in")
    lines = {r["doc_id"]: r["text"] for r in cp.dedup_lines(spark, docs, path).collect()}
    gone = {}
    for r in line_templates.recurring_lines(docs).collect():
        gone.setdefault(r["doc_id"], []).append(r["line"])
    assert lines == {r["doc_id"]: b"\n".join(line_templates.keep_lines(r["text"], gone.get(r["doc_id"]), 3)).decode() for r in docs.collect()}
    kept = {r["doc_id"] for r in cp.dedup_documents(spark, docs, path).collect()}
    assert kept == {r["component_id"] for r in simhash.digest(docs).collect() if r["doc_id"] is not None} | {None}
    hits = {r["doc_id"] for r in decontaminate.digest(docs, spark.read.parquet(f"{path}/benchmark.parquet")).collect()}
    assert {r["doc_id"] for r in cp.remove_benchmarks(spark, docs, path).collect()} == {r["doc_id"] for r in docs.collect()} - hits


def test_run(spark, folder, sf_dir):
    path, _ = folder
    assert cp.run(spark, path).select("doc_id").distinct().count() == 40 + 1 + 6 + 1
    whole = cp.run(spark, sf_dir)
    assert whole.columns == ["doc_id", "piece", "n_tokens", "bucket", "batch", "padding"] and whole.count() > 0
    assert whole.where(F.col("n_tokens") > F.col("bucket")).count() == 0


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_registered():
    assert {"pipeline"} | {f"op{n}" for n in range(1, 14)} <= {n.partition("_")[0] for n in entry.queries()}
    assert len(cp.STAGES) == 5


def test_the_rest_stands_without_the_package(tmp_path):
    """With the package out of reach, the entry still offers the other queries."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'almsbook.llm' or name == 'corpus_pipeline': raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert len(e.queries()) >= 67 and not any(n.startswith('op') for n in e.queries()) and e.queries().keys() == e.oracle_sql().keys()\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, env=os.environ | {"PYTHONPATH": root})


def test_a_worker_keeps_the_state_of_one_stage_only(spark):
    model = language_id.fit(docs(spark, (1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de")))
    encoder = token_records.encoder(token_records.tokenizer_path())
    assert token_records.encoder(token_records.tokenizer_path()) is encoder
    gone = [weakref.ref(encoder)]
    del encoder
    shared = language_id.Shared(spark, model)
    scorer = shared.scorer()
    assert gone[0]() is None and shared.scorer() is scorer
    gone.append(weakref.ref(scorer))
    del scorer
    assert decontaminate.Shared(spark, [(1, prose(1, 30))], 0.05, 16).matcher().find(prose(1, 30))
    assert gone[1]() is None


def test_rows_that_stay_leave_in_small_batches(spark):
    """No second copy of a large batch, and no row lost where it is cut."""
    rows = spark.range(2501).selectExpr("id AS doc_id", "concat('the cat and the dog ', id) AS text", "'en' AS lang")
    kept = language_id.keep_identified(rows, language_id.fit(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(2501))
    items = spark.createDataFrame([(1, "the cat and the dog 2500")], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(rows, items, max_error=0.0).collect()) == list(range(2500))
