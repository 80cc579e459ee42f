"""The stages in order on a small table, each against its operator."""

from __future__ import annotations

import importlib
import subprocess
import sys

import corpus_pipeline
from churnlens.llm import quality, simhash, toxicity
from churnlens.llm.common import written
from tests.conftest import SF_SMALL
from tests.llm.helpers import documents, labels, tuples


def test_stages_feed_one_another(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    marks = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "mixture", "packing"]
    state, kept = docs, [docs]
    for _, stage in corpus_pipeline.STAGES:
        state = written(stage(spark, state, SF_SMALL), "stage")
        kept.append(state)
    for frame in kept[:-1]:
        assert frame.dtypes == docs.dtypes
    ids = [{r.doc_id for r in f.select("doc_id").collect()} for f in kept]
    assert ids[1] == {r.doc_id for r in quality.quality_scores(docs, marks).filter("predicted = 1").collect()}
    assert ids[2] == {r.doc_id for r in toxicity.toxicity_scores(kept[1], marks).filter("predicted = 0").collect()}
    groups = simhash.brute_force([(r.doc_id, r.text) for r in kept[2].collect()])
    assert ids[3] == {d for d, c in groups.items() if d == c}
    assert ids[4] <= ids[3] and ids[5] == ids[4]
    words = lambda f: sum(len((r.text or "").split()) for r in f.collect())
    assert abs(words(kept[4]) / words(kept[3]) - 1) < 0.25
    assert corpus_pipeline.run(spark, SF_SMALL).count() == kept[5].count()


def test_copies_without_an_id_are_copies(spark):
    words = lambda g: " ".join(f"w{g}x{k}" for k in range(30))
    rows = [(7, words(1)), (8, words(1)), (None, words(1)), (None, words(1)), (None, words(2)), (None, words(2)), (None, words(3))]
    got = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, documents(spark, rows), SF_SMALL)
    assert tuples(got, "doc_id", "text") == sorted([(7, words(1)), (None, words(2)), (None, words(3))], key=repr)


def test_empty_documents(spark):
    empty = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0


def test_without_labels_nothing_is_rejected(spark, tmp_path):
    rows = [(k, f"text number {k} of a few") for k in range(6)]
    for name, marks in (("none", []), ("one-class", [(k, 0, 1) for k in range(6)])):
        labels(spark, marks).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        for stage in ("quality", "toxicity"):
            got = dict(corpus_pipeline.STAGES)[stage](spark, documents(spark, rows), f"{tmp_path}/{name}")
            assert tuples(got, "doc_id", "text") == sorted(rows, key=repr)


def test_entry_registers_every_query_and_bears_their_absence():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {n.split("_")[0] + "_" for n in names if n.startswith("op") and n[2].isdigit()}
    assert "pipeline" in names and set(entry.oracle_sql()) <= names
    code = ("import sys\n"
            "class Gone:\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('corpus_pipeline', 'churnlens.llm'): raise ModuleNotFoundError(name=name)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e\n"
            "assert e.queries() and not [n for n in e.queries() if n == 'pipeline' or n.startswith('op1_')]\n"
            "assert set(e.oracle_sql()) <= set(e.queries())\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry.__file__.rpartition("/")[0])
