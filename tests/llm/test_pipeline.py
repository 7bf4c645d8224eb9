import ast
from pathlib import Path

import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.llm import cases
from tests.oracle import differences

ROOT = Path(__file__).resolve().parents[2]


def test_stages_hand_on_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.staged(stage(spark, docs, small), name)
        assert out.schema.names == docs.schema.names
        assert 0 < out.count() <= docs.count() and out.exceptAll(docs).isEmpty()
        docs = out
    packed = corpus_pipeline.run(spark, small)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}


def test_no_document_or_column_breaks_a_stage(spark, small):
    for rows in (None, []):
        docs = cases.documents(spark, rows) if rows is None else cases.documents(spark, []).limit(0)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, small)
            assert docs.columns[:3] == ["doc_id", "text", "lang"]
        corpus_pipeline.STAGES[-1][1](spark, docs, small).count()


def test_every_number_has_one_query():
    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in queries()


@pytest.mark.parametrize("name", sorted(n for n in oracle_sql() if n.startswith("op")))
def test_equals_second_engine(spark, name):
    folder = "/root/testdata/sf0.01"
    assert differences(queries()[name](spark, folder), oracle_sql()[name], folder) == []


#: Every place where rows reach the driver, and why their number is bounded.
BOUNDED = {
    ("binary.py", "collect"): "ids of a vocabulary", ("language.py", "toPandas"): "the training sample",
    ("lexicon.py", "toPandas"): "the words of the lexicon", ("lexicon.py", "collect"): "a row per distinct count", ("maxent.py", "collect"): "one row per class or slice of the weights", ("maxent.py", "first"): "two sums",
    ("packing.py", "collect"): "one row per length", ("quality.py", "toPandas"): "the training sample", ("topk.py", "collect"): "cutoffs of a block of queries",
    ("lexical.py", "first"): "one row of totals", ("lexical.py", "toArrow"): "a part of the items, their terms, a row per term of it", ("lexical.py", "take"): "of an Arrow table",
    ("packing.py", "take"): "of an Arrow array", ("maxent.py", "take"): "of a numpy array", ("topk.py", "toArrow"): "a block of queries", ("topk.py", "count"): "a number", ("jaccard.py", "count"): "an aggregate",
}


def test_only_bounded_results_reach_the_driver():
    found = set()
    for path in (ROOT / "ledgerwatch" / "llm").glob("*.py"):
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and not (isinstance(node.func.value, ast.Name) and node.func.value.id in ("F", "w", "self", "X")):
                assert node.func.attr not in ("localCheckpoint", "crossJoin", "rdd")
                if node.func.attr in ("collect", "toPandas", "toArrow", "first", "head", "take", "toLocalIterator") or node.func.attr == "count" and not node.args:
                    found.add((path.name, node.func.attr))
    assert found <= set(BOUNDED)


def test_nothing_else_imports_this_package():
    for path in [*(ROOT / "ledgerwatch").rglob("*.py"), *(ROOT / "tests").glob("*.py"), ROOT / "bench.py"]:
        if "llm" not in path.parts:
            assert "ledgerwatch.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text(), path
