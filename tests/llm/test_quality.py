import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import quality
from tests.llm.cases import documents


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    seen, covered = Counter(windows), set()
    for k, x in enumerate(windows):
        if seen[x] > 1:
            covered.update(range(k, k + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


NAMES = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()


def test_base_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    docs = docs.union(documents(spark).select(F.col("doc_id") + 10_000_000, "text"))
    rows = quality.op2_quality_rules(spark, small).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        assert tuple(r[n] for n in NAMES) == base(texts[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    odd = documents(spark)
    text = {r["doc_id"]: r["text"] for r in odd.collect()}
    for r in quality.quality_rules(odd, spark.read.parquet(f"{small}/labels.parquet")).collect():
        assert tuple(r[n] for n in NAMES) == base(text[r["doc_id"]])


def test_verdict_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = quality.op2_quality_rules(spark, folder).join(labels, "doc_id").where("not base_failed").collect()
    assert np.mean([r["kept"] == bool(r["quality"]) for r in rows]) > 0.97
    assert np.mean([r["kept"] for r in rows if r["quality"]]) > 0.99


def test_trees_keep_their_direction():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(3000, 3))
    # The truth rises in the first feature, but falls in part of its range; noise everywhere.
    y = (x[:, 0] - 0.6 * np.sin(9 * x[:, 0]) + 0.5 * x[:, 2] + rng.normal(0, 0.3, 3000) > 0.7).astype(float)
    for sign in (1, -1):
        model = quality.fit_trees(x, y, np.array([sign, 0, 0]), trees=30)
        for point in rng.uniform(size=(40, 3)):
            line = np.tile(point, (60, 1))
            line[:, 0] = np.linspace(-0.2, 1.2, 60)
            assert (sign * np.diff(model.score(line)) >= -1e-12).all()
    free = quality.fit_trees(x, y, np.zeros(3, int), trees=30)
    assert ((free.score(x) > 0.5) == y).mean() > 0.75


def test_node_arrays_equal_a_walk():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(500, 4)), rng.integers(0, 2, 500).astype(float)
    t = quality.fit_trees(x, y, np.zeros(4, int), trees=7)
    for row in x[:50]:
        total = t.start
        for node in t.roots:
            while t.feature[node] >= 0:
                node = t.left[node] + (row[t.feature[node]] > t.threshold[node])
            total += t.value[node]
        assert t.score(row[None])[0] == pytest.approx(1 / (1 + np.exp(-total)))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, 1)], [(20, 1), (21, 1)]])
def test_without_two_classes_the_base_decides(spark, rows):
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    found = quality.quality_rules(documents(spark), labels).collect()
    assert found and all(r["kept"] != r["base_failed"] for r in found)


def test_empty_documents(spark, small):
    assert quality.quality_rules(documents(spark, []).limit(0), spark.read.parquet(f"{small}/labels.parquet")).count() == 0


def test_stage_keeps_what_the_query_keeps(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = {r["doc_id"] for r in quality.op2_quality_rules(spark, small).where("kept").collect()}
    assert {r["doc_id"] for r in quality.stage_quality(spark, docs, small).collect()} == kept
    assert quality.stage_quality(spark, docs, small).columns == docs.columns
