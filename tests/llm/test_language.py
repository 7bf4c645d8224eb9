import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import language
from ledgerwatch.llm import text as X
from tests.llm.cases import documents


def kernel(a: str, b: str) -> float:
    """The normalised kernel from its definition."""

    def grams(t):
        raw = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in t.encode())
        return {raw[k : k + n] for n in (1, 2, 3) for k in range(len(raw) - n + 1)}

    x, y = grams(a), grams(b)
    return len(x & y) / np.sqrt(len(x) * len(y))


def test_scores_are_the_kernel_with_landmarks():
    given = ["der Hund und die Katze", "the cat and the dog", "le chat et le chien ou là"]
    sets = [np.unique(np.concatenate(language.grams(np.frombuffer(t.encode(), np.uint8)))) for t in given]
    model = language.fit_model(sets, ["de", "en", "fr"], most=1 << 17)
    got = model.scorer()(*X.bytes_of(pa.array(given)))
    want = np.array([[kernel(a, b) for b in given] for a in given]) @ model.weights
    assert got == pytest.approx(want, abs=1e-4)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = language.op7_language_id(spark, folder).join(truth, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == truth.count() and len(held) > 150
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark):
    docs = documents(spark)
    rows = {r["doc_id"]: r for r in language.identified(docs, language.fit(docs)).collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for i, r in rows.items():
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text[i] or "")), text[i]
        assert r["lang_pred"] in ("und", "en", "de")


def test_nothing_to_learn(spark):
    docs = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert language.fit(docs) is None
    assert {(r["lang_pred"], r["score"]) for r in language.identified(docs, None).collect()} == {("und", 0.0)}
    assert language.identified(documents(spark, []).limit(0), None).count() == 0


def test_other_columns_do_not_matter(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = language.fit(docs)
    one = language.identified(docs, model).collect()
    two = language.identified(docs.withColumns({"lang": F.lit("xx"), "source": F.lit("y")}), model).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_stage_drops_only_texts_without_language(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame([(10**9, "12 %% 34", "en", "s", 8), (10**9 + 1, None, "en", "s", 0)], docs.schema))
    kept = language.stage_language(spark, docs, small)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in docs.select("doc_id").subtract(kept.select("doc_id")).collect()} == {10**9, 10**9 + 1}


def test_stage_drops_an_unlearned_language_and_noise(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rng = np.random.default_rng(2)
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz   "), 400)) for _ in range(40)]
    script = ["".join(rng.choice([chr(c) for c in range(0x10D0, 0x10F0)] + [" "], 300)) for _ in range(20)]
    extra = spark.createDataFrame([(10**9 + k, t) for k, t in enumerate(noise + script)], "doc_id long, text string")
    known = docs.withColumn("unlearned", F.col("lang") == "fr").withColumn("lang", F.when(F.col("lang") != "fr", F.col("lang")))
    known = known.unionByName(extra, allowMissingColumns=True)
    kept = language.stage_language(spark, known, folder)
    n = {r["unlearned"]: r["n"] for r in kept.groupBy("unlearned").agg(F.count("*").alias("n")).collect()}
    every = {r["unlearned"]: r["n"] for r in known.groupBy("unlearned").agg(F.count("*").alias("n")).collect()}
    assert n.get(None, 0) == 0
    assert n.get(True, 0) < 0.1 * every[True]
    assert n[False] > 0.99 * every[False]
