"""A fitted model's own SQL gives the scores of the model, in Spark and in DuckDB."""

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerwatch.plans import learning, portable

TRIALS = [
    learning.Trial(0, "logistic", {"C": 1.0, "tol": 1e-6}),
    learning.Trial(1, "gbt", {"trees": 6, "depth": 4, "rate": 0.3, "bins": 32}),
    learning.Trial(2, "forest", {"trees": 5, "depth": 4, "bins": 32}),
]


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    n = F.col("id")
    df = spark.range(3000).select(
        n.cast("string").alias("transaction_id"),
        F.when(n % 37 != 0, F.pmod(n * 7919, F.lit(1000)) / 7).alias("amount"),
        F.when(n % 50 != 0, F.pmod(n * 104729, F.lit(100)) / 100).alias("ratio"),
        F.when(n % 5 == 0, "it's").when(n % 5 == 1, "B").when(n % 5 == 2, "").otherwise(F.lit(None)).alias("type"),
    )
    path = str(tmp_path_factory.mktemp("rows") / "rows")
    df.withColumn("is_fraud", F.coalesce((F.col("amount") > 80) & (F.coalesce("type", F.lit("x")) != "B"), F.lit(False)).cast("int")).write.parquet(path)
    return path


@pytest.mark.parametrize("trial", TRIALS, ids=lambda t: t.family)
def test_the_sql_of_a_trained_model_equals_its_transform(spark, rows, trial):
    df = spark.read.parquet(rows)
    model = learning.fit(df.where("transaction_id % 3 <> 0"), trial, ["type"], ["amount", "ratio"])
    # A category that the training did not see.
    df = df.unionByName(df.limit(5).withColumns({"type": F.lit("new"), "transaction_id": F.concat(F.lit("9999"), F.col("transaction_id"))}))
    own = learning.score(model, df, ["transaction_id"]).toDF("transaction_id", "p", "y")
    written = portable.portable(model)
    found = written.score(df, ["transaction_id"]).join(own, "transaction_id")
    worst, differ, n = found.agg(F.max(F.abs(F.col("probability") - F.col("p"))), F.count_if((F.col("prediction") != F.col("y")) & (F.abs(F.col("p") - 0.5) > 1e-9)), F.count(F.lit(1))).first()
    assert worst < 1e-12 and differ == 0 and n == 3005
    theirs = duckdb.sql(written.sql(f"'{rows}/*.parquet'", ["transaction_id"])).fetchall()
    mine = {r["transaction_id"]: (r["probability"], r["prediction"]) for r in written.score(spark.read.parquet(rows), ["transaction_id"]).collect()}
    assert len(theirs) == 3000
    for key, p, y in theirs:
        assert p == pytest.approx(mine[key][0], abs=1e-12) and y == mine[key][1]


def test_names_and_texts_that_engines_read_differently_are_refused():
    with pytest.raises(ValueError, match="plain name"):
        portable.scaled("a b", 0.0, 1.0)
    with pytest.raises(ValueError, match="backslash"):
        portable.is_category("a", "x\\n", "(missing)")
