import numpy as np
import pytest

from ledgerwatch.llm import topk
from tests.oracle import differences


def test_equals_sql(spark, small):
    assert differences(topk.op3_exact_top_k(spark, small), topk.ORACLE, small) == []


def brute(rows, asked, k):
    ints = {}
    for n, (i, v) in enumerate(rows):
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            ints[n] = (i, [int(np.floor(1024 * float(np.float32(x)))) for x in v])
    out = []
    for q in sorted({i for i, _ in ints.values() if i in asked}):
        own = min(v for i, v in ints.values() if i == q)
        scores = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in ints.values() if i != q and len(v) == len(own))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 3])
def test_odd_vectors(spark, block, monkeypatch):
    """Ties, copies, nulls, no numbers, other lengths, few candidates, one vector many times."""
    monkeypatch.setattr(topk, "CELLS", 40)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=5).astype(np.float32)]) for i in range(60)]
    rows += [(100 + i, [0.5, -0.25, 0.0, 1.0, 0.125]) for i in range(60)]
    rows += [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [float("nan")] * 5), (204, [float("inf")] * 5), (None, [1.0] * 5)]
    rows += [(300, [1.0, 2.0]), (301, [2.0, 1.0]), (302, [-3.0, 1.0]), (400, [7.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    asked = {0, 5, 7, 100, 101, 130, 200, 203, 300, 400}
    found = topk.top_k(df, df.where(df.vec_id.isin(list(asked))), k=10, block=block)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, asked, 10)


def test_large_numbers_are_exact():
    a = np.array([[2.0**40, 1.0], [2.0**40 + 1, 3.0]])
    assert topk._product(a, a % 2**20)[1, 1] == (2**40 + 1) * 1 + 9


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert topk.top_k(df, df).count() == 0
