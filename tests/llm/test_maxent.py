import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import maxent
from tests.llm.cases import documents

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def check(rows, texts, held):
    """Counts and base score by brute force; texts: list in the order of ids."""
    counts = Counter(t for i, x in texts if not held(i) for t in tokens(x))
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for i, x in texts:
        own = tokens(x)
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        want[i, held(i), len(own), sum(counts[t] > 0 for t in own), total, round(base, 5)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows) == want


def test_base_equals_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    rows = maxent.op9_maxent_scores(spark, small).collect()
    check(rows, [tuple(r) for r in docs], lambda i: zlib.crc32(str(i).encode()) % 7 == 2)
    assert all(r["score"] < 0 for r in rows)


@pytest.mark.parametrize("entries", [1_000_000, 500])
def test_odd_rows(spark, monkeypatch, entries):
    monkeypatch.setattr(maxent, "ENTRIES", entries)
    docs = documents(spark).withColumn("held", F.coalesce(F.col("doc_id") % 3 == 2, F.lit(False)))
    rows = maxent.language_model_scores(docs).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], lambda i: i is not None and i % 3 == 2)
    assert all(math.isfinite(r["score"]) for r in rows)


def test_better_than_single_words_on_held_out_texts(spark):
    rows = [r for r in maxent.op9_maxent_scores(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_probabilities_add_up():
    """Over all classes, and within each class over its words and one unseen."""
    rng = np.random.default_rng(0)
    weights, bias = rng.normal(size=(maxent.ROWS, maxent.CLASSES)).astype(np.float32), rng.normal(size=maxent.CLASSES).astype(np.float32)
    features = rng.integers(0, maxent.ROWS, (5, 3)).astype(np.uint16)
    every = [maxent._log_softmax(weights, bias, features, np.full(5, c)) for c in range(maxent.CLASSES)]
    assert np.exp(every).sum(0) == pytest.approx(np.ones(5), abs=1e-5)
    counts = np.array([3, 1, 9])
    assert ((counts + 1) / (counts.sum() + len(counts) + 1)).sum() + 1 / (counts.sum() + len(counts) + 1) == pytest.approx(1)


def test_steps_follow_the_gradient():
    """A context that always has one class learns it; numeric and computed slopes agree in sign."""
    weights, squares, bias = np.zeros((maxent.ROWS, maxent.CLASSES), np.float32), np.zeros(maxent.ROWS, np.float32), np.zeros(maxent.CLASSES, np.float32)
    features = np.tile(np.array([[5, 9, 11], [6, 9, 12]], np.uint16), (4096, 1))
    target = np.tile([3, 7], 4096)
    for _ in range(20):
        maxent._steps(weights, squares, bias, features, target, 0.5)
    assert (np.exp(maxent._log_softmax(weights, bias, features[:2], target[:2])) > 0.9).all()


def test_without_training_texts(spark):
    docs = documents(spark).withColumn("held", F.lit(True))
    rows = maxent.language_model_scores(docs).collect()
    assert {r["train_tokens"] for r in rows} == {0} and all(r["base_score"] == 0 and r["n_known"] == 0 for r in rows)
    empty = documents(spark, []).limit(0).withColumn("held", F.lit(False))
    assert maxent.language_model_scores(empty).count() == 0


def test_features_never_share_a_row():
    """More word pairs than a fixed table of 2^14 or 2^16 rows has; the third last word counts too."""
    n = 70_000
    words = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(2654435761)
    block = maxent.Block(words, np.zeros(n, np.uint8), np.arange(n), np.array([n]), np.array([False]))
    keys = block.features()
    assert keys.shape == (n, 4) and len(np.unique(keys)) == 4 * n


@pytest.mark.parametrize("entries", [1_000_000, 50])
def test_context_tells_words_of_a_class_apart(spark, monkeypatch, entries):
    """Both words end alike, so they are of one class, and are equally frequent."""
    monkeypatch.setattr(maxent, "ENTRIES", entries)
    rows = [(k, ("left", "right")[k % 2] + " " + ("walking", "talking")[k % 2], False) for k in range(200)]
    rows += [(1000, "left walking", True), (1001, "left talking", True), (1002, "right talking", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(3)
    score = {r["doc_id"]: r["score"] for r in maxent.language_model_scores(docs).collect()}
    assert score[1000] > score[1001] + 0.5 and score[1002] > score[1001] + 0.5


def test_words_of_a_class_add_up_in_a_context():
    """After each word the counts of a class are those of its words."""
    rng = np.random.default_rng(3)
    size = rng.integers(1, 30, 40)
    codes = rng.integers(1, 9, size.sum())
    codes[np.cumsum(size) - 1] = 0
    block = maxent.Block(np.arange(5, 14, dtype=np.uint64), np.array([0, *[1 + k % 3 for k in range(8)]], np.uint8), codes, size, np.zeros(40, bool))
    w = maxent.Weights(block, None, np.arange(len(codes)))
    w.tf[np.searchsorted(w.pairs, w.own)] = w.count
    word, alike = w.share(block)
    first = np.cumsum(size) - size
    before = np.append(-1, codes[:-1])
    before[first] = -1
    pairs, kinds = Counter(zip(before, codes)), Counter(zip(before, block.classes[codes]))
    assert word.tolist() == [pairs[b, c] for b, c in zip(before, codes)]
    assert alike.tolist() == [kinds[b, c] for b, c in zip(before, block.classes[codes])]


def _learned(seed, texts=300, number=2):
    """A block of random texts over words of very different frequency, after its steps."""
    rng = np.random.default_rng(seed)
    size = rng.integers(2, 60, texts)
    codes = np.minimum(rng.zipf(1.3, size.sum()), 2000)
    codes[np.cumsum(size) - 1] = 0
    words = maxent.X.mix(np.arange(1, 2002, dtype=np.uint64))
    block = maxent.Block(words, (np.arange(2001) % maxent.CLASSES).astype(np.uint8), codes, size, np.arange(texts) % 5 == 0)
    taught = np.flatnonzero(np.repeat(~block.held, size))
    w = maxent.Weights(block, None, taught, number)
    w.learn(taught, np.zeros(maxent.CLASSES, np.float32))
    return block, w


def _by_key(w, keys, row):
    """{(range and key, class): (weight, tokens)} of one packet."""
    got = maxent._read(row["body"], row["size"])
    feature = np.repeat(keys, got["per"])
    return {(k, c): (v / maxent.SCALE, n) for k, c, v, n in zip(feature.tolist(), got["classes"].tolist(), got["value"].tolist(), got["tf"].tolist(), strict=True)}


def test_packets_are_small_and_answers_are_averages():
    """Of what two blocks send, by a plain loop; all of it takes few bytes a token."""
    blocks = [_learned(seed) for seed in (1, 2)]
    sent = [w.packets(2, at).to_pylist() for at, (_, w) in enumerate(blocks)]
    assert sum(len(r["body"]) for rows in sent for r in rows) < 12 * sum(len(b.codes) for b, _ in blocks)
    tokens, sums = Counter(), Counter()
    for _, w in blocks:
        feature = np.repeat(w.keys, w.per).tolist()
        n = Counter()
        for k, c in zip(feature, w.tf.tolist(), strict=True):
            n[k] += c
        for k, c, v, tf in zip(feature, w.kind.tolist(), w.value.tolist(), w.tf.tolist(), strict=True):
            tokens[k, c] += tf
            sums[k, c, "n"] += n[k]
            sums[k, c] += n[k] * np.clip(np.rint(v * maxent.SCALE), -127, 127) / maxent.SCALE
    for bucket in (0, 1):
        rows = [r for at in sent for r in at if r["bucket"] == bucket]
        back = maxent.answered(maxent.pa.Table.from_pylist(rows, maxent._INTO)).to_pylist()
        assert [r["block"] for r in back] == [0, 1]
        for r, (_, w) in zip(back, blocks, strict=True):
            keys = w.keys[w.keys >> np.uint64(32) == bucket]
            got, mine = _by_key(w, keys, r), set(keys.tolist())
            assert got.keys() == {p for p in tokens if p[0] in mine}
            for p, (value, tf) in got.items():
                assert value == pytest.approx(sums[p] / sums[*p, "n"], abs=0.51 / maxent.SCALE)
                assert tf == (tokens[p] if p[0] & 3 < 2 else 0)


def test_counts_beyond_a_byte_are_kept():
    per, classes, tf = np.array([2, 0, 1]), np.array([3, 60, 1]), np.array([254, 255, 1 << 40])
    got = maxent._read(maxent._body(per, classes, np.array([0.5, -1.0, 99.0]), tf, np.array([4, 9, 1 << 31], np.uint64)), 3, keyed=True)
    assert got["keys"].tolist() == [4, 9, 1 << 31] and got["per"].tolist() == [2, 0, 1] and got["classes"].tolist() == [3, 60, 1]
    assert got["tf"].tolist() == tf.tolist() and (got["value"] / maxent.SCALE).tolist() == [0.5, -1.0, 127 / maxent.SCALE]


def test_runs_are_summed():
    n = np.array([1, 5, 2, 1, 16, 3])
    values = np.random.default_rng(0).normal(size=(n.sum(), 3))
    want = [values[a : a + k].sum(0) for a, k in zip(np.cumsum(n) - n, n)]
    assert maxent._summed(values.copy(), n) == pytest.approx(np.array(want))


def test_a_unit_is_answered_once():
    """Packets of one receiver get one answer, which names each of their features once; a block reads its own from it."""
    blocks = [_learned(seed, number=3) for seed in (1, 2)]
    sent = [r for _, w in blocks for r in w.packets(3, 7).to_pylist()]
    back = []
    for bucket in range(3):
        back += maxent.answered(maxent.pa.Table.from_pylist([r for r in sent if r["bucket"] == bucket], maxent._INTO)).to_pylist()
    assert [(r["bucket"], r["block"]) for r in back] == [(0, 7), (1, 7), (2, 7)]
    keys = np.unique(np.concatenate([w.keys for _, w in blocks]))
    assert sum(r["size"] for r in back) == len(keys) < sum(len(w.keys) for _, w in blocks)
    want = {}
    for r in back:
        want |= _by_key(None, keys[keys >> np.uint64(32) == r["bucket"]], r)
    answers = maxent.Answers.of([b for b, _ in blocks], back, 3)
    for block, _ in blocks:
        w = maxent.Weights(block, answers, number=3)
        got = {}
        for f in range(0, len(w.keys), 7):
            pairs, tf = w._pairs(np.array([f]))
            some = slice(w.low[f], w.low[f] + w.per[f])
            got |= {(int(w.keys[f]), p % maxent.CLASSES): (v / maxent.SCALE, n) for p, v, n in zip(pairs.tolist(), w.value[some].tolist(), tf.tolist(), strict=True)}
        asked = set(w.keys[::7].tolist())
        assert got == {k: v for k, v in want.items() if k[0] in asked}


def test_large_counts_of_a_unit():
    block, w = _learned(5, 400, 1)
    w.tf = w.tf * 300
    answers = maxent.Answers.of([block], maxent.answered(maxent.pa.Table.from_batches([w.packets(1, 0)])).to_pylist(), 1)
    got, of = maxent.Weights(block, answers), w.keys & np.uint64(3)
    for kind in (0, 1):
        features = np.flatnonzero((of == kind) & (w.per > 0))
        assert got._pairs(features)[0].tolist() == w._pairs(features)[0].tolist()
        assert got._pairs(features)[1].tolist() == w._pairs(features)[1].tolist()


def test_units_leave_scores_as_they_are(spark, monkeypatch):
    """Blocks are the same, however they are dealt; one unit or many."""
    rows = [(k, " ".join(f"w{(k * j) % 37}x{j % 5}" for j in range(1, 60)), k % 5 == 0) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean").repartition(3, "doc_id").cache()
    monkeypatch.setattr(maxent, "BLOCK_BYTES", 2000)
    scores = []
    for size in (1 << 30, 3000):
        monkeypatch.setattr(maxent, "UNIT_BYTES", size)
        scores.append({r["doc_id"]: r["score"] for r in maxent.language_model_scores(docs).collect()})
    assert len(scores[0]) == 120 and scores[1] == pytest.approx(scores[0], rel=1e-3)


def test_steps_equal_plain_ones():
    """Weights of all pairs, of features found once and of frequent ones, by steps over whole rows of all features."""
    block, w = _learned(7, 400)
    taught = np.flatnonzero(np.repeat(~block.held, block.size))
    place, target = w.place[taught], w.target[taught].astype(np.int64)
    weights, squares = np.zeros((len(w.keys), maxent.CLASSES)), np.zeros(len(w.keys))
    seen = np.zeros(weights.shape, bool)
    seen[place, target[:, None]] = True
    for low in range(0, len(target), maxent.STEP):
        f, y = place[low : low + maxent.STEP], target[low : low + maxent.STEP]
        g = np.exp(weights[f].sum(1))
        g /= g.sum(1, keepdims=True)
        g[np.arange(len(y)), y] -= 1
        rows, n = np.unique(f, return_counts=True)
        summed = np.zeros(weights.shape)
        for k in range(4):
            np.add.at(summed, f[:, k], g)
        summed = (summed * seen)[rows]
        squares[rows] += (summed**2).sum(1) / (n * maxent.CLASSES)
        weights[rows] -= maxent.RATE * summed / np.sqrt((squares[rows] + 1e-3) * n)[:, None]
    assert len(w.pairs) == seen.sum() and w.value == pytest.approx(weights.ravel()[w.pairs], abs=1e-3)
    assert w.chosen(np.zeros(maxent.CLASSES, np.float32))[taught].shape == target.shape


def test_keys_of_a_word_are_sent_once():
    """Three keys that differ in their last two bits take hardly more than one; equal keys stay."""
    words = np.sort(np.random.default_rng(0).choice(1 << 30, 4000, replace=False)).astype(np.uint64) << np.uint64(2)
    body = lambda keys: maxent._body(np.zeros(len(keys), np.int64), *[np.zeros(0, np.int64)] * 3, keys)
    three = (words[:, None] | np.array([0, 2, 3], np.uint64)).ravel()
    assert len(body(three)) < 1.1 * len(body(words))
    twice = np.array([0, 0, 2, 3, 5, 5, 5, 7, (1 << 32) - 1], np.uint64)
    assert maxent._read(body(twice), len(twice), keyed=True)["keys"].tolist() == twice.tolist()


def test_long_runs_are_summed():
    rng = np.random.default_rng(1)
    n = np.array([maxent.LONG + 40, 1, maxent.LONG, 0 + 2, maxent.LONG + 1])
    values, at = rng.normal(size=(50, 3)), rng.integers(0, 50, n.sum())
    want = [values[at[a : a + k]].sum(0) for a, k in zip(np.cumsum(n) - n, n)]
    assert maxent._summed(values, n, at) == pytest.approx(np.array(want))


def test_features_are_listed_at_the_pace_of_a_sort():
    """Distinct pairs of words by sorting: by hashes they took forty times as long."""
    rng = np.random.default_rng(2)
    size, codes = np.full(400, 1000), rng.integers(1, 50_000, 400_000)
    codes[np.cumsum(size) - 1] = 0
    block = maxent.Block(maxent.X.mix(np.arange(50_000, dtype=np.uint64)), np.zeros(50_000, np.uint8), codes, size, np.zeros(400, bool))

    def least(work):
        took = []
        for _ in range(5):
            began = time.process_time()
            work()
            took.append(time.process_time() - began)
        return min(took)

    pairs = np.random.default_rng(3).permutation(len(codes))
    assert least(lambda: block.keys(3)) < 8 * least(lambda: np.argsort(pairs))


def test_numbers_are_sorted_with_their_places():
    for values in ([5, 1, 5, 0], [], [7], [(1 << 64) - 1, 3, 1 << 63, 3]):
        values = np.array(values, np.uint64)
        ordered, order = maxent._sorted(values)
        assert ordered.tolist() == sorted(values.tolist()) and values[order].tolist() == ordered.tolist() and sorted(order.tolist()) == [*range(len(values))]
