import math
import random
import re

import numpy as np
import pytest

from ledgerwatch.llm import lexical
from tests.llm import cases
from tests.oracle import differences

TERM = re.compile("[^\\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, k):
    held = [(d, terms(t)) for d, t in docs if terms(t)]
    total, length = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, own in held:
        for t in set(own):
            df[t] = df.get(t, 0) + 1
    once = {}
    for i, text in items:
        if text is not None:
            once[i] = min(once.get(i, text), text, key=lambda s: s.encode())
    out = []
    for item, text in once.items():
        scores = []
        for doc, own in held:
            m = 75 + 25 * len(own) * total // length
            score = 0
            for t in terms(text):
                if t in own:
                    score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * own.count(t) // (1000 * own.count(t) + 12 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def test_equals_sql(spark, small):
    assert differences(lexical.op13_lexical_search(spark, small), lexical.ORACLE, small) == []


def odd():
    rng = random.Random(3)
    docs = [(i, t) for i, t in enumerate(cases.texts())] + [(100 + i, "Same words here") for i in range(40)]
    docs += [(None, "same WORDS"), (5, "one Two"), (5, "one Two"), (7, None), (8, "İK ÀÉ àé 2x"), (9, "\x00a\x00b"), (10, "x" * 50_000)]
    docs += [(200 + i, " ".join(rng.choice("ab cd ef gh one two same".split()) for _ in range(rng.randrange(1, 60)))) for i in range(150)]
    items = [(1, "Same words, same WORDS!"), (2, None), (3, "..."), (4, "ab ab one"), (5, "two"), (5, "aa two"), (None, "cd of àé À"), (6, "not there"), (7, cases.prose(3, 80)), (8, "a b x2 2x")]
    return docs, items


@pytest.mark.parametrize("postings, terms_, group", [(lexical.POSTINGS, lexical.TERMS, lexical.GROUP), (20, 5, 3), (3, 1, 1)])
def test_odd_rows(spark, postings, terms_, group):
    """Nulls, ties, copies, long texts, strata and items cut into parts."""
    docs, items = odd()
    rows = spark.createDataFrame(docs, "id long, text string").repartition(4)
    once = spark.createDataFrame([r for r in items if r != (5, "two")], "id long, text string")
    made = lexical.index(rows, None, postings)
    found = lexical.search(made, lexical.documents(once), 5, terms_, group)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(docs, items, 5)


def test_clashing_columns_and_filter(spark):
    docs, items = odd()
    names = [f"{c} string" for c in ("n", "terms", "counts", "m", "part", "id", "score", "rank")]
    rows = spark.createDataFrame([(*r, *["x"] * len(names)) for r in docs], ", ".join(["doc_id long", "text string", *names]))
    asked = spark.createDataFrame([(*r, *["x"] * len(names)) for r in items], ", ".join(["item_id long", "text string", *names]))
    assert sorted((tuple(r) for r in lexical.ranked(rows, asked).collect()), key=repr) == brute(docs, items, 20)


def test_bounds_hold_and_spare_blocks(spark, monkeypatch):
    """Blocks below the k-th score are not visited, and no score is above its bound."""
    docs, items = odd()
    made = lexical.index(spark.createDataFrame(docs, "id long, text string"), None, 20)
    asked = lexical._Asked(lexical.documents(spark.createDataFrame(items, "id long, text string")).toArrow())
    weights = np.full(len(asked.vocabulary), 1000)
    for row in made.blocks.collect():
        block = lexical._Stratum(row.asDict(), asked.vocabulary, weights)
        bounds = asked.sums(block.best)
        for i in range(len(asked.ids)):
            own = slice(asked.low[i], asked.low[i + 1])
            _, scores = block.visit(asked.places[own], asked.times[own], 1, 10**6)
            assert max(scores, default=0) <= bounds[i]
            assert len(block.visit(asked.places[own], asked.times[own], int(bounds[i]) + 1, 5)[0]) == 0


def test_a_stratum_has_one_length_and_every_document_one_block(spark):
    docs, _ = odd()
    made = lexical.index(spark.createDataFrame(docs, "id long, text string"), None, 20)
    blocks = made.blocks.collect()
    ids = sorted(int(x) for b in blocks for x in np.frombuffer(b["docs"], "<i8"))
    assert ids == sorted(lexical._NO_ID if d is None else d for d, t in docs if terms(t))
    assert len(blocks) > len({b["m"] for b in blocks}) > 3


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert lexical.ranked(none, items).count() == 0
    assert lexical.ranked(docs, items.limit(0)).count() == 0
