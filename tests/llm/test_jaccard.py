import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from ledgerwatch.llm import jaccard
from tests.llm.cases import documents, prose


def brute(rows: list[tuple[int, str]], similarity=(4, 5)):
    """class, links per id: all pairs of full shingle sets."""
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    root, links = {i: i for i in sets}, defaultdict(set)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if similarity[1] * both >= similarity[0] * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
                if sets[a] != sets[b]:
                    links[a].add(sets[b])
                    links[b].add(sets[a])
    return {i: (find(i), len(links[i])) for i in sets}


def crowd(n: int) -> list[tuple[int, str]]:
    """Exact and near copies of a few texts in a dense group, chains, and strangers."""
    rng, rows = random.Random(5), []
    for k in range(n):
        words = prose(100 + k % 3, 120).split(" ")
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(40)}"
        rows.append((k, " ".join(words)))
    return rows + [(n + k, prose(500 + k, 60)) for k in range(40)] + [(n + 40, None), (n + 41, ""), (n + 42, "two words"), (n + 43, "two words")]


def check(spark, rows):
    found = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in found} == brute(rows)


@pytest.mark.parametrize("block", [1024, 7])
def test_equals_all_pairs(spark, monkeypatch, block):
    """With small blocks the dense groups are cut into many cells."""
    monkeypatch.setattr(jaccard, "BLOCK_CLASSES", block)
    check(spark, crowd(120))


def test_equals_all_pairs_where_broadcasts_are_off(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(jaccard, "BITS", 64)
    check(spark, crowd(40))


def test_bands_reach_the_recall():
    for similarity in (0.5, 0.8, 0.9):
        bands, rows = jaccard.banding(similarity)
        assert bands * rows <= jaccard.MOST_HASHES and 1 - (1 - similarity**rows) ** bands >= jaccard.RECALL
    with pytest.raises(ValueError, match="recall"):
        jaccard.banding(0.01)


def test_bands_meet_as_often_as_they_should():
    bands, rows = 4, 3
    rng = np.random.default_rng(1)
    hits, tries = 0, 400
    for _ in range(tries):
        shared, one, two = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (60, 20, 20))
        flat = np.concatenate([shared, one, shared, two])
        signed = jaccard.signatures(flat, np.array([0, 80, 160]), bands, rows)
        hits += bool((signed[0] == signed[1]).any())
    want = 1 - (1 - 0.6**rows) ** bands
    assert abs(hits / tries - want) < 4 * math.sqrt(want * (1 - want) / tries)


def test_odd_rows(spark):
    docs = documents(spark)
    rows = jaccard.jaccard_join(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    copies = [r for r in rows if r["n_copies"] > 1 and r["doc_id"] is not None]
    assert all(r["copy_id"] <= r["doc_id"] for r in copies) and len({r["copy_id"] for r in copies}) < len(copies)
    assert by_id[None]["n_links"] == 0
    assert jaccard.jaccard_join(documents(spark, []).limit(0)).count() == 0


def test_stage_keeps_one_of_each_class(spark):
    docs = documents(spark)
    kept = jaccard.stage_unique(spark, docs, "").collect()
    want = {r["class_id"] for r in jaccard.jaccard_join(docs).collect()}
    assert kept[0].__fields__ == docs.columns
    assert {r["doc_id"] for r in kept} == want
    assert len(kept) == len(want)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (105, 100)], "a long, b long")
    found = {r["node"]: r["root"] for r in jaccard.components(edges).collect()}
    assert found == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 105: 100}


def test_different_texts_of_one_id_and_texts_without_id(spark):
    """Each text has its own links, whatever its id."""
    one, two, three, lone = (prose(k, 100).split(" ") for k in (901, 902, 903, 904))
    near = lambda w: " ".join([*w[:-1], "other"])
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, near(one)), (3, near(two)), (None, " ".join(three)), (None, near(three)), (1, " ".join(lone))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(jaccard.jaccard_join(docs).collect(), key=str)
    assert sorted(r["n_links"] for r in found) == [0, 1, 1, 1, 1, 1, 1]
    assert {(r["doc_id"], r["class_id"]) for r in found} == {(1, 1), (2, 1), (3, 1), (None, None)}
    kept = [(r["doc_id"], r["text"]) for r in jaccard.unique(docs).collect()]
    assert sorted(k for k in kept if k[0]) == sorted([rows[0], rows[1], rows[6]])
    assert len(kept) == 4 and [k for k in kept if k[0] is None][0] in rows[4:6]
