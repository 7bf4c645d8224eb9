import re

import numpy as np
import pyarrow as pa

from ledgerwatch.llm import text as X
from tests.llm.cases import texts


def test_words_are_runs_of_other_bytes_than_ascii_space():
    given = texts()
    w = X.words(pa.array(given, pa.string()))
    found = [w.buf[a:b].tobytes().decode() for a, b in zip(w.start, w.end, strict=True)]
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in given]
    assert found == [x for ws in want for x in ws]
    assert np.diff(w.first).tolist() == [len(ws) for ws in want]


def test_hashes_follow_the_words_alone():
    given = texts()
    one, two = (X.words(pa.array(x, pa.string())) for x in (given, given[::-1]))
    seen = {}
    for w in (one, two):
        for a, b, h in zip(w.start, w.end, w.hashes().tolist(), strict=True):
            assert seen.setdefault(w.buf[a:b].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)


def test_windows_stay_within_a_text():
    w = X.words(pa.array(["a b c", "a b c d", None, "b c d"]))
    hashed, full = w.windows(w.hashes(), 3)
    assert full.tolist() == [True, False, False, True, True, False, False, True, False, False]
    assert hashed[0] == hashed[3] and hashed[4] == hashed[7] and hashed[0] != hashed[4]


def test_slices_hold_every_row_once():
    batch = pa.RecordBatch.from_pydict({"text": texts(), "k": list(range(len(texts())))})
    parts = list(X.slices(batch, size=500))
    assert [k for p in parts for k in p.column("k").to_pylist()] == list(range(len(batch)))
    assert max(len(p) for p in parts) > 1 and len(parts) > 3
