import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerwatch.llm import bpe, lexicon
from tests.llm.cases import documents, texts

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def noise(n: int) -> list[str]:
    rng = random.Random(7)
    signs = [*"abcdeTHE'strevmlld  \n\n\t\r.,!?019²½éÉßœŸİΣσς  ́日🙂\x1c\x85/-_\\\0", "<|endoftext|>", "<|startoftext|>", " 's", "'ll"]
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(50))) for _ in range(n)]


@pytest.mark.parametrize("name", FILES)
def test_ids_equal_the_library(name):
    path = public_tokenizers.path(name)
    own, library, given = bpe.Vocabulary(path), Tokenizer.from_file(path), texts() + noise(4000)
    got = [np.frombuffer(i, "<u4").tolist() for i in own.encode(pa.array(given, pa.string()))]
    assert got == [e.ids for e in library.encode_batch([t or "" for t in given], add_special_tokens=False)]


def test_decoding_equals_the_library():
    path = public_tokenizers.path(FILES[0])
    own, library = bpe.Vocabulary(path), Tokenizer.from_file(path)
    rng = random.Random(3)
    for _ in range(200):
        ids = [rng.randrange(50_257) for _ in range(rng.randrange(20))]
        assert own.decode(np.array(ids, int)).decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False)


def test_caches_may_be_dropped():
    own = bpe.Vocabulary(public_tokenizers.path(FILES[1]))
    own.kept = 3
    one = [own.encode(pa.array(texts(), pa.string())) for _ in range(3)]
    assert one[0] == one[1] == one[2]


def test_automaton_is_minimal_and_exact():
    rng = random.Random(2)
    words = sorted({bytes(rng.choice(b"abc ") for _ in range(rng.randrange(8))) for _ in range(2000)})
    ids = [np.arange(k % 4, dtype="<u4").tobytes() for k in range(len(words))]
    known = lexicon.Lexicon(lexicon.compile_lexicon(words, ids))
    asked = [*words, b"zz", b"abcabcabcabc", *(w + b"q" for w in words)]
    want = dict(zip(words, ids, strict=True))
    assert known.find(asked) == [want.get(w) for w in asked]
    arcs, final = lexicon._automaton(sorted([b"tapped", b"topped", b"tops", b"taps"]))
    reachable, stack = set(), [0]
    while stack:
        state = stack.pop()
        if state not in reachable:
            reachable.add(state)
            stack += arcs[state].values()
    # t (a|o) p (s | ped): states before and after t, after the vowel, after p, and the suffix p-e-d.
    assert len(reachable) == 7
    assert lexicon.Lexicon(lexicon.compile_lexicon([], [])).find([b"", b"a"]) == [None, None]


def test_encode_decode_round_trip(spark):
    path = public_tokenizers.path(FILES[0])
    library = Tokenizer.from_file(path)
    docs = documents(spark)
    rows = lexicon.encode_decode(docs, path, size=50).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert len(rows) >= docs.where("doc_id is not null").count()
    for r in rows:
        assert r["decoded"] == (r["text"] or "")
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(r["text"] or "", add_special_tokens=False).ids


def test_word_counts_cover_all_texts(spark, monkeypatch):
    path = public_tokenizers.path(FILES[0])
    docs = spark.createDataFrame([("a b a",), ("a\nb",), (None,), ("",)], "text string")
    counts = {bytes(r["word"]): r["count"] for r in lexicon.word_counts(docs, path).collect()}
    assert counts == {b" a": 2, b"b": 1, b"a": 1, b"\nb": 1, b" ": 1 + 1}


def test_lexicon_has_all_words_above_a_count(spark):
    path = public_tokenizers.path(FILES[1])
    docs = spark.createDataFrame([("a a a b b c c d",)], "text string")
    for size, words in ((4, {b"a", b"b", b"c", b"d"}), (3, {b"a", b"b", b"c"}), (2, {b"a"}), (1, {b"a"}), (0, set())):
        found = lexicon.Lexicon(lexicon.frequent(docs, path, size)).find([b"a", b"b", b"c", b"d"])
        assert {w for w, ids in zip([b"a", b"b", b"c", b"d"], found, strict=True) if ids is not None} == words


def test_empty_table(spark):
    docs = documents(spark, []).limit(0)
    assert lexicon.digests(docs, public_tokenizers.path(FILES[0])).count() == 0
