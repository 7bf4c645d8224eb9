"""BPE encoding and decoding with a lexicon: a minimal acyclic transducer of frequent words with their ids.

The words are the keys that `bpe` cuts texts into, counted over all rows; the `size` most frequent are
compiled. Words share prefixes and suffixes; the numbers on the arcs of a path add up to the word's place, where
its ids lie. The arrays are one block of bytes of bounded size, broadcast, which every worker puts into a
file of its own without a name and maps into memory. Words that it lacks are merged exactly.

Null is the empty text, which has no ids. Repeated rows get a row each. Texts equal to a special token get its id.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import bpe
from ledgerwatch.llm import text as X
from ledgerwatch.sources.tables import staged

#: Most words in the lexicon; distinct words a task counts before it passes them on; unseen words a worker keeps.
SIZE, HELD, KEPT = 65_536, 200_000, 200_000
_FIELDS = ("shape", "keys", "values", "target", "skip", "final", "at", "ids")
_TYPES = ("<i8", "<u8", "<i4", "<i4", "<i4", "u1", "<i8", "<u4")


def _automaton(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool]]:
    """The minimal acyclic automaton of sorted words: arcs by state, and the final states; state 0 is the start."""
    arcs: list[dict[int, int]] = [{}]
    final, register, path, before = [False], {}, [0], b""

    def close(down_to: int) -> None:
        while len(path) > down_to + 1:
            state = path.pop()
            label = before[len(path) - 1]
            same = register.setdefault((final[state], tuple(arcs[state].items())), state)
            arcs[path[-1]][label] = same
            if same != state and state == len(arcs) - 1:
                arcs.pop(), final.pop()

    for word in words:
        shared = 0
        while shared < min(len(word), len(before)) and word[shared] == before[shared]:
            shared += 1
        close(shared)
        for label in word[shared:]:
            arcs.append({}), final.append(False)
            arcs[path[-1]][label] = len(arcs) - 1
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        before = word
    close(0)
    return arcs, final


def compile_lexicon(words: list[bytes], ids: list[bytes]) -> bytes:
    """The transducer of distinct words and their ids (little-endian unsigned 32-bit numbers) as one block of bytes."""
    order = sorted(range(len(words)), key=words.__getitem__)
    arcs, final = _automaton([words[i] for i in order])
    below: dict[int, int] = {}
    stack = [0]
    while stack:
        state = stack[-1]
        open_ = [t for t in arcs[state].values() if t not in below]
        if open_:
            stack += open_
        else:
            below[stack.pop()] = final[state] + sum(below[t] for t in arcs[state].values())
    keys, target, skip = [], [], []
    for state in below:
        passed = int(final[state])
        for label, to in arcs[state].items():
            keys.append(state << 8 | label), target.append(to), skip.append(passed)
            passed += below[to]
    table = bpe.Table(np.array(keys, np.uint64), np.arange(len(keys), dtype=np.int32))
    at = np.concatenate([[0], np.cumsum([len(ids[i]) // 4 for i in order])])
    flat = np.frombuffer(b"".join(ids[i] for i in order), "<u4")
    parts = [table.keys, table.values, target, skip, final, at, flat]
    parts = [np.asarray(p, t) for p, t in zip(parts, _TYPES[1:], strict=True)]
    shape = np.array([table.bits, *(len(p) for p in parts)], "<i8")
    return b"".join(p.tobytes() + bytes(-p.nbytes % 8) for p in (shape, *parts))


class Lexicon:
    """A compiled lexicon, mapped into memory."""

    def __init__(self, block: bytes):
        file = tempfile.TemporaryFile()  # noqa: SIM115  the mapping keeps it
        file.write(block)
        file.flush()
        mapped = np.memmap(file, np.uint8, "r")
        shape = np.frombuffer(mapped, "<i8", len(_FIELDS))
        offset = shape.nbytes
        for name, kind, n in zip(_FIELDS[1:], _TYPES[1:], shape[1:].tolist(), strict=True):
            setattr(self, name, np.frombuffer(mapped, kind, n, offset))
            offset += -(-n * np.dtype(kind).itemsize // 8) * 8
        self.arcs = bpe.Table.__new__(bpe.Table)
        self.arcs.bits, self.arcs.keys, self.arcs.values = int(shape[0]), self.keys, self.values

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of each word, None where the lexicon lacks it; all words walk together, a byte at a time."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(size) - size
        raw = np.frombuffer(b"".join(words), np.uint8)
        state, place = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        going, depth = np.flatnonzero(size > 0), 0
        while len(going):
            arc = self.arcs.get((state[going] << 8 | raw[begin[going] + depth]).astype(np.uint64))
            state[going[arc < 0]] = -1
            going, arc = going[arc >= 0], arc[arc >= 0]
            place[going] += self.skip[arc]
            state[going] = self.target[arc]
            depth += 1
            going = going[size[going] > depth]
        known = (state >= 0) & (self.final[state].astype(bool) if len(self.final) else False)
        place[~known] = 0
        raw_ids, low, high = self.ids.tobytes(), 4 * self.at[place], 4 * self.at[np.minimum(place + 1, len(self.at) - 1)]
        return [raw_ids[a:b] if k else None for a, b, k in zip(low.tolist(), high.tolist(), known.tolist(), strict=True)]


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """word, count: how often each key occurs in all texts, summed in each task before the shuffle."""
    into = X.arrow_schema("word binary, count long")

    def run(batches):
        vocabulary, seen = bpe.vocabulary(path), Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(seen.keys(), into[0].type), pa.array(seen.values(), into[1].type)], schema=into)
            seen.clear()
            return out

        for batch in batches:
            for part in X.slices(batch):
                for keys in vocabulary.keys(part.column("text")):
                    seen.update(keys)
                if len(seen) > HELD:
                    yield flush()
        yield flush()

    return docs.select("text").mapInArrow(run, "word binary, count long").groupBy("word").agg(F.sum("count").alias("count"))


def frequent(docs: DataFrame, path: str, size: int = SIZE) -> bytes:
    """The compiled lexicon of the most frequent words of all texts: all above the lowest count that leaves at most `size`.

    What reaches the driver is a histogram of the counts, a row per distinct count, and the chosen words.
    """
    counted = staged(word_counts(docs, path), "words")
    cut = total = 0
    for row in counted.groupBy("count").agg(F.count("*").alias("n")).orderBy(F.desc("count")).collect():
        total += row["n"]
        if total > size:
            cut = row["count"]
            break
    top = counted.where(F.col("count") > cut).select("word").toPandas()["word"]
    words, vocabulary = [bytes(w) for w in top], bpe.Vocabulary(path)
    return compile_lexicon(words, vocabulary.encode_pieces([vocabulary.piece(w) for w in words]))


def encoder(spark: SparkSession, path: str, block: bytes):
    """A function for workers: Arrow texts -> their ids as bytes, by the lexicon first."""
    shared = spark.sparkContext.broadcast(block)

    def setup():
        vocabulary, lexicon = bpe.vocabulary(path), Lexicon(shared.value)
        vocabulary.kept = KEPT
        return vocabulary, lambda texts: vocabulary.encode(texts, lexicon.find)

    return setup


def encode_decode(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit numbers) and decoded (their bytes as text) of every text."""
    setup = encoder(docs.sparkSession, path, frequent(docs, path, size))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work():
        vocabulary, encode = setup()

        def one(part: pa.RecordBatch) -> dict:
            ids = encode(part.column("text"))
            back = [vocabulary.decode(np.frombuffer(i, "<u4")) for i in ids]
            return {"doc_id": part.column("doc_id"), "ids": ids, "decoded": [b.decode("utf-8", "replace") for b in back]}

        return one

    return X.map_slices(docs.select("doc_id", "text"), f"doc_id {kind}, ids binary, decoded string", None, setup=work)


def digests(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """`encode_decode` reduced to counts and digests where the ids are, so that no ids leave the task."""
    setup = encoder(docs.sparkSession, path, frequent(docs, path, size))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work():
        vocabulary, encode = setup()

        def one(part: pa.RecordBatch) -> dict:
            ids = encode(part.column("text"))
            flat = np.frombuffer(b"".join(ids), "<u4")
            back, n = vocabulary.decode(flat), np.array([len(i) // 4 for i in ids], np.int64)
            ends = np.concatenate([[0], np.cumsum(vocabulary.sizes[flat])])[np.concatenate([[0], np.cumsum(n)])].tolist()
            texts = (back[a:b].decode("utf-8", "replace").encode() for a, b in zip(ends[:-1], ends[1:], strict=True))
            return {
                "doc_id": part.column("doc_id"), "n_tokens": n, "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
                "decoded_sha256": [hashlib.sha256(t).hexdigest() for t in texts],
            }

        return one

    return X.map_slices(docs.select("doc_id", "text"), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", None, setup=work)


def op8_bpe_lexicon(spark: SparkSession, folder: str) -> DataFrame:
    return digests(spark.read.parquet(f"{folder}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
