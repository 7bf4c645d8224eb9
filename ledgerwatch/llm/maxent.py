"""Language-model scores by a maximum-entropy model with a class-factored softmax.

A text is its lower-cased words and one end token. Words fall into classes by their last bytes; the end is a class of its
own. P(w | h) = P(class | h) P(w | class, h): the first factor is a softmax over classes of weights of features of the
words before, the last one, the last two together, and the second and third last alone; a feature has a weight for each
class that follows it somewhere in the training texts. The second is the share of the word among the words of its class
after the same last word, drawn by `MASS` to its smoothed share in the class, with one place for all unseen words of the class.

Texts are coded once into blocks, each with a dictionary of its own, and blocks are dealt into units, in buckets by unit, so that
a join by it moves only what comes back. Counts over the corpus come from the dictionaries: every block sends its words in packets by hash, which sums
them without a row per word, and gets the totals back. Weights are summed by ranges of feature keys, as many ranges as the
tokens ask for. Every block takes gradient steps over its training texts once, from nothing on, and sends weights and counts
of its features; a range averages the weights by how often a block has the feature and answers each unit once for all its blocks,
which share most of their frequent features. So one exchange serves training and scoring. Weights travel as bytes, in steps of 1 / `SCALE`. In a block, features of many tokens have a row of a table, the
others only the pairs of feature and class that there are.

Words are told apart by 64-bit hashes, features by their range and 32 bits. Null and empty texts are the end token alone. Repeated rows count and are scored each.
Without training texts every class and word is equally new. A null id is never held out.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import text as X
from ledgerwatch.sources.tables import scratch

#: Classes; features of a block that have a whole row of weights at most, and tokens that they have at least; bytes of a word that make its class.
CLASSES, ROWS, OFTEN, SUFFIX = 64, 1 << 16, 4, 3
#: Rows of a run that are added one by one; batches of tokens whose pairs without a row are listed at a time.
LONG, LISTED = 16, 16
#: Logits whose exponentials 32 bits hold for certain, with the sum of those of all classes.
STEEP = 60
#: Bytes of text in a block and in a unit of blocks that are scored together; dictionary entries that one task counts; tokens per gradient step and scoring batch; features whose pairs are listed at a time.
BLOCK_BYTES, UNIT_BYTES, ENTRIES, STEP, BATCH, FEW = 6 << 20, 64 << 20, 1_000_000, 2048, 1024, 1 << 15
RATE, MASS, SCALE = 0.2, 4.0, 16
END = np.uint64(0x1D8AF066A1C3B2E5)
_SALTS = np.array([0x9AE16A3B2F90404F, 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x9FB21C651E98DF25], np.uint64)
#: Spark drops what a query has shuffled when the query has ended.
_DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows with packed values are large: so many bytes of them go to Python at a time.
_SENT = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
_BLOCK = "unit int, block long, doc_id array<{kind}>, held array<boolean>, size array<long>, words binary, classes binary, tf binary, codes binary"


def blocks(docs: DataFrame, units: int = 1) -> DataFrame:
    """Coded texts of (doc_id, text, held). Blocks of a part go to one unit after the other. `words` and `classes` are a block's dictionary, most frequent first; `tf` counts its training tokens."""
    schema = _BLOCK.format(kind=docs.schema["doc_id"].dataType.simpleString())
    into = X.arrow_schema(schema)

    def code(part: pa.RecordBatch, block: int, unit: int) -> pa.RecordBatch:
        w = X.words(part.column("text"), lower=True)
        size = np.diff(w.first) + 1
        hashed = np.insert(w.hashes() if len(w.start) else np.zeros(0, np.uint64), w.first[1:], END)
        ordered, at = _sorted(hashed)
        first = np.flatnonzero(_changes(ordered))
        count = np.diff(first, append=len(ordered))
        order = np.argsort(-count, kind="stable")
        place, codes = np.empty(len(order), np.uint32), np.empty(len(hashed), np.uint32)
        place[order] = np.arange(len(order))
        codes[at] = np.repeat(place, count)
        words, first = ordered[first[order]], at[first[order]]
        # A place of each distinct word in the text, for its last bytes; tokens up to there hold one end per text before.
        doc = np.searchsorted(np.cumsum(size), first, "right")
        at = np.minimum(first - doc, max(len(w.start) - 1, 0))
        suffix = np.zeros(len(words), np.uint64)
        if len(w.start):
            for k in range(SUFFIX):
                from_end = w.end[at] - 1 - k
                suffix = suffix << np.uint64(8) | np.where(from_end >= w.start[at], w.buf[np.maximum(from_end, 0)], 0).astype(np.uint64)
        classes = np.where(words == END, 0, 1 + X.mix(suffix) % np.uint64(CLASSES - 1)).astype(np.uint8)
        held = part.column("held").to_numpy(zero_copy_only=False).astype(bool)
        tf = np.bincount(codes[np.repeat(~held, size)], minlength=len(words)).astype("<u4")
        made = {
            "unit": [unit], "block": [block], "doc_id": [part.column("doc_id").to_pylist()], "held": [held.tolist()], "size": [size.tolist()],
            "words": [_steps_of(words)], "classes": [classes.tobytes()], "tf": [tf.tobytes()],
            "codes": [_packed(codes.astype("<u4"))],
        }
        return X.record(made, into)

    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in X.slices(batch, size=BLOCK_BYTES):
                yield code(part, (task << 32) + made, (task + made) % units)
                made += 1

    return docs.select("doc_id", "text", "held").mapInArrow(run, schema)


@dataclass
class Block:
    """A coded block: dictionary words and classes, and for each token its place there and in its text."""

    words: np.ndarray
    classes: np.ndarray
    codes: np.ndarray
    size: np.ndarray
    held: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, row: int) -> Block:
        raw = {n: batch.column(n)[row].as_buffer() for n in ("words", "classes", "codes")}
        codes = _unpacked(raw["codes"], "<u4").astype(np.int64)
        lists = (np.array(batch.column(n)[row].values.to_numpy(zero_copy_only=False)) for n in ("size", "held"))
        return cls(_words(raw["words"]), np.frombuffer(raw["classes"], np.uint8), codes, *lists)

    def features(self) -> np.ndarray:
        """Keys of the features of every token: last word, last two, second last, third last."""
        hashed, first, back = self.words[self.codes], np.cumsum(self.size) - self.size, []
        for k in (1, 2, 3):
            hashed = np.concatenate([hashed[:1], hashed[:-1]])
            hashed[first] = k
            back.append(hashed)
        one, two, three = back
        return np.column_stack([X.mix(x ^ s) for x, s in zip((one, one * X.GOLDEN + two, two, three), _SALTS, strict=True)])


    def _before(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Words, with one for each place before a text, and for every token the places of the last three there."""
        words, first, back = np.concatenate([self.words, np.arange(1, 4, dtype=np.uint64)]), np.cumsum(self.size) - self.size, []
        codes = self.codes
        for k in range(3):
            codes = np.concatenate([codes[:1], codes[:-1]])
            codes[first] = len(self.words) + k
            back.append(codes)
        return words, back

    def keys(self, number: int) -> np.ndarray:
        """Distinct features in order of range and key, see `places`."""
        words, (one, two, _) = self._before()
        return np.sort(_keys(words, _distinct(one * len(words) + two), number))

    def places(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct features in order of range and key, 32 bits of each, and for every token the places of its own among them.

        The dictionary names the words before a token, so only pairs of words are looked for among the tokens. The last two
        bits of a key are the kind of feature, so that those of a word lie together."""
        words, (one, two, three) = self._before()
        pairs, order = _sorted(one * len(words) + two)
        new = _changes(pairs)
        at, pairs = np.empty(len(pairs), np.int32), pairs[new].astype(np.int64)
        at[order] = np.cumsum(new, dtype=np.int32) - 1
        keys = _keys(words, pairs, number)
        low = np.cumsum([0, len(words), len(pairs), len(words)])
        keys, order = _sorted(keys)
        rank, place = np.empty(len(keys), np.int32), np.empty((len(one), 4), np.int32)
        rank[order] = np.arange(len(keys), dtype=np.int32)
        for k, (x, a) in enumerate(zip((one, at, two, three), low, strict=True)):
            place[:, k] = rank[a:][x]
        return keys, place


def _sorted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 on in order, and where they were: in one sort of both where 64 bits hold them. Equal ones may come in any order."""
    bits = max(len(values) - 1, 1).bit_length()
    if not len(values) or int(values.max()).bit_length() + bits > 64:
        order = np.argsort(values)
        return values[order], order
    both = values.astype(np.uint64) << np.uint64(bits) | np.arange(len(values), dtype=np.uint64)
    both.sort()
    order = (both & np.uint64((1 << bits) - 1)).astype(np.int64)
    both >>= np.uint64(bits)
    return both, order


def _changes(ordered: np.ndarray) -> np.ndarray:
    """Which of some numbers in order are the first of their kind."""
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return new


def _distinct(values: np.ndarray) -> np.ndarray:
    """By sorting, as hashing them takes many times as long."""
    values = np.sort(values)
    return values[_changes(values)]


def _keys(words: np.ndarray, pairs: np.ndarray, number: int) -> np.ndarray:
    """Keys of all features of words and of pairs of their places, by kind."""
    before = words[pairs // len(words)] * X.GOLDEN + words[pairs % len(words)]
    word, before = (X.mix(x ^ s) & ~np.uint64(3) for x, s in ((words, _SALTS[0]), (before, _SALTS[1])))
    keys = np.concatenate([word, before | np.uint64(1), word | np.uint64(2), word | np.uint64(3)])
    return _buckets(keys, number).astype(np.uint64) << np.uint64(32) | keys & np.uint64(0xFFFFFFFF)


def _buckets(words: np.ndarray, number: int) -> np.ndarray:
    return ((words >> np.uint64(32)) * np.uint64(number) >> np.uint64(32)).astype(np.int64)


def _packed(values: np.ndarray) -> bytes:
    """Integers byte by byte of a kind, so that bytes that are alike lie together."""
    raw = values.view("u1").reshape(len(values), -1).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(body: bytes, kind: str) -> np.ndarray:
    body = memoryview(body)
    raw = pa.decompress(body[8:], int.from_bytes(body[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, "u1").reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _steps_of(words: np.ndarray) -> bytes:
    """Hashes as steps from the one before; those of equally frequent words rise."""
    return _packed(np.diff(words, prepend=np.uint64(0)).astype("<u8"))


def _words(body: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(body, "<u8"), dtype=np.uint64)


def counts(coded: DataFrame, number: int) -> DataFrame:
    """(unit, block, bucket, totals): training counts over the corpus of a block's words of one bucket, in order of their hashes;
    and for block -1 `sums`: tokens and distinct words of each class in the bucket."""
    sends, gets = "bucket int, unit int, block long, words binary, classes binary, tf binary", "bucket int, unit int, block long, totals binary, sums array<long>"
    into, back = X.arrow_schema(sends), X.arrow_schema(gets)

    def send(batches):
        for batch in batches:
            for row in range(len(batch)):
                classes, tf = (np.frombuffer(batch.column(n)[row].as_buffer(), k) for n, k in (("classes", "u1"), ("tf", "<u4")))
                words = _words(batch.column("words")[row].as_buffer())
                order = np.argsort(words)
                words, classes, tf = words[order], classes[order], tf[order]
                some, first = np.unique(_buckets(words, number), return_index=True)
                cuts = [*zip(first, [*first[1:], len(order)], strict=True)]
                made = {"bucket": some} | {n: np.full(len(some), batch.column(n)[row].as_py()) for n in ("unit", "block")}
                made["words"] = [_steps_of(words[a:b]) for a, b in cuts]
                yield X.record(made | {n: [_packed(v[a:b]) for a, b in cuts] for n, v in (("classes", classes), ("tf", tf))}, into)

    def add(table: pa.Table) -> pa.Table:
        classes, tf = (np.concatenate([_unpacked(x, k) for x in table.column(n).to_pylist()]) for n, k in (("classes", "u1"), ("tf", "<u4")))
        words = [_words(x) for x in table.column("words").to_pylist()]
        words, sizes = np.concatenate(words), np.array([len(x) for x in words])
        _, first, at = np.unique(words, return_index=True, return_inverse=True)
        total = np.bincount(at, tf, len(first)).astype("<u8")
        kind = classes[first]
        sums = np.concatenate([np.bincount(kind, total.astype(float), CLASSES), np.bincount(kind, total > 0, CLASSES)]).astype(np.int64)
        ends = np.cumsum(sizes)
        own = total[at]
        made = {
            "bucket": [*table.column("bucket").to_pylist(), table.column("bucket")[0].as_py()], "unit": [*table.column("unit").to_pylist(), -1], "block": [*table.column("block").to_pylist(), -1],
            "totals": [*(_packed(own[b - n : b]) for b, n in zip(ends.tolist(), sizes.tolist(), strict=True)), None], "sums": [*[None] * len(sizes), sums.tolist()],
        }
        return pa.Table.from_batches([X.record(made, back)])

    sent = coded.select("unit", "block", "words", "classes", "tf").mapInArrow(send, sends)
    return sent.groupBy("bucket").applyInArrow(add, gets)


def _logits(weights: np.ndarray, bias: np.ndarray, features: np.ndarray, rare: Rare | None = None) -> np.ndarray:
    """For every token and class up to a constant of the token, so that none is too large for `exp`. Whole weights are in steps of 1 / `SCALE`. A bias for each token of a batch adds up faster than one for all."""
    z = np.take(weights, features[:, 0], axis=0)
    for k in range(1, features.shape[1]):
        z += np.take(weights, features[:, k], axis=0)
    if rare is not None:
        np.add.at(z.ravel(), rare.cell, rare.of.value[rare.own].astype(z.dtype, copy=False))
    if z.dtype.kind == "i":
        z = np.multiply(z, np.float32(1 / SCALE), dtype=np.float32)
    z += bias if bias.ndim == 1 else bias[: len(z)]
    if len(z) and max(z.max(), -z.min()) > STEEP:
        z -= z.max(1, keepdims=True)
    return z


def _log_softmax(weights: np.ndarray, bias: np.ndarray, features: np.ndarray, target: np.ndarray, rare: Rare | None = None) -> np.ndarray:
    """Natural logarithm of the probability of each target class."""
    z = _logits(weights, bias, features, rare)
    own = z[np.arange(len(z)), target]
    return own - np.log(np.exp(z, out=z) @ np.ones(z.shape[1], z.dtype))


def _summed(values: np.ndarray, n: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """Sums of runs of n of the rows `at`, all in order if there is none."""
    first, order = np.cumsum(n) - n, np.argsort(-n, kind="stable")
    out = np.empty((len(n), values.shape[1]), values.dtype)
    out[order] = _runs(values, first[order], n[order], np.arange(len(values)) if at is None else at)
    return out


def _runs(values: np.ndarray, low: np.ndarray, n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the rows at[low : low + n], the longest first: row by row for all runs at once, what long runs have beyond `LONG` as a product."""
    larger = len(n) - np.searchsorted(n[::-1], np.arange(LONG + 1), "right")
    summed = np.take(values, at[low], axis=0)
    for k, some in enumerate(larger[1:LONG].tolist(), 1):
        if not some:
            break
        summed[:some] += np.take(values, at[low[:some] + k], axis=0)
    if long := int(larger[LONG]):
        rest = n[:long] - LONG
        part = np.zeros((long, len(values)), values.dtype)
        np.add.at(part.ravel(), np.repeat(np.arange(long) * len(values), rest) + at[_spread(low[:long] + LONG, rest)], values.dtype.type(1))
        summed[:long] += part @ values
    return summed


def _steps(
    weights: np.ndarray, squares: np.ndarray, bias: np.ndarray, features: np.ndarray, target: np.ndarray, rate: float, seen: np.ndarray | None = None, rare=None, missed=None,
) -> None:
    """Gradient steps over batches of tokens, each weight row with its own pace. Only weights that `seen`, 1 or 0, marks move.

    With `rare`, which gives the other features of a batch, row 0 of the weights stands for them and stays as it is. `missed` gets the slope of every token's own class."""
    token, ones, bias = np.tile(np.arange(STEP), features.shape[1]), np.ones(weights.shape[1], weights.dtype), np.tile(bias, (min(STEP, len(target)), 1))
    for low in range(0, len(target), STEP):
        f, y = features[low : low + STEP], target[low : low + STEP]
        other = rare(low, low + len(y)) if rare else None
        g = _logits(weights, bias, f, other)
        np.exp(g, out=g)
        g *= (1 / (g @ ones))[:, None]
        cell = np.arange(0, g.size, g.shape[1]) + y
        own = g.ravel()[cell] - 1
        g.ravel()[cell] = own
        if missed is not None:
            missed[low : low + len(y)] = own
        flat = f.T.ravel()
        order = np.argsort(flat, kind="stable")
        if rare:
            order = order[np.count_nonzero(flat == 0) :]
        ranked = flat[order]
        first = np.flatnonzero(_changes(ranked))
        n = np.diff(first, append=len(ranked))
        most = np.argsort(-n, kind="stable")
        first, n = first[most], n[most]
        rows, summed = ranked[first], _runs(g, first, n, token[order] if len(y) == STEP else order % len(y))
        if seen is not None:
            summed *= np.take(seen, rows, axis=0)
        speed = squares[rows] + np.einsum("ij,ij->i", summed, summed) / (n * summed.shape[1]).astype(np.float32)
        squares[rows] = speed
        summed *= (rate / np.sqrt((speed + 1e-3) * n)).astype(np.float32)[:, None]
        weights[rows] = np.subtract(np.take(weights, rows, axis=0), summed, out=summed)
        if other is not None:
            other.move(g, rate)


#: What blocks send and units get by ranges of feature keys: `size` features and `body`, see `_body`. `block` is who gets the answer.
_PACKET = "bucket int, block long, size long, body binary"
_INTO = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("size", pa.int64()), ("body", pa.binary())])
_COMMON = 255


def _framed(parts: list[np.ndarray]) -> bytes:
    """Arrays of bytes, each compressed by itself, as they differ in what is frequent."""
    out = []
    for x in parts:
        raw = x.tobytes()
        packed = pa.compress(raw, codec="zstd", asbytes=True) if raw else raw
        out += [len(raw).to_bytes(5, "little"), len(packed).to_bytes(5, "little"), packed]
    return b"".join(out)


def _unframed(body: bytes) -> list[np.ndarray]:
    body, at, out = memoryview(body), 0, []
    while at < len(body):
        raw, packed = (int.from_bytes(body[at + k : at + k + 5], "little") for k in (0, 5))
        at += 10 + packed
        out.append(np.frombuffer(pa.decompress(body[at - packed : at], raw, codec="zstd", asbytes=True) if raw else b"", "u1"))
    return out


def _body(per: np.ndarray, classes: np.ndarray, value: np.ndarray, tf: np.ndarray, keys: np.ndarray | None = None) -> bytes:
    """One packed value: keys and the classes of each feature as steps from the one before, and their weights and training tokens, byte by byte of a kind.

    Weights are in steps of 1 / `SCALE`. Counts from 255 on are listed behind the others. Keys that differ in their last two bits only, as those
    of a word do, are one step and a bit for each; an equal key begins anew."""
    return _packet(per.astype("u1"), _class_steps(per, classes), _quantized(value), np.minimum(tf, _COMMON).astype("u1"), tf[tf >= _COMMON], keys)


def _class_steps(per: np.ndarray, classes: np.ndarray) -> np.ndarray:
    classes, first = classes.astype("u1"), (np.cumsum(per, dtype=np.int64) - per)[per > 0]
    steps = np.diff(classes, prepend=np.uint8(0))
    steps[first] = classes[first]
    return steps


def _quantized(value: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(value * SCALE), -127, 127).astype("i1")


def _packet(per: np.ndarray, steps: np.ndarray, value: np.ndarray, tf: np.ndarray, large: np.ndarray, keys: np.ndarray | None = None) -> bytes:
    """What `_body` says, of arrays that are bytes already."""
    parts = [per, steps, value, tf, large.astype("<u8")]
    if keys is not None:
        word, kind = keys >> np.uint64(2), np.uint8(1) << (keys & np.uint64(3)).astype(np.uint8)
        begin = np.flatnonzero(_changes(word) | ~_changes(keys))
        raw = np.diff(word[begin], prepend=np.uint64(0)).astype("<u4").view("u1").reshape(-1, 4).T
        parts = [raw[:2], raw[2:], np.bitwise_or.reduceat(kind, begin) if len(begin) else kind, *parts]
    return _framed(parts)


def _read(body: bytes, size: int, keyed: bool = False) -> dict[str, np.ndarray]:
    got, parts = {}, _unframed(body)
    if keyed:
        raw = np.concatenate(parts[:2]).reshape(4, -1)
        word = np.cumsum(np.ascontiguousarray(raw.T).view("<u4").ravel(), dtype=np.uint32)
        at, kind = np.nonzero(parts[2][:, None] >> np.arange(4, dtype=np.uint8) & np.uint8(1))
        got["keys"], parts = word[at] << np.uint32(2) | kind.astype(np.uint32), parts[3:]
    got["per"], steps, value, tf, large = parts
    per = got["per"]
    got["classes"], first = np.cumsum(steps, dtype="u1"), (np.cumsum(per, dtype=np.int64) - per)[per > 0]
    got["classes"] -= np.repeat(got["classes"][first] - steps[first], per[per > 0])
    got["value"], got["tf"] = value.view("i1"), tf.astype("<u4")
    if len(large):
        got["tf"] = got["tf"].astype(np.int64)
        got["tf"][tf == _COMMON] = np.frombuffer(large.tobytes(), "<u8")
    return got


def _slices(features: np.ndarray) -> list[np.ndarray]:
    """As many features at a time as keep their pairs small."""
    return [features[a : a + FEW] for a in range(0, len(features), FEW)]


def _spread(low: np.ndarray, per: np.ndarray) -> np.ndarray:
    """The places low, low + 1, ... of each of several runs."""
    return np.repeat(low - np.cumsum(per) + per, per) + np.arange(per.sum())


def answered(table: pa.Table) -> pa.Table:
    """Weights of a range of features, averaged over the packets by the training tokens each has, and for every receiver, once, those of the features in its packets."""
    got = [_read(b.as_py(), n, keyed=True) for b, n in zip(table.column("body"), table.column("size").to_pylist(), strict=True)]
    per, classes, value, tf, keys = (np.concatenate([g.pop(n) for g in got]) for n in ("per", "classes", "value", "tf", "keys"))
    per = per.astype(np.int64)
    ordered, order = _sorted(keys)
    new = _changes(ordered)
    keys, place = ordered[new].astype(np.uint32), np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    own = np.repeat(np.add.reduceat(np.append(tf, 0).astype(np.int64), np.cumsum(per) - per), per)
    pairs, order = _sorted(np.repeat(place, per) * CLASSES + classes)
    first = np.flatnonzero(_changes(pairs))
    pairs, own = pairs[first].astype(np.int64), own[order]
    total = lambda x: np.add.reduceat(x, first) if len(first) else x
    value = total(own * value[order]) / SCALE / np.maximum(total(own), 1)
    tf, per = total(tf[order].astype(np.int64)), np.bincount(pairs // CLASSES, minlength=len(keys))
    # Shares are of words after the last one or two, which are kinds 0 and 1.
    tf[np.repeat(keys & np.uint32(3), per) > 1] = 0
    low, steps, value, common = np.cumsum(per) - per, _class_steps(per, pairs % CLASSES), _quantized(value), np.minimum(tf, _COMMON).astype("u1")
    many = len(tf) and tf.max() >= _COMMON
    to = table.column("block").to_numpy()
    receivers = np.sort(to)
    receivers = receivers[_changes(receivers)]
    mine = _distinct(np.repeat(np.searchsorted(receivers, to), table.column("size").to_numpy()) * len(keys) + place)
    cuts = np.searchsorted(mine, np.arange(len(receivers) + 1) * len(keys)).tolist()
    made = {"block": receivers, "size": [], "body": []}
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        whose = mine[a:b] - k * len(keys)
        some = _spread(low[whose], per[whose])
        made["size"].append(b - a)
        made["body"].append(_packet(per[whose].astype("u1"), steps[some], value[some], common[some], tf[some[common[some] == _COMMON]] if many else tf[:0]))
    return pa.Table.from_batches([X.record(made | {"bucket": np.full(len(made["size"]), table.column("bucket")[0].as_py())}, _INTO)])


def _returned() -> None:
    """Gives memory that is free back to the system, where the C library can: a worker keeps pages else, and two of them live beside Spark's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None
    if trim is not None:
        trim(0)


class _Grown:
    """Numbers that come in parts, in one array that grows in place."""

    def __init__(self, kind):
        self.values, self.size = np.zeros(1 << 16, kind), 0

    def add(self, part: np.ndarray) -> None:
        if self.size + len(part) > len(self.values):
            self.values.resize((self.size + len(part)) * 5 // 4, refcheck=False)
        self.values[self.size : self.size + len(part)] = part
        self.size += len(part)

    def all(self) -> np.ndarray:
        self.values.resize(self.size, refcheck=False)
        return self.values


@dataclass
class Answers:
    """Averaged weights and counts of all features of a unit, in order of range and key. Feature k has the pairs low[k] to low[k + 1].

    The features of range r begin at start[r]. Counts from 255 on are in `large`, at the pairs `where`."""

    start: np.ndarray
    keys: np.ndarray
    low: np.ndarray
    kind: np.ndarray
    value: np.ndarray
    tf: np.ndarray
    where: np.ndarray
    large: np.ndarray

    @classmethod
    def of(cls, blocks: Iterable[Block], parts: Iterable[dict], number: int) -> Answers:
        """`parts` are the unit's packets in order of range; the blocks name the features, as the packets leave keys out."""
        each = []
        for block in blocks:
            keys = block.keys(number)
            each.append((np.searchsorted(keys, _starts(number)).tolist(), (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)))
        made = [_distinct(np.concatenate([keys[at[r] : at[r + 1]] for at, keys in each])) for r in range(number)]
        start, keys = np.cumsum([0, *map(len, made)]), np.concatenate(made)
        del each, made
        _returned()
        got, large = {n: _Grown(np.uint8) for n in ("per", "classes", "value", "tf")}, []
        for part in parts:
            read = _read(part["body"], part["size"])
            large.append(read["tf"][read["tf"] >= _COMMON].astype(np.int64))
            read["tf"] = np.minimum(read["tf"], _COMMON).astype("u1")
            for n, values in got.items():
                values.add(read[n].view("u1"))
        per, kind, value, tf = (got.pop(n).all() for n in ("per", "classes", "value", "tf"))
        low = np.zeros(len(keys) + 1, np.int32 if len(kind) < 1 << 31 else np.int64)
        np.cumsum(per, dtype=low.dtype, out=low[1:])
        made = cls(start, keys, low, kind, value.view("i1"), tf, np.flatnonzero(tf == _COMMON), np.concatenate(large) if large else np.zeros(0, np.int64))
        del per, kind, value, tf
        _returned()
        return made

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Where sorted features are among all."""
        cuts = np.searchsorted(keys, _starts(len(self.start) - 1)).tolist()
        own = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return np.concatenate([a + np.searchsorted(self.keys[a:b], own[c:d]) for a, b, c, d in zip(self.start[:-1], self.start[1:], cuts[:-1], cuts[1:], strict=True)])


def _starts(number: int) -> np.ndarray:
    return np.arange(number + 1, dtype=np.uint64) << np.uint64(32)


class Weights:
    """Weights and training counts of the features of a block: its own, from nothing on, or those that its unit was answered.

    Feature k has the pairs low[k] to low[k] + per[k]. `pairs` are feature places times CLASSES plus class, in order."""

    def __init__(self, block: Block, answers: Answers | None = None, taught: np.ndarray | None = None, number: int = 1):
        self.keys, self.place = block.places(number)
        self.target = block.classes[block.codes]
        self.own, self.count, self.answers = np.zeros(0, np.int64), np.zeros(0, np.int64), answers
        if answers:
            at = answers.places(self.keys)
            self.low, self.per = answers.low[at], answers.low[at + 1] - answers.low[at]
            self.kind, self.value, self.tf = answers.kind, answers.value, answers.tf
        else:
            if taught is not None:
                self.own, self.count = np.unique(self.place[taught] * np.int32(CLASSES) + self.target[taught, None].astype(np.int32), return_counts=True)
            self.per, self.kind = np.bincount(self.own // CLASSES, minlength=len(self.keys)), (self.own % CLASSES).astype(np.uint8)
            self.value, self.tf = np.zeros(len(self.own), np.float32), np.zeros(len(self.own), np.int64)
            self.low = np.cumsum(np.append(0, self.per), dtype=np.int64)

    @property
    def pairs(self) -> np.ndarray:
        return self._pairs(np.arange(len(self.keys)))[0]

    def _pairs(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of some features, and their training counts."""
        per = self.per[features]
        some = _spread(self.low[features], per)
        tf = self.tf[some].astype(np.int64)
        if self.answers:
            many = np.flatnonzero(tf == _COMMON)
            tf[many] = self.answers.large[np.searchsorted(self.answers.where, some[many])]
        return np.repeat(features.astype(np.int32) * np.int32(CLASSES), per) + self.kind[some], tf

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of weights for the features with the most tokens, or where there are answers, most tokens times pairs, and the row of every feature.

        Row 0 is empty and stands for the others, as most of the features have few classes. Answers stay whole numbers, in twice the rows."""
        n = np.bincount(self.place.ravel(), minlength=len(self.keys))
        use, least, rows = (n * self.per, OFTEN, 2 * ROWS) if self.answers else (n, OFTEN, ROWS)
        if len(use) >= rows:
            least = max(least, int(np.partition(use, len(use) - rows + 1)[len(use) - rows + 1]))
        common = np.flatnonzero(use >= least)
        common = common[np.argsort(-use[common], kind="stable")[: rows - 1]]
        row = np.zeros(len(self.keys), np.int32 if self.answers else np.uint16)
        row[common] = np.arange(1, len(common) + 1)
        del n, use, common
        some = np.flatnonzero(row)
        table = np.zeros((len(some) + 1, CLASSES), np.int16 if self.answers else np.float32)
        for few in _slices(some):
            held = self._held(few)
            table.ravel()[self._cells(row, few, held)] = self.value[held]
        return table, row

    def _held(self, features: np.ndarray) -> np.ndarray:
        return _spread(self.low[features], self.per[features])

    def _cells(self, row: np.ndarray, features: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Where the pairs of features with a row are in the table."""
        return np.repeat(row[features].astype(np.int64) * CLASSES, self.per[features]) + self.kind[held]

    def learn(self, taught: np.ndarray, bias: np.ndarray, rate: float = RATE) -> None:
        """Gradient steps over the tokens `taught`, in their order, and their counts."""
        table, row = self.table()
        held = self._held(some := np.flatnonzero(row))
        at = self._cells(row, some, held)
        seen = np.zeros(table.shape, np.float32)
        seen.ravel()[at] = 1
        self.squares, self.sums, self.seen = (np.zeros(k, np.float32) for k in (len(self.keys), len(self.kind), len(self.keys)))
        place, target = np.take(self.place, taught, axis=0), self.target[taught]
        rows = row[place]
        # A feature of one token has no weight when its token comes, and one step from there.
        n = np.bincount(self.own // CLASSES, self.count, len(self.keys))
        missed = np.empty(len(taught), np.float32)
        _steps(table, np.zeros(len(table), np.float32), bias, rows, target, rate, seen, Rares(self, place, (row == 0) & (n > 1), STEP), missed)
        once = (row == 0) & (n == 1)
        for column in place.T:
            token = np.flatnonzero(once[column])
            slope = missed[token]
            self.value[self.low[column[token]]] = -rate / np.sqrt(slope * slope / np.float32(CLASSES) + 1e-3) * slope
        self.value[held] = table.ravel()[at]
        self.tf = self.count

    def chosen(self, bias: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of every token's class."""
        table, row = self.table()
        out, rare = np.empty(len(self.target)), Rares(self, self.place, (row == 0) & (self.per > 0), BATCH)
        bias = np.tile(bias, (BATCH, 1))
        for low in range(0, len(out), BATCH):
            some = slice(low, low + BATCH)
            out[some] = _log_softmax(table, bias, row[self.place[some]], self.target[some], rare(low, low + BATCH))
        return out

    def packets(self, number: int, block: int) -> pa.RecordBatch:
        """What the block has learned, by ranges; features that only texts held out have are asked for with it."""
        bucket, per = (self.keys >> np.uint64(32)).astype(np.int64), self.per
        some, first = np.unique(bucket, return_index=True)
        cuts, bodies = [*first.tolist(), len(bucket)], []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            c, d = self.low[a], self.low[b]
            bodies.append(_body(per[a:b], self.kind[c:d], self.value[c:d], self.tf[c:d], self.keys[a:b] & np.uint64(0xFFFFFFFF)))
        return X.record({"bucket": some, "block": np.full(len(some), block), "size": np.diff(cuts), "body": bodies}, _INTO)

    def share(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of each word after the one before it, and of its class there."""
        own, order = _sorted(self.place[:, 0].astype(np.int64) * CLASSES + self.target)
        new, back = _changes(own), np.empty(len(own), np.int32)
        own, back[order] = own[new].astype(np.int32), np.cumsum(new, dtype=np.int32) - 1
        kind, total, of = np.zeros(len(own), np.int64), np.zeros(len(self.keys), np.int64), self.keys & np.uint64(3)
        for few in _slices(np.flatnonzero(of == 0)):
            pairs, tf = self._pairs(few)
            some = slice(*np.searchsorted(own, [few[0] * CLASSES, (few[-1] + 1) * CLASSES]))
            at = np.minimum(np.searchsorted(pairs, own[some]), max(len(pairs) - 1, 0))
            kind[some] = np.where(pairs[at] == own[some], tf[at], 0) if len(pairs) else 0
        for few in _slices(np.flatnonzero(of == 1)):
            ends, tf = np.cumsum(self.per[few]), np.cumsum(np.append(0, self._pairs(few)[1]))
            total[few] = tf[ends] - tf[ends - self.per[few]]
        kind = kind[back]
        # The word and the one before it are the last two of the next token; the end has no next and is alone in its class.
        word = np.append(total[self.place[1:, 1]], 0)
        last = np.cumsum(block.size) - 1
        word[last] = kind[last]
        return word, kind


class Rares:
    """The pairs of features that have no row in the table of weights, for batches of tokens one after the other. `which` marks the features."""

    def __init__(self, of: Weights, place: np.ndarray, which: np.ndarray, step: int):
        self.of, self.place, self.which, self.many, self.low = of, place, which, step * LISTED, -1

    def __call__(self, low: int, high: int) -> Rare:
        if self.low < 0 or low >= self.low + self.many:
            self._list(low)
        a, b = np.searchsorted(self.token, [low - self.low, high - self.low])
        c, d = self.ends[a], self.ends[b]
        return Rare(self.of, self.features[a:b], self.per[a:b], self.own[c:d], self.cell[c:d] - (low - self.low) * CLASSES)

    def _list(self, low: int) -> None:
        self.low, place = low, self.place[low : low + self.many]
        self.token, column = np.nonzero(self.which[place])
        self.features = place[self.token, column]
        self.per = per = self.of.per[self.features]
        self.ends = np.append(0, np.cumsum(per))
        self.own = _spread(self.of.low[self.features], per)
        self.cell = np.repeat(self.token * CLASSES, per)
        self.cell += self.of.kind[self.own]


@dataclass
class Rare:
    """Features of some tokens without a row, how many pairs each has, their places, and where each counts among tokens and classes."""

    of: Weights
    features: np.ndarray
    per: np.ndarray
    own: np.ndarray
    cell: np.ndarray

    def move(self, g: np.ndarray, rate: float) -> None:
        """One gradient step. A feature found several times has the same new values each time."""
        of, each = self.of, np.repeat(self.features, self.per)
        np.add.at(of.seen, self.features, np.ones(len(self.features), np.float32))
        np.add.at(of.sums, self.own, g.ravel()[self.cell])
        n = of.seen[each]
        slope = of.sums[self.own] / np.sqrt(n)
        np.add.at(of.squares, each, slope * slope / (n * CLASSES))
        of.value[self.own] = of.value[self.own] - rate / np.sqrt(of.squares[each] + 1e-3) * slope
        of.seen[self.features], of.sums[self.own] = 0, 0


def train(coded: DataFrame, number: int, bias: np.ndarray) -> DataFrame:
    """For every unit, as `block`, the weights and counts of its features after one pass over all training tokens, in packets by range.

    A block takes its steps from nothing on; the weights of the blocks are averaged and sent back in one exchange."""

    def step(batches):
        for batch in batches:
            for row in range(len(batch)):
                block = Block.of(batch, row)
                taught = np.flatnonzero(np.repeat(~block.held, block.size))
                w = Weights(block, None, taught, number)
                w.learn(taught, bias)
                made = w.packets(number, batch.column("unit")[row].as_py())
                del block, taught, w
                _returned()
                yield made

    sent = coded.select("unit", "held", "size", "words", "classes", "codes").mapInArrow(step, _PACKET)
    return sent.groupBy("bucket").applyInArrow(answered, _PACKET)


def score(coded: DataFrame, counted: DataFrame, weights: DataFrame, ranges: int, class_tokens: np.ndarray, class_words: np.ndarray) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text; `weights` are packets by unit."""
    kind = coded.schema["doc_id"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    into, bias = X.arrow_schema(schema), _bias(class_tokens)
    total, distinct = int(class_tokens.sum()), int(class_words.sum())
    places = class_tokens + class_words + 1.0

    def one(batch: pa.RecordBatch, row: int, totals: list, answers: Answers) -> pa.RecordBatch:
        block = Block.of(batch, row)
        order = np.argsort(block.words)
        own = np.empty(len(order))
        own[order] = np.concatenate([_unpacked(p, "<u8") for p in totals])
        gain, classes = np.log10(own + 1), block.classes.astype(np.int64)
        w = Weights(block, answers, number=ranges)
        chosen = w.chosen(bias)
        word, alike = w.share(block)
        within = np.log10((word + MASS * ((own + 1) / places[classes])[block.codes]) / (alike + MASS))
        first = np.cumsum(block.size) - block.size
        per = lambda values: np.add.reduceat(values, first)  # noqa: E731  every text has its end token
        made = {
            "doc_id": batch.column("doc_id")[row].values, "held_out": block.held, "n_tokens": block.size, "n_known": per((own > 0)[block.codes].astype(np.int64)),
            "train_tokens": np.full(len(first), total), "base_score": per((gain - np.log10(total + distinct + 1.0))[block.codes]),
            "score": per(within + chosen / np.log(10)),
        }
        return X.record(made, into)

    def run(own: pa.Table, sent: pa.Table) -> pa.Table:
        rows = [(batch, row) for batch in own.to_batches() for row in range(len(batch))]
        block, bucket, size = (sent.column(n).to_numpy() for n in ("block", "bucket", "size"))
        body, order = lambda at: sent.column("body")[at].as_py(), np.argsort(bucket)
        parts = ({"size": int(size[k]), "body": body(k)} for k in order[block[order] < 0].tolist())
        answers = Answers.of((Block.of(*x) for x in rows), parts, ranges)
        totals = lambda batch, row: [body(k) for k in order[block[order] == batch.column("block")[row].as_py()].tolist()]
        return pa.Table.from_batches([one(*x, totals(*x), answers) for x in rows], into)

    totals = counted.where("block >= 0").select("unit", "block", "bucket", F.lit(0).cast("long").alias("size"), F.col("totals").alias("body"))
    sent = totals.unionAll(weights.select(F.col("block").cast("int").alias("unit"), F.lit(-1).cast("long").alias("block"), "bucket", "size", "body"))
    return coded.drop("tf").groupBy("unit").cogroup(sent.groupBy("unit")).applyInArrow(run, schema)


def _bias(class_tokens: np.ndarray) -> np.ndarray:
    return np.log((class_tokens + 1.0) / (class_tokens.sum() + len(class_tokens))).astype(np.float32)


def _stored(df: DataFrame, name: str, key: str | None = None, conf: dict = _SENT) -> DataFrame:
    """Written and read back, tightly packed: the blocks are about as large as the texts. What was shuffled for it is dropped.

    With `key` in as many buckets as a shuffle has partitions, dealt by the tasks that make the rows: a join by it moves only the other side."""
    spark, folder = df.sparkSession, scratch(df.sparkSession, name)
    conf = conf | {_DROP: "true"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        writer = df.write.option("compression", "zstd")
        if key is None:
            writer.parquet(folder)
            return spark.read.parquet(folder)
        table = folder.rsplit("/", 1)[1].replace("-", "_")
        writer.format("parquet").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", folder).saveAsTable(table)
        return spark.table(table)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def language_model_scores(docs: DataFrame) -> DataFrame:
    """Scores of (doc_id, text, held) under a model of the texts that are not held."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    units = max(1, -(-size // UNIT_BYTES), min(-(-size // BLOCK_BYTES), spark.sparkContext.defaultParallelism))
    folder = _stored(blocks(docs, units), "coded", "unit", {})
    size = folder.agg(F.sum(F.length("classes")).alias("entries"), F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda a, x: a + x)).alias("tokens")).first()
    number = max(1, -(-(size["entries"] or 0) // ENTRIES))
    counted = _stored(counts(folder, number), "counts")
    sums = {r["pos"]: r["n"] for r in counted.where("block < 0").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("n")).collect()}
    tokens, words = (np.array([sums.get(k + at, 0) for k in range(CLASSES)], np.int64) for at in (0, CLASSES))
    ranges = max(1, -(-(size["tokens"] or 0) * 2 // ENTRIES))
    return _stored(score(folder, counted, train(folder, ranges, _bias(tokens)), ranges, tokens, words), "scores")


def op9_maxent_scores(spark: SparkSession, folder: str) -> DataFrame:
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2, F.lit(False))
    return language_model_scores(spark.read.parquet(f"{folder}/documents.parquet").withColumn("held", held))
