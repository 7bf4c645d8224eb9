"""Best-fit packing of token sequences by large-item matching, planned on a histogram of lengths.

A document over the capacity is cut into pieces of full size and a rest. Pieces above a third of
the capacity fit at most twice into a sequence: each length, largest first, is paired with the largest
other length that still fits. Smaller pieces, largest first, go to the tightest gap. Pieces of a length are
alike, so the plan is made on the counts of at most `capacity` lengths, for whole runs of equal
sequences at once, and its size does not depend on the number of documents. Each piece then finds its place by
its length and its rank among the pieces of that length, which is a sum over the tasks before
its own and a count within it.

Null and empty texts are documents of the end id alone. Repeated rows are packed each. Ties among pieces of
equal length are broken by their place in the table.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwatch.llm import bpe
from ledgerwatch.llm import text as X
from ledgerwatch.sources.tables import staged

CAPACITY, END = 4096, 1
_RANKS = 1 << 48


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, its task, and its rank in the task among its length."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long"
    into, end = X.arrow_schema(schema), np.array([END], "<u4").tobytes()

    def run(batches):
        vocabulary, task, seen = bpe.vocabulary(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for part in X.slices(batch):
                owner, piece, size, crc = [], [], [], []
                for d, ids in enumerate(vocabulary.encode(part.column("text"))):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        owner.append(d), piece.append(k), size.append(len(own) // 4), crc.append(zlib.crc32(own))
                size = np.array(size, np.int64)
                order = np.argsort(size, kind="stable")
                lengths, first, count = np.unique(size[order], return_index=True, return_counts=True)
                nth = np.empty(len(size), np.int64)
                nth[order] = np.arange(len(size)) - np.repeat(first, count) + np.repeat(seen[lengths], count)
                seen[lengths] += count
                yield X.record(
                    {"doc_id": part.column("doc_id").take(pa.array(owner, pa.int64())), "piece": piece, "start": np.array(piece, np.int64) * capacity, "length": size, "ids_crc32": crc, "task": np.full(len(size), task), "nth": nth},
                    into,
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, first sequence, pieces per sequence, offset): from this rank on, each sequence from
    the first one takes so many pieces of this length, one after the other, beginning at the offset."""
    left = {size: n for size, n in counts.items() if n}
    taken, out, total = defaultdict(int), [], 0
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left: runs (first sequence, number)
    rooms: list[int] = []

    def put(size: int, first: int, number: int, each: int, offset: int, last: int | None = None) -> None:
        out.append((size, taken[size], first, each, offset))
        taken[size] += number * each if last is None else last

    def leave(room: int, first: int, number: int) -> None:
        if room and number:
            if not gaps[room]:
                bisect.insort(rooms, room)
            gaps[room].append((first, number))

    large = sorted(size for size in left if 3 * size > capacity)
    for size in reversed(large):
        while left[size]:
            at = bisect.bisect_right(large, capacity - size) - 1
            while at >= 0 and not left[large[at]]:
                del large[at]
                at -= 1
            if at >= 0 and large[at] == size and left[size] == 1:
                # No second piece of its own length: the next smaller one.
                at -= 1
                while at >= 0 and not left[large[at]]:
                    del large[at]
                    at -= 1
            other = large[at] if at >= 0 else 0
            if other == size and left[size] > 1:
                number = left[size] // 2
                put(size, total, number, 2, 0)
                left[size] -= 2 * number
            elif other and other != size:
                number = min(left[size], left[other])
                put(size, total, number, 1, 0)
                put(other, total, number, 1, size)
                left[size] -= number
                left[other] -= number
            else:
                number, other = left[size], 0
                put(size, total, number, 1, 0)
                left[size] = 0
            leave(capacity - size - other, total, number)
            total += number
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[size]:
            at = bisect.bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                number = -(-left[size] // each)
                leave(capacity, total, number)
                total += number
                continue
            room = rooms[at]
            first, number = gaps[room].pop()
            if not gaps[room]:
                del rooms[at]
            each = room // size
            full = min(number, left[size] // each)
            if full:
                put(size, first, full, each, capacity - room)
                leave(room - each * size, first, full)
                left[size] -= full * each
            if full < number:
                rest = min(left[size], each)
                if rest:
                    put(size, first + full, 1, each, capacity - room, rest)
                    leave(room - rest * size, first + full, 1)
                    left[size] -= rest
                leave(room, first + full + bool(rest), number - full - bool(rest))
    return out


def placed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`sequence_id` and `offset` of every piece; `cut` must be read from a table, as it is read twice."""
    counts = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("before", F.coalesce(before, F.lit(0)))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = sorted(plan(histogram, capacity))
    size, rank, first, each, offset = (np.array(c, np.int64) for c in (zip(*rows, strict=True) if rows else [()] * 5))
    keys, names = size * _RANKS + rank, ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = f"doc_id {cut.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    into = X.arrow_schema(schema)

    def run(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            own = batch.column("nth").to_numpy() + batch.column("before").to_numpy()
            at = np.searchsorted(keys, length * _RANKS + own, "right") - 1
            nth = own - rank[at]
            made = {n: batch.column(n) for n in names} | {"sequence_id": first[at] + nth // each[at], "offset": offset[at] + nth % each[at] * length}
            yield X.record(made, into)

    return cut.join(counts.select("length", "task", "before"), ["length", "task"]).mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with the sequence and the offset it is packed at."""
    return placed(staged(pieces(docs, path, capacity), "pieces"), capacity)


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(spark.read.parquet(f"{folder}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))


def stage_pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
