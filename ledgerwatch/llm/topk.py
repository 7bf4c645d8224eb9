"""Exact top-k search by inner product: three phases with a uniform threshold.

Components become integers, floor(1024 x). The dimensions are split into lists, each with its part of every score.
1. Every task takes from each list the k best vectors for each query and adds up their parts; the
   k-th best sum over all tasks is a score that the result surely reaches, the cutoff.
2. The cutoffs are broadcast. A vector that reaches the cutoff has at least cutoff / lists in some list, so every task
   collects all entries from there on.
3. The scores of these entries are resolved exactly; a task passes on the k best per query that reach the cutoff, and
   the k best of all tasks are ranked.

Queries come in blocks of bounded size, each of which is one pass of all phases over the vectors. Vectors that are null or
empty, or hold null or non-finite components, and rows without an id take no part. Scores compare vectors of
equal length only. A repeated query id asks once, with the vector that sorts first; its own id is no candidate.
Repeated candidates are candidates each. Sums must fit in 64 bits.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwatch.llm import text as X

K, SCALE, LISTS = 10, 1024, 4
#: Queries per block, and scores held at a time.
BLOCK, CELLS = 4096, 1 << 20
_LEAST = -(2**62)


def integers(ids: pa.Array, vectors: pa.Array, scale: int = SCALE) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, integer components as float64) of the usable vectors, by their length."""
    size = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    ends = np.cumsum(size)
    good = (size > 0) & (bad[ends] == bad[ends - size]) & ids.is_valid().to_numpy(zero_copy_only=False)
    known = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    out = []
    for n in np.unique(size[good]):
        rows = np.flatnonzero(good & (size == n))
        out.append((known[rows], np.floor(scale * flat[(ends[rows] - n)[:, None] + np.arange(n)])))
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point while every sum is below 2^53, else in integers."""
    if len(a) and len(b) and a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max()) < 2**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _parts(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, lists: int):
    """Chunks of rows: their ids, the parts of their scores by list, and which are candidates of each query."""
    step = max(1, CELLS // max(1, len(queries)))
    cuts = np.linspace(0, vectors.shape[1], min(lists, vectors.shape[1]) + 1).astype(int)
    for low in range(0, len(ids), step):
        own = ids[low : low + step]
        yield own, [_product(vectors[low : low + step, a:b], queries[:, a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], own[:, None] != query_ids[None, :]


def _best(values: np.ndarray, k: int) -> np.ndarray:
    """The k largest of every column, in no order."""
    return values if len(values) <= k else np.partition(values, len(values) - k, axis=0)[-k:]


def _cutoffs(vectors: DataFrame, blocks: dict[int, tuple[np.ndarray, np.ndarray]], k: int, lists: int) -> DataFrame:
    """query_id, cutoff: phase one."""
    into = X.arrow_schema("query_id long, task int, sums array<long>")

    def run(batches):
        held = {n: np.full((0, len(q)), 0, np.int64) for n, (q, _) in blocks.items()}
        for batch in batches:
            for ids, rows in integers(batch.column("vec_id"), batch.column("embedding")):
                if rows.shape[1] not in blocks:
                    continue
                query_ids, queries = blocks[rows.shape[1]]
                for _, parts, allowed in _parts(ids, rows, query_ids, queries, lists):
                    listed = np.zeros(allowed.shape, bool)
                    for part in parts:
                        part = np.where(allowed, part, _LEAST)
                        least = _best(part, k).min(0)
                        listed |= part >= least[None, :]
                    sums = np.where(listed & allowed, sum(parts), _LEAST)
                    held[rows.shape[1]] = _best(np.concatenate([held[rows.shape[1]], _best(sums, k)]), k)
        for n, sums in held.items():
            if len(sums):
                known = [c[c > _LEAST] for c in sums.T]
                yield X.record({"query_id": blocks[n][0], "task": np.full(len(known), TaskContext.get().partitionId()), "sums": known}, into)

    local = vectors.mapInArrow(run, "query_id long, task int, sums array<long>")
    top = lambda: F.slice(F.sort_array(F.flatten(F.collect_list("sums")), False), 1, k).alias("sums")
    once = local.groupBy("query_id", F.expr("task div 256").alias("group")).agg(top())
    return once.groupBy("query_id").agg(top()).select("query_id", F.get("sums", F.lit(k - 1)).alias("cutoff"))


def _entries(vectors: DataFrame, blocks: dict[int, tuple[np.ndarray, np.ndarray]], cutoffs: dict[int, int], k: int, lists: int) -> DataFrame:
    """query_id, vec_id, score: phases two and three, at most k rows per query and task."""
    schema = "query_id long, vec_id long, score long"
    into = X.arrow_schema(schema)

    def keep(query: np.ndarray, vec: np.ndarray, score: np.ndarray):
        order = np.lexsort((vec, -score, query))
        query, vec, score = query[order], vec[order], score[order]
        first = np.searchsorted(query, query)
        some = np.arange(len(query)) - first < k
        return query[some], vec[some], score[some]

    def run(batches):
        held = tuple(np.zeros(0, np.int64) for _ in range(3))
        for batch in batches:
            for ids, rows in integers(batch.column("vec_id"), batch.column("embedding")):
                if rows.shape[1] not in blocks:
                    continue
                query_ids, queries = blocks[rows.shape[1]]
                least = np.array([cutoffs.get(int(q), _LEAST) for q in query_ids], np.int64)
                for own, parts, allowed in _parts(ids, rows, query_ids, queries, lists):
                    near = reduce(np.logical_or, (part * len(parts) >= least[None, :] for part in parts)) & allowed
                    at, of = np.nonzero(near)
                    score = sum(part[at, of] for part in parts)
                    some = score >= least[of]
                    held = keep(*(np.concatenate(x) for x in zip(held, (query_ids[of[some]], own[at[some]], score[some]), strict=True)))
        yield X.record(dict(zip(("query_id", "vec_id", "score"), held, strict=True)), into)

    return vectors.mapInArrow(run, schema)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, lists: int = LISTS, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of `vectors` (vec_id, embedding) for each of `queries`, ties to the smaller id."""
    vectors = vectors.select("vec_id", "embedding")
    asked = queries.where("vec_id is not null and embedding is not null").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    number = max(1, math.ceil(asked.count() / block))
    found = []
    for b in range(number):
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(number)) == b).orderBy("vec_id").toArrow()
        blocks = {v.shape[1]: (i, v) for i, v in integers(rows.column("vec_id").combine_chunks(), rows.column("embedding").combine_chunks())} if rows.num_rows else {}
        cutoffs = {r["query_id"]: r["cutoff"] for r in _cutoffs(vectors, blocks, k, lists).where("cutoff is not null").collect()}
        found.append(_entries(vectors, blocks, cutoffs, k, lists))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 10
"""
