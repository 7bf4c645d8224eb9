"""Ranked lexical search over a length-stratified index.

A term is a run of letters, digits and characters beyond ASCII, with A-Z lower-cased. A document's score sums, over the terms of
the item, w x (10^9 tf div (1000 tf + 12 m)), where m depends on its length alone. Documents of equal m form a
stratum; within it the postings of a term are grouped by tf, so that a tf has one impact for all its documents. A stratum of more than
POSTINGS postings is cut into blocks by row, so a length that a third of all documents share is many blocks.

For an item each block has a bound: the sum of the best impacts of its terms there. A task reads blocks in groups of bounded
size, visits those of a group from the highest bound down, and stops once a bound is below the k-th best score it holds. The best k of
each task are ranked.

Terms are told apart by 64-bit hashes; those of up to eight bytes and equal length never collide. Null texts have no term, and
documents without one take no part. A null doc_id ranks after all others. Repeated rows are documents each. An item
id that is repeated asks once, with the text that sorts first; null is an item id too. Items without terms find nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwatch.llm import text as X
from ledgerwatch.sources.tables import staged

K = 20
#: Postings in a block; blocks and bytes that a task holds at a time.
POSTINGS, GROUP, GROUP_BYTES = 1 << 20, 256, 64 << 20
#: Terms of the items that are searched at once, and terms that a filter of the index may have.
TERMS, FILTER = 1 << 17, 1 << 20
#: Bytes between terms: ASCII other than letters and digits.
BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_NO_ID = 2**63 - 1
_DOCS = "id long, n long, terms binary, counts binary"
_BLOCK = "m long, docs binary, terms binary, first binary, tf binary, at binary, posts binary"
_LEAST = 1


def _binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Rows of bytes of an array, cut after each of `ends`."""
    offsets = np.concatenate([[0], ends]).astype(np.int32) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def documents(rows: DataFrame, terms: np.ndarray | None = None) -> DataFrame:
    """id, n, and the distinct terms with their counts, of each row (id, text) that has a term; `terms` (sorted) limits which are kept, not n."""

    def work(part: pa.RecordBatch) -> dict:
        found = X.words(part.column("text"), lower=True, between=BETWEEN)
        n, hashed, doc = np.diff(found.first), found.hashes(), found.doc
        if terms is not None:
            some = _places(terms, hashed) >= 0
            hashed, doc = hashed[some], doc[some]
        order = np.lexsort((hashed, doc))
        hashed, doc = hashed[order], doc[order]
        new = np.ones(len(hashed), bool)
        new[1:] = (hashed[1:] != hashed[:-1]) | (doc[1:] != doc[:-1])
        begins = np.flatnonzero(new)
        counts = np.diff(np.append(begins, len(hashed))).astype(np.uint32)
        ends = np.searchsorted(doc[begins], np.arange(len(n)), "right")
        some = pa.array(n > 0)
        made = {"id": part.column("id"), "n": pa.array(n), "terms": _binaries(hashed[begins], ends), "counts": _binaries(counts, ends)}
        return {name: column.filter(some) for name, column in made.items()}

    return X.map_slices(rows.select(F.coalesce("id", F.lit(_NO_ID)).alias("id"), "text"), _DOCS, work)


def _places(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where each asked value is in a sorted array, -1 if it is not there."""
    at = np.minimum(np.searchsorted(known, asked), max(len(known) - 1, 0))
    return np.where(known[at] == asked, at, -1) if len(known) else np.full(len(asked), -1)


def _joined(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in rows of bytes, and how many each row has."""
    whole = column.combine_chunks()
    whole = whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole
    raw, at = X.bytes_of(whole)
    return raw.view(kind), np.diff(at) // np.dtype(kind).itemsize


def _block(rows: pa.Table) -> pa.Table:
    """The postings of a block's documents: by term, then by falling tf, then by document."""
    rows = rows.take(pc.sort_indices(rows["id"]))
    terms, held = _joined(rows["terms"], "<u8")
    tf, _ = _joined(rows["counts"], "<u4")
    post = np.repeat(np.arange(len(held), dtype=np.uint32), held)
    order = np.lexsort((post, -tf.astype(np.int64), terms))
    terms, tf, post = terms[order], tf[order], post[order]
    level, term = np.ones(len(terms), bool), np.ones(len(terms), bool)
    term[1:] = terms[1:] != terms[:-1]
    level[1:] = term[1:] | (tf[1:] != tf[:-1])
    at, starts = np.flatnonzero(level), np.flatnonzero(term)
    first = np.append(np.searchsorted(at, starts), len(at))
    made = {
        "m": [rows["m"][0].as_py()], "docs": [rows["id"].to_numpy().astype("<i8").tobytes()], "terms": [terms[starts].tobytes()],
        "first": [first.astype("<u4").tobytes()], "tf": [tf[at].tobytes()], "at": [np.append(at, len(terms)).astype("<u4").tobytes()], "posts": [post.tobytes()],
    }
    return pa.table({name: pa.array(value, pa.int64() if name == "m" else pa.binary()) for name, value in made.items()})


@dataclass
class Index:
    """Blocks of strata, and how many documents and terms there are in all."""

    blocks: DataFrame
    documents: int
    terms: int


def index(rows: DataFrame, terms: np.ndarray | None = None, postings: int = POSTINGS) -> Index:
    """The index of all rows (id, text), of all terms or of those given."""
    docs = staged(documents(rows, terms), "lexical")
    totals = docs.agg(F.count("n").alias("documents"), F.sum("n").alias("terms")).first()  # one row
    many, length = totals["documents"], totals["terms"] or 1
    docs = docs.withColumn("m", F.expr(f"75L + (25L * n * {many}L) div {length}L"))
    sizes = docs.groupBy("m").agg((F.sum(F.octet_length("terms")) / 8).alias("size")).where(F.col("size") > postings)
    # At most one row per `postings` postings.
    cut = docs.join(F.broadcast(sizes.select("m", F.ceil(F.col("size") / postings).alias("parts"))), "m", "left")
    part = F.pmod(F.monotonically_increasing_id(), F.coalesce("parts", F.lit(1)))
    made = cut.withColumn("part", part).select("m", "part", "id", "terms", "counts").groupBy("m", "part").applyInArrow(_block, _BLOCK)
    return Index(staged(made, "lexical_index"), many, totals["terms"] or 0)


class _Asked:
    """The items of one search: item i has the terms low[i]:low[i + 1] of `places` in the vocabulary, each `times` times."""

    def __init__(self, items: pa.Table):
        self.ids = items["id"].to_numpy()
        terms, held = _joined(items["terms"], "<u8")
        self.times = _joined(items["counts"], "<u4")[0].astype(np.int64)
        self.vocabulary, self.places = np.unique(terms, return_inverse=True)
        self.low = np.concatenate([[0], np.cumsum(held)])

    def sums(self, per_term: np.ndarray) -> np.ndarray:
        """The sum over the terms of each item, repeats included."""
        total = np.concatenate([[0], np.cumsum(self.times * per_term[self.places])])
        return total[self.low[1:]] - total[self.low[:-1]]


def _frequencies(index: Index, asked: _Asked) -> np.ndarray:
    """In how many documents each term of the vocabulary is."""
    into, vocabulary = X.arrow_schema("term long, df long"), asked.vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for terms, first, at in zip(*(batch.column(c) for c in ("terms", "first", "at")), strict=True):
                terms, first, at = (np.frombuffer(x.as_py(), kind) for x, kind in ((terms, "<u8"), (first, "<u4"), (at, "<u4")))
                place = _places(terms, vocabulary)
                own = np.flatnonzero(place >= 0)
                df[own] += at[first[place[own] + 1]].astype(np.int64) - at[first[place[own]]]
        yield X.record({"term": np.flatnonzero(df), "df": df[df > 0]}, into)

    counted = index.blocks.select("terms", "first", "at").mapInArrow(run, "term long, df long")
    found = counted.groupBy("term").agg(F.sum("df").alias("df")).toArrow()  # at most TERMS rows
    df = np.zeros(len(vocabulary), np.int64)
    df[found["term"].to_numpy()] = found["df"].to_numpy()
    return df


class _Stratum:
    """One block with the contributions of the asked terms to its documents."""

    def __init__(self, row: dict, vocabulary: np.ndarray, weights: np.ndarray):
        self.docs = np.frombuffer(row["docs"], "<i8")
        self.posts = np.frombuffer(row["posts"], "<u4")
        terms, first, tf, at = (np.frombuffer(row[c], kind) for c, kind in (("terms", "<u8"), ("first", "<u4"), ("tf", "<u4"), ("at", "<u4")))
        # One impact per tf of the stratum.
        levels, which = np.unique(tf, return_inverse=True)
        levels = levels.astype(np.int64)
        impact = ((1_000_000_000 * levels) // (1000 * levels + 12 * row["m"]))[which]
        place = _places(terms, vocabulary)
        self.begin, self.end = np.zeros(len(vocabulary), np.int64), np.zeros(len(vocabulary), np.int64)
        self.best = np.zeros(len(vocabulary), np.int64)
        own = np.flatnonzero(place >= 0)
        low, high = first[place[own]], first[place[own] + 1]
        self.begin[own], self.end[own] = at[low], at[high]
        self.best[own] = weights[own] * impact[low]
        weight = np.zeros(len(terms), np.int64)
        weight[place[own]] = weights[own]
        per_level = np.repeat(weight, np.diff(first.astype(np.int64))) * impact
        self.given = np.repeat(per_level, np.diff(at.astype(np.int64)))
        self.scores = np.zeros(len(self.docs), np.int64)

    def visit(self, places: np.ndarray, times: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores from `least` on, of those the k best."""
        scores = self.scores
        scores[:] = 0
        for p, t in zip(places, times, strict=True):
            a, b = self.begin[p], self.end[p]
            if a < b:
                scores[self.posts[a:b]] += t * self.given[a:b]
        some = np.flatnonzero(scores >= least)
        return _first(self.docs[some], scores[some], k)


def _first(docs: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, ties to the smaller id, in that order."""
    if len(docs) > 4 * k:
        some = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        docs, scores = docs[some], scores[some]
    order = np.lexsort((docs, -scores))[:k]
    return docs[order], scores[order]


def _groups(batches: Iterator[pa.RecordBatch], blocks: int, size: int) -> Iterator[list[dict]]:
    held, bytes_ = [], 0
    for batch in batches:
        for k in range(len(batch)):
            row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
            held.append(row)
            bytes_ += len(row["posts"])
            if len(held) >= blocks or bytes_ >= size:
                yield held
                held, bytes_ = [], 0
    if held:
        yield held


def _found(index: Index, asked: _Asked, weights: np.ndarray, k: int, group: int) -> DataFrame:
    """item_id, doc_id, score: at most k rows per item and task."""
    schema = "item_id long, doc_id long, score long"
    into = X.arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(asked.ids)
        for rows in _groups(batches, group, GROUP_BYTES):
            strata = [_Stratum(row, asked.vocabulary, weights) for row in rows]
            bounds = np.stack([asked.sums(s.best) for s in strata])
            for i in range(len(asked.ids)):
                places, times = asked.places[asked.low[i] : asked.low[i + 1]], asked.times[asked.low[i] : asked.low[i + 1]]
                for b in np.argsort(-bounds[:, i], kind="stable"):
                    docs, scores = held[i]
                    least = max(_LEAST, int(scores[-1]) if len(scores) >= k else 0)
                    if bounds[b, i] < least:
                        break
                    more = strata[b].visit(places, times, least, k)
                    held[i] = _first(np.concatenate([docs, more[0]]), np.concatenate([scores, more[1]]), k)
        sizes = [len(docs) for docs, _ in held]
        docs, scores = (np.concatenate([h[c] for h in held]) if held else np.zeros(0, np.int64) for c in (0, 1))
        yield X.record({"item_id": np.repeat(asked.ids, sizes), "doc_id": docs, "score": scores}, into)

    return index.blocks.mapInArrow(run, schema)


def search(index: Index, items: DataFrame, k: int = K, terms: int = TERMS, group: int = GROUP) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents with a score above 0 for each row of `items` (id, n, terms, counts)."""
    size = items.agg(F.sum(F.octet_length("terms"))).first()[0] or 0  # one row
    number, found = max(1, -(-size // (8 * terms))), None
    for b in range(number):
        # The items in parts of about `terms` terms; each is one pass over the index.
        asked = _Asked(items.where(F.pmod(F.xxhash64("id"), F.lit(number)) == b).orderBy("id").toArrow())
        df = _frequencies(index, asked)
        weights = np.array([math.floor(1000 * math.log((2 * index.documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)
        part = _found(index, asked, weights, k, group)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    known = lambda c: F.nullif(F.col(c), F.lit(_NO_ID)).alias(c)
    return ranked.select(known("item_id"), "rank", known("doc_id"), "score")


def ranked(documents_: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """The search of `documents_` (doc_id, text) for `items` (item_id, text); only terms that are asked for are indexed, while a filter of them is small."""
    once = items.groupBy("item_id").agg(F.min("text").alias("text"))
    asked = staged(documents(once.select(F.col("item_id").alias("id"), "text")), "items")
    size = asked.agg(F.sum(F.octet_length("terms"))).first()[0] or 0  # one row
    terms = np.unique(_joined(asked.select("terms").toArrow()["terms"], "<u8")[0]) if size <= 8 * FILTER else None
    return search(index(documents_.select(F.col("doc_id").alias("id"), "text"), terms), asked, k)


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet"))


ORACLE = r"""
WITH raw AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), docs AS (SELECT *, len(terms)::BIGINT AS n FROM raw WHERE len(terms) > 0
), totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM docs
), items AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(min(text), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark GROUP BY 1) GROUP BY 1, 2
), postings AS (SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(terms) AS term FROM docs) WHERE term IN (SELECT term FROM items) GROUP BY 1, 2
), weights AS (
  SELECT term, floor(1000 * ln((2 * t.docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals t GROUP BY term, t.docs
), scored AS (
  SELECT item_id, row, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * t.docs) // t.terms))))::BIGINT AS score
  FROM items JOIN postings USING (term) JOIN weights USING (term) JOIN docs USING (row), totals t GROUP BY 1, 2
), placed AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored JOIN docs USING (row) WHERE score > 0
)
SELECT * FROM placed WHERE rank <= 20
"""
