"""N-gram Jaccard join by MinHash bands, verified on the full sets of five-word shingles.

Texts with the same set of shingles form a class, which takes part once. A class goes to one bucket per
band; buckets with the same members are looked at once. A bucket is cut into blocks, and
each pair of blocks is a cell of bounded size, so a hot bucket spreads over many tasks. A pair counts only
in the bucket of the first band that it has in common: no pair is counted twice and none is written out. Signatures
tell which classes have a pair to count in a cell; only those send their sets there, which are compared exactly. A cell returns the number of links per class and a spanning
forest of them, from which the connected classes follow.

Texts of one to four words have one shingle, all their words; empty and null texts have none and stand
alone. Repeated rows are copies. Ids may be null, and different texts may have one id: a class has a number of its own, and
takes its smallest id, null if it has none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.llm import text as X
from ledgerwatch.sources.tables import staged

WORDS, SIMILARITY, RECALL, MOST_HASHES = 5, (4, 5), 0.9999, 128
#: A cell has about so many classes and shingles from either block.
BLOCK_CLASSES, BLOCK_SHINGLES, COLUMNS = 1024, 1_000_000, 2048
#: Columns beside those of a caller's table.
OWN, ROOT, FIRST, TWICE = "__lw_class", "__lw_root", "__lw_first", "__lw_twice"
_BIT, _WORD, _MASK = "__lw_bit", "__lw_word", "__lw_mask"
#: Bits of the table that thins out rows before a shuffle.
BITS = 1 << 24


def banding(similarity: float, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows per band with which a pair at the threshold shares a band with this probability."""
    for rows in range(most, 0, -1):
        share = similarity**rows
        bands = 1 if share >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-share)) if share > 1e-12 else most + 1
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no banding reaches this recall")


def shingles(w: X.Words, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after the other, and where each text begins."""
    count = np.diff(w.first)
    if not len(w.start):
        return np.zeros(0, np.uint64), np.zeros(len(count) + 1, np.int64)
    hashed = w.hashes()
    rolled, full = w.windows(hashed, n)
    sets = []
    for d in range(len(count)):
        a, b = w.first[d], w.first[d + 1]
        if count[d] >= n:
            sets.append(np.unique(rolled[a:b][full[a:b]]))
        elif count[d]:
            sets.append(X.mix(np.array([sum(int(x) * 31**k for k, x in enumerate(hashed[a:b])) + int(count[d]) & (1 << 64) - 1], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])])


def identity(flat: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """128 bits that stand for a set, whatever its order; None for the empty set."""
    one, two = (np.concatenate([[np.uint64(0)], np.cumsum(X.mix(flat ^ salt), dtype=np.uint64)]) for salt in (np.uint64(0), X.GOLDEN))
    both = np.column_stack([one[at[1:]] - one[at[:-1]], two[at[1:]] - two[at[:-1]]])
    return [row.tobytes() if b > a else None for row, a, b in zip(both, at[:-1], at[1:], strict=True)]


def signatures(flat: np.ndarray, at: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per text and band, over the minima of `rows` multiplicative hashes."""
    some = np.flatnonzero(np.diff(at))
    out = np.zeros((len(at) - 1, bands), np.uint64)
    if len(some):
        factors = np.random.default_rng(5).integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for k in range(bands):
            folded = np.full(len(some), k + 1, np.uint64) * X.GOLDEN
            for f in factors[k * rows : (k + 1) * rows]:
                folded = X.mix(folded ^ np.minimum.reduceat(flat * f, at[some]))
            out[some, k] = folded
    return out


def signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, class, number of shingles and the hashes of all bands."""

    def work(part: pa.RecordBatch) -> dict:
        flat, at = shingles(X.words(part.column("text")))
        return {
            "doc_id": part.column("doc_id"), "class": identity(flat, at), "shingles": np.diff(at),
            "bands": list(signatures(flat, at, bands, rows).view(np.int64)),
        }

    kind = docs.schema["doc_id"].dataType.simpleString()
    return X.map_slices(docs.select("doc_id", "text"), f"doc_id {kind}, class binary, shingles long, bands array<long>", work)


def with_class(docs: DataFrame, *more: str) -> DataFrame:
    """All columns of `docs`, OWN, and `set`: the shingles as little-endian 64-bit numbers, if asked for."""

    def work(part: pa.RecordBatch) -> dict:
        flat, at = shingles(X.words(part.column("text")))
        made = {name: part.column(i) for i, name in enumerate(part.schema.names)} | {OWN: identity(flat, at)}
        return made | {"set": [flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]} if more else made

    schema = T.StructType([*docs.schema.fields, *(T.StructField(name, T.BinaryType()) for name in (OWN, *more))])
    return X.map_slices(docs, schema, work)


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections."""
    out = np.zeros((len(sets), len(sets)), np.float32)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    several = count[column] > 1
    column, owner = (np.cumsum(count > 1) - 1)[column[several]], owner[several]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = column[-1] + 1 if len(column) else 0
    for low in range(0, total, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        block = np.zeros((len(sets), COLUMNS), np.float32)
        block[owner[a:b], column[a:b] - low] = 1
        out += block @ block.T
    return out


def _own_pairs(band: int, diagonal: bool, size: np.ndarray, bands: np.ndarray, side: np.ndarray, similarity: tuple[int, int]) -> np.ndarray:
    """Which pairs are looked at in this cell: those without an earlier band in common whose sizes allow the similarity."""
    near = ~np.eye(len(size), dtype=bool) if diagonal else side[:, None] != side[None, :]
    for k in range(band):
        near &= bands[:, k][:, None] != bands[:, k][None, :]
    part, whole = similarity
    near &= whole * np.minimum.outer(size, size) >= part * np.maximum.outer(size, size)
    return near


def _cell(band: int, diagonal: bool, ids: list[bytes], size: np.ndarray, bands: np.ndarray, side: np.ndarray, sets: list[np.ndarray], similarity: tuple[int, int]):
    """(node, links, root) of the classes that have a link in this cell."""
    near = _own_pairs(band, diagonal, size, bands, side, similarity)
    if not near.any():
        return []
    part, whole = similarity
    own = np.flatnonzero(near.any(1))
    near, size = near[np.ix_(own, own)], size[own]
    both = _shared([sets[i] for i in own]).astype(np.int64)
    linked = near & ((part + whole) * both >= part * np.add.outer(size, size))
    root = np.arange(len(own))
    while True:
        least = np.minimum(root, np.where(linked, root[None, :], len(own)).min(1))
        if (least == root).all():
            break
        root = least
    links = linked.sum(1)
    return [(ids[own[i]], int(links[i]), ids[own[root[i]]]) for i in np.flatnonzero(links)]


def _by_cell(schema: str, work):
    """Calls `work` with the key of each cell, (bucket, i, j, band), and its rows, which stay in Arrow; yields the rows it makes."""
    into = X.arrow_schema(schema)

    def record(made: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*made, strict=True), into, strict=True)], schema=into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, made = None, [], []
        for batch in batches:
            if not len(batch):
                continue
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("bucket", "i", "j", "band")])
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(batch)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                now = tuple(keys[low].tolist())
                if now != key and held:
                    made += work(key, pa.Table.from_batches(held))
                    held = []
                key = now
                held.append(batch.slice(low, high - low))
            if len(made) > 10_000:
                yield record(made)
                made = []
        if held:
            made += work(key, pa.Table.from_batches(held))
        if made:
            yield record(made)

    return run


def _signatures_of(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """node, shingles, bands and block of the rows of a cell."""
    bands = pc.list_flatten(rows["bands"]).to_numpy().reshape(len(rows), -1)
    return rows["node"].to_numpy(), rows["shingles"].to_numpy(), bands, rows["block"].to_numpy()


def _owners(similarity: tuple[int, int]):
    """The rows of a cell that have a pair of their own in it, decided by signatures."""

    def work(key: tuple, rows: pa.Table) -> list[tuple]:
        bucket, i, j, band = key
        node, size, bands, side = _signatures_of(rows)
        own = np.flatnonzero(_own_pairs(band, i == j, size, bands, side, similarity).any(1))
        return [(bucket, band, n, s, i, j) for n, s in zip(node[own].tolist(), side[own].tolist(), strict=True)]

    return work


def _verified(similarity: tuple[int, int]):
    def work(key: tuple, rows: pa.Table) -> list[tuple]:
        node, size, bands, side = _signatures_of(rows)
        order = np.lexsort((side, node))
        repeated = (np.diff(node[order]) == 0) & (np.diff(side[order]) == 0)
        order = order[np.concatenate([[True], ~repeated])]  # a repeated document once
        sets = [np.frombuffer(rows["set"][k].as_buffer(), np.uint64) for k in order.tolist()]
        return _cell(key[3], key[1] == key[2], node[order].tolist(), size[order], bands[order], side[order], sets, similarity)

    return work


def bits_of(keys: DataFrame, key: str) -> DataFrame:
    """A table of BITS bits, at most BITS / 64 rows whatever the number of keys, with one bit per key set."""
    bit = F.pmod(F.xxhash64(key), F.lit(BITS))
    mask = F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias(_MASK)
    return keys.select(bit.alias("bit")).groupBy(F.expr("bit div 64").alias(_WORD)).agg(mask)


def likely(df: DataFrame, key: str, bits: DataFrame, yes: bool = True) -> DataFrame:
    """The rows whose key may be among the keys of `bits`: all that are, and few others while the table is not full.
    Without `yes` the other rows, none of which is."""
    marked = df.withColumn(_BIT, F.pmod(F.xxhash64(key), F.lit(BITS))).withColumn(_WORD, F.expr(f"{_BIT} div 64"))
    marked = marked.join(F.broadcast(bits), _WORD, "inner" if yes else "left")
    test = F.expr(f"coalesce(shiftright({_MASK}, cast({_BIT} % 64 as int)) & 1, 0)")
    return marked.where(test == int(yes)).select(*df.columns)


def _candidates(distinct: DataFrame) -> DataFrame:
    """(node, shingles, bucket, band, n, total) of the buckets with two classes or more, each set of members once.

    Only rows that may be in such a bucket are shuffled to be joined with it.
    """
    rows = distinct.select("node", "shingles", F.posexplode("bands").alias("band", "bucket"))
    several = staged(rows.groupBy("bucket").count().where("count > 1").select("bucket"), "buckets")
    members = staged(likely(rows, "bucket", bits_of(several, "bucket")).join(several, "bucket"), "members")
    mark = F.xxhash64("node")
    buckets = members.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("shingles").alias("total"), F.min("band").alias("band"), F.bit_xor(mark).alias("x"), F.bit_xor(F.xxhash64(F.lit(7), "node")).alias("y")
    )
    # Of the buckets with the same members the one of the first band.
    once = F.struct("band", "bucket")
    buckets = buckets.groupBy("n", "total", "x", "y").agg(F.min(once).alias("b")).select("n", "total", "b.bucket")
    return staged(members.join(buckets, "bucket"), "members")


def linked(docs: DataFrame, distinct: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """(node, links, root, class) rows of all cells. `distinct`: node (a number), doc_id (of a row), class, shingles, bands, one row a class."""
    members = _candidates(distinct)
    nodes = members.select("node").distinct()
    some = staged(likely(distinct, "node", bits_of(nodes, "node")).join(nodes, "node"), "candidates")
    # Inner joins: a semi join would be moved below the filter that keeps most texts from being shuffled.
    ids = some.where("doc_id is not null").select("doc_id").distinct()
    texts = likely(docs.select("doc_id", "text").where("doc_id is not null"), "doc_id", bits_of(ids, "doc_id")).join(ids, "doc_id")
    sets = with_class(texts, "set").select(F.col("doc_id").alias(FIRST), OWN, "set")
    sets = some.join(sets, (F.col("doc_id") == F.col(FIRST)) & (F.col("class") == F.col(OWN))).select("node", "shingles", "bands", "set")
    # Of the rows without id one a class, among the classes that have no other row.
    bare = some.where("doc_id is null").select("node", "class", "shingles", "bands")
    texts = with_class(docs.select("doc_id", "text").where("doc_id is null"), "set")
    bare = bare.join(texts.select(F.col(OWN).alias("class"), "set"), "class").dropDuplicates(["class"])
    sets = sets.unionByName(bare.select("node", "shingles", "bands", "set"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_CLASSES), F.ceil(F.col("total") / BLOCK_SHINGLES), F.lit(1)).cast("int")
    cells = (
        members.withColumn("blocks", F.least(blocks, F.col("n").cast("int")))
        .withColumn("block", F.pmod(F.xxhash64(F.lit(3), "node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", "band", "node", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )
    spread = lambda df: df.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    # Which rows of a cell have a pair of their own there needs no sets; only those send theirs.
    kind = distinct.schema["node"].dataType.simpleString()
    schema = f"bucket long, band int, node {kind}, block int, i int, j int"
    signed_cells = spread(cells.join(some.select("node", "shingles", "bands"), "node"))
    owned = signed_cells.mapInArrow(_by_cell(schema, _owners(similarity)), schema)
    schema = f"node {kind}, links long, root {kind}"
    compared = spread(owned.join(sets, "node")).mapInArrow(_by_cell(schema, _verified(similarity)), schema)
    return compared.join(some.select("node", "class"), "node")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: every node of the edges with the least node it is connected to.

    Alternating star contraction: all greater neighbours of a node are tied to the least one, then all
    smaller ones, until every node has one parent that is no child itself.
    """

    def tie(df: DataFrame) -> DataFrame:
        least = df.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        return df.join(least, "a")

    now = staged(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(), "edges")
    while not _stars(now):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = tie(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        joined = tie(large)
        small = joined.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).union(joined.select("a", F.col("least").alias("b")))
        now = staged(small.where("a <> b").distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())


def _stars(edges: DataFrame) -> bool:
    """No node has two parents, and no parent has one."""
    marks = edges.select("a", F.lit(1).alias("child"), F.lit(0).alias("parent")).union(edges.select("b", F.lit(0), F.lit(1)))
    odd = marks.groupBy("a").agg(F.sum("child").alias("children"), F.sum("parent").alias("parents")).where("children > 1 or children = 1 and parents > 0")
    return odd.isEmpty()


def classes(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """(doc_id, class of every row), (class, root, class_id, copy_id, n_copies, n_links of classes with a copy or a link).

    `similarity` is a fraction (part, whole) so that the test is exact on integers.
    """
    each = staged(signed(docs, *banding(similarity[0] / similarity[1], recall)), "signatures")
    known = each.where("class is not null")
    groups = known.groupBy("class").agg(F.min("doc_id").alias("copy_id"), F.count("*").alias("n_copies"))
    # One row a class, with an id where a row of it has one; the table fixes the numbers.
    firsts = known.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.any_value("shingles").alias("shingles"), F.any_value("bands").alias("bands"))
    firsts = staged(firsts.withColumn("node", F.monotonically_increasing_id()), "distinct")
    found = staged(linked(docs, firsts, similarity), "links")
    links = found.groupBy("class", "node").agg(F.sum("links").alias("n_links")).join(components(found, "node", "root"), "node", "left")
    table = groups.join(links.select("class", "n_links", F.col("root").cast("string").alias("root")), "class", "left")
    table = table.where("n_copies > 1 or n_links is not null").withColumn("root", F.coalesce("root", F.hex("class")))
    table = staged(table.withColumn("n_links", F.coalesce("n_links", F.lit(0))), "classes")
    return each.select("doc_id", "class"), table.join(table.groupBy("root").agg(F.min("copy_id").alias("class_id")), "root")


def jaccard_join(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """Per row: doc_id; class_id, the least id connected to it by links; copy_id, the least id with the same shingles;
    n_copies, rows with the same shingles; n_links, classes of other shingles at `similarity` or more."""
    each, table = classes(docs, similarity, recall)
    out = each.join(table, "class", "left")
    alone = F.col("root").isNull()
    return out.select(
        "doc_id",
        *(F.when(alone, F.col("doc_id")).otherwise(F.col(c)).alias(c) for c in ("class_id", "copy_id")),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{folder}/documents.parquet"))


def unique(docs: DataFrame, similarity: tuple[int, int] = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row of each class of linked texts, the one with its least id; texts without words all stay.

    Verdicts are made without texts. Only rows whose id may be among those that go, or come twice, are shuffled.
    """
    each, table = classes(docs, similarity, recall)
    known = table.select("class", "root", "class_id")
    rows = each.join(known, "class").withColumn("first", F.col("doc_id").eqNullSafe(F.col("class_id")))
    twice = rows.where("first").groupBy("root").agg(F.count("*").alias("n")).where("n > 1").select("root", F.lit(True).alias("twice"))
    rows = staged(rows.join(twice, "root", "left"), "verdicts")
    verdicts = rows.select("class", "root", "class_id", F.coalesce("twice", F.lit(False)).alias(TWICE)).distinct()
    verdicts = verdicts.withColumnsRenamed({"class": OWN, "root": ROOT, "class_id": FIRST})
    odd = bits_of(rows.where("not first or twice"), "doc_id")
    asked = with_class(likely(docs, "doc_id", odd)).join(verdicts, OWN, "left")
    own = F.col("doc_id").eqNullSafe(F.col(FIRST))
    kept = asked.where(F.col(ROOT).isNull() | own & ~F.col(TWICE)).select(*docs.columns)
    again = with_class(likely(docs, "doc_id", bits_of(rows.where("first and twice"), "doc_id"))).join(verdicts.where(TWICE), OWN)
    once = again.where(own).dropDuplicates([ROOT]).select(*docs.columns)
    return likely(docs, "doc_id", odd, yes=False).unionByName(kept).unionByName(once)


def stage_unique(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return unique(docs)
