"""Token ids in binary files: frequency-ranked, in byte-aligned variable-length code with separate control bytes.

An id is stored as its rank by frequency over all documents, so that frequent ids take one byte. Two bits of a
control byte give the length of each of four numbers; the data bytes follow apart. Decoding looks the lengths
up in a table of all 256 control bytes. A file is a Parquet table of blocks: ids of many documents in ascending
doc_id order, with the number of ids per document and the ids before the block. `ranks` holds the ids by rank.

Null and empty texts have the end id alone. Null ids come first; rows of equal id follow each other in any order.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwatch.llm import bpe
from ledgerwatch.llm import text as X
from ledgerwatch.sources.tables import scratch

END = 1
#: Ids in a block, and in a file.
BLOCK, FILE = 1 << 18, 1 << 23
#: Lengths of the four numbers that each control byte describes.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1
_BLOCKS = "part int, before long, doc_id array<{kind}>, counts array<long>, control binary, data binary"


def pack_numbers(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit numbers."""
    size = 1 + (numbers > 0xFF).astype(np.uint8) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    code = np.zeros(-(-len(numbers) // 4) * 4, np.uint8)
    code[: len(numbers)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    raw = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), raw[np.arange(4) < size[:, None]].tobytes()


def unpack_numbers(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    raw = np.zeros((n, 4), np.uint8)
    raw[np.arange(4) < size[:, None]] = np.frombuffer(data, np.uint8)
    return raw.view("<u4").ravel()


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids of every text with the end id, in two bytes each where the vocabulary allows it."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def setup():
        vocabulary = bpe.vocabulary(path)
        narrow, end = _width(vocabulary), np.array([END], "<u4").tobytes()

        def one(part: pa.RecordBatch) -> dict:
            ids = vocabulary.encode(part.column("text"))
            return {"doc_id": part.column("doc_id"), "ids": [np.frombuffer(i + end, "<u4").astype(narrow).tobytes() for i in ids]}

        return one

    return X.map_slices(docs.select("doc_id", "text"), f"doc_id {kind}, ids binary", None, setup=setup)


def _width(vocabulary: bpe.Vocabulary) -> str:
    return "<u2" if len(vocabulary.sizes) <= 1 << 16 else "<u4"


def id_counts(ids: DataFrame, size: int, kind: str) -> DataFrame:
    """id, n over all documents; a task sends one row per id at most."""
    into = X.arrow_schema("id int, n long")

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for part in X.slices(batch, "ids"):
                total += np.bincount(np.frombuffer(X.bytes_of(part.column("ids"))[0].tobytes(), kind), minlength=size)
        some = np.flatnonzero(total)
        yield X.record({"id": some, "n": total[some]}, into)

    return ids.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, path: str, folder: str) -> None:
    """Writes the blocks of all documents to `folder`/blocks and the ids by rank to `folder`/ranks."""
    spark, vocabulary = docs.sparkSession, bpe.vocabulary(path)
    width, size = _width(vocabulary), len(vocabulary.sizes)
    tokenized(docs, path).write.option("compression", "zstd").parquet(f"{folder}/ids")
    ids = spark.read.parquet(f"{folder}/ids")
    counted = id_counts(ids, size, width).orderBy(F.desc("n"), "id").collect()  # at most the vocabulary
    order = np.array([r["id"] for r in counted], np.int64)
    rank = np.zeros(size, np.uint32)
    rank[order] = np.arange(len(order))
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(order)], "rank int, id int").write.parquet(f"{folder}/ranks")
    schema = _BLOCKS.format(kind=docs.schema["doc_id"].dataType.simpleString())
    into = X.arrow_schema(schema)

    def run(batches):
        part, before = TaskContext.get().partitionId(), 0
        held, held_ids, held_n = [], [], 0

        def block():
            nonlocal before, held, held_ids, held_n
            numbers = rank[np.concatenate(held)]
            control, data = pack_numbers(numbers)
            made = {"part": [part], "before": [before], "doc_id": [held_ids], "counts": [[len(h) for h in held]], "control": [control], "data": [data]}
            before += len(numbers)
            held, held_ids, held_n = [], [], 0
            return X.record(made, into)

        for batch in batches:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                held.append(np.frombuffer(raw.as_buffer(), width))
                held_ids.append(doc_id)
                held_n += len(held[-1])
                if held_n >= BLOCK:
                    yield block()
        if held:
            yield block()

    files = max(1, -(-sum(r["n"] for r in counted) // FILE))
    ordered = ids.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, schema).write.parquet(f"{folder}/blocks")


def read_ids(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and the ids (an array, or with `digest` only ids_crc32) of every document in the files."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    order = np.zeros(0, np.uint32)
    if ranked := spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect():  # at most the vocabulary
        order = np.array([r["id"] for r in ranked], np.uint32)
    # Ids before each file: a running sum within groups of a thousand files, and one over the groups.
    total = blocks.groupBy("part").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    total = total.withColumn("group", F.expr("part div 1000"))
    running = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    groups = total.groupBy("group").agg(F.sum("n").alias("n"))
    over = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("group", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("earlier"))
    files = total.withColumn("inside", F.coalesce(F.sum("n").over(running), F.lit(0))).join(groups, "group")
    files = files.select("part", (F.col("inside") + F.col("earlier")).alias("offset"))
    kind = blocks.schema["doc_id"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<int>")
    into = X.arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for row in range(len(batch)):
                own = {name: batch.column(name)[row] for name in ("before", "offset", "doc_id", "counts", "control", "data")}
                counts = own["counts"].values.to_numpy()
                ends = np.cumsum(counts)
                ids = order[unpack_numbers(own["control"].as_py(), own["data"].as_py(), int(ends[-1]))]
                made = {"doc_id": own["doc_id"].values, "start": own["offset"].as_py() + own["before"].as_py() + ends - counts, "n_tokens": counts}
                parts = [ids[b - n : b] for b, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield X.record(made | ({"ids_crc32": [zlib.crc32(p.astype("<u4").tobytes()) for p in parts]} if digest else {"ids": parts}), into)

    return blocks.join(files, "part").mapInArrow(run, schema)


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    into = scratch(spark, "token-files")
    write_ids(spark.read.parquet(f"{folder}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"), into)
    return read_ids(spark, into, digest=True)
