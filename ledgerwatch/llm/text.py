"""Words of a column of texts as numpy arrays, and row streams over Arrow batches.

A word is a run of bytes other than space and tab to carriage return; a null text has none. All work is on
the UTF-8 bytes of a slice of rows, so no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_BYTES = 1 << 21
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64 bits in which every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * _MIX[0]
    x = (x ^ (x >> np.uint64(33))) * _MIX[1]
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """Word i is buf[start[i]:end[i]]; text d has the words first[d]:first[d + 1] and the bytes text[d]:text[d + 1]."""

    buf: np.ndarray
    text: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def count(self, mask: np.ndarray) -> np.ndarray:
        """How many bytes of each text a mask over all bytes marks."""
        return np.diff(np.searchsorted(np.flatnonzero(mask), self.text))

    def hashes(self) -> np.ndarray:
        """64 bits per word. Words of up to eight bytes and equal length never collide."""
        padded = np.zeros(len(self.buf) + 8, np.uint8)
        padded[: len(self.buf)] = self.buf
        lanes = np.ndarray((len(self.buf) + 1,), "<u8", padded, strides=(1,))
        size = self.end - self.start
        out, open_, at = size.astype(np.uint64) * GOLDEN, slice(None), 0
        while True:
            rest = np.minimum(size[open_] - at, 8)
            lane = lanes[self.start[open_] + at] & (~np.uint64(0) >> ((8 - rest) * 8).astype(np.uint64))
            out[open_] = mix(out[open_] ^ lane)
            at += 8
            open_ = np.flatnonzero(size > at)
            if not len(open_):
                return out

    def windows(self, hashed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of n words within a text, by their first word, and which words begin one."""
        out = hashed.copy()
        for k in range(1, n):
            out[:-k] = out[:-k] * _MIX[1] + hashed[k:]
            out[len(out) - k :] = out[len(out) - k :] * _MIX[1]
        ends = np.repeat(self.first[1:], np.diff(self.first))
        return mix(out), np.arange(len(hashed)) + n <= ends


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of texts or binaries and the offset of each text in them."""
    texts = pa.array([], pa.string()) if texts.type == pa.null() else texts
    texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"") if texts.null_count else texts
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def words(texts: pa.Array, lower: bool = False, between: np.ndarray = SPACE) -> Words:
    """The runs of bytes that `between` does not mark."""
    buf, text = bytes_of(texts)
    buf = LOWER[buf] if lower else buf
    space = between[buf]
    before, after = np.ones(len(buf), bool), np.ones(len(buf), bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    cuts = text[(text > 0) & (text < len(buf))]
    before[cuts], after[cuts - 1] = True, True
    start = np.flatnonzero(~space & before)
    return Words(buf, text, np.searchsorted(start, text), start, np.flatnonzero(~space & after) + 1)


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch by rows so that a slice has about `size` bytes of text, or one longer text."""
    _, at = bytes_of(batch.column(column))
    low = 0
    while low < len(batch):
        high = max(low + 1, int(np.searchsorted(at, at[low] + size, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def arrow_schema(schema: str | T.StructType) -> pa.Schema:
    parsed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return to_arrow_schema(parsed)


def record(made: dict, into: pa.Schema) -> pa.RecordBatch:
    columns = (made[f.name] for f in into)
    return pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, into, strict=True)], schema=into)


def map_slices(
    df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], dict], column: str = "text", setup: Callable = None
) -> DataFrame:
    """mapInArrow over slices of bounded size; `work` returns the output columns of a slice."""

    into = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        do = setup() if setup else work
        for batch in batches:
            for part in slices(batch, column):
                yield record(do(part), into)

    return df.mapInArrow(run, schema)
