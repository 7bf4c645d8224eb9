"""Language identification with a blended-spectrum string kernel, Nyström landmarks and ridge regression.

A text is the set of its n-grams of one to three bytes, letters only: ASCII letters lowered, all other ASCII
bytes as one gap. The kernel of two texts is the number of n-grams that both have, over the geometric mean of their
numbers. Training takes at most `sample` labelled texts, those whose hashed id comes first, and of these
`landmarks` spread over the languages. With K the kernel among landmarks, a text x has the features
k(x, landmarks) K^(-1/2), and one ridge regression per language separates it from the rest. Scoring a
batch is two matrix products.

Null texts and texts without a letter are `und` with score 0; so is every text if nothing can be learned. Ties go
to the language that sorts first. The stage of the pipeline keeps a text only on evidence: enough of its three-byte n-grams
must be known, and the best language must lead the second by enough, both by what training texts have. Repeated rows get a row each. Rows without id or language teach nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import text as X

#: Bounds of the training set: labelled texts, landmarks, and n-grams that the kernel counts.
SAMPLE, LANDMARKS, GRAMS = 2_000, 192, 8_192
RIDGE, UNKNOWN, LEAST_SCORE = 1e-2, "und", 0.3
#: The quantile of training texts that evidence is measured by, and the shares of it that a text needs: of known n-grams and of the lead.
QUANTILE, COVERED, LEAD = 0.01, 0.9, 0.5
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
ROWS = 256


def grams(buf: np.ndarray) -> tuple[np.ndarray, ...]:
    """Numbers of the n-grams that begin at each byte, for n = 1, 2, 3, told apart by their high bits."""
    b = _FOLD[buf]
    # Capital letters of the Latin supplement: the second byte of C3 80 to C3 9E.
    upper = (b[1:] >= 0x80) & (b[1:] <= 0x9E) & (b[:-1] == 0xC3) & (b[1:] != 0x97)
    b[1:][upper] += 32
    b = b.astype(np.uint32)
    two = b[:-1] << np.uint32(8) | b[1:]
    return b, two + np.uint32(256), (two[:-1] << np.uint32(8) | b[2:]) + np.uint32(1 << 17)


def has_letter(raw: bytes) -> bool:
    return any(c.isalpha() for c in raw.decode("utf-8", "replace"))


@dataclass
class Model:
    """`index` gives the column of the n-grams that count; `weights` maps shared n-grams to languages."""

    codes: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray
    names: list[str]
    least: tuple[float, float] = (0.0, 0.0)

    def scorer(self, evidence: bool = False):
        index = np.full((1 << 17) + (1 << 24), -1, np.int16)
        index[self.codes] = np.arange(len(self.codes))
        norm = np.sqrt(self.landmarks.sum(1))
        shared = np.ascontiguousarray(self.landmarks.T, np.float32)
        weights = (self.weights / norm[:, None]).astype(np.float32)

        def score(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
            """One-versus-rest values of each text, and with `evidence` whether each has enough of it."""
            covered = np.zeros(len(at) - 1)
            out = np.zeros((len(at) - 1, len(self.names)), np.float32)
            for low in range(0, len(at) - 1, ROWS):
                high = min(low + ROWS, len(at) - 1)
                own, cut = buf[at[low] : at[high]], at[low : high + 1] - at[low]
                row = np.repeat(np.arange(high - low), np.diff(cut))
                has = np.zeros((high - low) * len(self.codes), bool)
                for n, code in enumerate(grams(own)):
                    column = index[code]
                    inside = column >= 0
                    if n:
                        whole = row[n:] == row[: len(row) - n]
                        inside &= whole
                    has[row[: len(column)][inside] * len(self.codes) + column[inside]] = True
                    if n == 2:
                        found, total = (np.bincount(row[: len(column)][x], minlength=high - low) for x in (inside, whole))
                        covered[low:high] = found / np.maximum(total, 1)
                has = has.reshape(high - low, -1)
                size = np.sqrt(np.maximum(has.sum(1), 1))
                out[low:high] = (has.astype(np.float32) @ shared) @ weights / size[:, None]
            return (out, (covered >= self.least[0]) & (lead(out) >= self.least[1])) if evidence else out

        return score


def lead(values: np.ndarray) -> np.ndarray:
    """By how much the best language is ahead of the second; of one language its value."""
    ranked = np.sort(values, axis=1)
    return ranked[:, -1] - (ranked[:, -2] if values.shape[1] > 1 else 0)


def fit_model(
    sets: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS, most: int = GRAMS, ridge: float = RIDGE, counts: list[np.ndarray] | None = None
) -> Model | None:
    """The model of labelled n-gram sets, and how often a text has each; None without any. The n-grams that most texts have are kept."""
    counts = [np.ones(len(s)) for s in sets] if counts is None else counts
    some = [x for x in zip(sets, labels, counts, strict=True) if len(x[0])]
    sets, labels, counts = zip(*some, strict=True) if some else ((), (), ())
    if not sets:
        return None
    names = sorted(set(labels))
    code, count = np.unique(np.concatenate(sets), return_counts=True)
    keep = np.sort(code[np.argsort(-count, kind="stable")[:most]])
    rows = np.zeros((len(sets), len(keep)), np.float32)
    for i, s in enumerate(sets):
        at = np.searchsorted(keep, s)
        at = at[keep[np.minimum(at, len(keep) - 1)] == s]
        rows[i, at[at < len(keep)]] = 1
    size = np.sqrt(np.maximum(rows.sum(1), 1))
    # Landmarks: the first texts of each language in turn, as many as there are.
    turn: dict[str, int] = dict.fromkeys(names, 0)
    place = []
    for y in labels:
        place.append(turn[y])
        turn[y] += 1
    some = np.array(sorted(range(len(sets)), key=lambda i: (place[i], labels[i]))[:landmarks])
    kernel = (rows @ rows[some].T) / size[:, None] / size[some][None, :]
    values, vectors = np.linalg.eigh(kernel[some].astype(float))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    features = kernel.astype(float) @ root
    target = np.where(np.array(labels)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    ridge_by = np.linalg.solve(features.T @ features + ridge * len(sets) * np.eye(features.shape[1]) / 10, features.T @ target)
    threes = [s >= 1 << 17 for s in sets]
    covered = [n[t & np.isin(s, keep)].sum() / max(n[t].sum(), 1) for s, t, n in zip(sets, threes, counts, strict=True)]
    least = COVERED * np.quantile(covered, QUANTILE), LEAD * np.quantile(lead(features @ ridge_by), QUANTILE)
    return Model(keep, rows[some], root @ ridge_by, names, tuple(map(float, least)))


def fit(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS) -> Model | None:
    """Learns from `text` and `lang` of at most `sample` rows."""
    known = docs.where("text is not null and lang is not null and doc_id is not null")
    taken = known.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = known.select("doc_id", "text", "lang").join(F.broadcast(taken.distinct()), "doc_id", "left_semi")

    def work(part: pa.RecordBatch) -> dict:
        buf, at = X.bytes_of(part.column("text"))
        none = np.zeros(0, np.uint32)
        sets = [np.unique(np.concatenate(grams(buf[a:b])), return_counts=True) if b - a > 2 else (none, none) for a, b in zip(at[:-1], at[1:], strict=True)]
        made = {n: [s[k].astype("<u4").tobytes() for s in sets] for k, n in enumerate(("codes", "counts"))}
        return {"doc_id": part.column("doc_id"), "lang": part.column("lang")} | made

    kind = docs.schema["doc_id"].dataType.simpleString()
    sets = X.map_slices(rows, f"doc_id {kind}, lang string, codes binary, counts binary", work).orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "codes").limit(sample).toPandas()
    codes, counts = ([np.frombuffer(c, "<u4") for c in sets[n]] for n in ("codes", "counts"))
    return fit_model(codes, list(sets["lang"]), landmarks, counts=counts)


def judge(model: Model | None, evidence: bool = False):
    """A function for workers: texts -> (languages, scores). With `evidence` texts that lack it are unknown."""
    score = model.scorer(True) if model else None

    def one(texts) -> tuple[list[str], np.ndarray]:
        buf, at = X.bytes_of(texts)
        letters = np.diff(np.searchsorted(np.flatnonzero((_FOLD[buf] >= 97) & (buf < 128)), at)) > 0
        for i in np.flatnonzero(~letters & (np.diff(at) > 0)):
            letters[i] = has_letter(buf[at[i] : at[i + 1]].tobytes())
        if model is None:
            return [UNKNOWN] * len(letters), np.zeros(len(letters))
        values, enough = score(buf, at)
        letters = letters & enough if evidence else letters
        best = values.argmax(1)
        sure = np.clip((1 + values[np.arange(len(best)), best].astype(float)) / 2, 0, 1)
        return [model.names[b] if k else UNKNOWN for b, k in zip(best, letters, strict=True)], np.where(letters, sure, 0.0)

    return one


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score of every text."""
    kind, shared = docs.schema["doc_id"].dataType.simpleString(), docs.sparkSession.sparkContext.broadcast(model)

    def setup():
        one = judge(shared.value)

        def work(part: pa.RecordBatch) -> dict:
            lang, score = one(part.column("text"))
            return {"doc_id": part.column("doc_id"), "lang_pred": lang, "score": score}

        return work

    return X.map_slices(docs.select("doc_id", "text"), f"doc_id {kind}, lang_pred string, score double", None, setup=setup)


def held_out():
    """The fourth of the documents that no model may learn from."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return identified(docs, fit(docs.where(~held_out()))).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def stage_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents in a learned language; texts without letters, without evidence or with a score below LEAST_SCORE go."""
    shared = spark.sparkContext.broadcast(fit(docs.where(~held_out())))

    def run(batches):
        one = judge(shared.value, evidence=True)
        for batch in batches:
            for part in X.slices(batch):
                lang, score = one(part.column("text"))
                yield part.filter(pa.array((score >= LEAST_SCORE) & (np.array(lang, object) != UNKNOWN)))

    return docs.mapInArrow(run, docs.schema)
