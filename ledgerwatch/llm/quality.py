"""Quality rules: boosted trees over document statistics, with monotonic constraints, scored as node arrays.

`statistics` reads every whole text once. `fit` grows trees by histograms of quantile bins on at most
`sample` labelled rows, the ones whose hashed id comes first. A constrained feature may only lower (-1) or raise (+1) the
score: a split that breaks this is not taken, and the middle of the two leaf values bounds all
nodes below either side. `Trees` holds all nodes in flat arrays, so scoring is a few takes per level
for a whole batch.

Null and empty texts have no words and zero statistics; repeated rows get a row each; rows of
`labels` without id or quality teach nothing, and with fewer than two classes every text that
passes the base rules is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import text as X
from ledgerwatch.sources.tables import staged

WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: Bound on the labelled rows that the trees are fit on, and what a text needs to be kept.
SAMPLE, THRESHOLD = 20_000, 0.3
#: Statistics the trees see, and the direction in which each may move the score (0: either).
FEATURES = {
    "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "distinct_share": 0,
    "upper_share": -1, "digit_share": 0, "mark_share": -1, "lone_mark_share": -1, "line_words": 0, "long_word_share": 0,
}
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
STATISTICS = BASE + "".join(f", {name} float" for name in FEATURES)
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = np.isin(np.arange(256), range(65, 91))
_DIGIT = np.isin(np.arange(256), range(48, 58))
_MARK = np.isin(np.arange(256), list(b"!?#*$%&|<>=+~^_@/\\{}[]"))


def _repeated(w: X.Words) -> np.ndarray:
    """Words that lie in a window of five which its text has twice or more, counted per text."""
    doc = w.doc
    hashed, full = w.windows(w.hashes() if len(doc) else np.zeros(0, np.uint64), WINDOW)
    hashed = X.mix(hashed ^ (doc.astype(np.uint64) * X.GOLDEN))
    order = np.sort(hashed[full])
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    covered = np.zeros(len(doc) + WINDOW, bool)
    if len(twice):
        at = np.flatnonzero(full)
        near = np.minimum(np.searchsorted(twice, hashed[at]), len(twice) - 1)
        at = at[twice[near] == hashed[at]]
        for k in range(WINDOW):
            covered[at + k] = True
    return np.diff(np.concatenate([[0], np.cumsum(covered[: len(doc)])])[w.first])


def _repeated_lines(buf: np.ndarray, text: np.ndarray) -> np.ndarray:
    raw, out = buf.tobytes(), np.zeros(len(text) - 1, np.int64)
    for d in range(len(out)):
        lines = [x for x in raw[text[d] : text[d + 1]].split(b"\n") if x.strip(b"\t\n\v\f\r ")]
        out[d] = len(lines) - len(set(lines))
    return out


def measure(part: pa.RecordBatch) -> dict:
    w = X.words(part.column("text"))
    n = np.diff(w.first)
    size = np.maximum(np.diff(w.text), 1)
    words, width = np.maximum(n, 1), w.end - w.start
    # Code points begin with a byte that is no continuation.
    points = w.count(((w.buf & 0xC0) != 0x80) & ~X.SPACE[w.buf])
    lines = _repeated_lines(w.buf, w.text)
    breaks = w.count(w.buf == 10) + 1
    repeat, symbols = _repeated(w), w.count(_SYMBOL[w.buf])
    alone = (width == 1) & _MARK[w.buf[w.start]] if len(width) else np.zeros(0, bool)
    per = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[w.first])
    # Distinct words per text: one sort of (text, word) hashes.
    doc = w.doc
    keyed = X.mix((w.hashes() if len(doc) else np.zeros(0, np.uint64)) ^ (doc.astype(np.uint64) * X.GOLDEN))
    _, seen = np.unique(keyed, return_index=True)
    distinct = np.bincount(doc[seen], minlength=len(n))
    return {name: part.column(name) for name in part.schema.names if name not in ("text",)} | {
        "n_words": n, "word_chars": points, "n_symbols": symbols, "n_dup_lines": lines, "n_repeat_words": repeat,
        "word_length": points / words, "symbol_share": symbols / size, "dup_line_share": lines / breaks,
        "repeat_share": repeat / words, "distinct_share": distinct / words, "upper_share": w.count(_UPPER[w.buf]) / size,
        "digit_share": w.count(_DIGIT[w.buf]) / size, "mark_share": w.count(_MARK[w.buf]) / size,
        "lone_mark_share": per(alone) / words, "line_words": n / breaks, "long_word_share": per(width > 20) / words,
    }


def statistics(docs: DataFrame) -> DataFrame:
    """`doc_id` and the statistics of every text."""
    return X.map_slices(docs.select("doc_id", "text"), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {STATISTICS}", measure)


@dataclass
class Trees:
    """All nodes of all trees: feature (-1 at a leaf), threshold, left child (the right one follows), value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities for the rows of x (missing values go left)."""
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                f = self.feature[node]
                right = x[rows, np.maximum(f, 0)] > self.threshold[node]
                node = np.where(f >= 0, self.left[node] + right, node)
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit_trees(
    x: np.ndarray, y: np.ndarray, direction: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, l2: float = 1.0, least: float = 0.2
) -> Trees | None:
    """Gradient boosting of the logistic loss; None if y has one class only."""
    if len(y) == 0 or y.min() == y.max():
        return None
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    total = np.full(len(y), start)
    feature, threshold, left, value, roots = [], [], [], [], []

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + l2), low, high))

    def loss(g, h, v):
        return g * v + (h + l2) * v * v / 2

    def node(v: float) -> int:
        feature.append(-1), threshold.append(0.0), left.append(-1), value.append(v * rate)
        return len(feature) - 1

    def grow(at: int, rows: np.ndarray, low: float, high: float, level: int) -> None:
        g, h = grad[rows], hess[rows]
        own, best = loss(g.sum(), h.sum(), leaf(g.sum(), h.sum(), low, high)), None
        for j in range(x.shape[1] if level < depth else 0):
            width = len(cuts[j]) + 1
            gl = np.cumsum(np.bincount(code[rows, j], g, width))[:-1]
            hl = np.cumsum(np.bincount(code[rows, j], h, width))[:-1]
            if not len(gl):
                continue
            gr, hr = g.sum() - gl, h.sum() - hl
            vl, vr = np.clip(-gl / (hl + l2), low, high), np.clip(-gr / (hr + l2), low, high)
            gain = own - loss(gl, hl, vl) - loss(gr, hr, vr)
            gain[(hl < least) | (hr < least) | (direction[j] * (vr - vl) < 0)] = -np.inf
            k = int(np.argmax(gain))
            if gain[k] > 1e-3 and (best is None or gain[k] > best[0]):
                best = gain[k], j, k, vl[k], vr[k]
        if best is None:
            total[rows] += value[at]
            return
        _, j, k, vl, vr = best
        feature[at], threshold[at], left[at] = j, float(cuts[j][k]), node(vl)
        node(vr)
        middle, lows, highs = (vl + vr) / 2, (low, low), (high, high)
        if direction[j] > 0:
            lows, highs = (low, middle), (middle, high)
        elif direction[j] < 0:
            lows, highs = (middle, low), (high, middle)
        goes = code[rows, j] <= k
        child = left[at]
        for side, own_rows in ((0, rows[goes]), (1, rows[~goes])):
            grow(child + side, own_rows, lows[side], highs[side], level + 1)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = p - y, p * (1 - p)
        roots.append(node(leaf(grad.sum(), hess.sum(), -4.0, 4.0)))
        grow(roots[-1], np.arange(len(y)), -4.0, 4.0, 0)
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(value), np.array(roots), depth, start)


def taught(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, y) of at most `sample` labelled rows, taken in the order of a hash of their id."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("y"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def fit(measured: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees | None:
    """Trees from the rows that `taught` chooses."""
    taken = taught(labels, sample)
    rows = measured.select("doc_id", *FEATURES).dropDuplicates(["doc_id"]).join(F.broadcast(taken), "doc_id").orderBy("doc_id").limit(sample).toPandas()
    return fit_trees(rows[list(FEATURES)].to_numpy(float).reshape(-1, len(FEATURES)), (rows["y"] > 0).to_numpy(float), np.array(list(FEATURES.values())))


def judged(measured: DataFrame, model: Trees | None, threshold: float = THRESHOLD) -> DataFrame:
    """`base_failed`, `kept` and the model's `probability` next to the statistics."""
    schema = f"doc_id {measured.schema['doc_id'].dataType.simpleString()}, {BASE}, base_failed boolean, kept boolean, probability double"

    into = X.arrow_schema(schema)

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(f).to_numpy(False).astype(float) for f in FEATURES]).reshape(len(b), -1)
            n, repeat = b.column("n_words").to_numpy(), b.column("n_repeat_words").to_numpy()
            failed = (n < LEAST_WORDS) | (100 * repeat > MOST_REPEATED * n)
            score = np.ones(len(b)) if model is None else model.score(x)
            made = [b.column(i) for i in range(6)] + [pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score)]
            yield pa.RecordBatch.from_arrays(made, schema=into)

    return measured.mapInArrow(run, schema)


def quality_rules(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Statistics and verdict of every document: doc_id, n_words ... n_repeat_words, base_failed, kept, probability."""
    measured = staged(statistics(docs), "quality")
    return judged(measured, fit(measured, labels, sample), threshold)


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))


def stage_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the rules keep, judged row by row so that no join by id is needed."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    # Only the documents that the trees learn from are measured before; all are measured where they are judged.
    some = docs.select("doc_id", "text").join(F.broadcast(taught(labels).select("doc_id")), "doc_id")
    model = fit(statistics(some), labels)

    def run(batches):
        for batch in batches:
            for part in X.slices(batch):
                made = measure(part)
                x = np.column_stack([np.asarray(made[f], np.float32).astype(float) for f in FEATURES]).reshape(len(part), -1)
                n, repeat = made["n_words"], made["n_repeat_words"]
                keep = ~((n < LEAST_WORDS) | (100 * repeat > MOST_REPEATED * n))
                keep &= True if model is None else model.score(x) >= THRESHOLD
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
