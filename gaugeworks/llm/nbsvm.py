"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams: words, pairs of words, and runs of one to three word shapes (how a
word is cased, what marks it carries, whether it repeats the word before). Each indicator is scaled by
its class log-count ratio r = log((p / |p|) / (q / |q|)) with p, q the smoothed document counts of the
n-gram in the two classes; on these a linear model with hinge loss is fitted by dual coordinate descent,
with the weights of a class inverse to its size. A logistic curve, fitted on rows kept aside, turns margins
into scores.

The model is fitted on at most `max_rows` labelled rows, picked by a hash of their ids; everything that
is learned comes from rows outside the held-out fold. Scores use the text alone.

Null and empty texts have no n-grams: their score comes from the bias. Very long texts: all their n-grams, in training
too; the buckets bound how many there are. Ties: equal scores of different texts need no order. Repeated rows get the
same score; of repeated labels of one id, and of several texts of it, the least counts; null labels and labels without a document are passed over.
With no labels, or one class only, the score is that class's share (0.5 without labels). Empty tables:
empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoder import forget
from .shared import fold_of, small_batches, written
from .words import mix, split_words

#: Buckets for n-grams of words and of shapes.
WORD_BUCKETS, SHAPE_BUCKETS = 1 << 18, 1 << 14
BUCKETS = WORD_BUCKETS + SHAPE_BUCKETS
FOLDS = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[[ord(c) for c in chars]] = 1
    return out


_UPPER, _LOW = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("abcdefghijklmnopqrstuvwxyz")
_DIGIT, _STOP, _ODDMARK = _table("0123456789"), _table(".,;:?'\"-()"), _table("#$%&*<>|~^=+_{}[]\\/@`")
_LOUD = _table("!")
_HIGH = np.zeros(256, np.uint8)
_HIGH[128:] = 1


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(edges, buckets): buckets[edges[d]:edges[d + 1]] are the distinct n-gram buckets of text d, rising."""
    raw = split_words(texts, lower=False)
    low = split_words(texts, lower=True)
    n_texts, n = len(texts), len(low.hash)
    edges = np.zeros(n_texts + 1, np.int64)
    if not n:
        return edges, np.zeros(0, np.int64)
    text = np.repeat(np.arange(n_texts), np.diff(low.first))
    count = lambda table: np.minimum(np.add.reduceat(table[raw.data], raw.start, dtype=np.int64), 2)  # noqa: E731  blanks after a word count nothing
    same = np.zeros(n, np.int64)
    same[1:] = (low.hash[1:] == low.hash[:-1]) & (text[1:] == text[:-1])
    length = np.minimum((raw.end - raw.start) // 4, 3)
    shape = count(_UPPER)
    for part in (count(_LOW), count(_DIGIT), np.minimum(count(_STOP), 1), count(_ODDMARK), np.minimum(count(_LOUD), 1), np.minimum(count(_HIGH), 1), same, length):
        shape = shape * 4 + part
    shape = mix(shape.astype(np.uint64) * _ODD + np.uint64(77))
    parts, owners = [], []
    with np.errstate(over="ignore"):
        parts.append(low.hash % np.uint64(WORD_BUCKETS))
        owners.append(text)
        pair = text[1:] == text[:-1]
        parts.append(mix(low.hash[:-1] * np.uint64(3) + low.hash[1:])[pair] % np.uint64(WORD_BUCKETS))
        owners.append(text[1:][pair])
        run = shape
        for k in range(3):
            if k:
                run = mix(run[:-1] * np.uint64(5) + shape[k:])
            inside = text[k:] == text[: n - k]
            parts.append(np.uint64(WORD_BUCKETS) + run[inside] % np.uint64(SHAPE_BUCKETS))
            owners.append(text[k:][inside])
    both = np.unique((np.concatenate(owners).astype(np.int64) << 20) | np.concatenate(parts).astype(np.int64))
    np.cumsum(np.bincount(both >> 20, minlength=n_texts), out=edges[1:])
    return edges, both & ((1 << 20) - 1)


@dataclass(frozen=True)
class Model:
    """weight and bias of the margin; slope and shift of the logistic curve."""

    weight: np.ndarray
    bias: float
    slope: float
    shift: float

    def margins(self, edges: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(self.weight[buckets], dtype=np.float64)))
        return total[edges[1:]] - total[edges[:-1]] + self.bias

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def ratios(rows: list[np.ndarray], good: np.ndarray, alpha: float = 1.0, least: int = 3) -> np.ndarray:
    """Class log-count ratios; 0 for n-grams of fewer than `least` rows."""
    p, q = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row, label in zip(rows, good, strict=True):
        (p if label else q)[row] += 1
    n_good, n_bad = max(1, int(good.sum())), max(1, int((~good).sum()))
    r = np.log((p + alpha) / (n_good + 2 * alpha)) - np.log((q + alpha) / (n_bad + 2 * alpha))
    return np.where(p + q >= least, r, 0.0)


def dual_descent(rows: list[np.ndarray], good: np.ndarray, r: np.ndarray, cost: float = 0.01, rounds: int = 12, seed: int = 7) -> tuple[np.ndarray, float]:
    """Hinge loss by dual coordinate descent: one multiplier a row, kept within its cost, the weights updated as it moves."""
    y = np.where(good, 1.0, -1.0)
    share = np.where(good, len(y) / (2 * max(1, good.sum())), len(y) / (2 * max(1, (~good).sum())))
    upper = cost * share
    values = [r[row] for row in rows]
    square = np.array([float(v @ v) + 1.0 for v in values])
    alpha, w, bias = np.zeros(len(y)), np.zeros(BUCKETS), 0.0
    pick = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in pick.permutation(len(y)):
            row, v = rows[i], values[i]
            slope = y[i] * (float(w[row] @ v) + bias) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), upper[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[row] += step * v
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-4 * cost:
            break
    return w, bias


def curve(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of margins, by Newton steps with smoothed targets."""
    n_good, n_bad = good.sum(), (~good).sum()
    if not n_good or not n_bad:
        return 1.0, 0.0
    target = np.where(good, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    x = np.stack([margins, np.ones(len(margins))])
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -30, 30)))
        hessian = (x * (p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x @ (p - target))
        at = at - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(at[0], 1e-3)), float(at[1])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", max_rows: int = 6000) -> Model:
    """A model of `label`, fitted on at most max_rows labelled rows outside the held-out fold."""
    own = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")).filter("id IS NOT NULL AND y IS NOT NULL")
    own = own.groupBy("id").agg(F.min("y").alias("y")).withColumn("fold", fold_of("id", FOLDS)).filter("fold <> 0")
    n = own.count()
    # a hash of the id picks about max_rows ids, whatever the table's size; the limit only cuts what chance adds
    share = min(1.0, 0.97 * max_rows / max(1, n))
    picked = own.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000)).limit(max_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    joined = texts.join(F.broadcast(picked), "id").select("id", "text", "y", "fold")  # max_rows ids at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in small_batches(batches):
            edges, buckets = features(batch.column(1).to_pylist())
            own = [buckets[a:b].astype(np.int32).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array(own, pa.binary())], ["id", "y", "fold", "f"])

    # of several texts of an id the least counts, so that a model is the same each time
    made = joined.mapInArrow(run, "id long, y int, fold long, f binary").groupBy("id", "y", "fold").agg(F.min("f").alias("f"))
    got = sorted(written(made, "labelled").collect(), key=lambda r: r["id"])
    good = np.array([r["y"] == 1 for r in got], bool)
    if not len(good) or good.all() or not good.any():
        base = 0.5 if not len(good) else float(good.all())
        return Model(np.zeros(BUCKETS, np.float32), 0.0, 1.0, float(np.log((base + 1e-3) / (1 - base + 1e-3))))
    rows = [np.frombuffer(r["f"], np.int32) for r in got]
    aside = np.array([r["fold"] == 1 for r in got], bool)
    fit = lambda use: (lambda x, y: (lambda r: (r, *dual_descent(x, y, r)))(ratios(x, y)))([rows[i] for i in np.flatnonzero(use)], good[use])
    margin = lambda r, w, b, use: np.array([float(w[rows[i]] @ r[rows[i]]) + b for i in np.flatnonzero(use)])
    both = lambda use: bool(good[use].any() and not good[use].all())
    if both(aside) and both(~aside):
        slope, shift = curve(margin(*fit(~aside), aside), good[aside])
    else:
        slope, shift = 1.0, 0.0
    r, w, bias = fit(np.ones(len(good), bool))
    return Model((w * r).astype(np.float32), bias, slope, shift)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", limit: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers of 4 bytes: 1.1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in small_batches(batches):
            found = shared.value.scores(shared.value.margins(*features(batch.column(1).to_pylist())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, score double")
    return rows.select(F.col("id").alias(id_col), (fold_of("id", FOLDS) == 0).alias("held_out"), "score", (F.col("score") >= limit).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", limit: float = 0.3) -> DataFrame:
    """The rows of docs whose score reaches the limit, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in small_batches(batches, at):
            found = shared.value.scores(shared.value.margins(*features(batch.column(at).to_pylist())))
            yield batch.filter(pa.array(found >= limit))

    return docs.mapInArrow(run, docs.schema)
