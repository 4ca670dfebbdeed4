"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a short vector of transformed statistics (root or log of rates, so that
their class distributions are nearer to normal).  Class moments are sums, taken over all
labelled training rows by partial sums in Spark.  Class covariances are shrunk towards the
pooled one and then towards the diagonal; their Cholesky factors are computed once, and a
score is the logistic of the difference of the two Mahalanobis log densities plus the log
prior ratio.

Cases: a null text is an empty one, and a text without words scores 0; label rows that are
null or neither 0 nor 1 are ignored, repeated label rows count once each; without rows of
both classes every text with words scores the share of label 1 (0.5 without any row).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import chunks, clash_proof, map_arrow, stored
from tillroll.llm.words import (
    ASCII_SPACE, BYTE_HASH, INVERSE, U64, find_words, powers, prefix_hash, text_bytes,
)

FEATURES = (
    "log_words", "symbols", "capitals", "digits", "stops", "log_word_length",
    "spread_word_length", "repeats", "few_distinct", "no_letter", "line_copies", "non_ascii",
    "log_line_length", "top_word",
)
POOLED = 0.1  # share of the pooled covariance in each class's
DIAGONAL = 0.002  # share of the mean variance on the diagonal

_UPPER, _LETTER, _DIGIT, _STOP, _HIGH, _SYMBOL = range(6)
_CLASSES = np.zeros((6, 256), bool)
_CLASSES[_UPPER, 65:91] = True
_CLASSES[_LETTER, 65:91] = _CLASSES[_LETTER, 97:123] = _CLASSES[_LETTER, 128:] = True
_CLASSES[_DIGIT, 48:58] = True
_CLASSES[_STOP, [ord(c) for c in ".,;:?'\"-()"]] = True
_CLASSES[_HIGH, 128:] = True
_CLASSES[_SYMBOL, 33:127] = ~(_CLASSES[_LETTER] | _CLASSES[_DIGIT] | _CLASSES[_STOP])[33:127]


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeated(text: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: distinct values, and how often its most frequent value stands in it."""
    keys = np.sort((text.astype(U64) << U64(40)) | (hashes >> U64(24)))
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else keys
    owner = (keys[new] >> U64(40)).astype(np.int64)
    runs = np.diff(np.concatenate((new, [len(keys)]))) if len(keys) else np.zeros(0, np.int64)
    top = np.zeros(n)
    np.maximum.at(top, owner, runs)
    return np.bincount(owner, minlength=n).astype(float), top


def statistics(column: pa.Array) -> np.ndarray:
    """One row of FEATURES per text (zeros for a text without words)."""
    raw, bounds = text_bytes(column)
    words = find_words(column, ASCII_SPACE)
    n = len(bounds) - 1
    size = np.maximum(np.diff(bounds), 1).astype(float)
    rate = [_per_text(c[raw], bounds) for c in _CLASSES]
    count = np.diff(words.first).astype(float)
    some = np.maximum(count, 1)
    text = np.repeat(np.arange(n), np.diff(words.first))
    length = (words.end - words.start).astype(float)
    mean = _per_text(length, words.first) / some
    square = _per_text(length**2, words.first) / some
    again = np.zeros(len(text))
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (text[1:] == text[:-1])
    distinct, top = _repeated(text, words.hash, n)
    letters = np.zeros(len(raw) + 1)
    np.cumsum(_CLASSES[_LETTER][raw], out=letters[1:])
    bare = (letters[words.end] == letters[words.start]).astype(float)
    # lines, without their breaks
    breaks = np.append(np.flatnonzero(raw == 10), len(raw))
    starts = np.union1d(breaks[:-1] + 1, bounds[:-1])
    starts = starts[starts < len(raw)]
    line = np.searchsorted(bounds, starts, side="right") - 1
    ends = np.minimum(breaks[np.searchsorted(breaks, starts)], bounds[line + 1])
    sums = prefix_hash(BYTE_HASH[raw])
    line_hash = (sums[ends] - sums[starts]) * powers(INVERSE, len(raw) + 1)[starts]
    n_lines = np.bincount(line, minlength=n).astype(float)
    distinct_lines, _ = _repeated(line, line_hash, n)
    out = np.stack([
        np.log1p(count), np.sqrt(rate[_SYMBOL] / size),
        np.sqrt(rate[_UPPER] / np.maximum(rate[_LETTER], 1)), np.sqrt(rate[_DIGIT] / size),
        np.sqrt(rate[_STOP] / size), np.log1p(mean),
        np.sqrt(np.maximum(square - mean**2, 0)) / np.maximum(mean, 1),
        np.sqrt(_per_text(again, words.first) / some), np.sqrt(1 - distinct / some),
        np.sqrt(_per_text(bare, words.first) / some),
        np.sqrt(1 - distinct_lines / np.maximum(n_lines, 1)), np.sqrt(rate[_HIGH] / size),
        np.log1p(size / np.maximum(n_lines, 1)), np.sqrt(top / some),
    ], axis=1)
    out[count == 0] = 0
    return out


@clash_proof("text_col")
def features(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` without its text plus ``features`` (array<double>)."""
    keep = [c for c in df.columns if c not in (text_col, "features")]
    rows = df.select(
        *(F.col(f"`{c}`") for c in keep), F.col(f"`{text_col}`").cast("string").alias("_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text"):
                x = statistics(part.column("_text"))
                ends = np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32)
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), column], [*keep, "features"]
                )

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    return map_arrow(rows, run, ", ".join([*fields, "features array<double>"]))


@dataclass
class Model:
    prior: float  # log prior ratio; the score's logit if there are no classes
    mean: np.ndarray
    scale: np.ndarray
    classes: list[tuple[np.ndarray, np.ndarray, float]]  # centre, Cholesky factor, log det

    def score(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.prior)
        z = (x - self.mean) / self.scale
        for sign, (centre, factor, log_det) in zip((-1, 1), self.classes):
            y = np.linalg.solve(factor, (z - centre).T)  # factor is small and triangular
            logit += sign * -0.5 * ((y**2).sum(0) + log_det)
        out = 1 / (1 + np.exp(-np.clip(logit, -700, 700)))
        return np.where(x[:, 0] == 0, 0.0, out)  # without words


def fit(train: DataFrame, label_col: str, pooled: float = POOLED, diagonal: float = DIAGONAL) -> Model:
    """Class moments of all rows of ``train`` (features, label 0 or 1), summed in Spark; at
    most 2 * (d + 1) ** 2 sums come to the driver."""
    d = len(FEATURES)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, d + 1, d + 1))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            x = np.hstack([np.ones((len(x), 1)), x])
            for k in (0, 1):
                total[k] += x[y == k].T @ x[y == k]
        k, i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_pydict({
            "k": pa.array(k.ravel().astype(np.int32)), "i": pa.array(i.ravel().astype(np.int32)),
            "j": pa.array(j.ravel().astype(np.int32)), "v": pa.array(total.ravel()),
        })

    rows = train.where(F.col(label_col).isin(0, 1)).select(
        "features", F.col(label_col).cast("int").alias("y")
    )
    partial = map_arrow(rows, moments, "k int, i int, j int, v double")
    total = np.zeros((2, d + 1, d + 1))
    for r in partial.groupBy("k", "i", "j").agg(F.sum("v").alias("v")).collect():
        total[r.k, r.i, r.j] = r.v
    n = total[:, 0, 0]
    if n.min() < 2:
        share = (n[1] + 0.5) / (n.sum() + 1)
        return Model(float(np.log(share / (1 - share))), np.zeros(d), np.ones(d), [])
    both = total.sum(0)
    mean = both[0, 1:] / n.sum()
    scale = np.sqrt(np.maximum(np.diag(both)[1:] / n.sum() - mean**2, 1e-12))
    scale[scale < 1e-5] = 1.0
    centres, covariances = [], []
    for k in (0, 1):
        m = total[k, 0, 1:] / n[k]
        centres.append((m - mean) / scale)
        covariances.append((total[k, 1:, 1:] / n[k] - np.outer(m, m)) / np.outer(scale, scale))
    common = (n[0] * covariances[0] + n[1] * covariances[1]) / n.sum()
    classes = []
    for centre, own in zip(centres, covariances):
        s = (1 - pooled) * own + pooled * common
        s = (1 - diagonal) * s + diagonal * max(np.trace(s) / d, 1e-6) * np.eye(d)
        factor = np.linalg.cholesky(s)
        classes.append((centre, factor, float(2 * np.log(np.diag(factor)).sum())))
    return Model(float(np.log(n[1] / n[0])), mean, scale, classes)


def score(df: DataFrame, model: Model) -> DataFrame:
    """``df`` (with features) without them plus ``score``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in df.columns if c not in ("features", "score")]
    rows = df.select(*(F.col(f"`{c}`") for c in keep), "features")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
            s = shared.value.score(x.reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(s)], [*keep, "score"])

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    return map_arrow(rows, run, ", ".join([*fields, "score double"]))


def classify(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, score) of documents (doc_id, text); learned from ``labels``
    (doc_id, quality) of the rows where ``held_out`` (a Column over doc_id) is false."""
    x = stored(features(docs.select("doc_id", "text")), "quality-features")
    y = labels.where("quality IN (0, 1)").select("doc_id", "quality").distinct()
    train = x.where(~held_out).join(y, "doc_id").select("features", "quality")
    return score(x.withColumn("held_out", held_out), fit(train, "quality"))
