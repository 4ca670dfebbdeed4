"""Language identification: sparse multinomial logistic regression on character n-grams.

Texts are lower-cased, everything that is no letter becomes a space, and their 1- to
3-grams are hashed into ``BUCKETS`` counts.  Document frequencies are counted over all
training documents.  Weights are learned by follow-the-regularised-leader (proximal, with
per-coordinate rates) under an elastic-net penalty, so most are exactly zero, from a
bounded sample of training documents; a fifth of that sample is kept back to calibrate a
temperature for the probabilities.

The sample takes about ``PER_LANGUAGE`` documents of each language, chosen by a hash of the
row, and at most ``SAMPLE`` in all (the only bounded part).

Cases: a text that is null, empty or has no letter is ``und`` with score 0, also without
any training document; rows without language teach nothing; one learned language is
predicted with score 1; repeated rows are classified each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import chunks, clash_proof, map_arrow, maybe_broadcast
from tillroll.llm.words import U64, _mix

BUCKETS = 1 << 14
GRAMS = 3
PER_LANGUAGE = 1000
SAMPLE = 8000
MIN_CALIBRATED = 50  # with fewer rows all are learned from, at temperature 1
EPOCHS = 2
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.1
UNDETERMINED = "und"

_SPACE = 32
_TABLE = np.arange(0x10000, dtype=np.uint32)
_TABLE[[c for c in range(0x10000) if not (0xD800 <= c < 0xE000 or chr(c).isalpha())]] = _SPACE
_letter = regex.compile(r"\p{L}").search


def counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds, bucket, count): the non-empty buckets of each text."""
    codes = [np.frombuffer((t or "").lower().encode("utf-32-le"), np.uint32) for t in texts]
    bounds = np.cumsum([0] + [len(c) for c in codes])
    code = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
    narrow = code < len(_TABLE)
    code = np.where(narrow, _TABLE[np.where(narrow, code, 0)], code).astype(U64)
    n = len(texts)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    total = np.zeros(n * BUCKETS, np.int64)
    gram = np.zeros(len(code), U64)
    for k in range(1, GRAMS + 1):
        m = len(code) - k + 1
        if m <= 0:
            break
        gram = gram[:m] * U64(0x9E3779B97F4A7C15) + code[k - 1 :] + U64(k << 32)
        whole = owner[:m] == owner[k - 1 :]  # not across texts
        lone = code[:m] != _SPACE if k == 1 else True
        keep = whole & lone
        bucket = (_mix(gram[keep]) % U64(BUCKETS)).astype(np.int64)
        total += np.bincount(owner[:m][keep] * BUCKETS + bucket, minlength=n * BUCKETS)
    at = np.flatnonzero(total)
    return np.searchsorted(at, np.arange(n + 1) * BUCKETS), at % BUCKETS, total[at]


def weigh(bounds: np.ndarray, bucket: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF values of unit length per text: (1 + log count) * idf."""
    x = (1 + np.log(count)) * idf[bucket]
    squares = np.zeros(len(x) + 1)
    np.cumsum(x**2, out=squares[1:])
    norm = np.sqrt(squares[bounds[1:]] - squares[bounds[:-1]])
    return x / np.repeat(np.maximum(norm, 1e-12), np.diff(bounds))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # (BUCKETS, languages)
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, bounds, bucket, x) -> np.ndarray:
        sums = np.zeros((len(x) + 1, len(self.languages)))
        np.cumsum(self.weights[bucket] * x[:, None], axis=0, out=sums[1:])
        return sums[bounds[1:]] - sums[bounds[:-1]] + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        lettered = np.array([bool(t and _letter(t)) for t in texts], bool)
        if not self.languages or not lettered.any():
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        bounds, bucket, count = counts(texts)
        p = softmax(self.logits(bounds, bucket, weigh(bounds, bucket, count, self.idf)) / self.temperature)
        best = p.argmax(1)
        names = [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, lettered)]
        return names, np.where(lettered, p.max(1), 0.0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def learn(
    rows: list[tuple[np.ndarray, np.ndarray, int]], n_classes: int, epochs: int = EPOCHS
) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over (buckets, values, class) rows: (weights, bias)."""
    z, n = np.zeros((BUCKETS + 1, n_classes)), np.zeros((BUCKETS + 1, n_classes))

    def weights(z, n):
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) > L1, w, 0.0)

    for _ in range(epochs):
        for bucket, x, label in rows:
            at = np.append(bucket, BUCKETS)  # the last coordinate is the bias
            value = np.append(x, 0.1)
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            p = softmax((value @ w)[None])[0]
            p[label] -= 1
            g = value[:, None] * p
            grown = ns + g**2
            z[at] = zs + g - (np.sqrt(grown) - np.sqrt(ns)) / ALPHA * w
            n[at] = grown
    w = weights(z, n)
    return w[:-1], 0.1 * w[-1]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least cross entropy (golden section on its log).  Targets leave
    1 / (rows + 2) to the other classes, so that separable rows don't drive it to zero."""
    rest = 1 / (len(labels) + 2)
    target = np.full(logits.shape, rest / (logits.shape[1] - 1))
    target[np.arange(len(labels)), labels] = 1 - rest

    def loss(t: float) -> float:
        return -(target * np.log(np.maximum(softmax(logits / np.exp(t)), 1e-300))).sum()

    a, b, ratio = np.log(0.02), np.log(20), (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for texts in _groups(batch, "_text"):
                _, bucket, _ = counts(texts)
                total += np.bincount(bucket, minlength=BUCKETS)
                n += len(texts)
        at = np.append(np.flatnonzero(total), -1)  # -1: documents
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array(at, pa.int32()),
            "n": pa.array(np.append(total[at[:-1]], n), pa.int64()),
        })

    partial = map_arrow(train.select("_text"), run, "bucket int, n long")
    df, n = np.zeros(BUCKETS), 0
    for r in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # <= BUCKETS + 1
        if r.bucket < 0:
            n = r.n
        else:
            df[r.bucket] = r.n
    return df, n


def _groups(batch: pa.RecordBatch, column: str) -> Iterator[list[str | None]]:
    """Texts by few at a time: a group's counts are a dense table."""
    for part in chunks(batch, column, 1 << 19):
        for at in range(0, part.num_rows, 64):
            yield part.column(column).slice(at, 64).to_pylist()


def fit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
    per_language: int = PER_LANGUAGE, sample: int = SAMPLE,
) -> Model:
    """Learn from the rows of ``docs`` with a language and a text that has a letter."""
    train = docs.select(
        F.col(f"`{text_col}`").cast("string").alias("_text"),
        F.col(f"`{lang_col}`").cast("string").alias("_lang"),
    ).where(F.col("_lang").isNotNull() & F.col("_text").rlike(r"\p{L}"))
    df, n = _document_frequencies(train)
    idf = np.log((1 + n) / (1 + df)) + 1
    sizes = {r._lang: r.n for r in train.groupBy("_lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], idf, np.zeros((BUCKETS, 0)), np.zeros(0))
    share = docs.sparkSession.createDataFrame(
        [(k, min(1.0, per_language / v)) for k, v in sizes.items()], "_l string, share double"
    )
    draw = F.xxhash64("_text", "_lang")
    chosen = (
        # the counted languages, a few rows: the texts are not shuffled for a draw
        train.join(maybe_broadcast(share, len(sizes), 64), F.col("_lang") == F.col("_l"))
        .where(F.pmod(draw, F.lit(1 << 30)) < F.col("share") * (1 << 30))
        .withColumn("_draw", F.xxhash64(draw, F.lit(1)))
    )

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text", 1 << 19):
                for at in range(0, part.num_rows, 64):
                    some = part.slice(at, 64)
                    bounds, bucket, count = counts(some.column("_text").to_pylist())
                    x = weigh(bounds, bucket, count, idf).astype(np.float32)
                    ends = pa.array(bounds.astype(np.int32))
                    yield pa.RecordBatch.from_arrays([
                        some.column("_draw"), some.column("_lang"),
                        pa.ListArray.from_arrays(ends, pa.array(bucket.astype(np.int16))),
                        pa.ListArray.from_arrays(ends, pa.array(x)),
                    ], ["_draw", "lang", "bucket", "x"])

    rows = map_arrow(
        chosen.select("_text", "_lang", "_draw"), vectors,
        "_draw long, lang string, bucket array<smallint>, x array<float>",
    ).orderBy("_draw", "lang").limit(sample).toArrow()
    code = {k: i for i, k in enumerate(languages)}
    examples = [
        (b.values.to_numpy().astype(np.int64), v.values.to_numpy().astype(np.float64), code[k])
        for k, b, v in zip(rows["lang"].to_pylist(), rows["bucket"], rows["x"])
    ]
    kept_back, learned = examples[::5], [e for i, e in enumerate(examples) if i % 5]
    if len(examples) < MIN_CALIBRATED:
        kept_back, learned = [], examples
    weights, bias = learn(learned, len(languages))
    model = Model(languages, idf, weights, bias)
    if len(languages) > 1 and kept_back:
        bounds = np.cumsum([0] + [len(b) for b, _, _ in kept_back])
        bucket, x = (np.concatenate([e[i] for e in kept_back]) for i in (0, 1))
        labels = np.array([e[2] for e in kept_back])
        model.temperature = calibrate(model.logits(bounds, bucket, x), labels)
    return model


@clash_proof("text_col")
def predict(
    docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True
) -> DataFrame:
    """``docs`` plus lang_pred and score (columns of those names are replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages
    keep = [c for c in docs.columns if c not in (text_col, "_text", "lang_pred", "score")]
    out = [*keep, *(["_text"] if keep_text else [])]
    rows = docs.select(
        *(F.col(f"`{c}`") for c in keep), F.col(f"`{text_col}`").cast("string").alias("_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for texts in _groups(batch, "_text"):
                found, p = shared.value.predict(texts)
                names += found
                scores.append(p)
            yield pa.RecordBatch.from_arrays([
                *batch.columns[: len(out)], pa.array(names, pa.string()),
                pa.array(np.concatenate(scores or [np.zeros(0)])),
            ], [*out, "lang_pred", "score"])

    fields = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in out]
    found = map_arrow(rows, run, ", ".join([*fields, "lang_pred string", "score double"]))
    return found.withColumnRenamed("_text", text_col)


def classify(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of documents (doc_id, text, lang), learned from
    the rows where ``held_out`` (a Column over doc_id) is false."""
    model = fit(docs.where(~held_out))
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    return predict(rows, model, keep_text=False)
