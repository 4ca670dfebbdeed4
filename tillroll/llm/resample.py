"""Importance resampling towards a target distribution by hashed n-gram features.

Features of a text are its runs of 1 to ``grams`` consecutive words joined by one space.  A
feature's bucket is the CRC-32 of its UTF-8 bytes modulo ``buckets``.  Per chunk of texts the
distinct features are grouped by byte length into two-dimensional uint8 arrays, all CRCs of
a length are updated column by column with one table lookup each, and the buckets are
scattered back to the occurrences.

Two passes over the documents: the first sums bucket counts of all documents and of the
target texts (``buckets`` rows reach the driver), the second gives each document the mean
gain of its features, floor(1000 * ln of the smoothed ratio of target to corpus frequency).
A Gumbel variate of the document's id is added, so the highest scores are a sample without
replacement whose weights are the importance weights.  Scores are ranked by a distributed
sort: ranges of (score, id) are numbered within their partition and moved up by the sizes of
the partitions before, so no task holds more than a range.

Cases: a null text has no words, no features and weight 0; so has a text of separators only;
a null id counts as the empty text in its Gumbel variate and comes last among equal scores;
rows with equal ids are rows of their own, and rows equal in score and id are ranked in the
order of n_features and weight; an empty target or corpus has counts of 0, which the
smoothing allows; very long words and texts are hashed in chunks; columns of other names
pass through, those named like the added ones are replaced; an empty table gives an empty
result.  Words are told apart by 64-bit hashes within a chunk of about 1 MB.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow, stored
from tillroll.llm.words import ALPHANUMERIC, LOWER, blocks, word_edges, word_hashes

BUCKETS = 10_000
GRAMS = 2
MIN_WORDS = 20
SHARE = 25  # percent of the documents of MIN_WORDS words that are drawn
SEED = 7
LONG = 512  # features of more bytes are too few for a matrix


def _crc_table() -> np.ndarray:
    """The byte table of the reflected CRC-32 polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC_TABLE = _crc_table()


def crc32(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of the byte strings ``data[start:start + size]``, length by length."""
    out = np.zeros(len(start), np.uint32)
    order = np.argsort(size, kind="stable")
    lengths, cut = np.unique(size[order], return_index=True)
    for length, a, b in zip(lengths.tolist(), cut, np.append(cut[1:], len(order))):
        own = order[a:b]
        if length > LONG:
            out[own] = [zlib.crc32(data[s : s + length].tobytes()) for s in start[own].tolist()]
            continue
        matrix = data[start[own][:, None] + np.arange(length)]
        crc = np.full(len(own), 0xFFFFFFFF, np.uint32)
        for column in range(length):
            crc = CRC_TABLE[(crc ^ matrix[:, column]) & 0xFF] ^ crc >> np.uint32(8)
        out[own] = ~crc
    return out


def _numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first occurrence of each distinct value, number of each value)."""
    _, first, number = np.unique(values, return_index=True, return_inverse=True)
    return first, number


class Features:
    """Buckets of all features of some texts: (text, bucket) of each occurrence."""

    def __init__(self, raw: np.ndarray, bounds: np.ndarray, grams: int, buckets: int):
        data = LOWER[raw]
        start, end = word_edges(data, bounds, ALPHANUMERIC)
        self.first = np.searchsorted(start, bounds)
        n = len(start)
        # the words of a text joined by one space: of what follows a word the first byte
        # stays, as a blank, unless the text ends
        last = np.zeros(n, bool)
        last[self.first[1:][self.first[1:] > self.first[:-1]] - 1] = True
        line = np.append(data, np.uint8(32))
        line[end[~last]] = 32
        mark = np.zeros(len(line) + 1, np.int8)
        mark[start] = 1
        mark[end + ~last] -= 1
        cover = np.cumsum(mark[:-1], dtype=np.int8) > 0
        place = np.concatenate(([0], np.cumsum(cover)))
        line, begin, stop = line[cover], place[start], place[end]
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(self.first))
        one = word_hashes(data, start, end)
        lead, word = _numbers(one)
        kinds = len(lead) + 1
        texts, found = [], []
        number = word  # of the run of k words from each word on
        for k in range(1, grams + 1):
            if k > 1:
                at = np.flatnonzero(text[: max(0, n - k + 1)] == text[k - 1 :]) if n >= k else np.zeros(0, np.int64)
                runs = number[at] * kinds + word[at + k - 1]
                lead, inverse = _numbers(runs)
                number = np.zeros(n, np.int64)
                number[at] = inverse
                lead = at[lead]
            else:
                at, inverse = np.arange(n), word
            size = stop[np.minimum(lead + k - 1, n - 1)] - begin[lead] if n else np.zeros(0, np.int64)
            bucket = (crc32(line, begin[lead], size) % np.uint32(buckets)).astype(np.int64)
            texts.append(text[at])
            found.append(bucket[inverse])
        self.text, self.bucket = np.concatenate(texts), np.concatenate(found)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``blocks`` in which a long text is put together again (its runs cross the parts)."""
    held: list[np.ndarray] = []
    for at, rows, data, bounds in blocks(batch.column(column), ALPHANUMERIC):
        if len(bounds) == 2 and (held or not rows):
            held.append(data)
            if rows:
                data = np.concatenate(held)
                held = []
                yield at, 1, data, np.array([0, len(data)])
            continue
        yield at, rows, data, bounds


def bucket_counts(texts: DataFrame, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): occurrences of features over all rows of the one string column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, bounds in _texts(batch, 0):
                total += np.bincount(Features(data, bounds, grams, buckets).bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array(some.astype(np.int32)), "n": pa.array(total[some]),
        })

    return map_arrow(texts, run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket."""
    s_all, t_all = float(sum(corpus.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([
        math.floor(1000 * math.log(
            (target.get(b, 0) + 1.0) * s_all / ((corpus.get(b, 0) + 1.0) * t_all)
        )) for b in range(buckets)
    ], np.int64)


def gumbel(seed: int, doc_id) -> int:
    """floor(-1000 * ln(-ln(u))) with u from the first 32 bits of SHA-256 of ``seed:id``."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


_ADDED = ("n_words", "n_features", "weight", "score")


def score(
    df: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
    grams: int = GRAMS, seed: int = SEED,
) -> DataFrame:
    """``df`` without its text plus n_words, n_features, weight and score (all long)."""
    keep = [c for c in df.columns if c != text_col and c not in (*_ADDED, "rank")]
    others = [f"c{i}" for i in range(len(keep))]
    rows = df.select(
        *(F.col(f"`{c}`").alias(o) for c, o in zip(keep, others)),
        F.col(f"`{id_col}`").cast("string").alias("i"), F.col(f"`{text_col}`").cast("string").alias("t"),
    )
    shared = df.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            ids = batch.column(batch.num_columns - 2)
            for at, count, data, bounds in _texts(batch, batch.num_columns - 1):
                found = Features(data, bounds, grams, len(gain))
                n = np.bincount(found.text, minlength=count)
                total = np.zeros(count, np.int64)
                np.add.at(total, found.text, gain[found.bucket])
                weight = total // np.maximum(n, 1)
                noise = np.array([gumbel(seed, i) for i in ids.slice(at, count).to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, count) for c in batch.columns[:-2]),
                     *(pa.array(x.astype(np.int64)) for x in (np.diff(found.first), n, weight, weight + noise))],
                    [*others, *_ADDED],
                )

    fields = [f"{o} {df.schema[c].dataType.simpleString()}" for c, o in zip(keep, others)]
    return map_arrow(rows, run, ", ".join(fields + [f"{c} long" for c in _ADDED])).toDF(*keep, *_ADDED)


def ranked(scored: DataFrame, id_col: str, share: int, min_words: int) -> DataFrame:
    """``scored`` plus ``rank`` (long): 1, 2, ... of the drawn rows, null for the others."""
    names = scored.columns
    plain = scored.toDF(*(f"c{i}" for i in range(len(names))))
    at = {n: f"c{i}" for i, n in enumerate(names)}
    fit = F.col(at["n_words"]) >= min_words
    order = [F.desc(at["score"]), F.asc_nulls_last(at[id_col]), F.asc(at["n_features"]), F.asc(at["weight"])]
    # the number holds the partition (upper 31 bits) and the place in it
    placed = stored(
        plain.where(fit).orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "places"
    )
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # one row a partition
    before = sizes.select("part", (
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ).alias("before"))
    drawn = F.floor(F.lit(share) * placed.count() / 100)
    number = F.col("place") - F.shiftleft("part", 33) + F.coalesce("before", F.lit(0)) + 1
    with_rank = placed.withColumn("part", part).join(F.broadcast(before), "part").withColumn(
        "rank", F.when(number <= drawn, number).cast("long")
    )
    rest = plain.where(~fit | fit.isNull()).withColumn("rank", F.lit(None).cast("long"))
    columns = [*at.values(), "rank"]
    return with_rank.select(*columns).union(rest.select(*columns)).toDF(*names, "rank")


def resample(
    df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    target_col: str = "text", share: int = SHARE, min_words: int = MIN_WORDS,
    grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED,
) -> DataFrame:
    """``df`` without its text plus n_words, n_features, weight, score and rank: of the N rows
    of at least ``min_words`` words the floor(share * N / 100) highest scores are drawn."""

    def counts(texts: DataFrame, column: str) -> dict[int, int]:
        one = texts.select(F.col(f"`{column}`").cast("string").alias("t"))
        return {r.bucket: r.n for r in bucket_counts(one, grams, buckets).collect()}  # <= buckets

    gain = gains(counts(df, text_col), counts(target, target_col), buckets)
    return ranked(stored(score(df, gain, id_col, text_col, grams, seed), "scores"), id_col, share, min_words)
