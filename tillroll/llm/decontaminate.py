"""Benchmark decontamination: which words of a document stand in benchmark windows.

A window is ``window`` consecutive words of an item (the whole item if it has fewer).  The
containment join is prefix-filtered: a window's shingles are ordered by rarity (their
counts over *all* documents), and as containment must be complete, the single rarest one is
a necessary prefix.  Documents meet windows only at that shingle; the length bound and the
position bound (the window must fit into the document around the shingle) come next, then
all words are compared, by hash and then by bytes.

The benchmark is indexed in slices of at most ``slice_bytes`` text bytes, counted first; a
slice's index is broadcast, documents are never shuffled.  A benchmark below that is one
slice.

Cases: null or word-less documents have no hits; item rows with a null id or no words are
ignored; equal item rows count once, equal windows of several items name them all; an
empty benchmark hits nothing.  Columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import BROADCAST_BYTES, chunks, clash_proof, map_arrow, stored
from tillroll.llm.words import ALPHANUMERIC, U64, Words, find_words

WINDOW = 10
SHINGLE = 3
_FILTER_BITS = 22

_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
_ADDED = "n_words long, n_hit long, item_ids array<long>, " \
    "hit_spans array<struct<first:int,last:int>>"


class WindowIndex:
    """Distinct windows of some items, keyed by one of their shingles."""

    def __init__(self, items: list[tuple[int, str]], window: int, shingle: int):
        column = pa.array([text for _, text in items], pa.string())
        words = find_words(column, ALPHANUMERIC)
        self.shingle = shingle
        found: dict[tuple, set[int]] = defaultdict(set)
        for (item, _), a, b in zip(items, words.first, words.first[1:]):
            size = min(window, b - a)
            text = [words.word(i) for i in range(a, b)]
            for i in range(b - a - size + 1 if size else 0):
                found[tuple(text[i : i + size])].add(item)
        self.windows = list(found)
        self.items = [sorted(x) for x in found.values()]
        self.size = np.array([len(w) for w in self.windows], np.int64)
        joined = pa.array([b" ".join(w).decode() for w in self.windows], pa.string())
        self.words = find_words(joined, ALPHANUMERIC)
        self.table = np.zeros((len(self.windows), window), U64)
        for j in range(window):
            has = self.size > j
            self.table[has, j] = self.words.hash[self.words.first[:-1][has] + j]

    def by_size(self) -> dict[int, np.ndarray]:
        """Windows by the number of words in their shingles."""
        k = np.minimum(self.size, self.shingle)
        return {int(x): np.flatnonzero(k == x) for x in np.unique(k)}

    def all_shingles(self, k: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, window, offset) of each shingle of ``k`` words."""
        hashes, _ = self.words.shingles(k)
        n = self.size[rows] - k + 1
        row = np.repeat(rows, n)
        offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        return hashes[self.words.first[row] + offset], row, offset

    def choose(self, counts: dict[tuple[int, int], int]) -> None:
        """Keep each window's rarest shingle (ties: smaller hash, then offset)."""
        self.keys = {}
        for k, rows in self.by_size().items():
            hashes, row, offset = self.all_shingles(k, rows)
            rarity = np.array([counts.get((k, int(np.int64(h))), 0) for h in hashes.view(np.int64)])
            order = np.lexsort((offset, hashes, rarity, row))
            first = order[np.unique(row[order], return_index=True)[1]]
            first = first[np.argsort(hashes[first], kind="stable")]
            self.keys[k] = (hashes[first], row[first], offset[first], _bits(hashes[first]))


def _bits(hashes: np.ndarray) -> np.ndarray:
    """A table of hash prefixes: most other hashes are ruled out by one look."""
    out = np.zeros(1 << _FILTER_BITS, bool)
    out[(hashes >> U64(64 - _FILTER_BITS)).astype(np.int64)] = True
    return out


def _present(words: Words, k: int, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, valid = words.shingles(k)
    at = np.flatnonzero(bits[(hashes >> U64(64 - _FILTER_BITS)).astype(np.int64)] & valid)
    return hashes[at], at


def matches(words: Words, index: WindowIndex) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every occurrence of the index's windows."""
    firsts, rows = [], []
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    for k, (keys, row, offset, bits) in index.keys.items():
        hashes, at = _present(words, k, bits)
        lo, hi = np.searchsorted(keys, hashes), np.searchsorted(keys, hashes, side="right")
        entry = np.repeat(lo, hi - lo) + _steps(hi - lo)
        at = np.repeat(at, hi - lo)
        window, first = row[entry], at - offset[entry]
        last = first + index.size[window]
        keep = (first >= words.first[text[at]]) & (last <= words.first[text[at] + 1])
        first, window = first[keep], window[keep]
        for j in range(index.table.shape[1]):
            has = index.size[window] > j
            same = ~has
            same[has] = words.hash[first[has] + j] == index.table[window[has], j]
            first, window = first[same], window[same]
        exact = [
            tuple(words.word(i) for i in range(f, f + index.size[w])) == index.windows[w]
            for f, w in zip(first, window)
        ]
        exact = np.array(exact, bool)
        firsts.append(first[exact])
        rows.append(window[exact])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(firsts), np.concatenate(rows)


def _steps(n: np.ndarray) -> np.ndarray:
    """0..n[0]-1, 0..n[1]-1, ..."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _count_shingles(docs: DataFrame, index: WindowIndex) -> dict[tuple[int, int], int]:
    """Occurrences over all documents of each shingle of the index."""
    wanted = {k: np.unique(index.all_shingles(k, rows)[0]) for k, rows in index.by_size().items()}
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {k: (w, _bits(w), np.zeros(len(w), np.int64)) for k, w in shared.value.items()}
        for batch in batches:
            for part in chunks(batch, "_text"):
                words = find_words(part.column("_text"), ALPHANUMERIC)
                for k, (keys, bits, total) in tables.items():
                    hashes, _ = _present(words, k, bits)
                    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                    np.add.at(total, at[keys[at] == hashes], 1)
        for k, (keys, _, total) in tables.items():
            some = total > 0
            yield pa.RecordBatch.from_pydict({
                "k": pa.array(np.full(some.sum(), k, np.int32)),
                "shingle": pa.array(keys[some].view(np.int64)),
                "n": pa.array(total[some]),
            })

    partial = map_arrow(docs.select("_text"), count, "k int, shingle long, n long")
    summed = partial.groupBy("k", "shingle").agg(F.sum("n").alias("n"))
    return {(r.k, r.shingle): r.n for r in summed.collect()}  # at most the index's shingles


def _slice_pass(docs: DataFrame, index: WindowIndex, extend: bool, text: bool) -> DataFrame:
    """Add the result columns; ``extend``: to those that ``docs`` has from other slices;
    ``text``: return the text too."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    drop = {"n_words", "n_hit", "item_ids", "hit_spans"} | ({"_text"} if not text else set())
    keep = [c for c in docs.columns if c not in drop]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text"):
                words = find_words(part.column("_text"), ALPHANUMERIC)
                first, window = matches(words, shared.value)
                n, total = part.num_rows, len(words.hash)
                items: list[set[int]] = [set() for _ in range(n)]
                delta = np.zeros(total + 1, np.int64)
                np.add.at(delta, first, 1)
                np.add.at(delta, first + shared.value.size[window], -1)
                text = np.searchsorted(words.first, first, side="right") - 1
                for t, w in set(zip(text.tolist(), window.tolist())):
                    items[t].update(shared.value.items[w])
                if extend:
                    for t, (ids, spans) in enumerate(zip(
                        part.column("item_ids").to_pylist(), part.column("hit_spans").to_pylist()
                    )):
                        items[t].update(ids)
                        for s in spans:
                            delta[words.first[t] + s["first"]] += 1
                            delta[words.first[t] + s["last"] + 1] -= 1
                hit = np.zeros(total + 1, np.int64)
                np.cumsum(np.cumsum(delta[:-1]) > 0, out=hit[1:])
                n_hit = hit[words.first[1:]] - hit[words.first[:-1]]
                spans = [
                    _runs(np.diff(hit[a : b + 1])) if k else []
                    for k, a, b in zip(n_hit, words.first, words.first[1:])
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + [
                        pa.array(np.diff(words.first).astype(np.int64)), pa.array(n_hit),
                        pa.array([sorted(x) for x in items], pa.list_(pa.int64())),
                        pa.array(spans, _SPANS),
                    ],
                    [*keep, "n_words", "n_hit", "item_ids", "hit_spans"],
                )

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    return map_arrow(docs, run, ", ".join([*fields, _ADDED]))


def _runs(mask: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask, [0]))))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2])]


@clash_proof("text_col")
def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
    slice_bytes: int = BROADCAST_BYTES // 8, keep_text: bool = True,
) -> DataFrame:
    """``docs`` plus n_words, n_hit, item_ids (sorted, distinct) and hit_spans (first and
    last word of each maximal run of hit words)."""
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")
    ).where("item IS NOT NULL AND text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_slices = max(1, -(-total // slice_bytes))
    clash = {text_col, "_text", "n_words", "n_hit", "item_ids", "hit_spans"}
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in clash]
    out = docs.select(*keep, F.col(f"`{text_col}`").cast("string").alias("_text"))
    for i in range(n_slices):
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(n_slices)) == i)
        index = WindowIndex([tuple(r) for r in part.collect()], window, shingle)
        index.choose(_count_shingles(out, index) if index.windows else {})
        last = i + 1 == n_slices
        out = _slice_pass(out, index, extend=i > 0, text=keep_text or not last)
        if not last:
            out = stored(out, "contamination")
    return out.withColumnRenamed("_text", text_col)
