"""Removal of repeated word windows: every word covered by a window of ``window`` words whose
sequence also starts anywhere else (another document, or another place of the same one).

1. *Count-min prefilter.*  The anchor of a window is the ``gram``-word string in it whose
   hash is least (the leftmost on ties): equal windows have equal anchors at equal places.
   Consecutive windows with one anchor occurrence form a run, about one per 8 words.  Each
   task counts the anchors of its runs in a sketch of ``ROWS`` rows and sends the cells that
   are not zero; partition sketches are added up cell by cell.  The least cell of an anchor
   is at least the number of its runs, and so at least the count of each of its windows:
   a window whose estimate is 1 cannot be repeated.  The sketch's flags (one bit a cell) are
   broadcast; their size grows with the text up to a bound.
2. *Exact grouping.*  A second pass takes only runs whose estimate is 2 or more.  Equal runs
   (anchor hash, hash of all their words, length) are grouped: all windows of a run that has
   an equal one are repeated.  Each task groups its own runs first and sends one
   representative of each class, so a passage of very many copies leaves a run per task.
   Anchors with several kinds of runs (a passage that ends, or a short common phrase) go on
   to a third pass: one representative of each class sends its windows one by one, which
   are grouped by the hash of all their words.  Anchors that the sketch shows to be very
   frequent go to single windows at once, so that no group of runs is large.
3. The removed windows of a document are united and its kept words returned.

The sketch only saves work: with too few cells for the corpus all runs are grouped, by a
shuffle of 32 bytes per run, and the result is the same.  Words, runs and windows are
compared by hashes of 64 bits a word and 128 bits a run or window, never by their bytes: two
different windows are taken as equal with a probability below 1e-10 over 1e13 windows.

Cases: a null text has no words; a text of fewer than ``window`` words keeps them all; rows
with null or equal ids count as rows of their own (two equal texts under one id repeat each
other); ids of any type are returned as they are; other columns pass through whatever their
names, except that columns named like the added ones are replaced; a text of any length is
hashed in parts of bounded size; the choice of representatives (ties) does not change the
result; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import chunks, map_arrow, numbered, stored
from tillroll.llm.sketch import Sketch, build_sketch
from tillroll.llm.spans import SPAN, by_document, packed, packed_by_doc
from tillroll.llm.words import (
    ASCII_SPACE, U64, _mix, blocks, powers, prefix_hash, text_bytes, word_edges, word_hashes,
)

WINDOW = 35
GRAM = 20
BYTES_PER_RUN = 50  # of text, about; sizes the sketch
POOL = 400_000  # entries grouped at once in a task
PARTITION_BYTES = 64 << 20  # text bytes per shuffle partition

_BASES = (0xA0761D6478BD642F | 1, 0xE7037ED1A0B428DB | 1)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)
_ENTRY = (("key", np.uint64), ("span", np.uint64), ("n", np.int32), ("doc", np.int64),
          ("start", np.int32), ("many", np.uint8))
_SPAN = [k for k, _ in SPAN]
# packed arrays, one row per bucket; kind 0: decided (only documents, starts and lengths, by
# buckets of documents), kind 1: to be grouped, by buckets of keys
_ENTRIES = "bucket int, kind int, " + ", ".join(f"{k} binary" for k, _ in _ENTRY)
_FOUND = "bucket int, kind int, " + ", ".join(f"{k} binary" for k in _SPAN)


def _sequences(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, word hashes, first): row i's words are ``first[i]:first[i + 1]``."""
    held: list[np.ndarray] = []
    for at, rows, data, bounds in blocks(batch.column(column), ASCII_SPACE):
        start, end = word_edges(data, bounds, ASCII_SPACE)
        codes = word_hashes(data, start, end)
        if len(bounds) == 2 and (held or not rows):  # a part of a long text
            held.append(codes)
            if rows:
                codes = np.concatenate(held)
                yield at, 1, codes, np.array([0, len(codes)])
                held = []
            continue
        yield at, rows, codes, np.searchsorted(start, bounds)


class Runs:
    """The runs of some word sequences."""

    def __init__(self, codes: np.ndarray, first: np.ndarray, window: int, gram: int):
        n = len(codes)
        self.window = window
        self.sums = [prefix_hash(codes, b) for b in _BASES]
        if n < window:
            self.at = self.n = np.zeros(0, np.int64)
            self.key = np.zeros(0, U64)
            return
        grams = self._hash(0, np.arange(n - gram + 1), gram)
        # the least gram of each window by doubling; places in the low bits settle ties
        least = grams >> U64(32) << U64(32) | np.arange(len(grams), dtype=U64)
        span, size = window - gram + 1, 1
        while size * 2 <= span:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        windows = n - window + 1
        least = np.minimum(least[:windows], least[span - size : span - size + windows])
        end = np.repeat(first[1:], np.diff(first))
        at = np.flatnonzero(np.arange(windows) + window <= end[:windows])
        anchor = (least[at] & U64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
        lead = np.flatnonzero(new)
        self.at, self.n = at[lead], np.diff(np.append(lead, len(at)))
        self.key = grams[anchor[lead]]

    def _hash(self, which: int, start: np.ndarray, words) -> np.ndarray:
        sums = self.sums[which]
        return _mix((sums[start + words] - sums[start]) * powers(_INVERSES[which], len(sums))[start])

    def spans(self, which: int, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self._hash(which, at, n - 1 + self.window)


def _steps(n: np.ndarray) -> np.ndarray:
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


# ------------------------------------------------------------------------ exact grouping


def _classes(e: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Entries in the order of their class; which are its first; which class is repeated."""
    order = np.lexsort((e["start"], e["doc"], e["n"], e["span"], e["key"]))
    e = {k: v[order] for k, v in e.items()}
    lead = np.ones(len(order), bool)
    lead[1:] = (
        (e["key"][1:] != e["key"][:-1]) | (e["span"][1:] != e["span"][:-1]) | (e["n"][1:] != e["n"][:-1])
    )
    at = np.flatnonzero(lead)
    size = np.diff(np.append(at, len(order)))
    several = (size > 1) | (np.maximum.reduceat(e["many"], at) > 0) if len(at) else np.zeros(0, bool)
    return e, lead, np.repeat(several, size)


class Pool:
    """Entries of a task, grouped in the task before they are sent to their buckets."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.parts: list[dict[str, np.ndarray]] = []
        self.size = 0

    def add(self, **e: np.ndarray) -> Iterator[pa.RecordBatch]:
        e["many"] = np.zeros(len(e["n"]), np.uint8)
        self.parts.append({k: e[k].astype(t) for k, t in _ENTRY})
        self.size += len(e["n"])
        if self.size >= POOL:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        e = {k: np.concatenate([p[k] for p in self.parts]) for k, _ in _ENTRY}
        self.parts, self.size = [], 0
        e, lead, several = _classes(e)
        e["many"] = several.astype(np.uint8)
        names = [k for k, _ in _ENTRY]
        yield packed_by_doc({k: v[several] for k, v in e.items()}, self.buckets, 0, names)
        yield packed({k: v[lead] for k, v in e.items()}, e["key"][lead], self.buckets, 1, names)


def _run_entries(texts: DataFrame, sketch: Sketch, buckets: int, window: int, gram: int) -> DataFrame:
    """Entries of the runs that the sketch does not rule out."""
    shared = texts.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, pool = shared.value, Pool(buckets)
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            for at, count, codes, first in _sequences(batch, 1):
                runs = Runs(codes, first, window, gram)
                often = np.flatnonzero(flags.repeated(runs.key))
                hot = flags.frequent(runs.key[often])
                yield from _windows(pool, runs, runs.at[often[hot]], runs.n[often[hot]], rows, at, first)
                own = often[~hot]
                text, n = np.searchsorted(first, runs.at[own], side="right") - 1, runs.n[own]
                yield from pool.add(
                    key=runs.key[own], span=runs.spans(1, runs.at[own], n), n=n,
                    doc=rows[at + text], start=runs.at[own] - first[text],
                )
        yield from pool.flush()

    return map_arrow(texts, run, _ENTRIES)


def _windows(pool: Pool, runs: Runs, at, n, rows, row, first) -> Iterator[pa.RecordBatch]:
    """Each window of some runs as an entry of its own (in portions)."""
    for a in range(0, len(at), POOL // 16):
        start = np.repeat(at[a : a + POOL // 16], n[a : a + POOL // 16]) + _steps(n[a : a + POOL // 16])
        one = np.ones(len(start), np.int64)
        text = np.searchsorted(first, start, side="right") - 1
        yield from pool.add(
            key=_mix(runs.spans(0, start, one) + U64(1)), span=runs.spans(1, start, one), n=one,
            doc=rows[row + text], start=start - first[text],
        )


def _resolve(entries: DataFrame, buckets: int) -> DataFrame:
    """Packed windows by buckets of documents: kind 0, repeated; kind 1, runs of which
    single windows may be."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {k: [] for k, _ in _ENTRY}
        for batch in batches:
            decided = pc.equal(batch.column("kind"), 0)
            yield batch.filter(decided).select(["bucket", "kind", *_SPAN])  # passes through
            rest = batch.filter(pc.invert(decided))
            for k, t in _ENTRY:
                held[k] += [np.frombuffer(x, t) for x in rest.column(k).to_pylist()]
        if not held["n"]:
            return
        e, lead, several = _classes({k: np.concatenate(held.pop(k)) for k, _ in _ENTRY})
        gone = several & (e["many"] == 0)  # the others were decided in their task
        yield packed_by_doc({k: e[k][gone] for k in _SPAN}, buckets, 0, _SPAN)
        group = np.cumsum(np.concatenate(([0], e["key"][1:] != e["key"][:-1])))
        kinds = np.bincount(group, weights=lead)[group]
        open_ = lead & (kinds > 1)
        yield packed_by_doc({k: e[k][open_] for k in _SPAN}, buckets, 1, _SPAN)

    return map_arrow(entries, run, _FOUND)


def _single_windows(joined: DataFrame, buckets: int, window: int) -> DataFrame:
    """Entries of the windows of open runs: (row, text, packed spans)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = Pool(buckets)
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            lists = batch.column(2).to_pylist()
            for at, count, codes, first in _sequences(batch, 1):
                pairs = [
                    np.frombuffer(lists[at + i], np.int32).reshape(-1, 2).astype(np.int64)
                    + np.array([first[i], 0])
                    for i in range(count)
                ]
                start, n = np.concatenate(pairs).T
                runs = Runs(codes, first, window, window)
                yield from _windows(pool, runs, start, n, rows, at, first)
        yield from pool.flush()

    return map_arrow(joined, run, _ENTRIES)


# ----------------------------------------------------------------------------- operator

_ADDED = {
    "n_words": ("long", pa.int64()),
    "n_removed": ("long", pa.int64()),
    "removed": (
        "array<struct<first:int,last:int>>",
        pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])),
    ),
    "kept": ("string", pa.string()),
    "kept_sha256": ("string", pa.string()),
}


def remove_windows(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    gram: int | None = None, columns: tuple[str, ...] = ("n_words", "n_removed", "removed", "kept"),
) -> DataFrame:
    """``df`` without its text plus the asked-for ``columns``: ``n_words``, ``n_removed``,
    ``removed`` (maximal runs of removed words, first and last), ``kept`` (kept words joined
    by one space) and ``kept_sha256`` (of its UTF-8 bytes)."""
    gram = max(1, min(window, GRAM if gram is None else gram))
    keep = [c for c in df.columns if c != text_col and c not in columns]
    spark = df.sparkSession
    docs, size = numbered(df, id_col, text_col, keep)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    texts = docs.select("r", "t")

    def keys_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, codes, first in _sequences(batch, 1):
            yield Runs(codes, first, window, gram).key

    sketch = build_sketch(texts, keys_of, size // BYTES_PER_RUN, parts)
    entries = _run_entries(texts, sketch, parts, window, gram)
    found = stored(_resolve(entries.repartition(parts, "bucket"), parts), "windows")
    # both joins take the same columns of the documents, by a number that is never null: they
    # share one shuffle of the texts
    others = [f"c{i}" for i in range(len(keep))]
    joined = docs.join(by_document(found.where("kind = 1"), parts), F.col("r") == F.col("owner"))
    singles = _single_windows(joined.select("r", "t", "spans", *others), parts, window)
    compared = _resolve(singles.repartition(parts, "bucket"), parts)
    gone = by_document(found.union(compared).where("kind = 0"), parts)
    final = docs.join(gone, F.col("r") == F.col("owner"), "left").select(*others, "t", "spans")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "t"):
                out = _apply(part.column("t"), part.column("spans").to_pylist(), window, columns)
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], *out], [*others, *columns])

    fields = [f"c{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    fields += [f"{c} {_ADDED[c][0]}" for c in columns]
    return map_arrow(final, apply, ", ".join(fields)).toDF(*keep, *columns)


def _apply(texts: pa.Array, lists: list, window: int, columns: tuple[str, ...]) -> list[pa.Array]:
    """The added columns of some rows."""
    raw, bounds = text_bytes(texts)
    start, end = word_edges(raw, bounds, ASCII_SPACE)
    first = np.searchsorted(start, bounds)
    delta = np.zeros(len(start) + 1, np.int64)
    for i, spans in enumerate(lists):
        if spans:
            pairs = np.frombuffer(spans, np.int32).reshape(-1, 2).astype(np.int64)
            np.add.at(delta, first[i] + pairs[:, 0], 1)
            np.add.at(delta, first[i] + pairs[:, 0] + pairs[:, 1] - 1 + window, -1)
    gone = np.cumsum(delta[:-1]) > 0
    before = np.concatenate(([0], np.cumsum(gone)))[first]
    n_words, n_removed = np.diff(first), np.diff(before)
    out: dict[str, pa.Array] = {}
    for name in columns:
        if name == "n_words":
            out[name] = pa.array(n_words, pa.int64())
        elif name == "n_removed":
            out[name] = pa.array(n_removed, pa.int64())
        elif name == "removed":
            turns = [
                np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=0, append=0)).reshape(-1, 2) if n else ()
                for a, b, n in zip(first, first[1:], n_removed)
            ]
            out[name] = pa.array(
                [[{"first": int(a), "last": int(b) - 1} for a, b in t] for t in turns], _ADDED[name][1]
            )
    if "kept" in columns or "kept_sha256" in columns:
        kept = np.flatnonzero(~gone)
        text = np.searchsorted(first, kept, side="right") - 1
        last = np.ones(len(kept), bool)
        last[:-1] = text[1:] != text[:-1]  # the byte after any other kept word separates it
        data, mark = raw.copy(), np.zeros(len(raw) + 1, np.int8)
        data[end[kept[~last]]] = 32
        mark[start[kept]] = 1
        stop = end[kept] + ~last
        mark[stop] -= 1
        cover = np.cumsum(mark[:-1], dtype=np.int8) > 0
        data = data[cover].tobytes()
        edges = np.concatenate(([0], np.cumsum(cover)))[bounds].tolist()
        if "kept" in columns:
            out["kept"] = pa.array([data[a:b].decode() for a, b in zip(edges, edges[1:])], _ADDED["kept"][1])
        if "kept_sha256" in columns:
            out["kept_sha256"] = pa.array([
                hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(edges, edges[1:])
            ])
    return [out[name] for name in columns]
