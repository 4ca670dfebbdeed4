"""Removal of repeated passages: every byte covered by a string of ``length`` bytes that
also starts earlier in the corpus (in a document of smaller id, or earlier in the same).

1. *Anchors.*  A window is the ``length`` bytes from a position on.  Its anchor is the
   ``seed``-byte string in it whose hash is least (the leftmost on ties): equal windows
   have equal seeds at equal places.  Consecutive windows with one anchor form a run; there
   is about one run per 35 bytes.  A merged sketch (``sketch.py``) over the seeds of all
   documents rules out runs whose seed occurs once: most of the corpus ends here, without its
   text or its runs having been moved.  The others are grouped by seed.  Of runs with equal
   bytes the earliest stays and the others are removed whole; each task does that with its
   own runs first, so a passage of a great many copies leaves a run per task, not per copy.
2. *Logarithmic suffix arrays.*  What remains (seeds with several kinds of runs, where a
   passage begins, ends or differs) is compared byte by byte.  The runs of a seed meet in one
   partition and come in corpus order, in batches.  A batch gets the sorted array of its
   suffixes (from each window start on, to ``length`` bytes); it is merge-scanned against
   every level of the index, which are such arrays of earlier batches: a match of ``length``
   bytes there, or earlier in the batch, marks the window.  What is new becomes a level, and
   levels of about equal size merge, so there are logarithmically many.
3. The marked windows of a document are united and its remaining bytes returned.

Seeds that the sketch shows to be very frequent (a line that a third of all documents have)
would bring their group into one task: their windows go one by one instead, each under the
hash of all its bytes, so the group spreads over all tasks.  The sketch counts every document
and decides on the route only; either gives the same result.

Runs, and windows of very frequent seeds, are taken as equal if two 64-bit hashes of all their
bytes and their lengths agree, not by comparing the bytes: two different windows are mistaken
for equal with a probability below 1e-10 over 1e14 windows.

Cases: a null text is an empty one and has nothing removed; rows with null or equal ids, and
ids that are no whole numbers, are taken in the order of (id, nulls last, text); texts below
``length`` bytes stay whole; texts of any length are worked on in pieces; other columns pass
through whatever their names, those named like the added ones are replaced; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import map_arrow, numbered, stored
from tillroll.llm.sketch import Sketch, build_sketch
from tillroll.llm.spans import SPAN, by_document, packed, packed_by_doc
from tillroll.llm.words import BYTE_HASH, U64, _mix, powers, prefix_hash, text_bytes

LENGTH = 100
SEED = 32
PIECE = 1 << 19  # bytes worked on at once; longer texts are cut with an overlap
BATCH_BYTES = 1 << 18  # of runs in a new index batch
PARTITION_BYTES = 64 << 20  # text bytes per shuffle partition
BYTES_PER_RUN = 35  # of text, about; sizes the sketch
POOL = 400_000  # entries grouped at once in a task

_BASES = (0xD1342543DE82EF95, 0x9E3779B97F4A7C15)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)
_ENTRY = (("seed", np.uint64), ("span", np.uint64), ("doc", np.int64), ("start", np.int32),
          ("n", np.int32))
# packed arrays, one row per bucket; kind 0: decided (by buckets of documents), kind 1: to be
# compared (by buckets of seeds, and once resolved by buckets of documents)
_ENTRIES_DDL = "bucket int, kind int, seed binary, span binary, doc binary, start binary, n binary"
_FOUND = ["seed", *(k for k, _ in SPAN)]
_FOUND_DDL = "bucket int, kind int, " + ", ".join(f"{k} binary" for k in _FOUND)


def _pieces(batch: pa.RecordBatch, overlap: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(bytes, bounds, row ids, offsets): groups of about PIECE bytes; piece i is
    ``bytes[bounds[i]:bounds[i + 1]]``, from ``offsets[i]`` on in the text of its row."""
    raw, bounds = text_bytes(batch.column("t"))
    rows = batch.column("r").to_numpy(zero_copy_only=False)
    held: list[tuple[np.ndarray, int, int]] = []
    size = 0

    def group():
        ends = np.cumsum([0] + [len(p) for p, _, _ in held])
        return (
            np.concatenate([p for p, _, _ in held]), ends,
            np.array([r for _, r, _ in held], np.int64), np.array([o for _, _, o in held], np.int64),
        )

    for row, a, b in zip(rows.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
        for at in range(a, max(b - overlap, a + 1), PIECE):
            piece = raw[at : min(b, at + PIECE + overlap)]
            held.append((piece, row, at - a))
            size += len(piece)
            if size >= PIECE:
                yield group()
                held, size = [], 0
    if held:
        yield group()


def _hash(sums: np.ndarray, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    at = powers(_INVERSES[which], len(sums))[start]
    return _mix((sums[end] - sums[start]) * at)


def runs(data: np.ndarray, bounds: np.ndarray, length: int, seed: int):
    """(piece, first window, windows, seed hash, prefix sums) of the runs in some pieces."""
    n = len(data)
    if n < length:
        return None
    codes = BYTE_HASH[data]
    sums = (prefix_hash(codes, _BASES[0]), prefix_hash(codes, _BASES[1]))
    starts = np.arange(n - seed + 1)
    seeds = _hash(sums[0], 0, starts, starts + seed)
    bits = U64(max(24, int(n).bit_length()))
    low = seeds >> bits << bits | starts.astype(U64)
    # the least of each window's seeds, by doubling
    span, size = length - seed + 1, 1
    least = low
    while size * 2 <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    windows = n - length + 1
    least = np.minimum(least[:windows], least[span - size : span - size + windows])
    anchor = (least & ((U64(1) << bits) - U64(1))).astype(np.int64)
    end = np.repeat(bounds[1:], np.diff(bounds))
    at = np.flatnonzero(np.arange(windows) + length <= end[:windows])
    if not len(at):
        return None
    anchor = anchor[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    piece = np.searchsorted(bounds, at[first], side="right") - 1
    return piece, at[first], count, seeds[anchor[first]], sums


def _sorted_classes(e: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Entries by (seed, span, n, doc, start), and which are the first of their class."""
    order = np.lexsort((e["start"], e["doc"], e["n"], e["span"], e["seed"]))
    e = {k: v[order] for k, v in e.items()}
    first = np.ones(len(order), bool)
    first[1:] = (
        (e["seed"][1:] != e["seed"][:-1]) | (e["span"][1:] != e["span"][:-1])
        | (e["n"][1:] != e["n"][:-1])
    )
    return e, first


def _entries(docs: DataFrame, length: int, seed: int, buckets: int, sketch: Sketch) -> DataFrame:
    """Runs that the sketch does not rule out, as packed entries: kind 0, to be removed
    (nothing is left to compare, and a passage may have any number of copies); kind 1, the
    first of their class in their task."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    names = [k for k, _ in _ENTRY]

    def grouped(parts: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        e, lead = _sorted_classes({k: np.concatenate([p[k] for p in parts]) for k, _ in _ENTRY})
        yield packed_by_doc({k: v[~lead] for k, v in e.items()}, buckets, 0, names)
        yield packed({k: v[lead] for k, v in e.items()}, e["seed"][lead], buckets, 1, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, held, size = shared.value, [], 0
        for batch in batches:
            for data, bounds, rows, offsets in _pieces(batch, length - 1):
                found = runs(data, bounds, length, seed)
                if found is None:
                    continue
                often = flags.repeated(found[3])
                piece, first, n, seeds = (x[often] for x in found[:4])
                sums = found[4]
                single = flags.frequent(seeds)
                if single.any():
                    copies = np.where(single, n, 1)
                    step = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                    single = np.repeat(single, copies)
                    piece, seeds = np.repeat(piece, copies), np.repeat(seeds, copies)
                    first = np.repeat(first, copies) + step
                    n = np.where(single, 1, np.repeat(n, copies))
                    whole = _hash(sums[0], 0, first, first + length)
                    seeds = np.where(single, _mix(whole + U64(1)), seeds)
                e = {
                    "seed": seeds, "span": _hash(sums[1], 1, first, first + n - 1 + length),
                    "doc": rows[piece], "start": first - bounds[piece] + offsets[piece], "n": n,
                }
                held.append({k: e[k].astype(t) for k, t in _ENTRY})
                size += len(n)
                if size >= POOL:
                    yield from grouped(held)
                    held, size = [], 0
        if size:
            yield from grouped(held)

    return map_arrow(docs, run, _ENTRIES_DDL)


def _resolve(entries: DataFrame, buckets: int) -> DataFrame:
    """Packed spans by buckets of documents: kind 0, removed; kind 1, to be compared by bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {k: [] for k, _ in _ENTRY}
        for batch in batches:  # what is decided passes through, batch by batch
            decided = pc.equal(batch.column("kind"), 0)
            yield batch.filter(decided).select(["bucket", "kind", *_FOUND])
            rest = batch.filter(pc.invert(decided))
            for k, t in _ENTRY:
                held[k] += [np.frombuffer(x, t) for x in rest.column(k).to_pylist()]
        if not held["n"]:
            return
        e, lead = _sorted_classes({k: np.concatenate(held.pop(k)) for k, _ in _ENTRY})
        group = np.cumsum(np.concatenate(([0], e["seed"][1:] != e["seed"][:-1])))
        several = np.bincount(group, weights=lead)[group] > 1
        yield packed_by_doc({k: e[k][~lead] for k in _FOUND}, buckets, 0, _FOUND)
        yield packed_by_doc({k: e[k][lead & several] for k in _FOUND}, buckets, 1, _FOUND, join=False)

    return map_arrow(entries, run, _FOUND_DDL)


def _open_runs(found: DataFrame, parts: int) -> DataFrame:
    """(owner, seed, start, n): one row per document, its unresolved runs as packed arrays."""
    types = dict(_ENTRY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {k: [] for k in _FOUND}
        for batch in batches:
            for k in _FOUND:
                held[k] += [np.frombuffer(x, types[k]) for x in batch.column(k).to_pylist()]
        if not held["n"]:
            return
        e = {k: np.concatenate(v) for k, v in held.items()}
        order = np.argsort(e["doc"], kind="stable")
        e = {k: v[order] for k, v in e.items()}
        cut = np.flatnonzero(np.concatenate(([True], e["doc"][1:] != e["doc"][:-1])))
        ends = np.append(cut[1:], len(order))
        for at in range(0, len(cut), 20_000):
            some = slice(at, at + 20_000)
            yield pa.RecordBatch.from_pydict({
                "owner": pa.array(e["doc"][cut[some]]),
                **{
                    k: pa.array([e[k][a:b].tobytes() for a, b in zip(cut[some], ends[some])], pa.binary())
                    for k in ("seed", "start", "n")
                },
            })

    rows = found.repartition(parts, "bucket")
    return map_arrow(rows, run, "owner long, seed binary, start binary, n binary")


class SuffixLevels:
    """The index of one partition: sorted arrays of distinct suffixes (to ``length`` bytes),
    from large to small, each more than twice as large as the next."""

    def __init__(self, length: int):
        self.kind = f"S{length}"
        self.length = length
        self.levels: list[np.ndarray] = []

    def add(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Add the suffixes of a batch (starts in corpus order) and return which of them
        match ``length`` bytes of an earlier suffix."""
        view = np.lib.stride_tricks.sliding_window_view(data, self.length)
        # suffixes may end in zero bytes, which S strips on reading but not in comparing
        suffixes = np.ascontiguousarray(view[starts]).view(self.kind).ravel()
        order = np.argsort(suffixes, kind="stable")
        array = suffixes[order]
        new = np.ones(len(array), bool)
        new[1:] = array[1:] != array[:-1]
        lead = np.flatnonzero(new)
        distinct = array[lead]
        known = np.zeros(len(distinct), bool)
        for level in self.levels:  # merge-scan: both sides are sorted
            at = np.minimum(np.searchsorted(level, distinct), len(level) - 1)
            known |= level[at] == distinct
        repeated = ~new | np.repeat(known, np.diff(np.append(lead, len(array))))
        fresh = distinct[~known]
        while self.levels and len(self.levels[-1]) <= 2 * len(fresh):
            fresh = np.concatenate((self.levels.pop(), fresh))
            fresh.sort(kind="stable")  # two sorted runs: a merge
        if len(fresh):
            self.levels.append(fresh)
        out = np.zeros(len(array), bool)
        out[order] = repeated
        return out


_SPANS = (("seed", np.uint64), ("doc", np.int64), ("start", np.int32), ("n", np.int32))


def _spans(joined: DataFrame, length: int, buckets: int) -> DataFrame:
    """The bytes of unresolved runs, packed by bucket of their seed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, bounds = text_bytes(batch.column("t"))
            rows = batch.column("r").to_numpy(zero_copy_only=False)
            lists = {k: batch.column(k).to_pylist() for k in ("seed", "start", "n")}
            sizes = np.array([len(x) // 4 for x in lists["n"]], np.int64)
            e = {k: np.frombuffer(b"".join(lists[k]), t) for k, t in _SPANS if k != "doc"}
            e["doc"] = np.repeat(rows, sizes)
            begin = np.repeat(bounds[:-1], sizes) + e["start"]
            size = e["n"].astype(np.int64) - 1 + length
            bucket = (e["seed"] % U64(buckets)).astype(np.int64)
            order = np.lexsort((begin, bucket))
            for part in np.array_split(order, max(1, size.sum() // (8 << 20) + 1)):
                cut = np.flatnonzero(np.diff(bucket[part], prepend=-1))
                for a, b in zip(cut, np.append(cut[1:], len(part))):
                    own = part[a:b]
                    yield pa.RecordBatch.from_pydict({
                        "bucket": pa.array([int(bucket[own[0]])], pa.int32()),
                        **{k: pa.array([e[k][own].astype(t).tobytes()], pa.binary()) for k, t in _SPANS},
                        "data": pa.array(
                            [b"".join(raw[s : s + z].tobytes() for s, z in zip(begin[own], size[own]))],
                            pa.binary(),
                        ),
                    })

    ddl = "bucket int, seed binary, doc binary, start binary, n binary, data binary"
    return map_arrow(joined, run, ddl)


def _scan(spans: DataFrame, length: int, batch_bytes: int, buckets: int) -> DataFrame:
    """Packed spans by buckets of documents: windows of unresolved runs that have an equal
    earlier one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, data, marks = {k: [] for k, _ in _SPANS}, [], []
        for batch in batches:
            for k, t in _SPANS:
                held[k] += [np.frombuffer(x, t) for x in batch.column(k).to_pylist()]
            data += [np.frombuffer(x, np.uint8) for x in batch.column("data").to_pylist()]
        if not held["n"]:
            return
        e = {k: np.concatenate(v) for k, v in held.items()}
        buffer = np.concatenate(data)
        del data
        size = e["n"].astype(np.int64) - 1 + length
        offset = np.cumsum(size) - size
        order = np.lexsort((e["start"], e["doc"]))
        index = SuffixLevels(length)
        cuts = np.flatnonzero(np.diff(np.cumsum(size[order]) // batch_bytes, prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(order))):
            own = order[a:b]
            z, n = size[own], e["n"][own].astype(np.int64)
            local = np.cumsum(z) - z
            text = buffer[np.repeat(offset[own] - local, z) + np.arange(z.sum())]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            marked = index.add(text, np.repeat(local, n) + step)
            # runs of marked windows
            entry = np.repeat(np.arange(len(own)), n)[marked]
            at = step[marked]
            new = np.ones(len(at), bool)
            new[1:] = (entry[1:] != entry[:-1]) | (at[1:] != at[:-1] + 1)
            lead = np.flatnonzero(new)
            marks.append((
                e["doc"][own][entry[lead]], e["start"][own][entry[lead]] + at[lead],
                np.diff(np.append(lead, len(at))),
            ))
        found = dict(zip((k for k, _ in SPAN), (np.concatenate(x) for x in zip(*marks))))
        yield packed_by_doc(found, buckets, 0, _FOUND)

    return map_arrow(spans, run, _FOUND_DDL)


def _without(raw: bytes, turns: list[int]) -> bytes:
    """``raw`` (UTF-8) without the characters that lie whole in the runs between turns."""
    out, at = [], 0
    for start, end in zip(turns[::2], turns[1::2]):
        while start < len(raw) and raw[start] & 0xC0 == 0x80:
            start += 1  # the character that the run starts within stays
        while start < end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1  # the one that it ends within, too
        if end > start:
            out.append(raw[at:start])
            at = end
    return b"".join([*out, raw[at:]])


def remove_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    seed: int = SEED, batch_bytes: int = BATCH_BYTES, kept: bool = True, digest: bool = False,
    text: bool = False,
) -> DataFrame:
    """``df`` without its text plus n_bytes, n_removed, removed (array of maximal removed
    runs: start, end in bytes) and, as asked for, ``kept`` (binary: the remaining bytes),
    ``kept_sha256`` and the text column without the characters whose bytes are all removed.
    Columns of those names are replaced."""
    added = [("n_bytes", "long"), ("n_removed", "long"), ("removed", "array<struct<start:int,end:int>>")]
    added += [("kept", "binary")] * kept + [("kept_sha256", "string")] * digest
    added += [(text_col, "string")] * text
    names = [n for n, _ in added]
    keep = [c for c in df.columns if c not in (text_col, *names)]
    docs, size = numbered(df, id_col, text_col, keep, ordered=True)
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    texts = docs.select("r", "t")

    def seeds_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for data, bounds, _, _ in _pieces(batch, length - 1):
            found = runs(data, bounds, length, seed)
            if found is not None:
                yield found[3]

    sketch = build_sketch(texts, seeds_of, size // BYTES_PER_RUN, parts)
    entries = _entries(texts, length, seed, parts, sketch)
    found = stored(_resolve(entries.repartition(parts, "bucket"), parts), "runs")
    # both joins take the same columns of the documents, by a number that is never null: they
    # share one shuffle of the texts
    others, added_as = [f"c{i}" for i in range(len(keep))], [f"a{i}" for i in range(len(names))]
    joined = docs.join(_open_runs(found.where("kind = 1"), parts), F.col("r") == F.col("owner"))
    spans = _spans(joined.select("r", "t", "seed", "start", "n", *others), length, parts)
    compared = _scan(spans.repartition(parts, "bucket"), length, batch_bytes, parts)
    gone = by_document(found.where("kind = 0").union(compared), parts)
    final = docs.join(gone, F.col("r") == F.col("owner"), "left").select(*others, "t", "spans")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            raw, bounds = text_bytes(batch.column("t"))
            lists = batch.column("spans").to_pylist()
            out: dict[str, list] = {n: [] for n in names}
            for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                edges = np.zeros(b - a + 1, np.int32)
                if lists[i] is not None:
                    start, n = np.frombuffer(lists[i], np.int32).reshape(-1, 2).astype(np.int64).T
                    np.add.at(edges, start, 1)
                    np.add.at(edges, start + n - 1 + length, -1)
                cover = np.cumsum(edges[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.concatenate(([False], cover, [False])).astype(np.int8)))
                rest = raw[a:b][~cover].tobytes()
                out["n_bytes"].append(int(b - a))
                out["n_removed"].append(int(b - a) - len(rest))
                out["removed"].append([
                    {"start": int(s), "end": int(t)} for s, t in zip(turns[::2], turns[1::2])
                ])
                if kept:
                    out["kept"].append(rest)
                if digest:
                    out["kept_sha256"].append(hashlib.sha256(rest).hexdigest())
                if text:
                    out[text_col].append(_without(raw[a:b].tobytes(), turns.tolist()).decode())
            types = {
                "n_bytes": pa.int64(), "n_removed": pa.int64(), "kept": pa.binary(),
                "kept_sha256": pa.string(), text_col: pa.string(),
                "removed": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
            }
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], *(pa.array(out[n], types[n]) for n in names)], [*others, *added_as]
            )

    fields = [f"{o} {df.schema[c].dataType.simpleString()}" for o, c in zip(others, keep)]
    fields += [f"{o} {t}" for o, (_, t) in zip(added_as, added)]
    return map_arrow(final, apply, ", ".join(fields)).toDF(*keep, *names)
