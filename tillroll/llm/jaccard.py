"""Documents joined by the Jaccard similarity of their word shingles.

A document is the set of its distinct 5-word shingles.  Its *point* is a count vector: the
shingles are hashed into groups, about one per four shingles, and counted per group; halves
of neighbouring groups add up to the coarser point of ``GROUPS`` groups that all documents
have.  The overlap of two sets is at most the sum of the coordinate minima of their points,
and that of any two members of two tree nodes at most the sum of the minima of the nodes'
greatest coordinates; an R-tree over the coarse points prunes with both.

One tree over all documents cannot prune (points of unrelated long texts are near each
other), so documents are first blocked by necessary shingles: shingles are put in a common
order, frequent ones last, and two sets that are similar enough share one among the first
quarter of each.  A block is the documents that share such a shingle; length and position
bounds hold within it.

1. Documents with equal sets form a class; its smallest id stands for it.
2. In each block the smallest document is paired with the others (a star); the pairs are
   verified, and verified links give first components.  A group of m near copies costs
   about m pairs here, not m * m.
3. Blocks that still hold several components are indexed: the points of their documents
   form an R-tree (a block of up to ``LEAF`` documents is one leaf), whose self-join gives
   the pairs across components that the bounds leave; these are verified too.
   Before any verification, the fine points of a pair must leave enough overlap.
   Of a pair, the smaller set must have the shared shingle in its (shorter) index prefix:
   rows that no such row can meet leave their block first, and the tree visits no two nodes
   without one.  A block of more than ``BLOCK_ROWS`` documents is split by hashes of the
   documents into cells of its index rows and cells of all its rows; every cell of the
   former meets every cell of the latter under a shuffle key of its own.
4. The components of all links are found by star contraction.

Verification compares the whole sets, one member's text at a time against its centre's;
a centre with many members is split over tasks by a salt.  So every pair of similar
documents is either verified or already in one component: no link is lost.

Cases: null, empty and word-less texts have an empty set and are linked with nothing; rows
with null or equal ids are rows of their own in the order of (id, nulls last, text); a
text of fewer than ``k`` words is one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import (
    are_few, chunks, clash_proof, few, keyed, map_arrow, maybe_broadcast, stored,
)
from tillroll.llm.components import components
from tillroll.llm.words import ASCII_SPACE, U64, Words, _mix, find_words

SHINGLE = 5
GROUPS = 256
LEAF = 32
FANOUT = 8
BLOCK_ROWS = 8192  # documents of a block, or of a cell of one, that are joined in one task
HELD_ROWS = 65_536  # of small blocks that are joined at once
PARTITION_BYTES = 64 << 20  # text bytes per shuffle partition
SAMPLE_BYTES = 64 << 20  # of texts that show which shingles are frequent
FREQUENT = 64  # documents (estimated) with a frequent shingle
MAX_FREQUENT = 1_000_000  # shingles in the table of frequent ones, a broadcast
MEMBERS_PER_TASK = 256

# thresholds: 100 * intersection >= 75 * union, that is intersection >= 3 * (n + m) / 7


def need(n, m):
    """The least overlap of linked sets of sizes n and m."""
    return -(-3 * (n + m) // 7)


def index_prefix(n):
    """Shingles that the smaller of two linked sets must be searched by."""
    return n + (-6 * n) // 7 + 1


def probe_prefix(n):
    """The same for the larger one."""
    return n + (-3 * n) // 4 + 1


# ----------------------------------------------------------------------------- sets


def shingle_sets(words: Words, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, _ = words.shingles(k)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= k:
            yield np.unique(hashes[a : b - k + 1])
        elif b > a:
            h = U64(b - a)
            with np.errstate(over="ignore"):
                for x in words.hash[a:b]:
                    h = h * U64(0x9E3779B97F4A7C15) + x
            yield _mix(np.array([h], U64))
        else:
            yield np.zeros(0, U64)


def point_of(shingles: np.ndarray) -> np.ndarray:
    """Counts per group of the leading hash bits; a power of two of groups."""
    bits = min(16, max(GROUPS.bit_length() - 1, (len(shingles) // 4).bit_length()))
    return np.bincount((shingles >> U64(64 - bits)).astype(np.int64), minlength=1 << bits)


def folded(point: np.ndarray, groups: int) -> np.ndarray:
    """The same counts in fewer groups."""
    return point.reshape(groups, -1).sum(1)


def packed_point(point: np.ndarray) -> bytes:
    kind = next(k for k in (np.uint8, np.uint16, np.uint32) if point.max() <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + point.astype(kind).tobytes()


def unpacked_point(data: bytes) -> np.ndarray:
    return np.frombuffer(data, {1: np.uint8, 2: np.uint16, 4: np.uint32}[data[0]], offset=1).astype(np.int64)


def may_link(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the points of two sets leave enough overlap."""
    groups = min(len(a), len(b))
    bound = np.minimum(folded(a, groups), folded(b, groups)).sum()
    return bool(bound >= need(int(a.sum()), int(b.sum())))


def _summaries(docs: DataFrame, k: int) -> DataFrame:
    """(doc, n, h1, h2, point, coarse) of each document: size, two hashes of the set, and
    the fine and the coarse point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text"):
                n, h1, h2, points, coarse = [], [], [], [], []
                for s in shingle_sets(find_words(part.column("_text"), ASCII_SPACE), k):
                    n.append(len(s))
                    h1.append(int(s.sum().astype(np.int64)))
                    h2.append(int(np.bitwise_xor.reduce(_mix(s ^ U64(0x5BD1E995)), initial=U64(0)).astype(np.int64)))
                    fine = point_of(s)
                    points.append(packed_point(fine))
                    coarse.append(packed_point(folded(fine, GROUPS)))
                yield pa.RecordBatch.from_pydict({
                    "doc": part.column("_row"), "n": pa.array(n, pa.int64()),
                    "h1": pa.array(h1, pa.int64()), "h2": pa.array(h2, pa.int64()),
                    "point": pa.array(points, pa.binary()), "coarse": pa.array(coarse, pa.binary()),
                })

    ddl = "doc long, n long, h1 long, h2 long, point binary, coarse binary"
    return map_arrow(docs, run, ddl)


def _frequent(docs: DataFrame, size: int, k: int) -> np.ndarray:
    """Shingles that a sample shows to be frequent (they only come later in the order)."""
    share = min(1.0, SAMPLE_BYTES / max(size, 1))
    sample = docs.where(F.pmod(F.xxhash64("_row", F.lit(2)), F.lit(1 << 30)) < int(share * (1 << 30)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text"):
                sets = list(shingle_sets(find_words(part.column("_text"), ASCII_SPACE), k))
                found, n = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "shingle": pa.array(found.view(np.int64)), "n": pa.array(n.astype(np.int64)),
                })

    counted = (
        map_arrow(sample, run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
        .where(F.col("n") > max(3, int(FREQUENT * share)))
        .orderBy(F.desc("n"), "shingle").limit(MAX_FREQUENT)
    )
    found = counted.select("shingle").toArrow().column(0).to_numpy()
    return np.sort(found.astype(np.int64).view(np.uint64))


# --------------------------------------------------------------------------- blocks

_ENTRY = (("token", np.uint32), ("doc", np.int64), ("n", np.int32), ("rank", np.int32))


def _entries(docs: DataFrame, frequent: np.ndarray, buckets: int, k: int) -> DataFrame:
    """The prefix shingles of each document (once per set and chunk), packed by bucket."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most MAX_FREQUENT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = shared.value
        for batch in batches:
            for part in chunks(batch, "_text"):
                rows = part.column("_row").to_pylist()
                seen, tokens, docs_, sizes = set(), [], [], []
                for row, s in zip(rows, shingle_sets(find_words(part.column("_text"), ASCII_SPACE), k)):
                    whole = (len(s), int(s.sum()), int(np.bitwise_xor.reduce(s, initial=U64(0))))
                    if not len(s) or whole in seen:
                        continue
                    seen.add(whole)
                    if len(late):
                        at = np.minimum(np.searchsorted(late, s), len(late) - 1)
                        is_late = late[at] == s
                        s = np.concatenate((s[~is_late], s[is_late]))
                    tokens.append(s[: probe_prefix(len(s))])
                    docs_.append(row)
                    sizes.append(len(s))
                if not tokens:
                    continue
                length = np.array([len(t) for t in tokens])
                token = np.concatenate(tokens)
                e = {
                    "token": (token >> U64(32)).astype(np.uint32),
                    "doc": np.repeat(np.array(docs_, np.int64), length),
                    "n": np.repeat(np.array(sizes, np.int32), length),
                    "rank": (np.arange(len(token)) - np.repeat(np.cumsum(length) - length, length)).astype(np.int32),
                }
                bucket = (token % U64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                bucket = bucket[order]
                at = np.flatnonzero(np.diff(bucket, prepend=-1))
                cuts = list(zip(at.tolist(), [*at[1:].tolist(), len(bucket)]))
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array(bucket[at], pa.int32()),
                    **{
                        name: pa.array([v[a:b].tobytes() for a, b in cuts], pa.binary())
                        for name, v in ((name, e[name][order]) for name, _ in _ENTRY)
                    },
                })

    return map_arrow(docs, run, "bucket int, token binary, doc binary, n binary, rank binary")


def possible(n1, r1, d1, n2, r2, d2) -> np.ndarray:
    """Length, prefix and position bounds for two documents that share a shingle.  Of sets of
    one size, either may be the smaller (the order of ids differs between copies)."""
    swap = (n1 > n2) | ((n1 == n2) & (d1 > d2))
    ns, rs = np.where(swap, n2, n1).astype(np.int64), np.where(swap, r2, r1)
    nl, rl = np.where(swap, n1, n2).astype(np.int64), np.where(swap, r1, r2)
    return (
        (4 * ns >= 3 * nl) & ((rs < index_prefix(ns)) | ((ns == nl) & (rl < index_prefix(nl))))
        & (np.minimum(ns - rs, nl - rl) >= need(ns, nl))
    )


def _small_pairs(key: np.ndarray, ends: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of a block, for some ``rows``, in parts; ``ends``: of each row's block."""
    for some in np.array_split(rows, max(1, len(rows) // 20_000)):
        count = ends[some] - some - 1
        i = np.repeat(some, count)
        yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)


def _block_ends(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row (sorted by key): the end and the size of its block."""
    at = np.flatnonzero(np.diff(key, prepend=-1))
    size = np.diff(np.append(at, len(key)))
    return np.repeat(at + size, size), np.repeat(size, size)


def _has_partner(key: np.ndarray, n: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Rows (sorted by key) with another of their block that length and prefix let them link
    with: one of the two is an index row and not larger."""
    n = n.astype(np.int64)
    block = np.cumsum(np.diff(key, prepend=-1) != 0) << 32
    index = rank < index_prefix(n)
    rows, leads = np.sort(block | n), np.sort((block | n)[index])
    smaller = np.searchsorted(leads, block | n, side="right") - np.searchsorted(leads, block | -(-3 * n // 4))
    larger = np.searchsorted(rows, block | 4 * n // 3, side="right") - np.searchsorted(rows, block | n)
    return (smaller > index) | (index & (larger > 1))


def _in_possible_pairs(key, n, rank, doc) -> np.ndarray:
    """Rows that some other of their block may link with by length, prefix and (in blocks of
    one leaf) position."""
    ends, size = _block_ends(key)
    keep = (size > LEAF) & _has_partner(key, n, rank)
    for i, j in _small_pairs(key, ends, np.flatnonzero(size <= LEAF)):
        ok = possible(n[i], rank[i], doc[i], n[j], rank[j], doc[j])
        keep[i[ok]] = keep[j[ok]] = True
    return keep


def _blocks(entries: DataFrame) -> DataFrame:
    """kind 0: star pairs (a, b); kind 1: the entries (key, a = doc, n, rank) of shared
    shingles; kind 2: (key, a = entries) of blocks of more than ``BLOCK_ROWS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list] = {name: [] for name, _ in _ENTRY}
        keys = []
        for batch in batches:
            for name, kind in _ENTRY:
                parts[name] += [np.frombuffer(x, kind) for x in batch.column(name).to_pylist()]
            keys += batch.column("bucket").to_pylist()
        if not keys:
            return
        sizes = [len(x) for x in parts["token"]]
        e = {name: np.concatenate(v) for name, v in parts.items()}
        del parts
        key = np.repeat(np.array(keys, np.int64), sizes) << 32 | e.pop("token").astype(np.int64)
        order = np.lexsort((e["doc"], key))
        key = key[order]
        at = np.flatnonzero(np.diff(key, prepend=-1))
        size = np.diff(np.append(at, len(key)))
        shared = np.repeat(size > 1, size)
        order, key = order[shared], key[shared]
        e = {name: v[order] for name, v in e.items()}
        at = np.flatnonzero(np.diff(key, prepend=-1))
        centre = np.repeat(at, np.diff(np.append(at, len(key))))
        ok = possible(
            e["n"][centre], e["rank"][centre], e["doc"][centre], e["n"], e["rank"], e["doc"]
        ) & (e["doc"][centre] != e["doc"])
        pairs = np.unique(np.stack((e["doc"][centre][ok], e["doc"][ok]), axis=1), axis=0)
        zero = np.zeros(len(pairs), np.int64)
        keep = _in_possible_pairs(key, e["n"], e["rank"], e["doc"])
        key, e = key[keep], {name: v[keep] for name, v in e.items()}
        ends, size = _block_ends(key)
        large = np.unique(ends[size > BLOCK_ROWS]) - 1
        for kind, columns in ((0, (pairs[:, 0], pairs[:, 1], zero, zero, zero)),
                              (1, (e["doc"], e["doc"], key, e["n"], e["rank"])),
                              (2, (size[large], size[large], key[large], e["n"][large], e["rank"][large]))):
            for i in range(0, len(columns[0]), 100_000):
                a, b, k, n, r = (c[i : i + 100_000] for c in columns)
                yield pa.RecordBatch.from_pydict({
                    "kind": pa.array(np.full(len(a), kind, np.int32)), "a": pa.array(a),
                    "b": pa.array(b), "key": pa.array(k), "n": pa.array(n.astype(np.int32)),
                    "rank": pa.array(r.astype(np.int32)),
                })

    return map_arrow(entries, run, "kind int, a long, b long, key long, n int, rank int")


# --------------------------------------------------------------------------- R-tree


class CountTree:
    """An R-tree over count vectors, bulk loaded: points sorted by size, then by their
    greatest coordinate, in leaves of ``LEAF`` and nodes of ``FANOUT``.  A pair needs a
    leading point and a probing one (either may be both)."""

    def __init__(self, points: np.ndarray, n: np.ndarray, group: np.ndarray, lead: np.ndarray, probe: np.ndarray):
        slab = np.argsort(np.argsort(n, kind="stable"), kind="stable") // (LEAF * FANOUT)
        self.order = np.lexsort((points.argmax(1), slab))
        self.points, self.n, self.group = points[self.order], n[self.order], group[self.order]
        self.lead, self.probe = lead[self.order], probe[self.order]
        cuts = np.arange(0, len(n), LEAF)
        tops, least, most = self._bounds(self.points, self.n, self.n, cuts)
        low = np.minimum.reduceat(self.group, cuts)
        high = np.maximum.reduceat(self.group, cuts)
        leads, probes = (np.logical_or.reduceat(x, cuts) for x in (self.lead, self.probe))
        self.levels = [(tops, least, most, low, high, leads, probes)]
        while len(tops) > 1:
            cuts = np.arange(0, len(tops), FANOUT)
            tops, least, most = self._bounds(tops, least, most, cuts)
            low, high = np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            leads, probes = (np.logical_or.reduceat(x, cuts) for x in (leads, probes))
            self.levels.append((tops, least, most, low, high, leads, probes))

    @staticmethod
    def _bounds(points, least, most, cuts):
        return (
            np.maximum.reduceat(points, cuts, axis=0), np.minimum.reduceat(least, cuts),
            np.maximum.reduceat(most, cuts),
        )

    def _may_join(self, level: int, a: int, b: int) -> bool:
        tops, least, most, low, high, leads, probes = self.levels[level]
        if not (leads[a] and probes[b] or leads[b] and probes[a]):
            return False
        if low[a] == high[a] == low[b] == high[b]:
            return False  # one component
        if 4 * most[a] < 3 * least[b] or 4 * most[b] < 3 * least[a]:
            return False
        return np.minimum(tops[a], tops[b]).sum() >= need(least[a], least[b])

    def self_join(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(i, j) positions of the points that the bounds leave, i before j."""
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            level, a, b = stack.pop()
            if not self._may_join(level, a, b):
                continue
            if level:
                below = len(self.levels[level - 1][1])
                left = range(a * FANOUT, min(below, (a + 1) * FANOUT))
                right = range(b * FANOUT, min(below, (b + 1) * FANOUT))
                stack += [(level - 1, x, y) for x in left for y in right if x <= y]
                continue
            i = np.arange(a * LEAF, min(len(self.n), (a + 1) * LEAF))
            j = np.arange(b * LEAF, min(len(self.n), (b + 1) * LEAF))
            i, j = (x.ravel() for x in np.meshgrid(i, j, indexing="ij"))
            keep = (i < j) & (self.group[i] != self.group[j])
            i, j = i[keep], j[keep]
            keep = (self.lead[i] & self.probe[j]) | (self.lead[j] & self.probe[i])
            i, j = i[keep], j[keep]
            keep = overlap_bound(self.points, i, j) >= need(self.n[i], self.n[j])
            yield self.order[i[keep]], self.order[j[keep]]


def overlap_bound(points: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.zeros(len(i), np.int64)
    for at in range(0, len(i), 16384):
        part = slice(at, at + 16384)
        out[part] = np.minimum(points[i[part]], points[j[part]]).sum(1)
    return out


def _block_pairs(block, n, rank, doc, group, lead, probe, points) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs across groups that all bounds leave; rows sorted by block."""
    ends, size = _block_ends(block)

    def checked(i, j):
        ok = possible(n[i], rank[i], doc[i], n[j], rank[j], doc[j]) & (doc[i] != doc[j])
        return i[ok], j[ok]

    # blocks of one leaf, all at once
    for i, j in _small_pairs(block, ends, np.flatnonzero(size <= LEAF)):
        keep = (group[i] != group[j]) & ((lead[i] & probe[j]) | (lead[j] & probe[i]))
        i, j = checked(i[keep], j[keep])
        keep = overlap_bound(points, i, j) >= need(n[i], n[j])
        yield i[keep], j[keep]
    a = 0
    while a < len(block):
        b = ends[a]
        if b - a > LEAF:
            part = slice(a, b)
            for i, j in CountTree(points[part], n[part], group[part], lead[part], probe[part]).self_join():
                yield checked(i + a, j + a)
        a = b


_ROLES = "key long, cell long, doc long, n int, rank int, component long, lead boolean, probe boolean"


def _mixed(labelled: DataFrame) -> DataFrame:
    """The entries (one per document and block) of blocks with several components; any row of
    a whole block (cell 0) probes, and those of the index prefix lead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("key", "doc", "n", "rank", "component")
        held: dict[str, list] = {c: [] for c in names}
        for batch in batches:
            for c in names:
                held[c].append(batch.column(c).to_numpy(zero_copy_only=False))
        if not held["key"]:
            return
        e = {c: np.concatenate(v) for c, v in held.items()}
        order = np.lexsort((e["doc"], e["key"]))
        e = {c: v[order] for c, v in e.items()}
        again = np.zeros(len(order), bool)
        again[1:] = (e["key"][1:] == e["key"][:-1]) & (e["doc"][1:] == e["doc"][:-1])
        e = {c: v[~again] for c, v in e.items()}
        ends, size = _block_ends(e["key"])
        at = np.unique(ends - size)
        several = np.minimum.reduceat(e["component"], at) < np.maximum.reduceat(e["component"], at)
        keep = np.repeat(several, size[at]) & _has_partner(e["key"], e["n"], e["rank"])
        e = {c: v[keep] for c, v in e.items()}
        e["lead"] = e["rank"] < index_prefix(e["n"].astype(np.int64))
        e["probe"], e["cell"] = np.ones(len(e["key"]), bool), np.zeros(len(e["key"]), np.int64)
        for i in range(0, len(e["key"]), 100_000):
            yield pa.RecordBatch.from_pydict({
                c: pa.array(e[c][i : i + 100_000])
                for c in ("key", "cell", "doc", "n", "rank", "component", "lead", "probe")
            })

    return map_arrow(labelled.select("key", "doc", "n", "rank", "component"), run, _ROLES)


def _split(labelled: DataFrame) -> DataFrame:
    """The entries of large blocks with several components, by cells: the index rows of one
    (leading) with any rows of another (probing).  Rows of a key are only counted before they
    are spread, so no task gets a whole block."""
    lead = F.col("rank") < F.col("n") + F.floor(-6 * F.col("n") / 7) + 1
    rows = labelled.select("key", "doc", "n", "rank", "component").distinct().withColumn("lead", lead)
    sizes = rows.groupBy("key").agg(
        F.count("*").alias("rows"), F.count_if("lead").alias("leads"),
        F.min("component").alias("low"), F.max("component").alias("high"),
    ).where("low < high AND leads > 0")

    def cells(size: str):
        return F.ceil(F.col(size) / BLOCK_ROWS)

    sizes = stored(sizes.select("key", cells("leads").alias("across"), cells("rows").alias("down")), "cells")
    rows = rows.join(maybe_broadcast(sizes, sizes.count(), 24), "key")

    def own(size: str):
        return F.pmod(F.xxhash64("doc"), F.col(size))

    def spread(size: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(size) - 1)).alias("other")

    leading = rows.where("lead").select("*", spread("down")).withColumn(
        "cell", own("across") * F.col("down") + F.col("other")
    ).withColumn("probe", F.lit(False))
    probing = rows.select("*", spread("across")).withColumn(
        "cell", F.col("other") * F.col("down") + own("down")
    ).withColumn("probe", F.lit(True)).withColumn("lead", F.lit(False))
    names = ("key", "cell", "doc", "n", "rank", "component", "lead", "probe")
    return leading.select(*names).union(probing.select(*names))


def _cross_pairs(mixed: DataFrame) -> DataFrame:
    """(a, b): pairs across components from the trees of blocks; rows sorted by key and cell."""
    names = ("key", "cell", "n", "rank", "doc", "component", "lead", "probe")

    def join_rows(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        key, cell, n, rank, doc, group, lead, probe = (
            rows.column(c).to_numpy() for c in names
        )
        points = np.stack([unpacked_point(x.as_py()).astype(np.uint32) for x in rows.column("coarse")])
        block = np.cumsum((np.diff(key, prepend=-1) != 0) | (np.diff(cell, prepend=-1) != 0))
        n, rank = n.astype(np.int64), rank.astype(np.int64)
        held: list[np.ndarray] = []
        total = 0

        def pairs():
            out = np.unique(np.concatenate(held), axis=0)
            held.clear()
            return pa.RecordBatch.from_pydict({"a": pa.array(out[:, 0]), "b": pa.array(out[:, 1])})

        for i, j in _block_pairs(block, n, rank, doc, group, lead, probe, points):
            if len(i):
                held.append(np.stack((np.minimum(doc[i], doc[j]), np.maximum(doc[i], doc[j])), axis=1))
                total += len(i)
            if total >= 1_000_000:
                yield pairs()
                total = 0
        if held:
            yield pairs()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < HELD_ROWS:
                continue
            rows = pa.Table.from_batches(held)
            key, cell = (rows.column(c).to_numpy() for c in ("key", "cell"))
            # all but the last block, which may go on
            cut = int(np.argmax((key == key[-1]) & (cell == cell[-1])))
            if cut:
                yield from join_rows(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
            size = len(rows) - cut
        if size:
            yield from join_rows(pa.Table.from_batches(held))

    return map_arrow(mixed.select(*names, "coarse"), run, "a long, b long")


# --------------------------------------------------------------------- verification


def _compare(pairs: DataFrame, values: DataFrame, parts: int, decode, linked) -> DataFrame:
    """The distinct pairs (a, b) for which ``linked(x, y)`` holds, x and y being what
    ``decode`` makes of a batch of ``values`` (id, value).  A centre's value meets those of
    its partners, which are split by a salt if they are many."""
    rows = pairs.count()
    pairs = few(pairs, rows)
    fan = F.floor((F.col("members") - 1) / MEMBERS_PER_TASK)  # the greatest salt
    centres = pairs.groupBy("a").agg(F.count("*").alias("members")).select(
        "a", F.explode(F.sequence(F.lit(0), fan)).alias("salt"), fan.alias("fan")
    )
    salts = pairs.join(
        centres.where("salt = 0").select(F.col("a").alias("c"), "fan"), F.col("a") == F.col("c")
    ).select("a", "b", F.pmod(F.xxhash64("b"), F.col("fan") + 1).alias("salt"))
    # the centres of the pairs and their partners, by the id of the value that they need
    roles = salts.select(F.col("b").alias("id"), "a", "salt", "b").union(
        centres.select(F.col("a").alias("id"), "a", "salt", F.lit(None).cast("long"))
    )
    if are_few(rows):
        held, roles = values, F.broadcast(roles)
    else:
        wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        held = values.join(maybe_broadcast(wanted, wanted.count(), 16), "id", "left_semi")
    met = held.join(roles, "id").repartition(parts, "a", "salt").sortWithinPartitions(
        F.col("a"), F.col("salt"), F.col("b").asc_nulls_first()
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, own = None, None
        for batch in batches:
            for part in chunks(batch, "value"):
                left, right = [], []
                ids = zip(part.column("a").to_pylist(), part.column("b").to_pylist())
                for (a, b), x in zip(ids, decode(part.column("value"))):
                    if b is None:
                        centre, own = a, x
                    elif a != centre:
                        raise RuntimeError("a member without its centre")
                    elif linked(own, x):
                        left.append(a)
                        right.append(b)
                yield pa.RecordBatch.from_pydict({
                    "a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())
                })

    return map_arrow(met.select("a", "b", "value"), run, "a long, b long")


def _verify(pairs: DataFrame, docs: DataFrame, summary: DataFrame, parts: int, k: int) -> DataFrame:
    """The links (u, v) among distinct pairs (a, b): by fine points, then by whole sets."""

    def points(column: pa.Array) -> Iterator[np.ndarray]:
        return map(unpacked_point, column.to_pylist())

    def sets(column: pa.Array) -> Iterator[np.ndarray]:
        return shingle_sets(find_words(column, ASCII_SPACE), k)

    def similar(x: np.ndarray, y: np.ndarray) -> bool:
        common = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * common >= 75 * (len(x) + len(y) - common)

    fine = summary.select(F.col("doc").alias("id"), F.col("point").alias("value"))
    near = stored(_compare(pairs, fine, parts, points, may_link), "near")
    texts = docs.select(F.col("_row").alias("id"), F.col("_text").alias("value"))
    return _compare(near, texts, parts, sets, similar).toDF("u", "v")


def _labels(docs: DataFrame, size: int, k: int) -> DataFrame:
    """(doc, n_shingles, label) per ``_row`` of ``docs``: label is the least row reachable
    by links."""
    spark, docs = docs.sparkSession, docs.select("_row", "_text")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    summary = stored(_summaries(docs, k), "sets")
    same = ["n", "h1", "h2"]
    classes = stored(
        summary.where("n > 0").groupBy(*same).agg(F.min("doc").alias("first")), "classes"
    )
    member = stored(
        summary.where("n > 0").select("doc", *same).join(classes, same).select("doc", "first"), "members"
    )
    entries = _entries(docs, _frequent(docs, size, k), 8 * parts, k)
    blocks = stored(_blocks(entries.repartition(parts, "bucket")), "blocks")

    # first links: stars, between classes
    first_a = member.select(F.col("doc").alias("a"), F.col("first").alias("fa"))
    first_b = member.select(F.col("doc").alias("b"), F.col("first").alias("fb"))
    stars = stored(
        blocks.where("kind = 0").select("a", "b").distinct().join(first_a, "a").join(first_b, "b")
        .where("fa <> fb").select(F.least("fa", "fb").alias("a"), F.greatest("fa", "fb").alias("b")).distinct(),
        "stars",
    )
    links = stored(_verify(stars, docs, summary, parts, k), "links")
    first = stored(components(links), "components")

    # blocks that hold several components, with the points of their documents
    placed = (
        member.join(first.select(F.col("node").alias("first"), "component"), "first", "left")
        .select("doc", "first", F.coalesce("component", "first").alias("component"))
        .where("doc <> first OR first <> component")
    )
    placed = stored(placed, "placed")
    placed = maybe_broadcast(placed, placed.count(), 24)
    live = (
        blocks.where("kind = 1").select(F.col("a").alias("doc"), "key", "n", "rank")
        .join(placed, "doc", "left")
        .select("key", F.coalesce("first", "doc").alias("doc"), "n", "rank",
                F.coalesce("component", "doc").alias("component"))
    )
    large = blocks.where("kind = 2").select("key")
    n_large = large.count()
    whole = live
    if n_large:
        large = maybe_broadcast(large, n_large, 8)
        whole = live.join(large, "key", "left_anti")
    mixed = _mixed(whole.repartition(parts, "key"))
    if n_large:
        mixed = mixed.union(_split(live.join(large, "key", "left_semi")))
    mixed = stored(mixed, "mixed")
    points = summary.where("n > 0").select("doc", "coarse")
    across = mixed.join(points, "doc").repartition(parts, "key", "cell").sortWithinPartitions("key", "cell")
    across = stored(_cross_pairs(across).distinct(), "across")
    more = _verify(across, docs, summary, parts, k)
    labels = components(links.union(more))

    named = classes.join(labels, F.col("first") == F.col("node"), "left").select(
        *same, F.coalesce("component", "first").alias("label")
    )
    return summary.select("doc", *same).join(named, same, "left").select(
        "doc", F.col("n").alias("n_shingles"), F.coalesce("label", "doc").alias("label")
    )


def join(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE
) -> DataFrame:
    """(id, n_shingles, component) per row of ``df``: ``component`` is the smallest id of
    the documents reachable by links, the row's own included."""
    text = F.col(f"`{text_col}`").cast("string").alias("_text")
    docs, _, size = keyed(df.select(F.col(f"`{id_col}`").alias(id_col), text), id_col)
    found = _labels(docs, size, k)
    ids = docs.select(F.col("_row").alias("doc"), F.col(id_col))
    names = docs.select(F.col("_row").alias("label"), F.col(id_col).alias("component"))
    return found.join(ids, "doc").join(names, "label").select(id_col, "n_shingles", "component")


@clash_proof("id_col", "text_col")
def representatives(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE
) -> DataFrame:
    """The rows of ``df`` that are the first of their component, in the order of ids."""
    text = F.col(f"`{text_col}`").cast("string").alias("_text")
    docs, _, size = keyed(df.select(*(F.col(f"`{c}`") for c in df.columns), text), id_col)
    firsts = _labels(docs, size, k).where("doc = label").select(F.col("doc").alias("_first_row"))
    return docs.join(firsts, F.col("_row") == F.col("_first_row"), "left_semi").select(
        *(F.col(f"`{c}`") for c in df.columns)
    )
