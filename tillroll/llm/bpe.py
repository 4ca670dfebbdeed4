"""Byte-level BPE encoding and decoding with given merge ranks.

A text is cut by the tokenizer's pattern.  Each pre-token is looked up in two tiers: a
minimal perfect hash over the vocabulary gives the id of a pre-token that is a whole
vocabulary entry; a miss is merged with a heap of adjacent pairs over a linked list of its
bytes (lowest rank first, leftmost on ties), O(n log n) also for very long runs.  A bounded
memo of recent pre-tokens stands before both tiers.

The rank file (under 1 MB) is read once on the driver and broadcast.

Cases: null and empty texts have no ids; repeated rows are encoded each on its own.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import clash_proof, map_arrow, worker_cache

MEMO_ENTRIES = 400_000  # about 80 MB
_MASK = (1 << 64) - 1


class PerfectHash:
    """Minimal perfect hash of byte strings: hash and displace, one slot per key.

    A key's bucket holds a displacement (>= 0) that sends all keys of the bucket to free
    slots, or -1 - slot for a bucket of one key.
    """

    def __init__(self, keys: list[bytes], seed: int = 0):
        self.seed, self.n, self.buckets = seed, len(keys), max(1, len(keys) // 2)
        by_bucket: list[list[int]] = [[] for _ in range(self.buckets)]
        for key in keys:
            h = xxhash.xxh3_64_intdigest(key, seed)
            by_bucket[h % self.buckets].append(h)
        if any(len(set(hs)) < len(hs) for hs in by_bucket):
            raise ValueError("equal keys, or a 64-bit collision: choose another seed")
        taken = bytearray(self.n)
        displace = [0] * self.buckets
        order = sorted(range(self.buckets), key=lambda b: -len(by_bucket[b]))
        singles = []
        for b in order:
            hashes = by_bucket[b]
            if len(hashes) < 2:
                singles += [b] * len(hashes)
                continue
            d = 0
            while True:
                slots = {self._slot(h, d) for h in hashes}
                if len(slots) == len(hashes) and not any(taken[s] for s in slots):
                    break
                d += 1
            displace[b] = d
            for s in slots:
                taken[s] = 1
        free = (s for s in range(self.n) if not taken[s])
        for b in singles:
            displace[b] = -1 - next(free)
        self.displace = displace

    def _slot(self, h: int, d: int) -> int:
        x = ((h ^ (d * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9) & _MASK
        return (x >> 32) % self.n

    def __call__(self, key: bytes) -> int:
        """The slot of a key; of any other string, some slot (compare the stored key)."""
        h = xxhash.xxh3_64_intdigest(key, self.seed)
        d = self.displace[h % self.buckets]
        return -1 - d if d < 0 else self._slot(h, d)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: merge the adjacent pair of lowest rank until none is left.

    Parts are a linked list over the bytes: part i covers ``piece[i:after[i]]`` and
    ``before[i]`` starts the part to its left.  Heap entries are rank << 40 | i; an entry
    is stale when the pair at i has another rank by now.
    """
    n, get = len(piece), ranks.get
    after, before = list(range(1, n + 2)), list(range(-1, n))
    current = [get(piece[i : i + 2], -1) for i in range(n)]
    current[-1] = -1  # a last byte starts no pair
    heap = [r << 40 | i for i, r in enumerate(current) if r >= 0]
    heapify(heap)
    while heap:
        top = heappop(heap)
        i = top & 0xFFFFFFFFFF
        if current[i] != top >> 40:
            continue
        j = after[i]
        k = after[j]
        after[i], current[j] = k, -1
        if k < n:
            before[k] = i
            r = current[i] = get(piece[i : after[k]], -1)
            if r >= 0:
                heappush(heap, r << 40 | i)
        else:
            current[i] = -1
        if i:
            h = before[i]
            r = current[h] = get(piece[h:k], -1)
            if r >= 0:
                heappush(heap, r << 40 | h)
    out, i = [], 0
    while i < n:
        j = after[i]
        out.append(ranks[piece[i:j]])
        i = j
    return out


_NARROW = 0x250  # Latin letters and ASCII


def cutter(pattern: str) -> Callable[[str], list[str]]:
    """``findall`` of the pattern.  Texts below U+0250 take the same pattern with its
    Unicode classes written out for those characters, which ``re`` runs faster."""
    full = regex.compile(pattern).findall
    narrow = pattern
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        one = regex.compile(name)
        chars = "".join(f"\\u{c:04x}" for c in range(_NARROW) if one.match(chr(c)))
        narrow = narrow.replace(name, chars)  # inside a class
    # outside a class the bare characters need brackets of their own
    bare, inside = [], False
    for part in re.split(r"(\[|\]|(?:\\u[0-9a-f]{4})+)", narrow):
        if part in "[]" and part:
            inside = part == "["
        elif part.startswith("\\u") and not inside:
            part = f"[{part}]"
        bare.append(part)
    space = "".join(f"\\u{c:04x}" for c in range(_NARROW) if regex.match(r"\s", chr(c)))
    narrow = "".join(bare).replace(r"\S", f"[^{space}]")
    fast, wide = re.compile(narrow).findall, re.compile(f"[^\\x00-\\u{_NARROW - 1:04x}]").search
    return lambda text: full(text) if wide(text) else fast(text)


class _Memo(dict):
    """Pre-token -> packed ids, filled on a miss; emptied when it is full."""

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, token: str) -> bytes:
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        ids = self.codec.piece(token.encode())
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(token) <= 64:
            self[token] = packed
        return packed


class Codec:
    """Encoder and decoder for one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, hashed: PerfectHash | None = None):
        self.ranks = ranks
        self.hash = hashed or PerfectHash(list(ranks))
        self.keys: list[bytes] = [b""] * self.hash.n
        self.ids = [0] * self.hash.n
        for key, rank in ranks.items():
            slot = self.hash(key)
            self.keys[slot], self.ids[slot] = key, rank
        self.vocabulary = [b""] * (max(ranks.values()) + 1)
        for key, rank in ranks.items():
            self.vocabulary[rank] = key
        self.cut = cutter(pattern)
        self.memo = _Memo(self)

    def piece(self, token: bytes) -> list[int]:
        slot = self.hash(token)
        return [self.ids[slot]] if self.keys[slot] == token else merge(token, self.ranks)

    def encode(self, text: str | None) -> bytes:
        """Ids of a text, packed as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.cut(text))) if text else b""

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f.read().splitlines())}


@lru_cache(maxsize=4)
def _parts(path: str) -> tuple[dict[bytes, int], PerfectHash]:
    ranks = read_ranks(path)
    return ranks, PerfectHash(list(ranks))


_CODECS: dict[tuple, Codec] = worker_cache(__name__)


def _codec(key: tuple, shared, pattern: str) -> Codec:
    """This worker's codec, kept across tasks."""
    if key not in _CODECS:
        ranks, hashed = shared.value
        _CODECS.clear()
        _CODECS[key] = Codec(ranks, pattern, hashed)
    return _CODECS[key]


@clash_proof("text_col")
def encode(
    df: DataFrame, path: str, pattern: str, text_col: str = "text",
    ids: bool = True, digests: bool = False,
) -> DataFrame:
    """``df`` without its text plus ``n_tokens`` and, as asked for, ``ids`` (array<int>) and
    the SHA-256 ``ids_sha256`` (packed ids) and ``decoded_sha256`` (bytes decoded again).
    Columns of ``df`` with those names are replaced.
    """
    spark: SparkSession = df.sparkSession
    shared, key = spark.sparkContext.broadcast(_parts(path)), (path, pattern)
    added = [("n_tokens", "long", pa.int64())]
    if ids:
        added.append(("ids", "array<int>", pa.list_(pa.int32())))
    if digests:
        added += [("ids_sha256", "string", pa.string()), ("decoded_sha256", "string", pa.string())]
    keep = [c for c in df.columns if c not in {text_col, *(a[0] for a in added)}]
    rows = df.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, shared, pattern)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            step = 500
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                packed = [codec.encode(t.as_py()) for t in texts.slice(at, step)]
                out = [pa.array([len(p) // 4 for p in packed], pa.int64())]
                if ids:
                    flat = pa.array(np.frombuffer(b"".join(packed), "<i4"))
                    ends = np.cumsum([0] + [len(p) // 4 for p in packed]).astype("i4")
                    out.append(pa.ListArray.from_arrays(pa.array(ends), flat))
                if digests:
                    sha = lambda x: hashlib.sha256(x).hexdigest()
                    out.append(pa.array([sha(p) for p in packed], pa.string()))
                    out.append(pa.array([sha(codec.decode(p)) for p in packed], pa.string()))
                yield pa.RecordBatch.from_arrays(
                    part.columns[:-1] + out, [*part.schema.names[:-1], *(a[0] for a in added)]
                )

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    return map_arrow(rows, run, ", ".join(fields + [f"{n} {t}" for n, t, _ in added]))


@clash_proof("ids_col")
def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``df`` plus ``decoded`` (binary): the bytes of ``ids_col``; null ids give null."""
    spark: SparkSession = df.sparkSession
    shared, key = spark.sparkContext.broadcast(_parts(path)), (path, pattern)
    keep = [c for c in df.columns if c != "decoded"]
    rows = df.select(*(F.col(f"`{c}`") for c in keep), F.col(ids_col).cast("array<int>").alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, shared, pattern)
        for batch in batches:
            lists = batch.column(batch.num_columns - 1).to_pylist()
            out = [None if x is None else codec.decode(np.array(x, "<u4").tobytes()) for x in lists]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.binary())],
                [*batch.schema.names[:-1], "decoded"],
            )

    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    return map_arrow(rows, run, ", ".join([*fields, "decoded binary"]))
