"""Alignment of two tokenizers' ids over the same bytes, and how often ids meet.

Tokenizer A (byte-level BPE, a ``tokenizers`` JSON file) encodes a blank and the text, B
(a sentencepiece model that adds the blank itself) encodes the text.  Byte offsets where a
token of A and one of B both end are shared cuts; they cut both id sequences into groups.
Two tokens are linked where their byte ranges overlap.

*Divide and conquer.*  ``shared_cuts`` looks for a common end near the middle of an interval
(outwards from the middle token of A, by bisection in the ends of B) and goes on with both
halves; what lies between the middle and the cut is known to hold none and is not searched
again, so each end is bisected once.  An interval without a cut is a group.

*Parts.*  A blank after a character that is no white space is always a shared cut: A's
pattern ends a pre-token there, and no piece of B's vocabulary holds a blank after another
character (checked when the model is loaded; a vocabulary that does is encoded by whole
texts).  A text is therefore cut there first and each distinct part is encoded and aligned
once, with a bounded memo; the recursion runs inside a part, or over the whole text where
there is no such blank.

One pass encodes and keeps, per document, its counts, the digest of its groups and its
distinct linked pairs with their numbers.  Pair counts over all documents are summed from
that table.  The most frequent pairs (at most ``MAX_PAIRS``, counted first) are broadcast;
links of any other pair are joined with the pair table by a shuffle, which such rare pairs
spread evenly.

Cases: null and empty texts have no tokens; neither have texts whose joined A or B bytes
differ from the blank and the text (such as those holding U+2581): their counts are 0 and
their digest is the empty text; strings of special tokens are plain text; repeated rows and
equal ids are rows of their own and all count; ties for the highest count of a B id all count
as best; a text of any length is taken whole; columns of other names pass through, those
named like the added ones are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import chunks, map_arrow, stored, worker_cache

MEMO_PARTS = 250_000
MEMO_BYTES = 96 << 20  # of aligned parts that are kept
MAX_PAIRS = 2_000_000  # in the broadcast table: 34 MB
_BLANK = "\u2581"

# what any of the libraries may take as white space before a blank
_SPACE = r"\s\x1c-\x1f\x85\u180e\u200b-\u200d\u2060\ufeff"
_CUT = re.compile(rf"(?<=[^{_SPACE}]) ")
_DOUBTFUL = re.compile(rf"[{_SPACE}] ")


def shared_cuts(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """(tokens of a, tokens of b) up to each shared cut, in order; ``a`` and ``b`` are the
    ascending ends of the tokens, whose last ones are equal."""
    if len(a) == 1 or len(b) == 1:
        return [(len(a), len(b))]
    out = []
    # tokens [.., a_hi) and [b_lo, b_hi); ends of a that may be cuts: [from, to)
    stack = [(len(a), 0, len(b), 0, len(a) - 1)]
    while stack:
        a_hi, b_lo, b_hi, lo, hi = stack.pop()
        if lo < hi and b_hi - b_lo > 1:
            left = (lo + hi) // 2
            right = left + 1
            while True:
                if left >= lo:
                    i, left = left, left - 1
                    j = bisect_left(b, a[i], b_lo, b_hi - 1)
                    if j < b_hi - 1 and b[j] == a[i]:
                        break
                if right < hi:
                    i, right = right, right + 1
                    j = bisect_left(b, a[i], b_lo, b_hi - 1)
                    if j < b_hi - 1 and b[j] == a[i]:
                        break
                elif left < lo:
                    i = -1
                    break
            if i >= 0:
                stack.append((a_hi, j + 1, b_hi, right, hi))
                stack.append((i + 1, b_lo, j + 1, lo, left + 1))
                continue
        out.append((a_hi, b_hi))
    return out


def links(a: list[int], b: list[int], cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """All pairs (token of a, token of b) whose byte ranges overlap."""
    out = []
    i = j = 0
    for a_hi, b_hi in cuts:
        while True:
            out.append((i, j))
            if a[i] < b[j]:
                i += 1
            elif a[i] > b[j]:
                j += 1
            else:
                break
        i, j = a_hi, b_hi
    return out


def _byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def _merge_ranks(spec: dict) -> dict[bytes, int] | None:
    """Ranks of a byte-level BPE whose merges are in the order of the ids they make (as in
    the usual vocabularies), so that a rank encoder gives the same ids; else None."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    letters = _byte_alphabet()
    special = {t["content"] for t in spec.get("added_tokens", [])}
    vocab = {t: i for t, i in model.get("vocab", {}).items() if t not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    made = [vocab.get("".join(m), -1) for m in merges]
    same = (
        spec.get("normalizer") is None and before.get("type") == "ByteLevel"
        and before.get("use_regex", True) and not before.get("add_prefix_space")
        and not model.get("ignore_merges") and all(x < y for x, y in zip(made, made[1:]))
        and all(c in letters for t in vocab for c in t)
        and len({*made, *(vocab[c] for c in letters if c in vocab)}) == len(vocab)
    )
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items()} if same else {}
    return ranks if all(bytes([b]) in ranks for b in range(256)) else None


class Aligner:
    """Both tokenizers and the memo of parts, in a Python worker."""

    def __init__(self, json_a: str, model_b: bytes, pattern: str | None):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        spec = json.loads(json_a)
        ranks = _merge_ranks(spec) if pattern else None
        if ranks:
            self.encode_a = tiktoken.Encoding(
                "a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
            ).encode_ordinary
        else:
            slow = Tokenizer.from_str(json_a)
            slow.encode_special_tokens = True
            self.encode_a = lambda text: slow.encode(text, add_special_tokens=False).ids
        letters = _byte_alphabet()
        self.bytes_a = {i: bytes(letters.get(c, 0) for c in t) for t, i in spec["model"]["vocab"].items()}
        self.bytes_a |= {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        self.exact_a = bool(ranks)  # ranks with all bytes give every text back
        self.size_a = [len(self.bytes_a.get(i, b"")) for i in range(max(self.bytes_a) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(_BLANK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.size_b = list(map(len, self.bytes_b))
        self.shown_id = list(map(str, range(max(*self.bytes_a, len(pieces)) + 1)))
        self.by_parts = not any(re.search(f"[^{_BLANK}]{_BLANK}", p) for p in pieces)
        self.blank = self.b.piece_to_id(_BLANK)
        self.wide = max(*self.bytes_a, len(pieces)) >= 1 << 16
        self.memo: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.memo.clear()
        self.table = array("q")  # n_a, n_b, n_groups, same bytes, first link of each part
        self.codes = array("q")  # links of all parts
        self.shown: list[bytes] = []
        self.size = 0

    def parts(self, text: str) -> list[str]:
        """Parts of a blank and ``text``, each without its first blank."""
        if not self.by_parts:
            return [text]
        return _CUT.split(text) if _DOUBTFUL.search(" " + text) else text.split(" ")

    def _add(self, part: str, ids_b: list[int]) -> None:
        text = " " + part
        ids_a = self.encode_a(text)
        whole = text.encode()
        self.memo[part] = len(self.shown)
        if b"".join([self.bytes_b[i] for i in ids_b]) != whole or not (
            self.exact_a or b"".join([self.bytes_a[i] for i in ids_a]) == whole
        ):
            self.table.extend((0, 0, 0, 0, len(self.codes)))
            self.shown.append(b"")
            return
        ends_a = list(accumulate([self.size_a[i] for i in ids_a]))
        ends_b = list(accumulate([self.size_b[i] for i in ids_b]))
        cuts = shared_cuts(ends_a, ends_b)
        self.table.extend((len(ids_a), len(ids_b), len(cuts), 1, len(self.codes)))
        bits = 32 if self.wide else 16
        self.codes.extend([ids_a[i] << bits | ids_b[j] for i, j in links(ends_a, ends_b, cuts)])
        name, shown, i, j = self.shown_id, [], 0, 0
        for p, q in cuts:
            left = name[ids_a[i]] if p == i + 1 else ",".join([name[x] for x in ids_a[i:p]])
            right = name[ids_b[j]] if q == j + 1 else ",".join([name[x] for x in ids_b[j:q]])
            shown.append(f"{left}|{right}")
            i, j = p, q
        packed = ";".join(shown).encode()
        self.shown.append(packed)
        self.size += len(packed) + 8 * (len(ids_a) + len(ids_b)) + len(whole) + 250

    def look_up(self, texts: list[str | None]) -> list[list[int]]:
        """Numbers of the parts of each text (none for null and empty ones)."""
        if len(self.memo) > MEMO_PARTS or self.size > MEMO_BYTES:
            self._clear()
        cut = [self.parts(t) if t else [] for t in texts]
        memo = self.memo
        missing = [p for p in {p for x in cut for p in x} if p not in memo]
        for at in range(0, len(missing), 10_000):
            some = missing[at : at + 10_000]
            # the model adds a blank, but none to an empty text
            for part, ids in zip(some, self.b.encode(some, num_threads=1)):
                self._add(part, ids if part else [self.blank])
        return [[memo[p] for p in x] for x in cut]


_ALIGNERS: dict[str, Aligner] = worker_cache(__name__)


def _aligner(key: str, shared) -> Aligner:
    """This worker's aligner, kept across tasks."""
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(*shared.value)
    return _ALIGNERS[key]


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _aligned(aligner: Aligner, texts: pa.Array, groups: bool) -> list[pa.Array]:
    """Counts, digest, shown groups, distinct pairs (packed) and their numbers of some texts."""
    numbers = aligner.look_up(texts.to_pylist())
    rows = len(numbers)
    sizes = np.array([len(x) for x in numbers], np.int64)
    flat = np.fromiter((i for x in numbers for i in x), np.int64, sizes.sum())
    row = np.repeat(np.arange(rows), sizes)
    table = np.frombuffer(aligner.table, np.int64).reshape(-1, 5)[flat]
    same = np.ones(rows, bool)
    same[row[table[:, 3] == 0]] = False
    own = same[row]
    table, row = table[own], row[own]
    total = np.zeros((rows, 3), np.int64)
    np.add.at(total, row, table[:, :3])
    shown = [b";".join([aligner.shown[i] for i in x]) if ok else b"" for x, ok in zip(numbers, same)]
    n = table[:, 0] + table[:, 1] - table[:, 2]  # links of each part
    at = np.repeat(table[:, 4], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    codes = np.frombuffer(aligner.codes, np.int64)[at].astype(np.int64 if aligner.wide else np.uint32)
    owner = np.repeat(row, n)
    order = np.lexsort((codes, owner))
    codes, owner = codes[order], owner[order]
    lead = np.ones(len(codes), bool)
    lead[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(lead)
    times = np.diff(np.append(first, len(codes))).astype(np.int32)
    codes = codes[first]
    edge = np.searchsorted(owner[first], np.arange(rows + 1))
    return [
        *(pa.array(total[:, i]) for i in range(3)),
        pa.array(total[:, 0] + total[:, 1] - total[:, 2]),
        pa.array([hashlib.sha256(s).hexdigest() if s else "" for s in shown], pa.string()),
        *([pa.array([s.decode() for s in shown], pa.string())] if groups else []),
        pa.array([codes[a:b].tobytes() for a, b in zip(edge, edge[1:])], pa.binary()),
        pa.array([times[a:b].tobytes() for a, b in zip(edge, edge[1:])], pa.binary()),
    ]


def _encoded(docs: DataFrame, others: list[str], shared, key: str, groups: bool) -> DataFrame:
    """The counts, digest and distinct pairs of each row; its text is the last column."""
    names = [*others, *_COUNTS, "groups_sha256", *(["groups"] if groups else []), "codes", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(key, shared)
        for batch in batches:
            for part in chunks(batch, "t"):
                out = _aligned(aligner, part.column("t"), groups)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *out], names)

    fields = [f"{o} {docs.schema[o].dataType.simpleString()}" for o in others]
    fields += [f"{c} long" for c in _COUNTS] + ["groups_sha256 string"]
    fields += ["groups string"] * groups + ["codes binary", "times binary"]
    return map_arrow(docs, run, ", ".join(fields))


def pair_counts(encoded: DataFrame, wide: bool) -> DataFrame:
    """(code, n, best): links of each linked id pair over all rows; whether it is the highest
    count of its B id.  A pair is one number: id of A, id of B."""
    packed, bits = (np.int64, 32) if wide else (np.uint32, 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            codes, number = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            total = np.zeros(len(codes), np.int64)
            np.add.at(total, number, np.concatenate([n for _, n in held]))
            return codes, total

        def sent(codes, total) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"code": pa.array(codes.astype(np.int64)), "n": pa.array(total)})

        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column(0).to_pylist()), packed)
            times = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int32).astype(np.int64)
            held.append((codes, times))
            size += len(codes)
            if size > 2_000_000:
                held = [summed()]
                size = len(held[0][0])
                if size > 1_000_000:
                    yield sent(*held[0])
                    held, size = [], 0
        if size:
            yield sent(*summed())

    counted = map_arrow(encoded.select("codes", "times"), run, "code long, n long")
    counted = stored(counted.groupBy("code").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("code").bitwiseAND((1 << bits) - 1)
    # one row per id of B, a vocabulary
    best = counted.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counted.withColumn("b", b).join(F.broadcast(best), "b").select(
        "code", "n", (F.col("n") == F.col("most")).alias("best")
    )


def _frequent(pairs: DataFrame, limit: int) -> tuple[DataFrame, int | None]:
    """Pairs of at least 2 ** k links with the least k that leaves ``limit`` of them; k, or
    None if these are all."""
    power = F.floor(F.log2(F.col("n").cast("double")) + 1e-9)
    steps = pairs.groupBy(power.alias("k")).agg(F.count("*").alias("pairs")).collect()  # at most 64
    total, least = 0, 64
    for row in sorted(steps, key=lambda r: -r.k):
        if total + row.pairs > limit:
            return pairs.where(power >= least), least
        total, least = total + row.pairs, row.k
    return pairs, None


def _summed(
    encoded: DataFrame, pairs: DataFrame, columns: list[str], limit: int, wide: bool
) -> DataFrame:
    """``encoded`` plus n_best and count_sum."""
    kind = np.int64 if wide else np.uint32
    some, least = _frequent(pairs, limit)
    table = some.toArrow()  # at most ``limit`` pairs
    codes = table.column("code").to_numpy()
    order = np.argsort(codes)
    best = table.column("best").to_numpy()[order]
    shared = encoded.sparkSession.sparkContext.broadcast(
        (codes[order], table.column("n").to_numpy()[order], best)
    )
    rare = least is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, best = shared.value
        for batch in batches:
            packed = batch.column("codes").to_pylist()
            own = np.frombuffer(b"".join(packed), kind).astype(np.int64)
            times = np.frombuffer(b"".join(batch.column("times").to_pylist()), np.int32).astype(np.int64)
            row = np.repeat(np.arange(batch.num_rows), [len(x) // kind().itemsize for x in packed])
            at = np.minimum(np.searchsorted(codes, own), max(0, len(codes) - 1))
            known = codes[at] == own if len(codes) else np.zeros(len(own), bool)
            total, top = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            at = at[known]
            np.add.at(total, row[known], times[known] * n[at])
            np.add.at(top, row[known], times[known] * best[at])
            out = [pa.array(top), pa.array(total)]
            if rare:
                edge = np.searchsorted(row[~known], np.arange(batch.num_rows + 1)).astype(np.int32)
                inner = pa.StructArray.from_arrays(
                    [pa.array(own[~known]), pa.array(times[~known])], ["code", "times"]
                )
                out.append(pa.ListArray.from_arrays(pa.array(edge), inner))
            names = [*columns, "n_best", "count_sum", *(["rest"] if rare else [])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *out], names)

    fields = [f"{c} {encoded.schema[c].dataType.simpleString()}" for c in columns]
    fields += ["n_best long", "count_sum long"]
    fields += ["rest array<struct<code:bigint,times:bigint>>"] * rare
    found = map_arrow(encoded, run, ", ".join(fields))
    if not rare:
        return found
    found = stored(found, "links")
    single = found.select("r", F.explode("rest").alias("x")).select("r", "x.code", "x.times")
    more = single.join(pairs, "code").groupBy("r").agg(
        F.sum(F.col("times") * F.col("n")).alias("more"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
    )
    add = lambda c, m: (F.col(c) + F.coalesce(m, F.lit(0))).alias(c)
    return found.join(more, "r", "left").select(*columns, add("n_best", "more_best"), add("count_sum", "more"))


def align(
    df: DataFrame, path_a: str, path_b: str, pattern: str | None = None, text_col: str = "text",
    groups: bool = False, max_pairs: int = MAX_PAIRS,
) -> DataFrame:
    """``df`` without its text plus n_a, n_b, n_groups, n_links, groups_sha256, n_best,
    count_sum and, if asked for, ``groups``: the ids of each group as ``a1,a2|b1;a3|b2,b3``.
    ``pattern``: the pre-token pattern of A's file; without it A is encoded by its own library
    alone, which takes longer."""
    import sentencepiece

    spark: SparkSession = df.sparkSession
    with open(path_a, encoding="utf-8") as fa, open(path_b, "rb") as fb:
        files = (fa.read(), fb.read(), pattern)
    spec = json.loads(files[0])
    ids = [*spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens", []))]
    size_b = sentencepiece.SentencePieceProcessor(model_proto=files[1]).get_piece_size()
    wide = max(*ids, size_b) >= 1 << 16
    shared = spark.sparkContext.broadcast(files)  # a vocabulary and a model, a few MB
    added = [*_COUNTS, "groups_sha256", *(["groups"] if groups else []), "n_best", "count_sum"]
    keep = [c for c in df.columns if c != text_col and c not in added]
    others = [f"c{i}" for i in range(len(keep))]
    docs = df.select(
        F.monotonically_increasing_id().alias("r"),
        *(F.col(f"`{c}`").alias(o) for c, o in zip(keep, others)),
        F.col(f"`{text_col}`").cast("string").alias("t"),
    )
    key = hashlib.sha256(files[0].encode() + files[1] + (pattern or "").encode()).hexdigest()
    encoded = stored(_encoded(docs, ["r", *others], shared, key, groups), "tokens")
    columns = ["r", *others, *_COUNTS, "groups_sha256", *(["groups"] if groups else [])]
    out = _summed(encoded, pair_counts(encoded, wide), columns, max_pairs, wide)
    return out.drop("r").toDF(*keep, *added)
