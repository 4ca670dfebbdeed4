"""Spans of documents as packed arrays: (doc, start, n), one row per bucket.

Spans are found in any task.  Rows of single spans would be as many as the copies of a passage
have pieces; packed by buckets of documents there are at most as many rows as tasks and buckets,
and ``by_document`` brings the spans of a document together by one small shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import map_arrow
from tillroll.llm.words import U64, _mix

SPAN = (("doc", np.int64), ("start", np.int32), ("n", np.int32))


def joined_spans(doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """The windows of each document as maximal runs, in the order of documents."""
    if not len(doc):
        return {"doc": doc, "start": start.astype(np.int32), "n": n.astype(np.int32)}
    order = np.lexsort((start, doc))
    doc, start, n = doc[order], start[order].astype(np.int64), n[order]
    base = np.cumsum(np.concatenate(([0], doc[1:] != doc[:-1])))
    far = base << 40  # documents side by side on one axis
    reach = np.maximum.accumulate(far + start + n)
    new = np.ones(len(doc), bool)
    new[1:] = far[1:] + start[1:] > reach[:-1]
    lead = np.flatnonzero(new)
    last = np.append(lead[1:], len(doc)) - 1
    return {
        "doc": doc[lead], "start": start[lead].astype(np.int32),
        "n": (reach[last] - far[last] - start[lead]).astype(np.int32),
    }


def packed(e: dict[str, np.ndarray], by: np.ndarray, buckets: int, kind: int, names) -> pa.RecordBatch:
    """One row per bucket of ``by``; the fields that ``e`` lacks are empty."""
    bucket = (by % U64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(cut[1:], len(bucket))
    columns = {"bucket": pa.array(bucket[cut]), "kind": pa.array(np.full(len(cut), kind, np.int32))}
    for k in names:
        own = e[k][order] if k in e else None
        columns[k] = pa.array([b"" if own is None else own[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def packed_by_doc(
    e: dict[str, np.ndarray], buckets: int, kind: int, names, join: bool = True
) -> pa.RecordBatch:
    """Spans packed by buckets of documents; ``join``: as maximal runs."""
    if join:
        e = joined_spans(e["doc"], e["start"], e["n"])
    return packed(e, _mix(e["doc"].astype(U64)), buckets, kind, names)


def by_document(found: DataFrame, parts: int) -> DataFrame:
    """(owner, spans): one row per document, its spans as maximal runs, packed as int32
    (start, n) pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {k: [] for k, _ in SPAN}
        for batch in batches:
            for k, t in SPAN:
                held[k] += [np.frombuffer(x, t) for x in batch.column(k).to_pylist()]
        if not held["n"]:
            return
        e = joined_spans(*(np.concatenate(held[k]) for k, _ in SPAN))
        if not len(e["doc"]):
            return
        pairs = np.stack((e["start"], e["n"]), 1)
        cut = np.flatnonzero(np.concatenate(([True], e["doc"][1:] != e["doc"][:-1])))
        ends = np.append(cut[1:], len(pairs))
        for at in range(0, len(cut), 20_000):
            yield pa.RecordBatch.from_pydict({
                "owner": pa.array(e["doc"][cut[at : at + 20_000]]),
                "spans": pa.array([
                    pairs[a:b].tobytes() for a, b in zip(cut[at : at + 20_000], ends[at : at + 20_000])
                ], pa.binary()),
            })

    return map_arrow(found.repartition(parts, "bucket"), run, "owner long, spans binary")
