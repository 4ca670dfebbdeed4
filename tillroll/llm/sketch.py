"""A merged count-min sketch of 64-bit keys, kept as flags: which cells count 2 or more, and
which are frequent.

Each task counts its keys in ``ROWS`` rows of cells and sends the cells that are not zero;
partition sketches are added up block by block.  The least cell of a key is at least its
count, so a key whose estimate is 1 occurs once.  Only flags (a bit a cell) and the frequent
cells come to the driver and are broadcast; their size is bounded by ``MAX_CELLS``.  Beyond
that the sketch fills and rules out less; what it lets through has to be compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import map_arrow
from tillroll.llm.words import U64, _mix

ROWS = 2
BLOCK = 1 << 18  # cells that are added up at once
MAX_CELLS = 1 << 28  # of a row: 32 MB of flags
HOT = 10_000  # a key of more occurrences (estimated) is frequent
KEYS = 800_000  # counted at once in a task

_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Sketch:
    """Flags of a merged sketch: which cells count 2 or more, and which are frequent."""

    def __init__(self, cells: int):
        self.cells = cells
        self.flags = [np.zeros(-(-cells // 8), np.uint8) for _ in range(ROWS)]
        self.hot = [np.zeros(0, np.uint32) for _ in range(ROWS)]

    @staticmethod
    def cell(keys: np.ndarray, row: int, cells: int) -> np.ndarray:
        return (_mix(keys * U64(_SEEDS[row]) + U64(row)) & U64(cells - 1)).astype(np.int64)

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for row, flags in enumerate(self.flags):
            at = self.cell(keys, row, self.cells)
            out &= (flags[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return out

    def frequent(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for row, hot in enumerate(self.hot):
            out &= np.isin(self.cell(keys, row, self.cells).astype(np.uint32), hot)
        return out


def build_sketch(
    rows: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], expected: int, parts: int
) -> Sketch:
    """The merged sketch of the keys that ``keys_of`` finds in all batches; about ``expected``
    in all, which sizes it."""
    expected = max(1, expected)
    cells = min(MAX_CELLS, max(BLOCK, 1 << (4 * expected - 1).bit_length()))
    hot = max(HOT, 16 * expected // cells)
    per_row = cells // BLOCK

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            keys, times = np.unique(np.concatenate(held), return_counts=True)
            for row in range(ROWS):
                at = Sketch.cell(keys, row, cells)
                order = np.argsort(at, kind="stable")
                at, n = at[order], times[order]
                new = np.flatnonzero(np.diff(at, prepend=-1))  # keys of one cell
                at, n = at[new], np.minimum(np.add.reduceat(n, new), 1 << 31).astype(np.uint32)
                block = at // BLOCK
                cut = np.flatnonzero(np.diff(block, prepend=-1))
                ends = np.append(cut[1:], len(at))
                inner = (at % BLOCK).astype(np.uint32)
                yield pa.RecordBatch.from_pydict({
                    "slot": pa.array((row * per_row + block[cut]).astype(np.int32)),
                    "cells": pa.array([inner[a:b].tobytes() for a, b in zip(cut, ends)], pa.binary()),
                    "times": pa.array([
                        None if (n[a:b] == 1).all() else n[a:b].tobytes() for a, b in zip(cut, ends)
                    ], pa.binary()),
                })

        for batch in batches:
            for keys in keys_of(batch):
                held.append(keys)
                size += len(keys)
                if size > KEYS:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, total = None, np.zeros(BLOCK, np.int64)

        def done() -> pa.RecordBatch:
            again = total >= 2
            some = np.flatnonzero(again).astype(np.uint32)
            dense = len(some) * 32 > BLOCK
            return pa.RecordBatch.from_pydict({
                "slot": pa.array([slot], pa.int32()), "dense": pa.array([dense]),
                "flags": pa.array([(np.packbits(again) if dense else some).tobytes()], pa.binary()),
                "hot": pa.array([np.flatnonzero(total >= hot).astype(np.uint32).tobytes()], pa.binary()),
            })

        for batch in batches:
            for s, c, t in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if s != slot:
                    if slot is not None:
                        yield done()
                    slot, total[:] = s, 0
                at = np.frombuffer(c, np.uint32)
                total[at] += 1 if t is None else np.frombuffer(t, np.uint32)  # cells differ
        if slot is not None:
            yield done()

    partial = map_arrow(rows, count, "slot int, cells binary, times binary")
    sorted_ = partial.repartition(min(parts, ROWS * per_row), "slot").sortWithinPartitions("slot")
    merged = map_arrow(sorted_, merge, "slot int, dense boolean, flags binary, hot binary")
    sketch, frequent = Sketch(cells), [[] for _ in range(ROWS)]
    table = merged.toArrow()  # at most ROWS * MAX_CELLS bits of flags, and as many again
    for slot, dense, flags, often in zip(*(table.column(i) for i in range(4))):
        row, block = divmod(slot.as_py(), per_row)
        part = sketch.flags[row][block * BLOCK // 8 : (block + 1) * BLOCK // 8]
        if dense.as_py():
            part[:] = np.frombuffer(flags.as_py(), np.uint8)
        else:
            again = np.zeros(BLOCK, bool)
            again[np.frombuffer(flags.as_py(), np.uint32)] = True
            part[:] = np.packbits(again)
        frequent[row].append(np.frombuffer(often.as_py(), np.uint32) + np.uint32(block * BLOCK))
    sketch.hot = [np.concatenate(x) if x else np.zeros(0, np.uint32) for x in frequent]
    return sketch
