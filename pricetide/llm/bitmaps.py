"""Bitmaps of bounded size that tell which numbers surely are not in a set."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BITMAP_LOG2 = 27                 # most bits of a bitmap (16 MB)
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _bits(s: np.ndarray, log2: int) -> tuple[np.ndarray, np.ndarray]:
    down = np.uint64(64 - log2)
    return (s * _FIRST) >> down, (s * _SECOND) >> down


def in_bitmap(bits: np.ndarray, log2: int, s: np.ndarray) -> np.ndarray:
    """Places of the numbers that the bitmap may hold (all that it holds are among them)."""
    first, second = _bits(s, log2)
    hit = np.flatnonzero((bits[first >> np.uint64(3)] >> (first & np.uint64(7)).astype(np.uint8)) & 1)
    again = second[hit]
    return hit[((bits[again >> np.uint64(3)] >> (again & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)]


def bitmap(seed: DataFrame, log2: int) -> np.ndarray:
    """The bitmap of the numbers in the column seed: a few tasks each make one of the fixed
    size, the driver joins them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros((1 << log2) // 8, np.uint8)
        for batch in batches:
            for b in _bits(batch.column("seed").to_numpy(zero_copy_only=False).view(np.uint64), log2):
                np.bitwise_or.at(bits, b >> np.uint64(3), np.uint8(1) << (b & np.uint64(7)).astype(np.uint8))
        yield pa.RecordBatch.from_pydict({"bits": pa.array([bits.tobytes()], pa.binary())})

    out = np.zeros((1 << log2) // 8, np.uint8)
    for row in seed.select("seed").repartition(4).mapInArrow(run, "bits binary").toLocalIterator():
        out |= np.frombuffer(row["bits"], np.uint8)
    return out
