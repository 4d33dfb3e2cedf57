"""A one-pass count-min sketch of 64-bit keys, kept as far as the question `at least twice?` needs."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from .shared import small_batches
from .textops import mix

#: Cells of one row of the sketch, at most: 32 MB of bits. Beyond, more keys are overestimated, none lost.
MOST_CELLS = 1 << 28
#: Cells whose partial counts meet in one group.
SLICE = 1 << 18
#: Partitions whose counts of a slice are merged first, before these are.
FAN_IN = 64
#: Keys that a task holds before it hands on what it has counted.
HELD = 200_000


def cells(keys: np.ndarray, row: int, width: int) -> np.ndarray:
    """Where the keys are counted in a row of the sketch."""
    h = keys if row == 0 else mix(keys ^ np.uint64(0xA0761D6478BD642F * row & (1 << 64) - 1))
    return (((h >> np.uint64(32)) * np.uint64(width)) >> np.uint64(32)).astype(np.int64)


def width_for(expected_keys: int, most: int | None = None) -> int:
    """Cells in a row: three for each key, up to the bound; most: another one than MOST_CELLS."""
    return int(min(most or MOST_CELLS, max(1 << 12, 3 * expected_keys)))


def _sparse(at: np.ndarray, twice: np.ndarray) -> bytes:
    """Sorted distinct cells of a slice, each with whether it was counted twice, as steps."""
    steps = np.diff(at.astype(np.int64) << 1 | twice, prepend=0)
    return steps.astype(np.uint16 if steps.max() < 1 << 16 else np.uint32).tobytes()


def _unpack(data: bytes, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    both = np.cumsum(np.frombuffer(data, np.uint32 if wide else np.uint16).astype(np.int64))
    return both >> 1, both & 1


def _dense(count: np.ndarray) -> tuple[bytes, bytes]:
    return zlib.compress(np.packbits(count >= 1).tobytes(), 1), zlib.compress(np.packbits(count >= 2).tobytes(), 1)


def _merge_sparse(rows: pa.Table) -> pa.Table:
    count = np.zeros(SLICE, np.uint8)
    for data, wide in zip(rows["steps"], rows["wide"], strict=True):
        at, twice = _unpack(data.as_buffer(), wide.as_py())
        count[at] = np.minimum(count[at] + 1 + twice, 2)
    once, more = _dense(count)
    return pa.table({"slice": rows["slice"].slice(0, 1), "lot": rows["lot"].slice(0, 1), "once": pa.array([once]), "twice": pa.array([more])})


def _merge_dense(rows: pa.Table) -> pa.Table:
    count = np.zeros(SLICE, np.uint8)
    bits = lambda b: np.unpackbits(np.frombuffer(zlib.decompress(b.as_buffer()), np.uint8))
    for once, twice in zip(rows["once"], rows["twice"], strict=True):
        np.minimum(count + bits(once) + bits(twice), 2, out=count)
    return pa.table({"slice": rows["slice"].slice(0, 1), "twice": pa.array([_dense(count)[1]])})


def repeated_cells(rows: DataFrame, keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]], *, width: int, depth: int = 2) -> Broadcast:
    """Broadcast of `depth` bitmaps of the cells that count two keys or more over all rows.

    Each task counts its partition, and hands on the cells it has met, by slice. Slices are merged in
    two steps on the executors. The driver gets the final bitmaps alone, depth * width / 8 bytes
    whatever the input.
    """
    small_batches(rows.sparkSession)
    slices = -(-width // SLICE)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lot = TaskContext.get().partitionId() // FAN_IN
        held: list[list[np.ndarray]] = [[] for _ in range(depth)]

        def hand_on() -> Iterator[pa.RecordBatch]:
            for d in range(depth):
                at, n = np.unique(np.concatenate(held[d]), return_counts=True)
                held[d].clear()
                cuts = np.searchsorted(at, np.arange(slices + 1) * SLICE)
                full = [s for s in range(slices) if cuts[s] < cuts[s + 1]]
                parts = [_sparse(at[cuts[s] : cuts[s + 1]] - s * SLICE, n[cuts[s] : cuts[s + 1]] > 1) for s in full]
                wide = [len(p) == 4 * int(cuts[s + 1] - cuts[s]) for p, s in zip(parts, full, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([d * slices + s for s in full], pa.int32()), pa.array([lot] * len(full), pa.int32()), pa.array(parts, pa.binary()), pa.array(wide, pa.bool_())], ["slice", "lot", "steps", "wide"])

        total = 0
        for batch in batches:
            for some in keys(batch):
                for d in range(depth):
                    held[d].append(cells(some, d, width).astype(np.uint32))
                total += len(some)
                if total > HELD:
                    yield from hand_on()
                    total = 0
        if total:
            yield from hand_on()

    partial = rows.mapInArrow(count, "slice int, lot int, steps binary, wide boolean").groupBy("slice", "lot").applyInArrow(_merge_sparse, "slice int, lot int, once binary, twice binary")
    final = partial.groupBy("slice").applyInArrow(_merge_dense, "slice int, twice binary")
    bitmaps = np.zeros((depth, slices * SLICE // 8), np.uint8)
    found = final.toArrow()
    for place, bits in zip(found["slice"].to_pylist(), found["twice"], strict=True):
        d, s = divmod(place, slices)
        bitmaps[d, s * SLICE // 8 : (s + 1) * SLICE // 8] = np.frombuffer(zlib.decompress(bits.as_buffer()), np.uint8)
    return rows.sparkSession.sparkContext.broadcast(bitmaps.tobytes())  # as bytes: a worker then holds one copy


def maybe_repeated(bitmaps: bytes, keys: np.ndarray, width: int, depth: int = 2) -> np.ndarray:
    """False only for keys that were counted at most once."""
    rows = np.frombuffer(bitmaps, np.uint8).reshape(depth, -1)
    out = np.ones(len(keys), bool)
    for d in range(depth):
        at = cells(keys, d, width)
        out &= (rows[d][at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return out
