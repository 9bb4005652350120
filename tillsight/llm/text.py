"""Whole texts as flat byte arrays inside an Arrow task.

A block is a run of rows whose texts together stay near `BLOCK_BYTES`, so a task's memory does not
depend on how many rows Spark puts in a batch; one longer text is a block of its own.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

BLOCK_BYTES = 4 << 20

# ASCII white space, as bytes.split() and `[\x20\x09-\x0D]` have it.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def blocks(column, budget: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of each block; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0:
        return
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=kind)[column.offset : column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + budget, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster where executors have no such folder the package is sent with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """mapInArrow with this package on the workers' path."""
    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def free_names(taken: list[str], count: int) -> list[str]:
    """Names for columns of one's own, none of which is taken in any case of letters."""
    known = {name.lower() for name in taken}
    found, k = [], 0
    while len(found) < count:
        if f"own_{k}" not in known:
            found.append(f"own_{k}")
        k += 1
    return found


def slices(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow array of the byte strings that tile `data`."""
    kind = pa.binary() if offsets[-1] < 2**31 - 1 else pa.large_binary()
    width = np.int32 if kind == pa.binary() else np.int64
    return pa.Array.from_buffers(
        kind,
        len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=width)), pa.py_buffer(data)],
    )


def tiles(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow binary array without nulls."""
    wide = pa.types.is_large_binary(array.type)
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = array.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(
    buf: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE
) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of a block: their bytes, their first byte's place, and each row's range of words."""
    inside = ~separator[buf]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(buf)]
    before[firsts] = False  # a row starts a word of its own
    starts = np.flatnonzero(inside & ~before)
    bounds = np.searchsorted(starts, offsets)
    if len(starts) == 0:
        return pa.array([], pa.binary()), starts, bounds
    kept = buf[inside]
    rank = np.cumsum(inside)
    tile = np.append(rank[starts] - 1, len(kept))
    return slices(kept, tile), starts, bounds


def coded(array: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes and dictionary of an Arrow array without nulls."""
    if len(array) == 0:
        return np.zeros(0, np.int64), array
    found = array.dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def total(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of `values` over each row's range."""
    running = np.concatenate([[0], np.cumsum(values)])
    return running[bounds[1:]] - running[bounds[:-1]]


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, … as many as counts[0], then those of the next."""
    ends = np.cumsum(counts)
    if len(ends) == 0:
        return np.zeros(0, dtype=np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - counts), counts)
