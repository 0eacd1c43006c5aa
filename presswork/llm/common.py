"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZERS = os.path.dirname(public_tokenizers.path(""))
SLICE_BYTES = 4 << 20
LATIN = "ɐ"  # below: letters on which all pattern libraries agree


_kept: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]):
    """What a worker keeps from task to task: one thing, that of the stage it works for."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Free what the worker keeps of an earlier stage."""
    _kept.clear()
    pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``docs`` has no column of that name."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def fit_rate(seen: int, most: int) -> float:
    """Share of ``seen`` rows that a sample of about ``most`` takes."""
    return 1.0 if seen <= most else most / seen


def strings(column: pa.Array) -> list[str]:
    """Texts of an Arrow column, null as the empty text."""
    return [x or "" for x in column.to_pylist()]


def byte_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text each, one row at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(sizes):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop
        start = stop


def byte_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow text column and the offsets of its rows; null is empty."""
    import pyarrow.compute as pc

    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    bytes_ = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first, last = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    return bytes_[first:last], offsets - first


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


def expand(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices ``starts[i] .. starts[i] + counts[i] - 1`` of all i, one after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)


def byte_of_letter() -> dict[str, int]:
    """The letter by which a byte-level vocabulary spells each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
