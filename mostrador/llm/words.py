"""Words of many texts as 64-bit hashes, in numpy, for code that runs inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK_BYTES = 1 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)

IS_BLANK = np.zeros(256, bool)
IS_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= _STEP
    x ^= x >> np.uint64(32)
    x *= _STEP
    x ^= x >> np.uint64(32)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _MIX)
LOW_VALUES = BYTE_VALUES.copy()
LOW_VALUES[65:91] = BYTE_VALUES[97:123]


class Chunk(NamedTuple):
    """Consecutive texts: their bytes, where each begins, and the row of the first."""

    data: np.ndarray
    starts: np.ndarray  # one more than there are texts
    row: int


def chunks(texts: pa.Array | pa.ChunkedArray, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a column in pieces of about a MiB, a longer text whole; null is empty."""
    column = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        last = min(last, len(column))
        yield Chunk(raw[at[first] : at[last]], at[first : last + 1] - at[first], first)
        first = last


class Words(NamedTuple):
    hashes: np.ndarray
    starts: np.ndarray  # index of each text's first word, one more than there are texts


def words_of(chunk: Chunk, values: np.ndarray = BYTE_VALUES) -> Words:
    """Hashes of the maximal runs of bytes that are not ASCII blanks, text by text."""
    n = len(chunk.data)
    if not n:
        return Words(np.zeros(0, np.uint64), np.zeros(len(chunk.starts), np.int64))
    inside = ~IS_BLANK[chunk.data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = chunk.starts[:-1][chunk.starts[:-1] < n]
    begins[heads] = inside[heads]
    at = np.flatnonzero(begins)
    if not len(at):
        return Words(np.zeros(0, np.uint64), np.zeros(len(chunk.starts), np.int64))
    spots = np.flatnonzero(inside)
    word = np.cumsum(begins[spots]) - 1
    place = spots - at[word]
    powers = np.full(int(place.max()) + 1, _STEP, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    first = np.searchsorted(spots, at)
    sums = np.add.reduceat(values[chunk.data[spots]] * powers[place], first)
    return Words(mix(sums), np.searchsorted(at, chunk.starts))


def follow(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every window of so many words, across the whole array."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for i in range(1, size):
        out = mix(out * _MIX + hashes[i : i + n])
    return out


BLOCK = 1 << 12


def total_counts(df: DataFrame, count: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    """The sum over all batches of an array of ``size`` counts, a multiple of ``BLOCK``.

    Each task adds up its own rows and hands on its sums in blocks, so what is shuffled does
    not depend on the length of the texts, and the driver gets one row per block.
    """
    schema = "block int, counts binary"

    def as_batch(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        keys = sorted(total)
        sums = pa.array([total[k].tobytes() for k in keys], pa.binary())
        return pa.record_batch([pa.array(keys, pa.int32()), sums], ["block", "counts"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += count(batch)
        blocks = total.reshape(-1, BLOCK)
        yield as_batch({i: b for i, b in enumerate(blocks) if b.any()})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                seen = np.frombuffer(counts, np.int64)
                total[block] = total[block] + seen if block in total else seen
        yield as_batch(total)

    out = np.zeros((size // BLOCK, BLOCK), np.int64)
    blocks = df.mapInArrow(counted, schema).repartition("block").mapInArrow(added, schema)
    for row in blocks.collect():
        out[row.block] += np.frombuffer(row.counts, np.int64)
    return out.reshape(-1)
