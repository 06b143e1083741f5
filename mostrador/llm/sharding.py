"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

The rows are numbered by their order; a keyed permutation of 0 .. n - 1 gives each row its
place in the shuffled order, from which shard and slot follow. The permutation can be
computed, and inverted, for a single row without looking at any other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.llm.common import Scratch, free_name, without

ROUNDS = 6
SEED = 20_240_601
_KEYS = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xBF58476D1CE4E5B9)


def _half_bits(n: int) -> int:
    """Half the width of the smallest even-width block that holds n numbers."""
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def _mixed(x: np.ndarray, key: np.uint64, bits: int) -> np.ndarray:
    x = (x ^ key) * _STEP
    x ^= x >> np.uint64(31)
    x *= _KEYS
    return (x ^ (x >> np.uint64(29))) & np.uint64((1 << bits) - 1)


def _round_keys(seed: int) -> list[np.uint64]:
    with np.errstate(over="ignore"):
        return [np.uint64(seed & (2**64 - 1)) * _STEP + np.uint64(i + 1) * _KEYS for i in range(ROUNDS)]


def _network(x: np.ndarray, bits: int, keys: list[np.uint64]) -> np.ndarray:
    low = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & low
    for key in keys:
        left, right = right, left ^ _mixed(right, key, bits)
    return (left << np.uint64(bits)) | right


def _back(x: np.ndarray, bits: int, keys: list[np.uint64]) -> np.ndarray:
    low = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & low
    for key in reversed(keys):
        left, right = right ^ _mixed(left, key, bits), left
    return (left << np.uint64(bits)) | right


def _walk(rows: np.ndarray, n: int, seed: int, step) -> np.ndarray:
    """The network, repeated for the numbers that it puts outside 0 .. n - 1."""
    bits, keys = _half_bits(n), _round_keys(seed)
    out = step(np.asarray(rows).astype(np.uint64), bits, keys)
    outside = out >= np.uint64(n)
    while outside.any():
        out[outside] = step(out[outside], bits, keys)
        outside = out >= np.uint64(n)
    return out.astype(np.int64)


def permuted(rows: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """Where the permutation puts row numbers."""
    return _walk(rows, n, seed, _network)


def original(places: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """The row numbers that the permutation put at places."""
    return _walk(places, n, seed, _back)


def row_at(shard: int, slot: int, shards: int, n: int, seed: int = SEED) -> int:
    """The row number that lies in a slot of a shard."""
    return int(original(np.array([slot * shards + shard]), n, seed)[0])


def numbered(df: DataFrame, order: list[Column], name: str, scratch: Scratch) -> tuple[DataFrame, int]:
    """The rows with their place, from 0, in a total order, and their number.

    The rows are range-partitioned and sorted, equal ones dealt out at random since any of
    them may come first, and written; the counts of the parts then give the offsets. Only one
    number per part reaches the driver.
    """
    part, place = free_name(df, "part"), free_name(df, "place")
    count = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    keys = [*order, F.rand(SEED)]
    dealt = df.repartitionByRange(count, *keys).sortWithinPartitions(*order)
    ranged = dealt.withColumns(
        {part: F.shiftright(at, 33).cast("int"), place: at.bitwiseAND(F.lit((1 << 33) - 1))}
    )
    written = scratch.stored(ranged, "ranged")
    sizes = {r[0]: r[1] for r in written.groupBy(part).count().collect()}
    before = [0]
    for i in range(max(sizes, default=-1) + 1):
        before.append(before[-1] + sizes.get(i, 0))
    offsets = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    out = written.withColumn(name, F.get(offsets, F.col(part)) + F.col(place))
    return out.drop(part, place), int(before[-1])


def shard(docs: DataFrame, order: list[Column], shards: int, seed: int = SEED) -> DataFrame:
    """The rows with ``row_number``, ``shard`` and ``slot``: shard sizes differ by one at most.

    ``order`` must tell rows apart that are to keep their places in a rerun; rows equal in it
    are interchangeable and share out their places among them. Null keys come first. Further
    columns stay, those named like a result are replaced; an empty table gives an empty one.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    plain = without(docs, "row_number", "shard", "slot")
    rows, n = numbered(plain, order, "row_number", Scratch(docs.sparkSession))

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), n, seed))

    at = free_name(rows, "place")
    out = rows.withColumn(at, place("row_number"))
    slot = F.expr(f"`{at}` div {int(shards)}").cast("long")
    return out.withColumns(
        {"shard": F.pmod(F.col(at), F.lit(shards)).cast("int"), "slot": slot}
    ).drop(at)


def write_shards(sharded: DataFrame, folder: str) -> None:
    """A folder per shard, its rows in the order of their slots."""
    sharded.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
