"""Whether two results, or two copies of a dataset, hold the same rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.session import scratch_folder, shuffles_freed

BUCKETS = 4096


def weighed_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every distinct row with how often each side holds it. Columns pair up by name.

    Both sides go through one shuffle, whereas subtracting in each direction would run
    every input twice. Equal rows fold before that shuffle.
    """
    sides = left.withColumn("on_left", F.lit(1)).unionByName(right.withColumn("on_left", F.lit(0)))
    return sides.groupBy(*left.columns).agg(
        F.sum("on_left").alias("left_rows"), F.sum(1 - F.col("on_left")).alias("right_rows")
    )


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side holds more often, with ``surplus``: above zero on the left."""
    surplus = F.col("left_rows") - F.col("right_rows")
    weighed = weighed_rows(left, right).withColumn("surplus", surplus)
    return weighed.where(F.col("surplus") != 0).drop("left_rows", "right_rows")


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: the rows of each side, and how many only that side has."""
    sides = {"izquierda": ("left_rows", "right_rows"), "derecha": ("right_rows", "left_rows")}
    zero = F.lit(0).cast("long")
    totals = [
        F.coalesce(F.sum(own), zero).alias(f"filas_{side}") for side, (own, _) in sides.items()
    ] + [
        F.coalesce(F.sum(F.greatest(F.col(own) - F.col(other), zero)), zero).alias(f"solo_{side}")
        for side, (own, other) in sides.items()
    ]
    return weighed_rows(left, right).agg(*totals)


def reconcile_apart(left: DataFrame, right: DataFrame) -> DataFrame:
    """What reconcile() gives, for sides that shuffle far more than they return.

    Each side is run on its own and its rows are stored; what it shuffled is deleted before
    the next one runs, so the disk never holds the shuffles of both.
    """
    spark = right.sparkSession
    root, sides = scratch_folder(spark), []
    for name, df in (("izquierda", left), ("derecha", right)):
        with shuffles_freed(df.sparkSession):
            # an order is of no use here; rebalanced, the rows are not sorted for it
            df.hint("rebalance").write.parquet(f"{root}/{name}")
        sides.append(spark.read.schema(df.schema).parquet(f"{root}/{name}"))
    return reconcile(*sides)


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of a row. It skips nulls, so every column goes in with a null flag:
    a value in the neighbouring column counts as different."""
    return F.xxhash64(*[x for c in df.columns for x in (F.isnull(f"`{c}`"), F.col(f"`{c}`"))])


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-free hash sum: equal datasets have equal fingerprints.

    Nothing but the two totals is shuffled, so it suits whole tables. Different data can
    collide, if hardly ever; differences() is exact.
    """
    total = F.sum(row_hash(df).cast("decimal(20,0)"))
    return df.agg(
        F.count(F.lit(1)).alias("filas"),
        F.coalesce(total, F.lit(0).cast("decimal(30,0)")).alias("huella"),
    )


def _in_bucket(df: DataFrame, level: int, buckets: int) -> Column:
    """A row's bucket at a level of the tree: as many digits of its hash, to the base ``buckets``."""
    return F.pmod(row_hash(df), F.lit(buckets**level))


def unequal_buckets(left: DataFrame, right: DataFrame, level: int, buckets: int = BUCKETS) -> DataFrame:
    """Buckets of rows in which the sides differ. A task sends one sum per bucket, no rows."""

    def weighed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(
            _in_bucket(df, level, buckets).alias("bucket"),
            F.lit(sign).alias("rows"),
            (row_hash(df).cast("decimal(20,0)") * sign).alias("sum"),
        )

    both = weighed(left, 1).unionByName(weighed(right.select(left.columns), -1))
    sums = both.groupBy("bucket").agg(F.sum("rows").alias("rows"), F.sum("sum").alias("sum"))
    return sums.where("rows <> 0 OR sum <> 0").select("bucket")


def differing_rows(left: DataFrame, right: DataFrame, levels: int = 2, buckets: int = BUCKETS) -> DataFrame:
    """What differences() finds, for sides of any size that hardly differ.

    Sums of row hashes are compared per bucket, then per bucket of the unequal buckets, and
    so on for ``levels`` levels; only rows of the last unequal buckets are compared, and
    shuffled, themselves. Sides that agree are read but never shuffled. The unequal buckets
    of the first level, at most ``buckets`` numbers, are broadcast; those below are joined
    as Spark sees fit. Columns pair up by name.
    """
    right = right.select(left.columns)
    for level in range(1, levels + 1):
        found = unequal_buckets(left, right, level, buckets)
        wanted = F.broadcast(found) if level == 1 else found
        left, right = (
            df.join(wanted, _in_bucket(df, level, buckets) == wanted["bucket"], "left_semi")
            for df in (left, right)
        )
    return differences(left, right)


def parity_differences(raw: Mapping[str, DataFrame], parquet: Mapping[str, DataFrame]) -> DataFrame:
    """The rows on which the copies of each table differ, as JSON text: tabla, fila, sobra.

    ``sobra`` is how many more of the row the raw side has, below zero if it has fewer. A
    table that only one side knows is compared with an empty one.
    """
    found = []
    for name in dict.fromkeys([*raw, *parquet]):
        left = raw.get(name, parquet.get(name))
        sides = [side[name] if name in side else left.limit(0) for side in (raw, parquet)]
        rows = differing_rows(*sides)
        row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in left.columns]), {"ignoreNullFields": "false"})
        found.append(rows.select(F.lit(name).alias("tabla"), row.alias("fila"), F.col("surplus").alias("sobra")))
    return reduce(DataFrame.unionByName, found)


def parity(raw: Mapping[str, DataFrame], parquet: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows on both sides, and whether the copies agree."""

    def side(tables: Mapping[str, DataFrame], suffix: str) -> DataFrame:
        rows = [
            fingerprint(df).select(
                F.lit(name).alias("tabla"),
                F.col("filas").alias(f"filas_{suffix}"),
                F.col("huella").alias(f"huella_{suffix}"),
            )
            for name, df in tables.items()
        ]
        return reduce(DataFrame.unionByName, rows)

    both = side(raw, "texto").join(side(parquet, "parquet"), "tabla", "full")
    same = F.col("filas_texto").eqNullSafe(F.col("filas_parquet")) & F.col(
        "huella_texto"
    ).eqNullSafe(F.col("huella_parquet"))
    return both.select("tabla", "filas_texto", "filas_parquet", same.alias("coinciden"))
