"""Joining dimensions to totals, rolling up, and taking the top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mostrador.sources.star import fold, settle


def roll_up(totals: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Totals of a finer grouping summed to a coarser one, settled."""
    rolled = totals.groupBy(*keys).agg(*[fold(totals, name) for name in measures])
    return settle(rolled, measures)


def top(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows. ``order`` must end in a key that breaks ties."""
    return df.orderBy(*order).limit(k)


def top_per_group(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank_name: str,
    ties_share_a_rank: bool = False,
) -> DataFrame:
    """Rows ranked within their group, those past rank ``k`` left out.

    With shared ranks a group can keep more than ``k`` rows. Spark limits each group
    before the shuffle as well as after it. All rows that tie go to one task, so ranks
    are shared over totals; over raw rows use rank_values().
    """
    ranking = F.rank() if ties_share_a_rank else F.row_number()
    ranked = df.withColumn(rank_name, ranking.over(Window.partitionBy(*groups).orderBy(*order)))
    return ranked.where(F.col(rank_name) <= k)


def rank_values(
    df: DataFrame, groups: Sequence[str], value: str, k: int, rank_name: str, rows_name: str
) -> DataFrame:
    """The values of each group whose rows rank up to ``k``, highest value first.

    Tied rows share a rank, as RANK() over the rows would give it, and are counted in one
    row instead of listed. Rows fold before the shuffle, so neither a hot group nor a
    value held by most of its rows reaches a single task whole. A group has at most ``k``
    such values, which bounds the running count.
    """
    counted = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias(rows_name))
    first = top_per_group(counted, groups, [F.desc(value)], k, rank_name)
    before = Window.partitionBy(*groups).orderBy(F.desc(value)).rowsBetween(
        Window.unboundedPreceding, -1
    )
    rank = (F.coalesce(F.sum(rows_name).over(before), F.lit(0)) + 1).cast("int")
    return first.withColumn(rank_name, rank).where(F.col(rank_name) <= k)
