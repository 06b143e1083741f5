"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

The distinct vectors are dealt into shards. In each, points are inserted into a graph: a
greedy search proposes neighbours, and pruning with a relaxed distance keeps those that lie
in different directions (Subramanya et al., 2019). A query runs a beam search in every shard
and the nearest of all shards are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Over
from pyspark.sql import functions as F

from mostrador.llm.common import Scratch

NEAREST = 10
SHARD_ROWS = 8_192
QUERY_BLOCK = 2_048
DEGREE = 28
BUILD_BEAM = 48
SEARCH_BEAM = 128
RELAXED = (1.0, 1.2)
ENTRIES, STARTS, ROUNDS = 128, 16, 4
INSERTED = 256
AT_ONCE = 4


def square_distances(x: np.ndarray, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of rows of q to the points named in the same row of ids."""
    gap = x[ids] - q[:, None, :]
    return np.einsum("ijk,ijk->ij", gap, gap)


def entry_points(x: np.ndarray, draw: np.random.Generator, most: int = ENTRIES) -> np.ndarray:
    """The points nearest to the means of a few rounds of k-means: where searches start.

    Links lead from one cluster to the next only if the graph happens to have them, so a
    search needs a start near every cluster.
    """
    k = min(most, len(x))
    centres, square = x[draw.choice(len(x), k, replace=False)], (x * x).sum(1)
    for _ in range(ROUNDS):
        apart = square[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(1)
        own = np.argmin(apart, axis=1)
        sums = np.zeros_like(centres, dtype=np.float64)
        np.add.at(sums, own, x)
        counts = np.bincount(own, minlength=k)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres).astype(np.float32)
    apart = square[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(1)
    return np.unique(np.argmin(apart, axis=0))


def beam_search(x: np.ndarray, links: np.ndarray, entries: np.ndarray, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For every query the ``beam`` best points met, nearest first: (ids, squared distances).

    All queries step together, from the entries nearest to each. Each step opens the nearest
    points of a beam that are not open yet, until all are. Missing places have the id -1 and
    an infinite distance.
    """
    n, rows = len(q), np.arange(len(q))[:, None]
    ids = np.full((n, beam), -1, np.int64)
    far = np.full((n, beam), np.inf, np.float32)
    starts = np.broadcast_to(entries, (n, len(entries)))
    apart = square_distances(x, starts, q)
    first = np.argsort(apart, axis=1, kind="stable")[:, : min(STARTS, beam)]
    ids[:, : first.shape[1]] = np.take_along_axis(starts, first, 1)
    far[:, : first.shape[1]] = np.take_along_axis(apart, first, 1)
    opened = ids < 0
    met = np.zeros((n, len(x)), bool)
    met[rows, ids[:, : first.shape[1]]] = True
    live = np.arange(n)
    while len(live):
        rank = np.where(opened[live], np.inf, far[live])
        pick = np.argpartition(rank, AT_ONCE - 1, axis=1)[:, :AT_ONCE]
        usable = np.isfinite(np.take_along_axis(rank, pick, 1))
        going = usable.any(1)
        live, pick, usable = live[going], pick[going], usable[going]
        if not len(live):
            break
        chosen = np.where(usable, ids[live[:, None], pick], -1)
        opened[live[:, None], pick] = True
        new = np.where((chosen >= 0)[:, :, None], links[chosen], -1).reshape(len(live), -1)
        new.sort(axis=1)
        fresh = new >= 0
        fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
        fresh &= ~met[live[:, None], new]
        at, col = np.nonzero(fresh)
        points = new[at, col]
        met[live[at], points] = True
        gap = x[points] - q[live[at]]
        found = np.full(new.shape, np.inf, np.float32)
        found[at, col] = np.einsum("ij,ij->i", gap, gap)
        all_far = np.concatenate([far[live], found], 1)
        all_ids = np.concatenate([ids[live], np.where(fresh, new, -1)], 1)
        all_open = np.concatenate([opened[live], ~fresh], 1)
        best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
        far[live], ids[live] = np.take_along_axis(all_far, best, 1), np.take_along_axis(all_ids, best, 1)
        opened[live] = np.take_along_axis(all_open, best, 1)
    order = np.argsort(far, axis=1, kind="stable")
    return ids[rows, order], far[rows, order]


def robust_prune(x: np.ndarray, points: np.ndarray, ids: np.ndarray, far: np.ndarray, relaxed: float) -> np.ndarray:
    """For every point at most ``DEGREE`` neighbours out of its candidates.

    The nearest candidate is kept and removes those that lie nearer to it, by the factor, than
    to the point; and so on with the rest.
    """
    far = np.where(ids == points[:, None], np.inf, far).astype(np.float32)
    out = np.full((len(points), DEGREE), -1, np.int64)
    near, rows = x[ids], np.arange(len(points))
    for k in range(DEGREE):
        best = np.argmin(far, axis=1)
        some = np.isfinite(far[rows, best])
        if not some.any():
            break
        out[some, k] = ids[rows, best][some]
        gap = near - near[rows, best][:, None, :]
        between = np.einsum("ijk,ijk->ij", gap, gap)
        far[(relaxed * relaxed * between <= far) & some[:, None]] = np.inf
        far[rows, best] = np.inf
    return out


def build(x: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Links of the graph over distinct points, and the points where searches start."""
    n = len(x)
    draw = np.random.default_rng(seed)
    entries = entry_points(x, draw)
    links = draw.integers(0, n, (n, DEGREE)) if n > 1 else np.full((n, DEGREE), -1)
    for relaxed in RELAXED if n > 1 else ():
        order = draw.permutation(n)
        for first in range(0, n, INSERTED):
            points = order[first : first + INSERTED]
            ids, far = beam_search(x, links, entries, x[points], min(BUILD_BEAM, max(n, AT_ONCE)))
            own = links[points]
            old = np.where(own >= 0, square_distances(x, own, x[points]), np.inf)
            ids, far = np.concatenate([ids, own], 1), np.concatenate([far, old], 1)
            again = np.sort(ids, axis=1)
            if (again[:, 1:] == again[:, :-1]).any():
                for i in range(len(ids)):
                    _, place = np.unique(ids[i], return_index=True)
                    twice = np.ones(ids.shape[1], bool)
                    twice[place] = False
                    far[i, twice] = np.inf
            far = np.where(ids < 0, np.inf, far)
            links[points] = robust_prune(x, points, ids, far, relaxed)
            _point_back(x, links, points, relaxed)
    return links, entries


def _point_back(x: np.ndarray, links: np.ndarray, points: np.ndarray, relaxed: float) -> None:
    """Each new neighbour gets the point as its neighbour; full lists are pruned again."""
    source = np.repeat(points, DEGREE)
    target = links[points].reshape(-1)
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    at, first = np.unique(target, return_index=True)
    sizes = np.diff(np.append(first, len(target)))
    wide = np.full((len(at), DEGREE + int(sizes.max(initial=0))), -1, np.int64)
    wide[:, :DEGREE] = links[at]
    row = np.repeat(np.arange(len(at)), sizes)
    wide[row, DEGREE + np.arange(len(target)) - first[row]] = source
    wide.sort(axis=1)
    wide[:, 1:][wide[:, 1:] == wide[:, :-1]] = -1
    few = (wide >= 0).sum(1) <= DEGREE
    plain = -np.sort(-wide[few], axis=1)[:, :DEGREE]
    links[at[few]] = plain
    full = np.flatnonzero(~few)
    for part in range(0, len(full), INSERTED):
        rows = full[part : part + INSERTED]
        far = np.where(wide[rows] >= 0, square_distances(x, wide[rows], x[at[rows]]), np.inf)
        links[at[rows]] = robust_prune(x, at[rows], wide[rows], far, relaxed)


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, not zero, no null and no infinite or undefined component."""
    good = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & good & F.exists(vector, lambda v: v != 0)


def _matrix(column: pd.Series, kind=np.float32) -> np.ndarray:
    return np.stack([np.asarray(v, kind) for v in column]) if len(column) else np.zeros((0, 1), kind)


def build_index(vectors: DataFrame, scratch: Scratch, nearest: int = NEAREST, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """The written index over all rows of (vec_id, vector), and the number of shards.

    Equal vectors are one point, which carries the ``nearest + 1`` smallest ids: no other row
    of it can be among the nearest of any query, whose own row may be one of them. Repeated
    rows are folded first, so that they take up no places. The smallest ids are found by a
    ranking that Spark limits before it shuffles, so a vector that a third of all rows share
    is no hot group. Vectors of other lengths are apart.
    """
    by_vector = Over.partitionBy("vector").orderBy("vec_id")
    once = vectors.where("vec_id IS NOT NULL").select("vector", "vec_id").distinct()
    least = once.withColumn("place", F.row_number().over(by_vector))
    least = least.where(F.col("place") <= nearest + 1)
    points = least.groupBy("vector").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    points = scratch.stored(points.withColumn("size", F.size("vector")), "points")
    shards = max(1, -(-points.count() // shard_rows))
    hashed = F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int")

    def linked(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ids", key=lambda s: s.map(lambda v: v[0]), ignore_index=True)
        links, entries = build(_matrix(rows["vector"]))
        starts = np.isin(np.arange(len(rows)), entries)
        return rows.assign(point=np.arange(len(rows)), links=list(links), entry=starts)

    schema = "vector array<double>, ids array<long>, size int, shard int, point long, links array<long>, entry boolean"
    columns = [c.split()[0] for c in schema.split(", ")]
    graph = points.withColumn("shard", hashed).groupBy("size", "shard")
    graph = graph.applyInPandas(lambda rows: linked(rows)[columns], schema)
    return scratch.stored(graph, "graph"), shards


def search(index: DataFrame, shards: int, queries: DataFrame, scratch: Scratch, nearest: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score) of the nearest rows found, for (query_id, vector).

    Queries meet every shard in blocks: a task holds one shard and one block. What it finds
    is measured again on the original vectors in double precision.
    """
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("size", F.size("vector"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    shown = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def found(points: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(points) and len(wanted):
            points = points.sort_values("point", ignore_index=True)
            exact, q = _matrix(points["vector"], np.float64), _matrix(wanted["vector"], np.float64)
            x, links = exact.astype(np.float32), np.stack(points["links"].to_list())
            beam = max(SEARCH_BEAM, nearest + 1)
            entries = np.flatnonzero(points["entry"])
            for part in range(0, len(q), INSERTED):
                rows = q[part : part + INSERTED]
                ids, _ = beam_search(x, links, entries, rows.astype(np.float32), beam)
                for i, own in enumerate(wanted["query_id"].iloc[part : part + INSERTED]):
                    met = ids[i][ids[i] >= 0]
                    score = np.sqrt(((exact[met] - rows[i]) ** 2).sum(1))
                    best = [(s, v) for s, p in zip(score, met, strict=True) for v in points["ids"].iat[p] if v != own]
                    for s, v in sorted(best)[:nearest]:
                        out["query_id"].append(own)
                        out["vec_id"].append(v)
                        out["score"].append(s)
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    key = ["size", "shard", "block"]
    grouped = shown.groupBy(*key).cogroup(asked.groupBy(*key))
    hits = grouped.applyInPandas(found, "query_id long, vec_id long, score double").distinct()
    place = F.row_number().over(Over.partitionBy("query_id").orderBy("score", "vec_id"))
    ranked = hits.withColumn("rank", place.cast("int")).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, nearest: int = NEAREST, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nearest rows of ``vectors`` (vec_id, vector) to each of ``queries`` (query_id, vector).

    Distance is Euclidean; ties go to the smaller vec_id; a candidate with the query's own id
    is left out. Fewer candidates than ``nearest`` are all returned if the search meets them,
    as it does in a shard no larger than the beam. Unusable vectors take no part on either
    side; rows without an id are no candidates. A repeated row counts once. Empty tables give
    an empty result.
    """
    scratch = Scratch(vectors.sparkSession)
    points = vectors.select("vec_id", F.col("vector").cast("array<double>").alias("vector"))
    asked = queries.select("query_id", F.col("vector").cast("array<double>").alias("vector"))
    asked = scratch.stored(asked.where(usable(F.col("vector")) & F.col("query_id").isNotNull()).distinct(), "queries")
    index, shards = build_index(points.where(usable(F.col("vector"))), scratch, nearest, shard_rows)
    return search(index, shards, asked, scratch, nearest)
