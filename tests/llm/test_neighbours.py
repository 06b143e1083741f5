"""Nearest neighbours against brute force, and on odd inputs."""

from __future__ import annotations

import numpy as np
import pytest

from mostrador.llm import neighbours
from mostrador.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def brute(vectors, queries, nearest=10):
    ids, x = np.array([v[0] for v in vectors]), np.array([v[1] for v in vectors], float)
    out = {}
    for own, q in queries:
        far = np.sqrt(((x - np.asarray(q, float)) ** 2).sum(1))
        order = np.lexsort((ids, far))
        out[own] = [(int(ids[i]), float(far[i])) for i in order if ids[i] != own][:nearest]
    return out


def test_query_recall(spark):
    rows = QUERIES["op4_graph_neighbours"](spark, FOLDER).collect()
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    vectors = [(r.vec_id, r.embedding) for r in table]
    want = brute(vectors, [v for v in vectors if v[0] % 100 == 0])
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    exact = {i: np.array(v, float) for i, v in vectors}
    for own, found in got.items():
        assert [(s, v) for v, s in found] == sorted((s, v) for v, s in found)
        assert all(abs(s - np.sqrt(((exact[own] - exact[v]) ** 2).sum())) < 1e-9 for v, s in found)
    recall = np.mean([len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 10 for q in want])
    assert recall >= 0.95


@pytest.mark.parametrize("clusters, spread", [(0, 1.0), (40, 0.3), (400, 0.2)])
def test_recall_on_a_full_shard(clusters, spread):
    """Points without and with clusters, as many as a shard holds, asked near points of it."""
    draw, n, width = np.random.default_rng(5), neighbours.SHARD_ROWS, 64
    x = spread * draw.normal(size=(n, width))
    if clusters:
        x += draw.normal(size=(clusters, width))[draw.integers(0, clusters, n)]
    x = x.astype(np.float32)
    links, entries = neighbours.build(x)
    assert 1 < len(entries) <= neighbours.ENTRIES
    q = x[draw.choice(n, 200, replace=False)] + 0.01 * draw.normal(size=(200, width)).astype(np.float32)
    ids, _ = neighbours.beam_search(x, links, entries, q, neighbours.SEARCH_BEAM)
    want = np.argsort(((x[None] - q[:, None]) ** 2).sum(2), axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(ids, want)]) >= 0.95


def test_recall_over_several_full_shards(spark):
    draw = np.random.default_rng(6)
    n, centres = 2 * neighbours.SHARD_ROWS + 500, draw.normal(size=(60, 16))
    x = centres[draw.integers(0, 60, n)] + 0.2 * draw.normal(size=(n, 16))
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    table = spark.createDataFrame(vectors, "vec_id long, vector array<double>")
    asked = table.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")
    got = {}
    for r in neighbours.nearest_neighbours(table, asked).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(vectors, vectors[::100])
    assert set(got) == set(want)
    assert np.mean([len(got[q] & {v for v, _ in want[q]}) / 10 for q in want]) >= 0.95


def test_shards_and_common_vectors(spark):
    draw = np.random.default_rng(4)
    vectors = [(i, draw.normal(size=8).round(3).tolist()) for i in range(400)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(300)] + [vectors[5], vectors[5]]
    table = spark.createDataFrame(vectors, "vec_id long, vector array<double>")
    asked = table.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "query_id")
    found = neighbours.nearest_neighbours(table, asked, shard_rows=90).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = brute(sorted({(i, tuple(v)) for i, v in vectors}), [v for v in vectors if v[0] % 100 == 0])
    assert {q: [v for v, _ in rows] for q, rows in want.items()} == got


def test_odd(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, None), (100, [0.0, 0.0]), (200, [1.0, None]), (300, [1.0, inf]), (400, [nan, 1.0]), (500, []), (600, [1.0, 2.0]),
            (700, [1.0, 3.0]), (800, [1.0, 2.0, 3.0]), (None, [1.0, 2.0]), (600, [1.0, 2.0]), (1, [1.0, 2.5])]
    table = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    asked = table.withColumnRenamed("vec_id", "query_id")
    found = sorted(map(tuple, neighbours.nearest_neighbours(table, asked).collect()))
    assert found == [(1, 1, 600, 0.5), (1, 2, 700, 0.5), (600, 1, 1, 0.5), (600, 2, 700, 1.0), (700, 1, 1, 0.5), (700, 2, 600, 1.0)]
    assert neighbours.nearest_neighbours(table.limit(0), asked).count() == 0
    assert neighbours.nearest_neighbours(table, asked.limit(0)).count() == 0


def test_repeated_rows_take_up_no_places(spark):
    rows = [(i, [1.0, 2.0]) for i in (1, 2) for _ in range(12)] + [(i, [1.0, 2.0]) for i in range(3, 21)]
    table = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    asked = table.where("vec_id = 1").withColumnRenamed("vec_id", "query_id")
    found = sorted(map(tuple, neighbours.nearest_neighbours(table, asked).collect()))
    assert found == [(1, place, place + 1, 0.0) for place in range(1, 11)]
