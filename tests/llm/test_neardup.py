"""Near-duplicates and components against plain versions and on odd inputs."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mostrador.llm import neardup
from mostrador.llm import words as W
from mostrador.llm.common import Scratch
from mostrador.llm.components import components
from mostrador.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def joined_sets(items, pairs):
    """Plain union of sets: the smallest member of each item's component."""
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def plain_links(texts):
    """All pairs of different texts whose weighted Jaccard similarity is 0.8 or more."""
    seen, found = defaultdict(int), []
    for text in texts:
        chunk = next(W.chunks(pa.array([text])))
        found.append(W.words_of(chunk, W.LOW_VALUES).hashes)
        for b in set((found[-1] >> np.uint64(48)).tolist()):
            seen[b] += 1
    weights = neardup.word_weights(np.array([seen[b] for b in range(neardup.BINS)]), len(texts))
    sets, holders = [], defaultdict(list)
    for i, hashes in enumerate(found):
        sets.append(neardup.weighted_shingles(hashes, weights))
        for s in sets[-1][0].tolist():
            holders[s].append(i)
    pairs = {(a, b) for rows in holders.values() for a in rows for b in rows if a < b and texts[a] != texts[b]}
    return {p for p in pairs if neardup.similarity(sets[p[0]], sets[p[1]]) >= 0.8}


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    texts = [r.text for r in docs]
    links = plain_links(texts)
    first = {}
    same = [(first.setdefault(t, i), i) for i, t in enumerate(texts)]
    want = joined_sets(range(len(texts)), [*links, *same])
    rows = {r.doc_id: r for r in QUERIES["op1_minhash_neardup"](spark, FOLDER).collect()}
    assert len(rows) == len(docs)
    groups = defaultdict(set)
    for i, root in want.items():
        groups[root].add(docs[i].doc_id)
    for members in groups.values():
        for doc in members:
            assert rows[doc].class_id == min(members)
            assert rows[doc].class_size == len(members)
            assert rows[doc].kept == (doc == min(members))


def test_links_lost(spark):
    """Of all links between different texts, the share that candidates miss."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    texts = [r.text for r in docs.collect()]
    want = {tuple(sorted((texts[a], texts[b]))) for a, b in plain_links(texts)}
    got = neardup.links(docs, Scratch(spark)).count()
    assert got >= 0.97 * len(want)


ODD = [None, "", "  \n", "one two", "One  TWO", "one two three four five six", "ñ" * 30_000, "a b " * 9_000]
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau " * 8


def odd(spark):
    rows = [(i, t, "n", 1) for i, t in enumerate(ODD)]
    rows += [(20, LONG + "end", "n", 1), (21, LONG + "stop now", "n", 1), (None, LONG + "end", "n", 1), (3, "one two", "n", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, node string, place int")


def test_odd(spark):
    docs = odd(spark)
    rows = neardup.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    of = defaultdict(set)
    for r in rows:
        of[r.class_key].add(r.doc_id)
    assert sorted(map(sorted, (c - {None} for c in of.values()))) == [[0, 1], [2], [3, 4], [5], [6], [7], [20, 21]]
    kept = neardup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 5, 6, 7, 20]
    assert neardup.near_duplicates(docs.limit(0)).count() == 0
    assert neardup.deduplicated(docs.limit(0)).count() == 0


def test_samples_agree_as_often_as_texts_are_similar():
    draw = np.random.default_rng(0)
    agreed, similar = [], []
    for _ in range(40):
        one = np.unique(draw.integers(0, 2**63, 800).astype(np.uint64))
        two = np.unique(np.where(draw.random(len(one)) < 0.8, one, draw.integers(0, 2**63, len(one)).astype(np.uint64)))
        sets = [(x, 1 + (x % np.uint64(5)).astype(float)) for x in (one, two)]
        found = neardup.samples(np.concatenate([one, two]), np.log(np.concatenate([s[1] for s in sets])), np.array([0, len(one)]))
        agreed.append((found[:, 0] == found[:, 1]).mean())
        similar.append(neardup.similarity(*sets))
    assert np.mean(agreed) == pytest.approx(np.mean(similar), abs=0.03)


def test_components(spark):
    draw = np.random.default_rng(2)
    pairs = {(int(a), int(b)) for a, b in draw.integers(0, 400, (250, 2)) if a != b}
    pairs |= {(1000 + i, 1001 + i) for i in range(60)} | {(2000, 2001 + i) for i in range(200)}
    links = spark.createDataFrame(sorted(pairs), "a long, b long")
    got = {r.node: r.root for r in components(links, Scratch(spark)).collect()}
    assert got == joined_sets({x for p in pairs for x in p}, pairs)
    assert components(links.limit(0), Scratch(spark)).count() == 0


def test_crowded_buckets(spark):
    """Many texts around one passage: links that no representative of a bucket is part of."""
    draw = np.random.default_rng(4)
    names = [f"w{i}" for i in range(50_000)]
    passage = [str(w) for w in draw.choice(names, 90, replace=False)]
    texts = []
    for i in range(120):
        own = [str(w) for w in draw.choice(names, 30, replace=False)]
        texts.append(" ".join(passage + own))
        if i % 10 == 0:
            texts.append(" ".join(passage + own[:-2] + ["changed", f"end{i}"]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scratch = Scratch(spark)
    found, _ = neardup.linked(docs, scratch)
    want = joined_sets(range(len(texts)), plain_links(texts))
    assert len(set(want.values())) == 120
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()} == want
    unmet = spark.read.parquet(f"{scratch.root}/unmet_pairs").count()
    assert spark.read.parquet(f"{scratch.root}/strangers").count() > 100
    assert unmet < 10 * found.count() + 100


def test_first_shingles_meet():
    """Any two texts of the similarity share a first shingle, whose position allows for it."""
    draw = np.random.default_rng(5)
    counts = draw.integers(0, 50, neardup.SHINGLE_BINS)
    for _ in range(200):
        pool = np.unique(draw.integers(0, 2**63, 60).astype(np.uint64))
        sets = []
        for _ in range(2):
            held = pool[draw.random(len(pool)) < 0.95]
            sets.append((held, 1 + (held % np.uint64(3)).astype(float)))
        if neardup.similarity(*sets) < 0.8:
            continue
        (x, before_x), (y, before_y) = (neardup.first_shingles(*s, counts, 0.8) for s in sets)
        common, i, j = np.intersect1d(x, y, return_indices=True)
        total = sets[0][1].sum(), sets[1][1].sum()
        follows = np.minimum(total[0] - before_x[i], total[1] - before_y[j])
        assert len(common) and (follows >= 0.8 / 1.8 * sum(total) - 1e-6).any()


def test_marks_bound_what_is_common(spark):
    """No pair has more weight in common than the bound says, and most unlike pairs fall below."""
    draw = np.random.default_rng(6)
    rows, sets = [], []
    for i in range(40):
        pool = np.unique(np.random.default_rng(i // 4).integers(0, 2**63, 150 if i < 36 else 5000).astype(np.uint64))
        held = pool[draw.random(len(pool)) < 0.8]
        weights = 1 + (held % np.uint64(7)).astype(float) / 7
        sets.append((held, weights))
        marks = [int(m) for m in neardup.shingle_marks(held)]
        rows.append((i, float(weights.sum()), float(weights.min()), *marks))
    names = ["node", "total", "lightest", *[f"m{i}" for i in range(neardup.MARK_WORDS)]]
    table = spark.createDataFrame(rows, names)
    pairs = table.alias("a").join(table.alias("b"), F.col("a.node") < F.col("b.node"))
    got = pairs.select(F.col("a.node"), F.col("b.node"), neardup.most_common("a", "b")).collect()
    assert len(got) == 40 * 39 // 2
    for a, b, most in got:
        _, i, j = np.intersect1d(sets[a][0], sets[b][0], return_indices=True)
        assert np.minimum(sets[a][1][i], sets[b][1][j]).sum() <= most + 1e-9
    total = [s[1].sum() for s in sets]
    unlike = [most < 0.8 / 1.8 * (total[a] + total[b]) for a, b, most in got if a // 4 != b // 4 and b < 36]
    assert np.mean(unlike) > 0.99
