"""Periodic runs against brute force, reference SQL and odd inputs."""

from __future__ import annotations

import random

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from checks.compare import compare, reference
from mostrador.llm import runs
from mostrador.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL


def plain_runs(word) -> list[tuple[int, int, int]]:
    found, n = {}, len(word)
    for period in range(1, n // 2 + 1):
        i = 0
        while i + period < n:
            j = i
            while j + period < n and word[j] == word[j + period]:
                j += 1
            if j - i >= period:
                found.setdefault((i, j - i + period), period)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 4).flatmap(lambda k: st.lists(st.integers(0, k - 1), max_size=60)))
def test_all_runs(word):
    assert runs.runs_of(word) == plain_runs(word)


def texts(seed: int):
    rng = random.Random(seed)
    for _ in range(300):
        n = rng.randint(0, 150)
        word = [f"w{rng.randrange(rng.choice([2, 3, 40]))}" for _ in range(n)]
        for _ in range(rng.randint(0, 2)):
            if word:
                a = rng.randrange(n)
                b, p = rng.randint(a, n), rng.randint(1, max(1, (n - a) // 3))
                word = [word[a + (i - a) % p] if a <= i < b else word[i] for i in range(n)]
        yield word


def test_candidates_lose_no_run():
    for least in (2, 3, 12, 13):
        words = list(texts(least))
        _, found, collapsed = runs.measured(pa.array([" ".join(w) for w in words]), least)
        for word, got, left in zip(words, found.to_pylist(), collapsed.to_pylist(), strict=True):
            want = [r for r in plain_runs(word) if r[1] >= least]
            assert [tuple(r.values()) for r in got] == want
            gone = {i for s, n, q in want for i in range(s + q, s + n)}
            assert left == " ".join(w for i, w in enumerate(word) if i not in gone)


def test_query_against_sql(spark):
    name = "op12_periodic_runs"
    verdict = compare(spark, reference(SMALL), SMALL, QUERIES[name], ORACLES[name])
    assert verdict.startswith("equal"), verdict


def test_odd_rows(spark):
    long = "eins zwei drei " * 30_000
    given = [None, "", " \n\t", "a", "a " * 11, "a\x0b" * 12, "ñ😀 x\n" * 9, "A a " * 6, "z" * 100_000, long, long]
    rows = [(i, t, 5, "r", "c") for i, t in enumerate(given)] + [(None, "b " * 20, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, runs string, collapsed string")
    out = runs.periodic_runs(docs)
    assert out.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    found = {r.doc_id: r for r in out.collect()}
    assert len(found) == len(rows)
    assert [found[i].n_words for i in range(6)] == [0, 0, 0, 1, 11, 12]
    assert [found[i].collapsed for i in range(5)] == ["", "", "", "a", "a " * 10 + "a"]
    assert found[5].collapsed == "a" and found[7].collapsed == "A a" and found[6].collapsed == "ñ😀 x"
    assert [tuple(r) for r in found[9].runs] == [(0, 90_000, 3)] and found[9].collapsed == found[10].collapsed
    assert [tuple(r) for r in found[None].runs] == [(0, 20, 1)]
    assert runs.periodic_runs(docs.limit(0)).count() == 0
