"""Fitted models word by word: the quality ratio and the language vote, on whole tables."""

from __future__ import annotations

import math
from collections import Counter

import pytest

from checks.compare import compare, reference
from mostrador.llm import language, quality
from mostrador.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL

WIDE = (1 << 64) - 1
GOLDEN, STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def mixed(x: int) -> int:
    x &= WIDE
    for _ in range(2):
        x = ((x ^ (x >> 32)) * STEP) & WIDE
    return x ^ (x >> 32)


def word_hash(word: bytes) -> int:
    return mixed(sum(mixed((b + 1) * GOLDEN) * pow(STEP, i, WIDE + 1) for i, b in enumerate(word)))


def gram_bins(text: str | None) -> list[int]:
    hashes = [word_hash(w) for w in (text or "").encode().split()]
    pairs = [mixed(a * GOLDEN + b) for a, b in zip(hashes, hashes[1:])]
    return [(h >> 48) % quality.BINS for h in hashes + pairs]


def test_quality_ratio_of_every_document(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    good = {r.doc_id for r in labels if r.quality == 1 and not r.toxic}
    bins = {r.doc_id: gram_bins(r.text) for r in docs}
    raw = Counter(b for own in bins.values() for b in own)
    target = Counter(b for i, own in bins.items() if i in good for b in own)
    share = sum(target.values()) / sum(raw.values())
    prior = quality.PRIOR
    got = {r.doc_id: r for r in QUERIES["op5_quality_rules"](spark, SMALL).collect()}
    assert set(got) == set(bins)
    for i, own in bins.items():
        logs = [math.log((target[b] + prior * share) / (raw[b] + prior) / share) for b in own]
        ratio = sum(logs) / len(logs) if logs else 0.0
        assert got[i].ratio == pytest.approx(ratio, abs=1e-9)
        if abs(ratio - quality.LEAST_RATIO) > 1e-9:
            assert got[i].kept == (not got[i].base_failed and ratio >= quality.LEAST_RATIO)
    assert {r.kept for r in got.values()} == {True, False}


def shares(text: str) -> dict[int, float]:
    data = [b if 97 <= b < 123 or b >= 128 else 32 for b in text.lower().encode()]
    code = [(a << 16) | (b << 8) | c for a, b, c in zip(data, data[1:], data[2:]) if b != 32]
    counts = Counter((c * 2654435761 % (1 << 32)) >> 19 for c in code)
    return {b: math.sqrt(n / len(code)) for b, n in counts.items()}


def winner(names: list[str], machines, margin) -> str:
    votes = {name: 0.0 for name in names}
    for m in machines:
        far = margin(m)
        votes[m.first if far >= 0 else m.second] += 1
        votes[m.first] += math.tanh(far) / (2 * len(names) + 1)
        votes[m.second] -= math.tanh(far) / (2 * len(names) + 1)
    return max(names, key=lambda name: (votes[name], -names.index(name)))


def test_language_vote_of_every_document(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    model = language.learn(docs)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in language.identify(docs, model).collect():
        found = shares(texts[r.doc_id])
        margin = lambda m: float(m.weights[-1]) + sum(float(m.weights[b]) * s for b, s in found.items())
        family = winner(sorted(model.families), model.between, margin)
        assert r.lang_pred == winner(model.families[family], model.within[family], margin)
    assert len({r.lang_pred for r in language.identify(docs, model).collect()}) > 2


def test_shards_against_sql(spark):
    """The permutation stated again, with wide arithmetic, in SQL."""
    name = "op6_shuffle_shards"
    verdict = compare(spark, reference(SMALL), SMALL, QUERIES[name], ORACLES[name])
    assert verdict.startswith("equal"), verdict
