"""Collocations against a plain count, reference SQL and odd inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from checks.compare import compare, reference
from mostrador.llm import phrases
from mostrador.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL


def plain(rows, least, most, percent, best):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            word = [w for w in re.split("[ \t]", piece) if w]
            n[lang] += len(word)
            for k in range(1, most + 1):
                f[lang].update(tuple(word[i : i + k]) for i in range(len(word) - k + 1))
    out = []
    for lang, count in f.items():
        usual = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in usual.items():
            inside = any(
                100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in usual.items() if len(q) > len(p)
            )
            if not inside:
                cuts = [(1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def test_query_against_sql(spark):
    name = "op13_collocations"
    verdict = compare(spark, reference(SMALL), SMALL, QUERIES[name], ORACLES[name])
    assert verdict.startswith("equal"), verdict


def test_against_plain_counts(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("lang", "text").limit(60)
    rows = [tuple(r) for r in docs.collect()]
    for least, most, percent, best in ((4, 5, 100, 2_000), (3, 3, 60, 20), (5, 2, 100, 7), (2, 6, 80, 500)):
        out = phrases.collocations(spark.createDataFrame(rows, docs.schema), least, most, percent, best)
        assert sorted(map(tuple, out.collect())) == plain(rows, least, most, percent, best)


def test_crowded_bitmap_changes_nothing(spark, monkeypatch):
    """A bitmap in which every bit is set lets everything through and gives the same rows."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("lang", "text").limit(30)
    rows = [tuple(r) for r in docs.collect()]
    monkeypatch.setattr(phrases, "reaching", lambda *given: b"\xff" * (1 << (phrases.BITS - 3)))
    out = phrases.collocations(spark.createDataFrame(rows, docs.schema), 3, 4)
    assert sorted(map(tuple, out.collect())) == plain(rows, 3, 4, 100, 2_000)


def test_small_holdings_change_nothing(spark, monkeypatch):
    """Tasks that hand on their sums and stripes again and again give the same rows."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("lang", "text").limit(40)
    rows = [tuple(r) for r in docs.collect()]
    for name, value in (("SUMS_HELD", 64), ("SLOTS_HELD", 16), ("CHUNK_BYTES", 2000)):
        monkeypatch.setattr(phrases, name, value)
    out = phrases.collocations(spark.createDataFrame(rows, docs.schema), 3, 4)
    assert sorted(map(tuple, out.collect())) == plain(rows, 3, 4, 100, 2_000)


def test_blocks_keep_their_sums():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << phrases.HASH_BITS, 5_000))
    sums = rng.integers(1, 1 << 31, len(keys))
    got = {}
    for block, hashes, counts in zip(*[c.to_pylist() for c in phrases.blocks_of(keys, sums).columns]):
        low = np.cumsum(phrases._from_planes(hashes))
        high = block << (phrases.HASH_BITS - phrases.BLOCK_BITS)
        got |= dict(zip((low | high).tolist(), phrases._from_planes(counts).tolist()))
    assert got == dict(zip(keys.tolist(), sums.tolist()))
    assert phrases.blocks_of(keys[:0], sums[:0]).num_rows == 0


def test_bitmap_holds_what_reaches_the_count(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("text", "lang", F.lit(7).cast("long").alias("seed"))
    bits = np.frombuffer(phrases.reaching(docs, 20, 5, None), np.uint8)
    count = Counter()
    for r in docs.collect():
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            word = [w for w in re.split("[ \t]", piece) if w]
            count.update(zip(word, word[1:]))
    usual = [pair for pair, n in count.items() if n >= 20]
    hashes = [phrases.word_hashes(pa.array(pair)) for pair in usual]
    seeds = np.full(2, 7, np.int64)
    assert all(phrases.is_set(bits, phrases.phrase_hashes(h, seeds, 2)).all() for h in hashes)
    assert len(usual) * 0.9 < np.unpackbits(bits).sum() <= len(usual)


def test_sums_past_64_bits(spark):
    rows = spark.createDataFrame([(9_000_000_000_000, 8_000_000_000_000_000, 9_000_000_000_001, 70)], "a long, n long, l long, r long")
    got = rows.select(phrases.floor_ratio(*[F.col(c) for c in "anlr"])).first()[0]
    assert got == 1000 * 9_000_000_000_000 * 8_000_000_000_000_000 // (9_000_000_000_001 * 70)


def test_odd_rows(spark):
    texts = [None, "", " \t", ".,;", "A b\tc", "a b c. a b\x0bc a!b", "ñ😀 a b c " * 50, "x" * 50_000, "long text here " * 20_000, "a  b"]
    rows = [(lang, t, 1, "r") for t in texts for lang in ("de", None, "und", "")] * 2
    docs = spark.createDataFrame(rows, "lang string, text string, seed int, rank string")
    got = sorted(map(tuple, phrases.collocations(docs, 3, 4).collect()))
    assert got == plain([(r[0], r[1]) for r in rows], 3, 4, 100, 2_000) and got
    assert phrases.collocations(docs.limit(0)).count() == 0
