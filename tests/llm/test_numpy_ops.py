"""Mixing, quality, sharding, language and packing against plain versions and odd inputs."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks.compare import compare, reference
from mostrador.llm import language, mixing, packing, quality, sharding, words
from mostrador.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL

ODD = [None, "", " \n\t", "a", "eins zwei\neins zwei\n\nx# $y", "the word " * 400, "ñü😀\x85z " * 30, "12 34", "a" * 40_000]
ROWS = [(i, t, "src" if i % 2 else None, "en" if i < 6 else None, 5) for i, t in enumerate(ODD)]
ROWS += [(1, "", "src", "en", 5), (None, "the word", "z", None, 5), (None, "the word", "z", None, 5)]
SCHEMA = "doc_id long, text string, source string, lang string, size int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").collect()


def plain_words(text):
    return (text or "").encode().split()


# --- mixing ---------------------------------------------------------------------------


def test_mix_against_sql(spark):
    verdict = compare(spark, reference(SMALL), SMALL, QUERIES["op3_mix_sources"], ORACLES["op3_mix_sources"])
    assert verdict.startswith("equal"), verdict


def test_mix_hits_targets(spark):
    rows = QUERIES["op3_mix_sources"](spark, "/root/testdata/sf0.01").collect()
    taken, target, longest = Counter(), {}, Counter()
    for r in rows:
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source_size] += r.taken
        target[r.source_size] = r.target
        longest[r.source_size] = max(longest[r.source_size], r.size)
    for key, words_taken in taken.items():
        assert abs(words_taken - target[key]) <= longest[key]


def test_mix_odd(spark, odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ROWS)
    assert all(r.turns == 0 for r in rows if r.size == 0)
    assert {r.size for r in rows if r.text == "the word " * 400} == {800}
    assert mixing.mix(odd.limit(0)).count() == 0
    assert mixing.mixed(odd).columns == odd.columns
    ordered = [r.finish for r in mixing.in_order(odd).collect()]
    assert ordered == sorted(ordered)


@pytest.mark.parametrize("names", [1, 3, 40_000])
def test_mix_is_cut_inside_any_number_of_ties(spark, tmp_path, names):
    """Sources of one word each share one finish time; the cut among them equals the SQL's."""
    rows = spark.range(names * 2 if names > 3 else 900).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 7 != 3, "eins").otherwise("eins zwei").alias("text"),
        F.concat(F.lit("s"), F.col("id") % names if names <= 3 else F.col("id")).alias("source"),
    )
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    verdict = compare(spark, connection, str(tmp_path), QUERIES["op3_mix_sources"], ORACLES["op3_mix_sources"])
    assert verdict.startswith("equal"), verdict


def test_mix_spends_its_budget_on_equal_sources(spark):
    docs = spark.range(90_000).select(F.col("id").alias("doc_id"), F.lit("wort").alias("text"), F.col("id").cast("string").alias("source"))
    got = mixing.mix(docs).agg(F.sum(F.col("size") * F.col("turns")).alias("taken"), F.min("turns"), F.max("turns")).first()
    assert tuple(got) == (135_000, 0, 2)


# --- quality --------------------------------------------------------------------------


def plain_base(text):
    found = plain_words(text)
    windows = Counter(zip(found, found[1:], found[2:], strict=False))
    covered = {i + k for i in range(len(found) - 2) for k in range(3) if windows[tuple(found[i : i + 3])] > 1}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            again += line in seen
            seen.add(line)
    n = len(found)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    chars = sum(len(w.decode()) for w in found)
    return n, chars, symbols, again, len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_quality_query(spark, given):
    rows = QUERIES["op5_quality_rules"](spark, SMALL).collect()
    want = {r.doc_id: plain_base(r.text) for r in given}
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want[r.doc_id]
    assert len(rows) == len(given)


def test_quality_separates(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic = 0")
    rows = QUERIES["op5_quality_rules"](spark, folder).where("NOT base_failed").join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.2


def test_ratio_against_plain(spark):
    texts = ["a b c", "a b", "z z z"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.ratio for r in quality.judge(docs, labels).collect()}
    raw, target, of = Counter(), Counter(), {}
    for i, text in enumerate(texts):
        for chunk in words.chunks(pa.array([text])):
            found = words.words_of(chunk)
            of[i] = quality.grams(found.hashes, found.starts)[0].tolist()
        raw.update(of[i])
        target.update(of[i] if i == 0 else [])
    share = target.total() / raw.total()
    weight = {b: np.log((target[b] + 20 * share) / (raw[b] + 20) / share) for b in raw}
    for i, bins in of.items():
        assert got[i] == pytest.approx(np.mean([weight[b] for b in bins]))


def test_quality_odd(spark, odd):
    labels = spark.createDataFrame([(None, 1, 0), (4, 1, None), (4, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.judge(odd, labels).collect()
    assert len(rows) == len(ROWS) and all(r.size == 5 for r in rows)
    assert sorted(map(str, ((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows))) == sorted(
        map(str, (plain_base(r[1]) for r in ROWS))
    )
    assert quality.judge(odd.limit(0), labels).count() == 0
    assert quality.judge(odd, labels.limit(0)).where("ratio <> 0").count() == 0


# --- sharding -------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000])
def test_permutation(n):
    places = sharding.permuted(np.arange(n), n)
    assert sorted(places) == list(range(n))
    assert sharding.original(places, n).tolist() == list(range(n))
    assert sharding.row_at(int(places[n // 2]) % 4, int(places[n // 2]) // 4, 4, n) == n // 2


def test_shard_query(spark, given):
    rows = QUERIES["op6_shuffle_shards"](spark, SMALL).collect()
    again = QUERIES["op6_shuffle_shards"](spark, SMALL).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    texts = {r.doc_id: (r.text or "").encode() for r in given}
    slots = defaultdict(list)
    order = sorted((r.doc_id, r.size) for r in rows)
    for r in rows:
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]))
        place = int(sharding.permuted(np.array([r.row_number]), len(rows))[0])
        assert (r.shard, r.slot) == (place % 24, place // 24)
        assert order[r.row_number][0] == r.doc_id
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[i]) for i in range(24)]
    assert max(sizes) - min(sizes) <= 1


def test_shard_odd(spark, odd, tmp_path):
    import pyspark.sql.functions as F

    out = sharding.shard(odd, [F.col("doc_id"), F.xxhash64("text")], 3)
    rows = out.collect()
    assert sorted(r.row_number for r in rows) == list(range(len(ROWS)))
    assert sharding.shard(odd.limit(0), [F.col("doc_id")], 3).count() == 0
    sharding.write_shards(out, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(ROWS)


# --- language -------------------------------------------------------------------------


def test_language_held_out(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op8_language_id"](spark, folder).collect()
    given = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.lang_pred == given[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd(spark, odd):
    rows = language.identify(odd).collect()
    by_text = {r.text: r.lang_pred for r in rows}
    assert len(rows) == len(ROWS)
    assert [by_text[t] for t in (None, "", " \n\t", "12 34")] == ["und"] * 4
    assert by_text["a"] == "en"
    assert language.identify(odd.limit(0)).count() == 0
    none = odd.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in language.identify(none).collect()} == {"und"}


def test_language_never_reads_the_label(spark, odd):
    model = language.learn(odd)
    other = odd.selectExpr("doc_id + 1 AS doc_id", "text", "'xx' AS lang", "'s' AS source")
    a = sorted((r.text or "", r.lang_pred, r.score) for r in language.identify(odd, model).collect())
    b = sorted((r.text or "", r.lang_pred, r.score) for r in language.identify(other, model).collect())
    assert a == b


# --- packing --------------------------------------------------------------------------


def check_packing(rows, texts, size=1024):
    """Every id in exactly one piece, sequences gapless, none too long."""
    exact = packing.tokenizer(None).exact
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = exact.encode(texts[doc] or "", add_special_tokens=False).ids + [0]
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            own = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            assert (p.start, p.ids_crc32, p.doc_tokens) == (at, zlib.crc32(own), len(ids))
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= size
    return sum(r.length for r in rows) / (size * len(by_sequence))


def test_packing_query(spark, given):
    rows = QUERIES["op10_pack_sequences"](spark, SMALL).collect()
    assert check_packing(rows, {r.doc_id: r.text for r in given}) > 0.95


def test_packing_odd(spark, odd):
    rows = packing.pack(odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), size=16, most_open=2).collect()
    check_packing(rows, {r[0]: r[1] for r in ROWS if r[0] is not None}, 16)
    assert packing.pack(odd.limit(0)).count() == 0
    with_ids = packing.pack(odd, with_ids=True, keep=["doc_id", "size"]).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in with_ids)
    assert len({(r.sequence_id, r.offset) for r in with_ids}) == len(with_ids)


def test_both_tokenizers_agree():
    loaded, draw = packing.tokenizer(None), np.random.default_rng(1)
    parts = ["a", "Z", " ", "  ", "\n", "\t", "é", "'s", "'ll", "1", "23", "!", "?!", "😀", " ", "\x1c", "<|endoftext|>", "<|", "ñ", "the", " of"]
    for _ in range(1000):
        text = "".join(draw.choice(parts, draw.integers(0, 12)))
        assert loaded.ids(text) == loaded.exact.encode(text, add_special_tokens=False).ids
