"""Tables with nulls everywhere, repeated rows and columns named like results."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mostrador.llm import language, neighbours, packing, quality, sharding

LONG = "palabra nueva " * 20_000
TEXTS = [None, "", " \n", "12 34", "the words of a text", "the words of a text", "ñü 😀 z", LONG]
CLASHING = (
    "n_words string, ratio string, kept string, row_number string, shard string, slot string, held_out string, "
    "lang_pred int, score string, start string, length string, ids_crc32 string, doc_tokens string, "
    "sequence_id string, `offset` string, ids string, `window` string, open string, row string, found string, "
    "place string, part string, trusted string, statistics string, turn string, size string, queued string"
)
NAMES = [c.split()[0].strip("`") for c in CLASHING.split(", ")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "xx" if i % 2 else None, None if i % 3 else "s", *[None if i == 4 else (7 if n == "lang_pred" else n) for n in NAMES]) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (None, *rows[5][1:]), (None, None, None, None, *rows[5][4:])]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {CLASHING}")


def same_elsewhere(docs, out, replaced: set[str], gone: set[str] = frozenset()):
    """All other columns keep their values, row for row; those replaced are there once."""
    kept = [c for c in docs.columns if c not in replaced | gone]
    assert len(set(out.columns)) == len(out.columns) and set(kept) <= set(out.columns)
    assert not gone & set(out.columns)
    rows = lambda df: Counter(map(str, df.select([F.col(f"`{c}`") for c in kept]).collect()))
    assert rows(docs) == rows(out)


def test_quality(spark, docs):
    for labels in ([], [(4, 1, 0), (4, 1, 0), (None, 1, 0), (5, None, None), (7, 0, 1)]):
        table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
        out = quality.judge(docs, table)
        same_elsewhere(docs, out, set(quality.RESULT))
        found = {r.doc_id: r for r in out.collect()}
        assert found[7].n_words == 40_000 and found[0].n_words == 0
        assert not any(r.kept for r in found.values())  # each is too short or repeats itself
    assert quality.judge(docs.limit(0), table).count() == 0


def test_shards(docs):
    order = [F.col("doc_id"), F.xxhash64("text")]
    out = sharding.shard(docs, order, 5)
    same_elsewhere(docs, out, {"row_number", "shard", "slot"})
    rows = out.collect()
    assert sorted(r.row_number for r in rows) == list(range(docs.count()))
    assert len({(r.shard, r.slot) for r in rows}) == len(rows)
    assert sharding.shard(docs.limit(0), order, 5).count() == 0


def test_language(docs):
    out = language.identify(docs)
    same_elsewhere(docs, out, {"held_out", "lang_pred", "score"})
    for r in out.collect():
        unknown = r.text is None or not any(map(str.isalpha, r.text))
        assert (r.lang_pred == "und") == unknown and (r.score > 0) != unknown
    kept = language.in_a_language(docs)
    assert kept.columns == docs.columns
    assert {r.text for r in kept.collect()} == {t for t in TEXTS if t and any(map(str.isalpha, t))}
    assert language.identify(docs.limit(0)).count() == 0 == language.in_a_language(docs.limit(0)).count()


@pytest.mark.parametrize("with_ids", [False, True])
def test_packing(docs, with_ids):
    out = packing.pack(docs, with_ids=with_ids)
    names = {f.name for f in packing.PIECE}
    assert len(set(out.columns)) == len(out.columns) and "text" not in out.columns
    assert ("ids" in out.columns) == with_ids and names <= set(out.columns)
    rows = out.collect()
    whole = sum(r.length for r in rows)
    # every row of the table is packed, repeated and null ones as well
    assert whole == sum(r.doc_tokens for r in rows if r.start == 0) and sum(r.start == 0 for r in rows) == docs.count()
    assert {r.found for r in rows} == {"found", None} and {r.window for r in rows} == {"window", None}
    used = Counter()
    for r in rows:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= packing.WINDOW
    assert packing.pack(docs.limit(0), with_ids=with_ids).count() == 0


def test_neighbours(spark):
    rows = [(i % 7 or None, [float(i % 5), 1.0], "x", "y", "z") for i in range(1, 30)] * 2
    table = spark.createDataFrame(rows, "vec_id long, vector array<double>, rank string, score string, query_id string")
    asked = table.drop("query_id").withColumnRenamed("vec_id", "query_id")
    found = neighbours.nearest_neighbours(table, asked)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert all(r.query_id != r.vec_id and r.vec_id is not None for r in found.collect())


def test_all_stages(spark, docs):
    for table in (docs, docs.limit(0)):
        out = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, "")
            assert out.columns == docs.columns
        pieces = corpus_pipeline.STAGES[-1][1](spark, out, "")
        assert pieces.columns[:3] == ["doc_id", "lang", "source"] and "ids" in pieces.columns
        assert pieces.where("start = 0").count() == out.count()
