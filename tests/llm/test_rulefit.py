"""The rule ensemble: statistics and rules against plain versions, held-out accuracy, odd tables."""

from __future__ import annotations

import math
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mostrador.llm import rulefit
from mostrador.llm import words as W
from mostrador.llm.common import Scratch
from mostrador.llm.queries import QUERIES

ODD = [None, "", " \n\t", "a", "x y x y x y", "eins zwei\neins zwei\n\nx# $y", "ñü😀\x85z " * 30, "A. B! c|", "a" * 200_000, "the word " * 20_000]


def plain(text: str | None) -> dict[str, float]:
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    chars, n = max(len(text), 1), max(len(words), 1)
    lines = [line for line in text.encode().split(b"\n") if line.split()]
    n_lines = text.count("\n") + 1
    blank = sum(c in " \t\n\r\x0b\x0c" for c in text)
    share = lambda kind: sum(c in kind for c in text) / chars
    upper, lower, digit = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    again = lambda k: (max(len(words) - k + 1, 0) - len({tuple(words[i : i + k]) for i in range(len(words) - k + 1)})) / n
    known = sum(c in upper + lower + digit + "#*$%&|<>.,;:!?" for c in text)
    return {
        "n_words": len(words),
        "word_length": (len(text) - blank) / n,
        "longest_word": max(map(len, words), default=0),
        "upper": share(upper), "lower": share(lower), "digit": share(digit),
        "symbol": share("#*$%&|<>"), "mark": share(".,;:!?"),
        "other": (len(text) - blank - known) / chars,
        "blank": blank / chars,
        "line_words": len(words) / n_lines,
        "line_repeats": (len(lines) - len(set(lines))) / n_lines if "\n" in text else 0.0,
        "same_next": sum(a == b for a, b in zip(words, words[1:])) / n,
        "same_after_next": sum(a == b for a, b in zip(words, words[2:])) / n,
        "distinct": len(set(words)) / n,
        "pair_repeats": again(2), "triple_repeats": again(3),
        "single": sum(len(w) == 1 for w in words) / n,
        "ends_marked": sum(w[-1] in "#*$%&|<>.,;:!?" for w in words) / n,
    }


def test_statistics():
    texts = [*ODD, *ODD[::-1]]
    found = [row for chunk in W.chunks(pa.array(texts)) for row in rulefit.chunk_statistics(chunk)]
    for text, row in zip(texts, found, strict=True):
        want = plain(text)
        assert row.tolist() == pytest.approx([want[name] for name in rulefit.STATISTICS]), text


def test_paths_of_a_description():
    tree = "\n".join([
        "  Tree 0 (weight 1.0):", "    If (feature 3 <= 0.5)", "     If (feature 3 <= 0.25)", "      Predict: 0.0",
        "     Else (feature 3 > 0.25)", "      Predict: 1.0", "    Else (feature 3 > 0.5)", "     Predict: 1.0E-1",
    ])
    T = rulefit.Test
    assert set(rulefit.paths(tree)) == {
        (T(3, True, 0.5),), (T(3, True, 0.25),), (T(3, False, 0.25), T(3, True, 0.5)), (T(3, False, 0.5),),
    }


def plain_score(model, row):
    total = model.intercept
    for rule, weight in model.rules:
        if all((row[t.number] <= t.limit) == t.at_most for t in rule):
            total += weight
    return 1 / (1 + math.exp(-total))


def test_query(spark):
    """Scores equal the rules applied by hand; held-out labels are told apart."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scratch = Scratch(spark)
    measured = scratch.stored(rulefit.statistics(docs.select("doc_id", "text")), "statistics")
    model = rulefit.learn(rulefit.labelled(measured, labels, rulefit.SAMPLE_ROWS, scratch))
    assert 0 < len(model.rules) < 60
    got = {r.doc_id: r for r in QUERIES["op11_quality_classifier"](spark, folder).collect()}
    assert len(got) == docs.count()
    quality = {r.doc_id: r.quality for r in labels.collect()}
    right = []
    for r in docs.collect():
        row, out = plain(r.text), got[r.doc_id]
        want = plain_score(model, [row[name] for name in rulefit.STATISTICS])
        assert out.score == pytest.approx(want) and out.predicted == int(out.score >= 0.3)
        assert out.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if out.held_out and r.doc_id in quality:
            right.append(out.predicted == quality[r.doc_id])
    assert len(right) > 50 and sum(right) >= 0.97 * len(right)


def test_labels_of_held_out_rows_do_not_matter(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    turned = labels.withColumn("quality", F.when(rulefit.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    scratch = Scratch(spark)
    measured = scratch.stored(rulefit.statistics(docs), "statistics")
    both = [sorted(rulefit.labelled(measured, x, 20_000, Scratch(spark)).collect()) for x in (labels, turned)]
    assert both[0] == both[1]


def test_odd_tables(spark):
    schema = "doc_id long, text string, score string, statistics int, quality int"
    rows = [(i, t, "s", 1, 2) for i, t in enumerate(ODD)] + [(None, "x", "s", 1, 2), (3, "a", "s", 1, 2), (3, "a", "s", 1, 2)]
    docs = spark.createDataFrame(rows, schema)
    kinds = "doc_id long, quality int, toxic int, text string"
    tables = [
        [],
        [(3, 1, 0, "t")],
        [(i, i % 2, 0, "t") for i in range(len(ODD))] * 2 + [(3, 0, 0, "t"), (None, 1, 0, "t"), (4, None, 0, "t"), (5, 7, 0, "t")],
    ]
    for given in tables:
        out = rulefit.classify(docs, spark.createDataFrame(given, kinds))
        assert out.columns == ["doc_id", "quality", "statistics", "held_out", "score", "predicted"]
        found = out.collect()
        assert len(found) == len(rows)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
        assert len({r.score for r in found if r.doc_id == 3}) == 1
        assert [r.held_out for r in found if r.doc_id is None] == [False]
    assert rulefit.classify(docs.limit(0), spark.createDataFrame(tables[2], kinds)).count() == 0
