"""Personal data: base spans against the plain patterns, and what the bootstrap finds."""

from __future__ import annotations

from mostrador.llm import pii
from mostrador.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.plain import private_row, private_spans

TEXTS = [
    None,
    "",
    "😀 a.b@c.co_m@y.org x@y z@host.a.b, 1.2.3.4.5.6.7.8 0255.1.1.1 256.1.1.1 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111 +1 (640) 555-0953 +12 3",
    "é" * 30_000 + "a.b@c.de" + "1" * 20_000 + " " + "x" * 30_000,
    "+1 (640) 555-0953+44 20 7946 0958 10.0.0.110.0.0.2 a@b.c.d@e.f",
]
MORE = [f"Reach us. Contact: user{i}@mail.org or so" for i in range(4)] + [
    "Contact: 555-01-7788 here",
    "Staff no: 555-01-7788",
    "Ticket: 2024-11-07",
]


def frame(spark, texts):
    rows = [(i, t, "mine") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string")


def test_base_spans(spark):
    got = pii.scan(frame(spark, TEXTS))
    assert got.columns == ["doc_id", "text", "spans"]
    for row in got.collect():
        assert sorted(map(tuple, row.spans)) == sorted(private_spans(row.text)), row.doc_id


def test_bootstrap(spark):
    spans = {r.text: [tuple(s) for s in r.spans] for r in pii.scan(frame(spark, MORE)).collect()}
    assert spans[MORE[4]] == [(9, 4, 20, "identifier")]
    assert spans[MORE[6]] == []
    assert all(s[0][3] == "email" for t, s in spans.items() if "@" in t)


def test_second_round_learns_from_the_first(spark):
    rows = [("a:", f"s{i}@x.yz", True) for i in range(15)] + [("a:", v, False) for v in ("n1-22", "n2-22", "n3-22")]
    rows += [("b:", v, False) for v in ("n1-22", "n2-22", "n3-22", "n4-22")] + [("c:", "n5-22", False)]
    edges = spark.createDataFrame(rows, "label string, value string, seed boolean")
    assert {r.label for r in pii.trusted_labels(edges, 1).collect()} == {"a:"}
    assert {r.label for r in pii.trusted_labels(edges, 2).collect()} == {"a:", "b:"}


def test_empty_table_and_repeated_rows(spark):
    docs = frame(spark, TEXTS)
    assert pii.scan(docs.limit(0)).count() == 0
    assert pii.scan(docs.union(docs), keep=["doc_id"]).count() == 2 * len(TEXTS)


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op9_personal_data"](spark, SMALL).drop("spans").collect()
    assert sorted(map(tuple, got)) == sorted(private_row(*r) for r in rows)


def test_seeds_and_values_with_blanks(spark):
    phones = [f"phone2: +1 (743) 555-38{i}4" for i in range(4)]
    cards = [f"card: {c}" for c in ("4111 1111 1111 1111", "5500 0055 5555 5559", "4012 8888 8888 1881")]
    more = ["phone2: 743 555 1234 x", "card: DE89 3704 0044 0532 0130 00.", "see (card:      (A-1077-3).", "at: 10-77-31"]
    spans = {r.text: [tuple(s) for s in r.spans] for r in pii.scan(frame(spark, phones + cards + more)).collect()}
    assert all([s[3] for s in spans[t]] == ["phone"] for t in phones)
    assert all([s[3] for s in spans[t]] == ["card"] for t in cards)
    assert spans[more[0]] == [(8, 4, 20, "identifier")]
    assert spans[more[1]] == [(6, 4, 33, "identifier")]
    assert len(spans[more[2]]) == 1 and spans[more[3]] == []


def test_rounds_go_on_until_no_label_is_new(spark):
    rows = [("a:", f"s{i}@x.yz", True) for i in range(45)]
    rows += [(label, f"n{i}-22", False) for label in ("a:", "b:") for i in range(12)]
    rows += [(label, f"k{i}-22", False) for label in ("b:", "c:") for i in range(3)]
    edges = spark.createDataFrame(rows, "label string, value string, seed boolean")
    assert {r.label for r in pii.trusted_labels(edges, 2).collect()} == {"a:", "b:"}
    assert {r.label for r in pii.trusted_labels(edges).collect()} == {"a:", "b:", "c:"}


def test_words_on_either_side_reveal_values(spark):
    texts = [f"please call me at +1 (743) 555-38{i}4 today" for i in range(4)]
    texts += [f"{n} it is 10.1.2.{i} is my host" for i, n in enumerate(("ab", "cd", "ef", "gh"))]
    more = ["you call me at 555-01-7788.", "so 77-A-1204 is my host, ok", "we met at 2024-11-07", "look at 10-30-00"]
    texts += more + [f"a{i} at {i}2024-x" for i in range(6)]
    spans = {r.text: [tuple(s) for s in r.spans] for r in pii.scan(frame(spark, texts)).collect()}
    assert spans[more[0]] == [(15, 4, 26, "identifier")]
    assert spans[more[1]] == [(3, 4, 12, "identifier")]
    assert spans[more[2]] == spans[more[3]] == []
