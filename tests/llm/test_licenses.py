"""The licence scan against a plain version and on odd inputs."""

from __future__ import annotations

from mostrador.llm import licenses
from mostrador.llm.license_rules import SIGNATURES
from mostrador.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.plain import license_row

TEXTS = [
    None,
    "",
    "GNU General Public License, version 3. gnu general\npublic license again; GPL",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); é MIT License",
    "CC BY 4.0 and cc-by-sa 4.0, CC BY cc by",
    "SPDX-License-Identifier: GPL-3.0-or-later\nSPDX-License-Identifier: MIT",
    "😀 https://creativecommons.org/licenses/by/4.0/ accent by licence",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files",
    "submit licenses; the mit licensed. İ cc\tby BSD 3-Clause License  public domain",
    "mit license " * 600 + "é" * 40_000,
]
NAMES = "doc_id n_words n_base first_word last_word base_labels labels score".split()


def test_hundreds_of_ordered_rules():
    assert len(SIGNATURES) >= 200
    assert [s.order for s in SIGNATURES] == list(range(len(SIGNATURES)))
    assert [s.priority for s in SIGNATURES] == sorted(s.priority for s in SIGNATURES)


def test_scan(spark):
    rows = [(i, t, "mine", 1) for i, t in enumerate(TEXTS)] + [(1, "", "mine", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, row int")
    got = licenses.scan(docs)
    assert got.columns.count("labels") == 1 and "row" in got.columns
    want = sorted(license_row(r[0], r[1]) for r in rows)
    assert sorted(map(tuple, got.select(NAMES).collect())) == want
    assert licenses.scan(docs.limit(0)).count() == 0
    spans = got.where("doc_id = 2").first().found
    assert [TEXTS[2][s.start : s.end].lower() for s in spans][0] == "gnu general public license, version 3"


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op7_license_scan"](spark, SMALL)
    assert got.columns == NAMES
    assert sorted(map(tuple, got.collect())) == sorted(license_row(*r) for r in rows)
