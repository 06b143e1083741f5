"""Every stage of the pipeline against a plain version, on the rows the stage before it kept."""

from __future__ import annotations

from collections import Counter, defaultdict
import hashlib

import corpus_pipeline
from mostrador.llm import packing
from mostrador.llm.language import has_letter
from tests.conftest import SMALL
from tests.llm.plain import secret_spans
from tests.llm.test_neardup import joined_sets, plain_links
from tests.llm.test_numpy_ops import check_packing


def plain_language(rows):
    return [r for r in rows if has_letter(r.text)]


def plain_dedup(rows):
    texts = [r.text or "" for r in rows]
    first = {}
    same = [(first.setdefault(t, i), i) for i, t in enumerate(texts)]
    classes = defaultdict(list)
    for i, root in joined_sets(range(len(rows)), [*plain_links(texts), *same]).items():
        classes[root].append(rows[i])
    return [min(c, key=lambda r: r.doc_id) for c in classes.values()]


def plain_redaction(rows):
    out = []
    for r in rows:
        text, left, at = r.text, "", 0
        spans = sorted(secret_spans(text))
        for start, _, end, _ in spans:
            if start >= at:
                left += text[at:start] + "[secret]"
            at = max(at, end)
        text = left + text[at:] if spans else text
        d = r.asDict() | {"text": text, "n_chars": len(text) if spans else r.n_chars}
        out.append(type(r)(**d))
    return out


def plain_mix(rows):
    size = {i: len((r.text or "").encode().split()) for i, r in enumerate(rows)}
    key = {i: hashlib.md5(f"mix|{r.doc_id}|{r.text or ''}".encode()).hexdigest() for i, r in enumerate(rows)}
    sources = defaultdict(list)
    for i in sorted(size, key=key.get):
        sources[rows[i].source].append(i)
    total = {s: sum(size[i] for i in m) for s, m in sources.items()}
    names = sorted(total, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    budget, full = 1.5 * sum(total.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = budget - sum(2 * total[s] for s in full)
        new = {s for s in rest if 2 * total[s] * sum(weight[x] for x in rest) < weight[s] * left}
        if not new:
            break
        full |= new
    target = {s: 2.0 * total[s] if s in full else min(2.0 * total[s], weight[s] * left / sum(weight[x] for x in rest)) for s in names}
    queue = []
    for rank, s in enumerate(names):
        at = 0
        for turn in range(2):
            for i in sources[s]:
                at += size[i]
                if size[i]:
                    queue.append((at / target[s], rank, at, i))
    out, used = [], 0
    for *_, i in sorted(queue):
        used += size[i]
        if used > budget:
            break
        out.append(rows[i])
    return out


PLAIN = [plain_language, plain_dedup, plain_redaction, plain_mix]


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for number, ((name, stage), plain) in enumerate(zip(corpus_pipeline.STAGES, PLAIN)):
        before = docs.collect()
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        assert docs.columns == columns, name
        assert Counter(map(str, docs.collect())) == Counter(map(str, plain(before))), name
    kept = docs.collect()
    pieces = corpus_pipeline.STAGES[4][1](spark, docs.dropDuplicates(["doc_id"]), SMALL).collect()
    check_packing(pieces, {r.doc_id: r.text for r in kept})
    assert "pipeline" in __import__("__spark_entry__").queries()


def test_run(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


def test_odd_rows(spark):
    texts = [None, "", "12", "eins zwei drei", "eins zwei drei", "token=abcdefghijklmnop x"]
    rows = [(i, t, "de", None, 3, "x") for i, t in enumerate(texts)] * 2
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string"
    docs = spark.createDataFrame(rows, schema)
    for table in (docs, docs.limit(0)):
        out = table
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, out, SMALL)
            assert out.columns == docs.columns
        assert out.where("text IS NULL OR text LIKE '%abcdef%'").count() == 0


def test_product_holds_the_token_ids(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(50)
    rows = corpus_pipeline.STAGES[4][1](spark, docs, SMALL).collect()
    texts, got = {r.doc_id: r.text for r in docs.collect()}, {}
    for r in sorted(rows, key=lambda r: r.start):
        assert len(r.ids) == r.length
        got.setdefault(r.doc_id, []).extend(r.ids)
    encode = packing.tokenizer(None).ids
    assert got == {i: [*(encode(t) if t else []), packing.END] for i, t in texts.items()}
