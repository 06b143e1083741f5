"""Licence scan: ordered signatures behind a keyword prefilter, overlaps resolved.

Each text is tested for the keywords first; only signatures whose keyword occurs run. A
detection that lies inside one of the same or a higher priority is dropped, so "gnu general
public license version 3" is one detection of gpl-3.0 and not also one of gpl.
"""

from __future__ import annotations

from itertools import groupby
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.llm.common import bound, without
from mostrador.llm.license_rules import CONFIDENCE, PHRASES, SIGNATURES
from mostrador.llm.spans import matches

# Fixed value: what a word of the base phrases is, after A-Z went to lower case.
LOW_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
FOUND = "array<struct<start:bigint,back:bigint,priority:int,order:int,label:string>>"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def keyword_table(signatures) -> Column:
    """Constant array of (words of the keyword, its signatures)."""
    by_keyword = groupby(sorted(signatures, key=lambda s: (s.keyword, s.order)), lambda s: s.keyword)
    entries = []
    for keyword, rules in by_keyword:
        listed = [
            F.struct(
                F.lit(r.regex).alias("regex"),
                F.lit(r.priority).alias("priority"),
                F.lit(r.order).alias("order"),
                F.lit(r.label).alias("label"),
            )
            for r in rules
        ]
        words = F.array(*[F.lit(w) for w in keyword.split()])
        entries.append(F.struct(words.alias("words"), F.array(*listed).alias("rules")))
    return F.array(*entries)


def detections(text: Column, signatures=SIGNATURES) -> Column:
    """Every match of every signature that the prefilter lets through, sorted for ``resolved``."""

    def tried(low: Column, keywords: Column) -> Column:
        rules = F.flatten(F.transform(keywords, lambda k: k["rules"]))
        found = F.transform(
            rules,
            lambda r: F.transform(
                matches(low, r["regex"]),
                lambda m: F.struct(
                    m["start"].alias("start"),
                    (-m["end"]).alias("back"),
                    r["priority"].alias("priority"),
                    r["order"].alias("order"),
                    r["label"].alias("label"),
                ),
            ),
        )
        return F.array_sort(F.flatten(found))

    def gated(any_case: Column) -> Column:
        return F.filter(
            keyword_table(signatures),
            lambda k: F.forall(k["words"], lambda w: F.contains(any_case, w)),
        )

    keywords = bound(F.lower(text), gated)
    return bound(
        keywords,
        lambda ks: F.when(
            F.size(ks) > 0, bound(lower_ascii(text), lambda low: tried(low, ks))
        ).otherwise(F.array().cast(FOUND)),
    )


def resolved(found: Column, levels=tuple(sorted(CONFIDENCE))) -> Column:
    """Sorted detections without those inside one of the same or a higher priority.

    In the order (start, longest first, priority, rule) a detection lies inside an earlier
    one exactly if that one ends no sooner, so the furthest end per priority is all a
    sweep has to remember.
    """
    nowhere = F.lit(-1).cast("bigint")
    state = F.struct(
        *[nowhere.alias(f"end{p}") for p in levels], F.array().cast(FOUND).alias("kept")
    )

    def step(done: Column, d: Column) -> Column:
        end = -d["back"]
        covered = F.lit(False)
        for p in levels:
            covered = covered | ((d["priority"] >= p) & (done[f"end{p}"] >= end))
        ends = [
            F.when(d["priority"] == p, F.greatest(done[f"end{p}"], end))
            .otherwise(done[f"end{p}"])
            .alias(f"end{p}")
            for p in levels
        ]
        kept = F.when(covered, done["kept"]).otherwise(F.concat(done["kept"], F.array(d)))
        return F.struct(*ends, kept.alias("kept"))

    return F.aggregate(found, state, step, lambda done: done["kept"])


def phrase_places(text: Column) -> Column:
    """Per base phrase (label, places, first word, last word); a phrase that is absent has 0 places."""

    def blanks(piece: Column) -> Column:
        return (F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))).cast("bigint")

    def placed(words: Column, phrase: str, label: str) -> Column:
        length = len(phrase.split())

        def counted(gaps: Column) -> Column:
            n = (F.size(gaps) - 1).cast("bigint")
            before = F.slice(gaps, F.lit(1), F.greatest(F.size(gaps) - 1, F.lit(0)))
            passed = F.aggregate(
                F.transform(before, blanks), F.lit(0).cast("bigint"), lambda a, x: a + x
            )
            return F.struct(
                F.lit(label).alias("label"),
                n.alias("n"),
                F.when(n > 0, blanks(F.get(gaps, 0))).alias("first"),
                F.when(n > 0, passed + (n - 1) * length).alias("last"),
            )

        return bound(F.split(words, f" {phrase}(?= )", -1), counted)

    def in_words(low: Column) -> Column:
        words = F.array_join(F.regexp_extract_all(low, F.lit(LOW_WORD), F.lit(0)), " ")
        return bound(
            F.concat(F.lit(" "), words, F.lit(" ")),
            lambda w: F.array(*[placed(w, phrase, label) for phrase, label in PHRASES.items()]),
        )

    gate = [F.forall(F.array(*map(F.lit, p.split())), lambda w: F.contains(F.lower(text), w)) for p in PHRASES]
    some = gate[0]
    for g in gate[1:]:
        some = some | g
    return F.when(some, bound(lower_ascii(text), in_words))


def scan(docs: DataFrame, signatures=SIGNATURES) -> DataFrame:
    """The documents with n_words, n_base, first_word, last_word, base_labels, found, labels, score.

    ``found`` holds the detections that stay: (start, end, label, priority), code points of
    the whole text. ``labels`` are theirs and those of the base phrases. ``score`` is the
    highest confidence of any, 0 without one. A null text counts as empty. Repeated rows are
    each scanned; an empty table gives an empty one. Further columns stay, those named like
    a result are replaced.
    """
    added = ["n_words", "n_base", "first_word", "last_word", "base_labels", "found", "labels", "score"]
    kept = without(docs, *added).columns
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # explode() keeps the two costly arrays from being computed once per column that reads them
    once = F.array(F.struct(phrase_places(text).alias("places"), resolved(detections(text, signatures)).alias("found")))
    seen = rows.select("row", F.explode(once).alias("seen")).select("row", "seen.places", "seen.found")
    there = F.filter(F.coalesce("places", F.array()), lambda p: p["n"] > 0)
    base = F.transform(there, lambda p: p["label"])
    labels = F.array_union(base, F.transform("found", lambda d: d["label"]))
    best = F.array_min(F.transform("found", lambda d: d["priority"]))
    levels = [F.when(best == p, F.lit(c)) for p, c in CONFIDENCE.items()]
    shown = F.transform(
        "found",
        lambda d: F.struct(
            d["start"].alias("start"), (-d["back"]).alias("end"), d["label"].alias("label"), d["priority"].alias("priority")
        ),
    )
    total = F.aggregate(F.transform(there, lambda p: p["n"]), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return seen.select(
        *[F.col("row")[c].alias(c) for c in kept],
        F.regexp_count(text, F.lit(ANY_CASE_WORD)).cast("long").alias("n_words"),
        total.alias("n_base"),
        F.array_min(F.transform(there, lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform(there, lambda p: p["last"])).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        shown.alias("found"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        F.coalesce(*levels, F.when(F.size(there) > 0, F.lit(CONFIDENCE[4])), F.lit(0.0)).alias("score"),
    )
