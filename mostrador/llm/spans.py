"""Where a pattern matches a text, as native column expressions.

Spark's functions give the matched strings but not their places. Splitting the text at
the same pattern gives the strings between the matches; the running sum of both lengths
gives the places, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mostrador.llm.common import bound

CHUNK = 256
MATCH = "array<struct<start:bigint,end:bigint,text:string>>"
SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"


def running_sums(numbers: Column) -> Column:
    """Sums of the first 1, 2, ... numbers. Chunks keep the array copies from growing as n squared."""
    none = F.array().cast("array<bigint>")

    def appended(values: Column) -> Column:
        return F.aggregate(
            values,
            none,
            lambda done, x: F.concat(
                done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0).cast("bigint")) + x)
            ),
        )

    def by_chunks(values: Column) -> Column:
        parts = F.transform(
            F.sequence(F.lit(1), F.size(values), F.lit(CHUNK)),
            lambda first: appended(F.slice(values, first, F.lit(CHUNK))),
        )

        def shifted(pieces: Column) -> Column:
            ends = appended(F.transform(pieces, lambda p: F.element_at(p, -1)))
            return bound(
                ends,
                lambda totals: F.flatten(
                    F.transform(
                        pieces,
                        lambda p, i: F.transform(
                            p,
                            lambda x: x + F.when(i > 0, F.get(totals, i - 1)).otherwise(F.lit(0).cast("bigint")),
                        ),
                    )
                ),
            )

        return bound(parts, shifted)

    return bound(
        numbers,
        lambda values: F.when(F.size(values) == 0, none)
        .when(F.size(values) <= CHUNK, appended(values))
        .otherwise(by_chunks(values)),
    )


def places(gaps: Column, found: Column) -> Column:
    """Matches with their places, from the strings between matches and the matches."""

    def located(g: Column, m: Column) -> Column:
        steps = F.transform(
            m,
            lambda _, i: (
                F.length(F.get(g, i))
                + F.when(i > 0, F.length(F.get(m, i - 1))).otherwise(F.lit(0))
            ).cast("bigint"),
        )
        return bound(
            running_sums(steps),
            lambda starts: F.transform(
                m,
                lambda text, i: F.struct(
                    F.get(starts, i).alias("start"),
                    (F.get(starts, i) + F.length(text)).alias("end"),
                    text.alias("text"),
                ),
            ),
        )

    return bound(
        found,
        lambda m: F.when(F.size(m) == 0, F.array().cast(MATCH)).otherwise(
            bound(gaps, lambda g: located(g, m))
        ),
    )


def matches(text: Column, pattern: str | Column) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, text), end exclusive.

    The pattern must not match the empty string. A null text has none.
    """
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern
    text = F.coalesce(text, F.lit(""))
    return places(
        F.split(text, regex, -1), F.regexp_extract_all(text, regex, F.lit(0))
    )


def as_spans(found: Column, rank: int, kind: str) -> Column:
    """Matches as spans of one kind; the rank orders kinds that start at the same place."""
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"),
            F.lit(rank).alias("rank"),
            m["end"].alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )


def no_spans() -> Column:
    return F.array().cast(SPAN)


def digest(spans: Column) -> Column:
    """Spans as ``kind:start:end``, by start, then by rank, comma-joined."""
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with every span, overlapping ones merged, replaced by a mask."""
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when((s["start"] >= done["at"]) & (s["end"] > done["at"]), F.concat(done["out"], gap, F.lit(mask)))
            .otherwise(done["out"])
            .alias("out"),
        )

    replaced = F.aggregate(
        F.array_sort(spans),
        state,
        step,
        lambda done: F.concat(
            done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text))
        ),
    )
    return F.when(F.size(spans) > 0, replaced).otherwise(text)
