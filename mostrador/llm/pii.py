"""Personal data: fixed shapes, and identifiers that bootstrapped contexts reveal.

Entities of a known shape (mail addresses, IP addresses, cards, phones) are the seeds. The
labels they stand behind ("Phone:", "contact =") and the words on either side of them ("call
me at _") become patterns; Spark scores the graph of patterns and values in rounds, and what
stands in a trusted pattern counts as personal data also where its shape is none of the
known ones. Patterns too common to reveal anything fail by their trust.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.llm.common import Scratch, bound, without
from mostrador.llm.spans import MATCH, as_spans, matches, no_spans

# The base kinds in the order in which they are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
FOUND_KIND = "identifier"

# The same matches as the plain patterns. A match can only begin where a run of its first
# class begins or the previous match ended; saying so keeps long runs linear.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
IP_RANGE = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"

# Values that may be identifiers: a known shape, parts that hold digits joined by single
# blanks ("DE89 3704 0044"), or one token with a digit or an at sign, less its last full stop.
_TOKEN = "[A-Za-z0-9._%@()-]"
_LONG = r"[0-9](?:[\x20-]?[0-9]){11,}+"
_PART = r"(?=[A-Z(]*+[0-9])[A-Z0-9()/-]++(?!\.?[A-Za-z0-9_%@+])"
_JOINED = rf"(?<!{_TOKEN}){_PART}(?:\x20{_PART})++"
_SINGLE = rf"(?<!{_TOKEN})(?![A-Za-z._%@()-]*+{_LONG}){_TOKEN}*?[0-9@](?:{_TOKEN}*[A-Za-z0-9)])?+"
VALUE = f"{EMAIL}|{IP}|{PHONE}|{_LONG}|{_JOINED}|{_SINGLE}"
LEAST_VALUE = 5
CONTEXT = 64
NGRAM = 3
_WORD = r"[\p{L}\p{M}\p{N}_]"
LABEL = r"(?:([\p{L}0-9_-]+)[^\S\n]+)?([\p{L}0-9_-]+)[^\S\n]*[:=#]+[^\S\n]*[\"'(<]?$"

SUPPORT = 3
TRUST = 0.6
SALTS = 16


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""

    def weight(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when((F.length(digits) - i) % 2 == 1, twice).otherwise(digit)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(F.transform(places, weight), F.lit(0), lambda a, x: a + x) % 10 == 0


def is_card(text: Column) -> Column:
    return bound(
        _digits(text), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False))
    )


def is_phone(text: Column) -> Column:
    return F.length(_digits(text)).between(9, 15)


def base_matches(text: Column) -> Column:
    """Matches of the four known shapes, one array a kind, each behind a cheap test that it can occur."""
    gates = {
        "email": F.contains(text, F.lit("@")),
        "ip": F.regexp_like(text, F.lit(r"[0-9]\.[0-9]")),
        "card": F.regexp_like(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){11}")),
        "phone": F.contains(text, F.lit("+")),
    }
    found = {
        "email": matches(text, EMAIL),
        "ip": F.filter(matches(text, IP), lambda m: F.regexp_like(m["text"], F.lit(IP_RANGE))),
        "card": F.filter(matches(text, CARD), lambda m: is_card(m["text"])),
        "phone": F.filter(matches(text, PHONE), lambda m: is_phone(m["text"])),
    }
    none = F.array().cast(MATCH)
    return F.struct(*[F.coalesce(F.when(gates[k], found[k]), none).alias(k) for k in BASE_KINDS])


def base_spans(found: Column) -> Column:
    """The matches as spans."""
    return F.concat(*[as_spans(found[k], rank, k) for rank, k in enumerate(BASE_KINDS)])


def holds_base(text: Column) -> Column:
    """Whether one of the known shapes lies in a string."""
    return bound(base_matches(text), lambda found: F.size(base_spans(found)) > 0)


def seeds(found: Column) -> Column:
    """The base spans as mentions; cards and phones count as their digits, however written."""

    def mention(kind: str):
        value = _digits if kind in ("card", "phone") else F.lower
        return lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), value(m["text"]).alias("value"), F.lit(True).alias("seed")
        )

    return F.concat(*[F.transform(found[k], mention(k)) for k in BASE_KINDS])


def other_values(text: Column) -> Column:
    """Identifier-like values that hold none of the known shapes, as mentions."""
    found = F.filter(
        matches(text, VALUE), lambda m: (F.length(m["text"]) >= LEAST_VALUE) & ~holds_base(m["text"])
    )
    some = F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"),
            m["end"].alias("end"),
            F.regexp_replace(F.lower(m["text"]), r"[\x20()-]", "").alias("value"),
            F.lit(False).alias("seed"),
        ),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string,seed:boolean>>")
    return F.coalesce(F.when(F.regexp_like(text, F.lit("[0-9@]")), some), none)


def label_before(before: Column) -> Column:
    """The last word before a colon, equals sign or number sign that ends the string, with the word in front of it."""
    label = F.regexp_extract(before, LABEL, 0)
    return F.trim(F.regexp_replace(F.lower(label), r"[^\p{L}0-9_:=#-]+", " "))


def patterns(before: Column, after: Column) -> Column:
    """What may reveal a mention between two contexts: its label, and the 1 to 3 words on either side.

    Words are runs of letters, digits and underscores, in lower case. One that the end of a
    full context may cut is left out.
    """

    def whole(context: Column, cut: str) -> Column:
        full = F.length(context) == CONTEXT
        return F.lower(F.when(full, F.regexp_replace(context, cut, "")).otherwise(context))

    def words(context: Column) -> Column:
        return F.regexp_extract_all(context, F.lit(f"{_WORD}+"), F.lit(0))

    def ngrams(both: Column) -> list[Column]:
        left, right, sizes = both["left"], both["right"], range(1, NGRAM + 1)
        ends = [F.when(F.size(left) >= n, F.concat(F.array_join(F.slice(left, -n, n), " "), F.lit(" _"))) for n in sizes]
        return ends + [
            F.when(F.size(right) >= n, F.concat(F.lit("_ "), F.array_join(F.slice(right, 1, n), " "))) for n in sizes
        ]

    label = label_before(before)
    sides = F.struct(
        words(whole(before, rf"^{_WORD}+")).alias("left"),
        words(whole(after, rf"{_WORD}+\z")).alias("right"),
        F.when(label != "", label).alias("label"),
    )
    return bound(sides, lambda both: F.array_compact(F.array(both["label"], *ngrams(both))))


def with_patterns(text: Column, mentions: Column) -> Column:
    """The mentions with their patterns, from 64 code points on either side, on the mention's line.

    The text is cut into blocks once, so that a context costs the same anywhere in it.
    """

    def located(blocks: Column) -> Column:
        def block(i: Column) -> Column:
            return F.coalesce(F.get(blocks, i), F.lit(""))

        def one(m: Column) -> Column:
            at, left = (m["start"] / CONTEXT).cast("int"), (m["start"] % CONTEXT).cast("int")
            to, right = (m["end"] / CONTEXT).cast("int"), (m["end"] % CONTEXT).cast("int")
            before = F.right(F.concat(block(at - 1), F.substring(block(at), F.lit(1), left)), F.lit(CONTEXT))
            after = F.concat(F.substring(block(to), right + 1, F.lit(CONTEXT)), block(to + 1))
            after = F.substring(after, 1, CONTEXT)
            both = F.struct(before.alias("before"), after.alias("after"))
            found = bound(
                both,
                lambda c: patterns(
                    F.substring_index(c["before"], "\n", -1), F.substring_index(c["after"], "\n", 1)
                ),
            )
            return F.struct(*[m[c].alias(c) for c in ("start", "end", "value", "seed")], found.alias("patterns"))

        return F.transform(mentions, one)

    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string,seed:boolean,patterns:array<string>>>")
    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CONTEXT}}}"), F.lit(0))
    return F.when(F.size(mentions) > 0, bound(blocks, located)).otherwise(none)


def trusted_labels(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Labels, or patterns of any form, that reveal personal data, from the graph of (label, value, seed).

    A label's trust is the mean belief in its distinct values; a label counts once it has
    the support of ``SUPPORT`` believed values and a trust of ``TRUST``. Belief is 1 for a
    seed, else the chance that not all of its trusted labels are wrong. Trust never falls
    from round to round, so the set of labels only grows; the rounds end when it does not,
    or after ``rounds``. The join of a round is salted, since one label may hold a third of
    all values.
    """
    scratch = Scratch(edges.sparkSession)
    edges = scratch.stored(
        edges.groupBy("label", "value").agg(F.max(F.col("seed").cast("double")).alias("belief")), "edges"
    )
    believed, known, turn = edges, 0, 0
    while True:
        turn += 1
        labels = scratch.stored(
            believed.groupBy("label")
            .agg(
                (F.sum("belief") / F.count(F.lit(1))).alias("trust"),
                F.sum((F.col("belief") >= TRUST).cast("long")).alias("support"),
            )
            .where((F.col("trust") >= TRUST) & (F.col("support") >= SUPPORT)),
            f"labels{turn}",
        )
        count = labels.count()
        if count <= known or turn == rounds:
            return labels.select("label", "trust")
        known = count
        salted = labels.select(
            "label", "trust", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        )
        salt = F.pmod(F.xxhash64("value"), F.lit(SALTS)).cast("int")
        doubt = F.log(F.greatest(F.lit(1) - F.col("trust"), F.lit(1e-9)))
        seen = edges.withColumn("salt", salt).join(salted, ["label", "salt"])
        learned = seen.groupBy("value").agg((F.lit(1) - F.exp(F.sum(doubt))).alias("learned"))
        learned = scratch.stored(learned, f"learned{turn}")
        believed = edges.join(learned, "value", "left").select(
            "label", "value", F.greatest("belief", F.coalesce("learned", F.lit(0.0))).alias("belief")
        )


def scan(docs: DataFrame, keep: list[str] | None = None, name: str = "spans") -> DataFrame:
    """The documents with the personal data of the whole text: (start, rank, end, kind) in ``spans``.

    Spans of the four base kinds come from their shapes, those of kind ``identifier`` from
    trusted labels and words. ``keep`` names the columns to carry along, all by default; one named like
    the result is replaced. Null and empty texts have no spans. Repeated rows are each
    scanned, an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession)
    carried = [c for c in without(docs, name).columns if keep is None or c in keep]
    text = F.coalesce(F.col("text"), F.lit(""))
    shapes = F.array(F.struct(text.alias("text"), base_matches(text).alias("base")))
    values = F.concat(seeds(F.col("shape.base")), other_values(F.col("shape.text")))
    found = docs.select(
        F.monotonically_increasing_id().alias("id"),
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"),
        F.explode(shapes).alias("shape"),
    )
    found = found.select(
        "id",
        "row",
        base_spans(F.col("shape.base")).alias("base"),
        bound(values, lambda v: with_patterns(F.col("shape.text"), v)).alias("mentions"),
    )
    rows = scratch.stored(found, "rows")
    mentions = rows.select("id", F.explode("mentions").alias("m")).select("id", "m.*")
    mentions = mentions.withColumn("label", F.explode("patterns"))
    trusted = trusted_labels(mentions.select("label", "value", "seed"))
    salted = trusted.select("label", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    more = (
        mentions.where(~F.col("seed"))
        .withColumn("salt", F.pmod("id", F.lit(SALTS)).cast("int"))
        .join(salted, ["label", "salt"])
    )
    span = F.struct(
        F.col("start"), F.lit(len(BASE_KINDS)).alias("rank"), F.col("end"), F.lit(FOUND_KIND).alias("kind")
    )
    extra = more.groupBy("id").agg(F.collect_set(span).alias("extra"))
    merged = F.concat("base", F.coalesce("extra", no_spans())).alias(name)
    return rows.join(extra, "id", "left").select(*[F.col("row")[c].alias(c) for c in carried], merged)
