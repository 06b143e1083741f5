"""Secret scan through a trigram index.

Every rule's regular expression yields a Boolean query over the trigrams that any match
must contain. Postings (trigram, document) are intersected per clause of that query, and
only documents that pass are verified with the expression itself. A rule without mandatory
trigrams is run over every text.
"""

from __future__ import annotations

import re._constants as codes
import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mostrador.llm.common import free_name, without
from mostrador.llm.spans import as_spans, masked, matches, no_spans

MOST_STRINGS = 64
MOST_CHARS = 8


@dataclass(frozen=True)
class Rule:
    """A kind of secret; ``value`` is the group whose length counts, 0 the whole match."""

    kind: str
    regex: str
    least: int = 1
    value: int = 0


# The three base kinds, in the order in which they are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=12,
        value=2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]+", least=16),
)

# An armored key: to the next END line of a private key, whatever stands between, or else as
# far as its headers and base64 go; a short run counts as the last one if its line ends there.
_KEY = r"[A-Z ]{0,20}PRIVATE KEY(?: BLOCK)?-----"
_SEP = r"""(?:[\x20\x09-\x0D"'+,;>#*/|]|\\[nrt])"""
_LAST = r"""[A-Za-z0-9+/]++={0,2}+(?![^\r\n"'\\])"""
PRIVATE_KEY = (
    rf"-----BEGIN {_KEY}(?:[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END {_KEY}"
    rf"|(?:(?:{_SEP}++[A-Za-z][A-Za-z-]{{1,30}}:\x20[^\r\n\\]*+)*+{_SEP}++[A-Za-z0-9+/]{{16,}}+={{0,2}}+)?+"
    rf"(?:{_SEP}++[A-Za-z0-9+/]{{16,}}+={{0,2}}+)*+(?:{_SEP}++{_LAST})?+)"
)

# Publicly documented shapes of credentials.
MORE_RULES = (
    Rule("private_key", PRIVATE_KEY),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("package", r"npm_[A-Za-z0-9]{36}"),
    Rule("mail", r"SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"[Bb]earer\x20[A-Za-z0-9._~+/-]{20,}"),
    Rule("login", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{1,64}@"),
)
RULES = BASE_RULES + MORE_RULES

Clauses = frozenset[frozenset[str]]
ANYTHING: Clauses = frozenset([frozenset()])


def _absorbed(clauses) -> Clauses:
    """Clauses without those that a weaker one already covers."""
    kept: list[frozenset[str]] = []
    for clause in sorted(set(clauses), key=len):
        if not any(k <= clause for k in kept):
            kept.append(clause)
    return frozenset(kept)


def _both(a: Clauses, b: Clauses) -> Clauses:
    if len(a) * len(b) > MOST_STRINGS:  # dropping a condition only adds candidates
        return min(a, b, key=len)
    return _absorbed(x | y for x, y in product(a, b))


def _containing(strings: frozenset[str]) -> Clauses:
    lowered = (s.lower() for s in strings)
    return _absorbed(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in lowered)


def _sequence(items) -> tuple[frozenset[str] | None, Clauses]:
    """The strings a sequence can be, if few, and what every match of it contains."""
    run, whole, query = frozenset([""]), True, ANYTHING
    for op, arg in items:
        strings, inner = _item(op, arg)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = frozenset(a + b for a, b in product(run, strings))
            continue
        query, whole = _both(query, _containing(run)), False
        if strings is None:
            query, run = _both(query, inner), frozenset([""])
        else:
            tails = frozenset(s[-2:] for s in run)
            few = len(tails) * len(strings) <= MOST_STRINGS
            run = frozenset(a + b for a, b in product(tails, strings)) if few else strings
    return (run, _containing(run)) if whole else (None, _both(query, _containing(run)))


def _item(op, arg) -> tuple[frozenset[str] | None, Clauses]:
    nothing = (frozenset([""]), ANYTHING)
    if op is codes.LITERAL:
        return frozenset([chr(arg)]), ANYTHING
    if op is codes.SUBPATTERN:
        return _sequence(arg[3])
    if op is codes.AT or op is codes.ASSERT or op is codes.ASSERT_NOT:
        return nothing
    if op is codes.IN:
        chars: set[str] = set()
        for kind, value in arg:
            if kind is codes.LITERAL:
                chars.add(chr(value))
            elif kind is codes.RANGE and value[1] - value[0] < MOST_CHARS:
                chars |= {chr(c) for c in range(value[0], value[1] + 1)}
            else:
                return None, ANYTHING
        return (frozenset(chars), ANYTHING) if len(chars) <= MOST_CHARS else (None, ANYTHING)
    if op is codes.BRANCH:
        parts = [_sequence(branch) for branch in arg[1]]
        if all(strings is not None for strings, _ in parts):
            union = frozenset().union(*[strings for strings, _ in parts])
            if len(union) <= MOST_STRINGS:
                return union, ANYTHING
        return None, _absorbed(clause for _, query in parts for clause in query)
    if op in (codes.MAX_REPEAT, codes.MIN_REPEAT, codes.POSSESSIVE_REPEAT):
        least, most, body = arg
        strings, query = _sequence(body)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, ANYTHING
        return None, query if least else ANYTHING
    return None, ANYTHING


def trigram_query(regex: str) -> Clauses:
    """Alternatives, each a set of lower-case trigrams that a matching text all contains.

    One empty alternative says that nothing is mandatory.
    """
    return _absorbed(_sequence(parser.parse(regex))[1])


def _text(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def postings(docs: DataFrame, key: Column, rules=RULES) -> DataFrame:
    """The inverted index (trigram, key), of the trigrams that the rules' queries name."""
    wanted = sorted({t for r in rules for clause in trigram_query(r.regex) for t in clause})
    named = F.array(*[F.lit(t) for t in wanted])
    low = F.lower(_text())
    present = F.get(
        F.transform(F.array(low), lambda t: F.filter(named, lambda g: F.contains(t, g))), F.lit(0)
    )
    rows = docs.select(key.alias("key"), F.explode(present).alias("trigram"))
    return rows.groupBy("key", "trigram").agg(F.lit(1).alias("one")).drop("one")


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """Per key the rules of which some alternative finds all its trigrams in the index."""
    uses: dict[str, list[Column]] = {}
    for number, rule in enumerate(rules):
        for order, clause in enumerate(sorted(map(sorted, trigram_query(rule.regex)))):
            for trigram in clause:
                use = F.struct(
                    F.lit(number).alias("rule"), F.lit(order).alias("part"), F.lit(len(clause)).alias("needs")
                )
                uses.setdefault(trigram, []).append(use)
    pairs = [x for t, rows in uses.items() for x in (F.lit(t), F.array(*rows))]
    used = index.select("key", F.explode(F.create_map(*pairs)[F.col("trigram")]).alias("use"))
    met = used.groupBy("key", "use").agg(F.count(F.lit(1)).alias("found"))
    met = met.where(F.col("found") == F.col("use.needs"))
    return met.groupBy("key").agg(F.collect_set("use.rule").alias("rules"))


def verified(text: Column, rule: Rule) -> Column:
    """Matches of a rule, those with too short a value dropped."""
    found = matches(text, rule.regex)
    if rule.least <= 1:
        return found
    if not rule.value:
        return F.filter(found, lambda m: F.length(m["text"]) >= rule.least)
    value = lambda m: F.regexp_extract(m["text"], rule.regex, rule.value)
    return F.filter(found, lambda m: F.length(value(m)) >= rule.least)


def _hit(text: Column, rule: Rule) -> Column:
    """Cheap test that a rule without trigrams can match at all."""
    if rule.kind == "hex":  # runs shorter than the least length are never kept
        return F.when(F.regexp_like(text, F.lit("[0-9a-f]{16}")), matches(text, "[0-9a-f]{16,}"))
    return verified(text, rule)


def scan(docs: DataFrame, rules=RULES, name: str = "spans") -> DataFrame:
    """The documents with the secrets of the whole text: (start, rank, end, kind) in ``spans``.

    A null or empty text has no spans. Repeated rows are each scanned, an empty table gives
    an empty one. Any further columns stay; one with the name of the result is replaced. The key of the index is a hash of doc_id and text:
    should two documents share it, both are verified for the union of their rules.
    """
    key = F.xxhash64(F.col("doc_id"), _text(), F.length(_text()))
    indexed = [i for i, r in enumerate(rules) if trigram_query(r.regex) != ANYTHING]
    found = candidates(postings(docs, key, rules), rules)
    # a result column of the struct's name would be taken for the struct
    row = free_name(docs, "row")
    rows = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    joined = docs.select(rows.alias(row), key.alias("key")).join(found, "key", "left")
    text = F.coalesce(F.col(row)["text"], F.lit(""))
    kinds = []
    for number, rule in enumerate(rules):
        if number in indexed:
            hits = F.when(F.array_contains("rules", number), verified(text, rule))
        else:
            hits = _hit(text, rule)
        kinds.append(F.coalesce(as_spans(hits, number, rule.kind), no_spans()))
    kept = [F.col(row)[c].alias(c) for c in without(docs, name).columns]
    return joined.select(*kept, F.concat(*kinds).alias(name))


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """The documents with every secret replaced by a mask; clean texts stay as they are.

    ``n_chars``, where there is one, follows a changed text. Null texts stay null.
    """
    found = free_name(docs, "spans")
    out, changed = scan(docs, name=found), F.size(found) > 0
    out = out.withColumn("text", masked(F.col("text"), F.col(found), mask))
    if "n_chars" in docs.columns:
        new = F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", new)
    return out.select([F.col(f"`{c}`") for c in docs.columns])
