"""A sparse ensemble of rules over statistics of a text, as one column expression.

Shallow trees are grown on labelled texts; every path from a root to a node is a rule, a
conjunction of comparisons. A lasso keeps few of them and gives each a weight of a logistic
model. What is left is compiled into an expression over the statistics.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.llm import words as W
from mostrador.llm.common import Scratch, free_name, without

SAMPLE_ROWS = 20_000
TREES, DEPTH = 16, 3
PENALTY = 0.002
LEAST_SCORE = 0.3
SYMBOLS = b"#*$%&|<>"
MARKS = b".,;:!?"


def _set(values: bytes | range) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


_UPPER, _LOWER, _DIGIT = _set(range(65, 91)), _set(range(97, 123)), _set(range(48, 58))
_SYMBOL, _MARK, _LINE = _set(SYMBOLS), _set(MARKS), _set(b"\n")
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80

STATISTICS = [
    "n_words", "word_length", "longest_word", "upper", "lower", "digit", "symbol", "mark", "other", "blank",
    "line_words", "line_repeats", "same_next", "same_after_next", "distinct", "pair_repeats", "triple_repeats",
    "single", "ends_marked",
]


def repeats(hashes: np.ndarray, text: np.ndarray, size: int, n: int) -> np.ndarray:
    """Per text how many of its windows of words equal an earlier one."""
    windows = W.follow(hashes, size)
    inside = text[: len(windows)] == text[size - 1 :] if len(windows) else np.zeros(0, bool)
    whose, key = text[: len(windows)][inside], windows[inside]
    order = np.lexsort((key, whose))
    whose, key = whose[order], key[order]
    again = (whose[1:] == whose[:-1]) & (key[1:] == key[:-1])
    return np.bincount(whose[1:][again], minlength=n)


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


def chunk_statistics(chunk: W.Chunk) -> np.ndarray:
    """A row per text, a column per statistic; an empty text has zeros."""
    n = len(chunk.starts) - 1
    found = W.words_of(chunk)
    text = np.repeat(np.arange(n), np.diff(found.starts))
    words = np.diff(found.starts).astype(float)
    sums = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[chunk.starts])
    shows = _FIRST_BYTE[chunk.data]
    chars, blank = sums(shows), sums(W.IS_BLANK[chunk.data])
    per_char = lambda count: count / np.maximum(chars, 1)
    per_word = lambda count: count / np.maximum(words, 1)
    # code points per word, and its last byte
    inside = ~W.IS_BLANK[chunk.data]
    edge = np.zeros(len(inside) + 1, bool)
    edge[chunk.starts] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    upto = np.concatenate([[0], np.cumsum(shows)])
    last = np.flatnonzero(ends)
    length = upto[last + 1] - upto[np.flatnonzero(begins)]
    longest = np.zeros(n)
    np.maximum.at(longest, text, length)
    same = lambda step: np.bincount(
        text[step:][(found.hashes[step:] == found.hashes[:-step]) & (text[step:] == text[:-step])], minlength=n
    )
    counts = {name: sums(kind[chunk.data]) for name, kind in (
        ("upper", _UPPER), ("lower", _LOWER), ("digit", _DIGIT), ("symbol", _SYMBOL), ("mark", _MARK), ("lines", _LINE)
    )}
    again = [
        repeated_lines(chunk.data[a:b].tobytes()) if many else 0
        for a, b, many in zip(chunk.starts[:-1], chunk.starts[1:], counts["lines"], strict=True)
    ]
    other = chars - blank - sum(counts[k] for k in ("upper", "lower", "digit", "symbol", "mark"))
    columns = {
        "n_words": words,
        "word_length": per_word(chars - blank),
        "longest_word": longest,
        **{k: per_char(counts[k]) for k in ("upper", "lower", "digit", "symbol", "mark")},
        "other": per_char(other),
        "blank": per_char(blank),
        "line_words": words / (counts["lines"] + 1),
        "line_repeats": np.array(again, float) / (counts["lines"] + 1),
        "same_next": per_word(same(1)),
        "same_after_next": per_word(same(2)),
        "distinct": per_word(words - repeats(found.hashes, text, 1, n)),
        "pair_repeats": per_word(repeats(found.hashes, text, 2, n)),
        "triple_repeats": per_word(repeats(found.hashes, text, 3, n)),
        "single": per_word(np.bincount(text[length == 1], minlength=n)),
        "ends_marked": per_word(np.bincount(text[(_SYMBOL | _MARK)[chunk.data[last]]], minlength=n)),
    }
    return np.column_stack([columns[name] for name in STATISTICS])


def statistics(docs: DataFrame, into: str = "statistics") -> DataFrame:
    """The documents without their text, with an array of the statistics of the whole text."""
    kept = without(docs, "text", into).columns
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(into, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [chunk_statistics(chunk) for chunk in W.chunks(batch.column(batch.num_columns - 1))]
            table = np.concatenate(rows) if rows else np.zeros((0, len(STATISTICS)))
            offsets = pa.array(np.arange(len(table) + 1) * len(STATISTICS), pa.int32())
            found = pa.ListArray.from_arrays(offsets, pa.array(table.reshape(-1)))
            yield pa.record_batch([*batch.columns[:-1], found], [f.name for f in schema.fields])

    text = F.col("text").alias(free_name(docs, "text"))
    return docs.select(*[F.col(f"`{c}`") for c in kept], text).mapInArrow(run, schema)


class Test(NamedTuple):
    """Is the statistic of that number at most, or else above, the limit?"""

    number: int
    at_most: bool
    limit: float

    def column(self, values: Column) -> Column:
        value = F.get(values, F.lit(self.number))
        return value <= F.lit(self.limit) if self.at_most else value > F.lit(self.limit)


Rule = tuple[Test, ...]

_BRANCH = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+|Infinity|-Infinity|NaN)\)$")


def paths(description: str) -> list[Rule]:
    """The conjunctions on the way to every node of the trees that Spark's model describes."""
    way: list[tuple[int, Test]] = []
    rules = []
    for line in description.splitlines():
        if not (found := _BRANCH.match(line)):
            continue
        depth = len(found[1])
        way = [w for w in way if w[0] < depth] + [(depth, Test(int(found[2]), found[3] == "<=", float(found[4])))]
        rules.append(simplified([t for _, t in way]))
    return sorted(set(rules))


def simplified(tests: list[Test]) -> Rule:
    """One test per statistic and side: the strictest."""
    strictest: dict[tuple[int, bool], float] = {}
    for number, at_most, limit in tests:
        known = strictest.get((number, at_most), limit)
        strictest[number, at_most] = min(known, limit) if at_most else max(known, limit)
    return tuple(sorted(Test(n, a, v) for (n, a), v in strictest.items()))


class Ensemble(NamedTuple):
    """Weighted rules and an intercept; without rules every text gets the same score."""

    rules: list[tuple[Rule, float]]
    intercept: float

    def score(self, values: Column) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule, values), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(rule: Rule, values: Column) -> Column:
    first, *rest = [test.column(values) for test in rule]
    for test in rest:
        first = first & test
    return first


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def labelled(measured: DataFrame, labels: DataFrame, rows: int, scratch: Scratch) -> DataFrame:
    """At most ``rows`` (label, statistics), those of smallest hash of id, none held out."""
    usual = labels.select("doc_id", F.col("quality").cast("double").alias("label"))
    usual = usual.where(F.col("label").isin(0.0, 1.0) & ~held_out(F.col("doc_id"))).distinct()
    # the ids come first, so that neither copies of a label nor of a document weigh more
    first = usual.join(measured.select("doc_id").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "label")
    found = measured.join(first.limit(rows), "doc_id").select("doc_id", "label", "statistics").distinct()
    # few parts: the sample is small, and every step of the lasso is a job over all of them
    return scratch.stored(found.repartition(2).sortWithinPartitions("doc_id", "label"), "labelled")


def learn(train: DataFrame, penalty: float = PENALTY) -> Ensemble:
    """Rules from a forest of shallow trees, weights from a lasso, on (label, statistics).

    With one label only, or none, there is no rule: the score is the share of good labels
    (one half where there are none), kept inside 0.01 to 0.99.
    """
    seen = {row.label: row["count"] for row in train.groupBy("label").count().collect()}
    rows = sum(seen.values())
    if len(seen) < 2:
        share = min(max(seen.get(1.0, 0) / rows, 0.01), 0.99) if rows else 0.5
        return Ensemble([], float(np.log(share / (1 - share))))
    vectors = train.select("label", "statistics", array_to_vector("statistics").alias("features"))
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, maxBins=64, featureSubsetStrategy="onethird", bootstrap=False, seed=11
    ).fit(vectors)
    rules = paths(forest.toDebugString)
    if not rules:
        return Ensemble([], float(np.log(seen[1.0] / seen[0.0])))
    values = F.col("statistics")
    flags = F.array(*[F.when(holds(rule, values), 1.0).otherwise(0.0) for rule in rules])
    lasso = LogisticRegression(regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=40, tol=1e-4)
    fitted = lasso.fit(train.select("label", array_to_vector(flags).alias("features")))
    weights = fitted.coefficients.toArray().tolist()
    return Ensemble([(r, w) for r, w in zip(rules, weights, strict=True) if w], float(fitted.intercept))


RESULT = ["held_out", "score", "predicted"]


def classify(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, least: float = LEAST_SCORE) -> DataFrame:
    """The documents without their text, with ``held_out``, ``score`` and ``predicted``.

    Only the statistics of the whole text decide. The model is fitted on at most ``rows``
    labelled documents that are not held out; ``predicted`` is 1 from a score of ``least``.
    Null and empty texts have zeros for statistics and get a score like any other. A null id
    has no label and is not held out; repeated rows get equal scores; labels other than 0
    and 1 are left out, and a document with both counts once for each. Further columns stay,
    those named like a result or ``statistics`` are replaced; an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession)
    measured = scratch.stored(statistics(without(docs, *RESULT)), "statistics")
    model = learn(labelled(measured, labels, rows, scratch))
    scored = measured.withColumn("held_out", held_out(F.col("doc_id"))).withColumn(
        "score", model.score(F.col("statistics"))
    )
    return scored.withColumn("predicted", (F.col("score") >= least).cast("int"))
