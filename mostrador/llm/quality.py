"""Quality rules: counts of a text, and how much its words resemble a trusted target.

Words and pairs of words are hashed into a fixed number of bins. One multinomial comes from
trusted texts, one from the raw corpus; the mean log-likelihood ratio of a text's n-grams,
against a fixed threshold, decides about it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.llm import words as W
from mostrador.llm.common import free_name, without

BINS = 1 << 16
TRUSTED_ROWS = 20_000
PRIOR = 20.0
LEAST_RATIO = -0.1

# What counts as a symbol, and the base rule's limits.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50

BLANKS = " \t\n\r\x0b\x0c"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def grams(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the words and word pairs of consecutive texts, and the text each belongs to."""
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    pairs = W.follow(hashes, 2)
    inside = text[1:] == text[:-1] if len(text) > 1 else np.zeros(0, bool)
    bins = np.concatenate([hashes, pairs[inside]]) >> np.uint64(48)
    return bins.astype(np.int64) % BINS, np.concatenate([text, text[1:][inside]])


def gram_counts(docs: DataFrame, trusted: str) -> np.ndarray:
    """Counts per bin over all texts, and over those whose column ``trusted`` is true: (2, BINS)."""

    def count(batch: pa.RecordBatch) -> np.ndarray:
        total = np.zeros((2, BINS), np.int64)
        marks = np.asarray(batch.column(1).fill_null(False).to_pylist(), bool)
        for chunk in W.chunks(batch.column(0)):
            found = W.words_of(chunk)
            bins, text = grams(found.hashes, found.starts)
            total[0] += np.bincount(bins, minlength=BINS)
            total[1] += np.bincount(bins[marks[chunk.row + text]], minlength=BINS)
        return total.reshape(-1)

    return W.total_counts(docs.select("text", trusted), count, 2 * BINS).reshape(2, BINS)


def log_ratios(counts: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Per bin the log of its share of the target over its share of the corpus.

    ``prior`` corpus counts that carry no evidence are added to every bin, so that words too
    rare to say anything weigh next to nothing, whatever the size of the corpus.
    """
    raw, target = counts.astype(float)
    share = target.sum() / max(raw.sum(), 1.0)
    return np.log((target + prior * share) / (raw + prior) / share)


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """At most ``rows`` ids of texts labelled good and not toxic, those of smallest hash."""
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL")
    order = F.xxhash64("doc_id")
    return good.select("doc_id").distinct().orderBy(order, "doc_id").limit(rows)


def repeated_words(hashes: np.ndarray, starts: np.ndarray, size: int = 3) -> np.ndarray:
    """Per text the words inside windows of ``size`` words that occur twice or more in it."""
    out = np.zeros(len(starts) - 1, np.int64)
    for i, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
        windows = W.follow(hashes[a:b], size)
        if len(windows) < 2:
            continue
        ordered = np.sort(windows)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(twice):
            again = np.isin(windows, twice)
            covered = np.zeros(b - a, bool)
            for shift in range(size):
                covered[shift : shift + len(windows)] |= again
            out[i] = covered.sum()
    return out


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


RESULT = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(),
    "ratio": pa.float64(),
    "kept": pa.bool_(),
}


def measured(texts: pa.Array, weights: np.ndarray, least: float) -> list[pa.Array]:
    n = len(texts)
    out = {name: np.zeros(n, bool if kind == pa.bool_() else float if kind == pa.float64() else np.int64) for name, kind in RESULT.items()}
    for chunk in W.chunks(texts):
        found = W.words_of(chunk)
        here = slice(chunk.row, chunk.row + len(chunk.starts) - 1)
        sums = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[chunk.starts])  # noqa: E731, B023
        out["n_words"][here] = np.diff(found.starts)
        out["word_chars"][here] = sums(~W.IS_BLANK[chunk.data] & ((chunk.data & 0xC0) != 0x80))
        out["n_symbols"][here] = sums(_SYMBOL[chunk.data])
        out["n_repeat_words"][here] = repeated_words(found.hashes, found.starts)
        bins, text = grams(found.hashes, found.starts)
        total = np.bincount(text, weights[bins], minlength=len(chunk.starts) - 1)
        count = np.bincount(text, minlength=len(chunk.starts) - 1)
        out["ratio"][here] = total / np.maximum(count, 1)
    out["n_dup_lines"][:] = [repeated_lines(t) if t and "\n" in t else 0 for t in texts.to_pylist()]
    few, many = out["n_words"] < LEAST_WORDS, 100 * out["n_repeat_words"] > MOST_REPEATED * out["n_words"]
    out["base_failed"] = few | many
    out["kept"] = ~out["base_failed"] & (out["ratio"] >= least)
    return [pa.array(out[name], kind) for name, kind in RESULT.items()]


def judge(docs: DataFrame, labels: DataFrame, least: float = LEAST_RATIO, rows: int = TRUSTED_ROWS) -> DataFrame:
    """The documents with the base counts, the log-likelihood ratio and ``kept``.

    The trusted target is fitted on at most ``rows`` documents that ``labels`` calls good
    and not toxic, the raw multinomial on all documents. A text without words has ratio 0
    and fails the base rule, so it is not kept; null counts as empty. Without any trusted
    text all ratios are near 0 and the base rule alone decides. Repeated rows count as often
    as they occur. Further columns stay; those named like a result are replaced.
    """
    mark = free_name(docs, "trusted")
    ids = F.broadcast(trusted_ids(labels, rows).withColumn(mark, F.lit(True)))
    weights = np.zeros(BINS)
    counts = gram_counts(docs.select("doc_id", "text").join(ids, "doc_id", "left"), mark)
    if counts[1].any():
        weights = log_ratios(counts)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    kept = without(docs, *RESULT).columns
    fields = [docs.schema[c] for c in kept]
    kinds = [T.LongType()] * 5 + [T.BooleanType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType(fields + [T.StructField(n, k) for n, k in zip(RESULT, kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = measured(batch.column(batch.num_columns - 1), shared.value, least)
            yield pa.record_batch([*batch.columns[:-1], *new], [f.name for f in schema.fields])

    columns = [F.col(f"`{c}`") for c in kept] + [F.col("text").alias(free_name(docs, "text"))]
    return docs.select(*columns).mapInArrow(run, schema)
