"""Language identification in two steps: the family first, then the language within it.

Features are hashed byte trigrams of the lower-cased letters. Linear support vector machines,
one per pair, vote: between families, and between the languages of the winning family.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Over
from pyspark.sql import functions as F

from mostrador.llm import words as W
from mostrador.llm.common import free_name, without

BINS = 1 << 13
SAMPLE_ROWS = 2_000
UNKNOWN = "und"

# Common knowledge: ISO 639-1 codes by family. A code not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb",
    "romance": "fr es it pt ca ro gl oc",
    "slavic": "ru uk be pl cs sk bg sr hr sl mk",
    "uralic": "fi et hu",
    "indic": "hi bn ur mr gu pa ne",
    "turkic": "tr az kk uz",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def trigram_bins(chunk: W.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Bins of the byte trigrams, and the text of each; other bytes than letters' are blanks."""
    data = np.where(_LETTER[chunk.data], chunk.data, 32).astype(np.uint32)
    text = np.repeat(np.arange(len(chunk.starts) - 1), np.diff(chunk.starts))
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    use = (text[2:] == text[:-2]) & (data[1:-1] != 32)
    bins = (code[use] * np.uint32(2654435761)) >> np.uint32(32 - 13)
    return bins.astype(np.int64), text[2:][use]


def features(texts: pa.Array) -> np.ndarray:
    """Shares of the bins, a row per text."""
    out = np.zeros((len(texts), BINS), np.float32)
    for chunk in W.chunks(pc.utf8_lower(texts)):
        bins, text = trigram_bins(chunk)
        n = len(chunk.starts) - 1
        counts = np.bincount(text * BINS + bins, minlength=n * BINS).reshape(n, BINS)
        out[chunk.row : chunk.row + n] = counts
    return out / np.maximum(out.sum(1, keepdims=True), 1)


def train_machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss, by dual coordinate descent."""
    n = len(y)
    w, alpha = np.zeros(x.shape[1], np.float32), np.zeros(n)
    square = (x * x).sum(1) + 1 / (2 * cost)
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(n):
            slope = y[i] * (x[i] @ w) - 1 + alpha[i] / (2 * cost)
            new = max(alpha[i] - slope / square[i], 0.0)
            if new != alpha[i]:
                w += np.float32((new - alpha[i]) * y[i]) * x[i]
                moved = max(moved, abs(slope))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


class Machine(NamedTuple):
    first: str
    second: str
    weights: np.ndarray


class Model(NamedTuple):
    """Machines between families and, by family, between its languages."""

    families: dict[str, list[str]]
    between: list[Machine]
    within: dict[str, list[Machine]]


def pairwise(names: list[str], x: np.ndarray, given: np.ndarray) -> list[Machine]:
    machines = []
    for a, b in combinations(names, 2):
        rows = (given == a) | (given == b)
        machines.append(Machine(a, b, train_machine(x[rows], np.where(given[rows] == a, 1.0, -1.0))))
    return machines


def train(x: np.ndarray, langs: np.ndarray) -> Model:
    x = np.hstack([np.sqrt(x), np.ones((len(x), 1), np.float32)])
    of = {lang: FAMILY_OF.get(lang, lang) for lang in sorted(set(langs))}
    families: dict[str, list[str]] = {}
    for lang, family in of.items():
        families.setdefault(family, []).append(lang)
    given = np.array([of[lang] for lang in langs])
    between = pairwise(sorted(families), x, given)
    within = {f: pairwise(names, x, langs) for f, names in families.items()}
    return Model(families, between, within)


def ballot(names: list[str], machines: list[Machine], margins: dict[int, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The winner's index per row, by votes, then margins, then name; and a score from 0 to 1."""
    votes, sums = np.zeros((n, len(names))), np.zeros((n, len(names)))
    at = {name: i for i, name in enumerate(names)}
    for m in machines:
        margin = margins[id(m)]
        a, b = at[m.first], at[m.second]
        votes[:, a] += margin >= 0
        votes[:, b] += margin < 0
        sums[:, a] += np.tanh(margin)
        sums[:, b] -= np.tanh(margin)
    best = np.argmax(votes + sums / (2 * len(names) + 1), axis=1)
    least = np.full(n, np.inf)
    for m in machines:
        margin = margins[id(m)]
        for name, sign in ((m.first, 1), (m.second, -1)):
            won = best == at[name]
            least[won] = np.minimum(least[won], sign * margin[won])
    return best, 1 / (1 + np.exp(-4 * np.minimum(least, 50)))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def predict(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    n = len(texts)
    names, scores = np.full(n, UNKNOWN, object), np.zeros(n)
    if not model.families:
        return names.tolist(), scores
    machines = model.between + [m for f in model.within.values() for m in f]
    weights = np.array([m.weights for m in machines] or np.zeros((0, BINS + 1)))
    families = sorted(model.families)
    for chunk in W.chunks(pc.utf8_lower(texts)):
        bins, text = trigram_bins(chunk)
        rows = len(chunk.starts) - 1
        values = np.zeros((len(machines), rows))
        if len(machines) and len(bins):
            # the square root of a share needs the counts of distinct (text, bin) pairs
            pairs, counts = np.unique(text * BINS + bins, return_counts=True)
            of, which = pairs // BINS, pairs % BINS
            share = np.sqrt(counts / np.bincount(text, minlength=rows)[of])
            for k in range(len(machines)):
                values[k] = np.bincount(of, weights[k, which] * share, minlength=rows)
        values += weights[:, -1:]
        margins = {id(m): values[k] for k, m in enumerate(machines)}
        family, sure = ballot(families, model.between, margins, rows)
        for f, name in enumerate(families):
            here = np.flatnonzero(family == f)
            if not len(here):
                continue
            langs, own = model.families[name], model.within[name]
            best, score = ballot(langs, own, {id(m): margins[id(m)][here] for m in own}, len(here))
            names[chunk.row + here] = np.array(langs, object)[best]
            scores[chunk.row + here] = np.minimum(sure[here], score)
    for i, text in enumerate(texts.to_pylist()):
        if not has_letter(text):
            names[i], scores[i] = UNKNOWN, 0.0
    return names.tolist(), scores


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def learn(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fitted on at most ``rows`` labelled texts that are not held out, shared out among the languages.

    Of every language those texts are taken whose hash of id and text is smallest. The hashes
    are found without carrying texts; only the chosen ones reach the driver, as features.
    """
    usable = docs.select("doc_id", "text", "lang").where(
        "doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL"
    )
    usable = usable.where(~held_out(F.col("doc_id"))).withColumn("key", F.xxhash64("doc_id", "text"))
    langs = max(1, usable.select("lang").distinct().count())
    each = max(1, rows // langs)
    ranked = usable.select("lang", "key").withColumn(
        "place", F.row_number().over(Over.partitionBy("lang").orderBy("key"))
    )
    chosen = ranked.where(F.col("place") <= each).select("lang", "key").distinct()
    picked = usable.join(F.broadcast(chosen), ["lang", "key"], "left_semi")
    picked = picked.groupBy("lang", "key").agg(F.first("text").alias("text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                x = features(part.column(2))
                used = [np.flatnonzero(row) for row in x]
                sparse = [[u.astype(np.int32).tobytes() for u in used], [row[u].tobytes() for row, u in zip(x, used, strict=True)]]
                columns = [part.column(0), part.column(1), *[pa.array(s, pa.binary()) for s in sparse]]
                yield pa.record_batch(columns, ["lang", "key", "bins", "shares"])

    found = picked.mapInArrow(vectors, "lang string, key long, bins binary, shares binary").collect()
    found.sort(key=lambda r: (r.lang, r.key))
    x = np.zeros((len(found), BINS), np.float32)
    for i, r in enumerate(found):
        x[i, np.frombuffer(r.bins, np.int32)] = np.frombuffer(r.shares, np.float32)
    return train(x, np.array([r.lang for r in found], object))


def predictions(model: Model, text: Column) -> Column:
    """The language of a text and its score, as a struct. Only texts go to Python, some MiB at a time."""

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [predict(model, texts.slice(c.row, len(c.starts) - 1)) for c in W.chunks(texts)]
            names = pa.array([name for part, _ in parts for name in part], pa.string())
            scores = pa.array(np.concatenate([np.zeros(0), *[score for _, score in parts]]))
            yield pa.StructArray.from_arrays([names, scores], ["lang_pred", "score"])

    return predicted(text)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents with ``held_out``, ``lang_pred`` and ``score``.

    Only the text decides. A null text or one without a letter is ``und`` with score 0, and so
    is everything if nothing could be learned. Repeated rows get equal predictions; further
    columns stay, those named like a result are replaced.
    """
    model = learn(docs) if model is None else model
    plain = without(docs, "held_out", "lang_pred", "score")
    kept, found = [F.col(f"`{c}`") for c in plain.columns], free_name(docs, "found")
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    scored = plain.select(*kept, out, predictions(model, F.col("text")).alias(found))
    return scored.select(*kept, "held_out", f"{found}.lang_pred", f"{found}.score")


def in_a_language(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The documents whose text is in a language that was learned, with all their columns."""
    model = learn(docs) if model is None else model
    return docs.where(predictions(model, F.col("text"))["lang_pred"] != UNKNOWN)
