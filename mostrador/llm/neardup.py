"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A text is the weighted set of its five-word shingles: how often one occurs, times the mean
inverse document frequency of its words. Consistent weighted samples (Ioffe, 2010) agree
between two texts with a probability of their weighted Jaccard similarity; bands of samples
put similar texts into common buckets; candidates are verified by that similarity itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Over
from pyspark.sql import functions as F

from mostrador.llm import words as W
from mostrador.llm.common import Scratch, free_name, without
from mostrador.llm.components import components

SHINGLE = 5
SIMILAR = 0.8
BANDS = 12
ROWS = 3
BINS = 1 << 16
# Counts that order shingles by rarity: so many bins, by the upper bits of a shingle's hash.
SHINGLE_BINS = 1 << 18
SHINGLE_SHIFT = np.uint64(46)
# Bits that tell which shingles a text lacks, in words of 64.
MARK_WORDS = 8
# Which members of a bucket stand for it: the smallest and the largest key, under two orders.
FLIP = 0x5DEECE66D1CE4E5B

_TABLE = 1 << 16


def _gamma_table() -> np.ndarray:
    """Quantiles of the gamma distribution with shape 2, by bisection of its closed form."""
    share = (np.arange(_TABLE) + 0.5) / _TABLE
    low, high = np.zeros(_TABLE), np.full(_TABLE, 40.0)
    for _ in range(60):
        middle = (low + high) / 2
        below = 1 - (1 + middle) * np.exp(-middle) < share
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return high


GAMMA = _gamma_table().astype(np.float32)
LOG_GAMMA = np.log(_gamma_table()).astype(np.float32)
SEEDS = W.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts the words of a bin occur, over all texts, and how many texts there are."""

    def count(batch: pa.RecordBatch) -> np.ndarray:
        total = np.zeros(BINS + W.BLOCK, np.int64)
        total[BINS] = batch.num_rows
        for chunk in W.chunks(batch.column(0)):
            found = W.words_of(chunk, W.LOW_VALUES)
            text = np.repeat(np.arange(len(found.starts) - 1), np.diff(found.starts))
            pairs = np.unique((text << 16) | (found.hashes >> np.uint64(48)).astype(np.int64))
            total[:BINS] += np.bincount(pairs & 0xFFFF, minlength=BINS)
        return total

    total = W.total_counts(docs.select("text"), count, BINS + W.BLOCK)
    return total[:BINS], int(total[BINS])


def word_weights(frequencies: np.ndarray, texts: int) -> np.ndarray:
    """Inverse document frequency between 1 (in every text) and 2 (in one text).

    The range is narrow on purpose: with plain logarithms the few shingles in which two near
    copies differ, rare by nature, outweigh all that they share.
    """
    seen = np.clip(frequencies, 1, max(texts, 1))
    return 1 + np.log(max(texts, 1) / seen) / np.log(max(texts, 2))


def weighted_shingles(hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of one text, in order, and their weights.

    A text of fewer words than a shingle has is one shingle; one without a word has none.
    """
    if not len(hashes):
        return hashes, np.zeros(0)
    size = min(SHINGLE, len(hashes))
    idf = weights[(hashes >> np.uint64(48)).astype(np.int64)]
    mean = np.convolve(idf, np.ones(size) / size, "valid")
    shingles, first, times = np.unique(W.follow(hashes, size), return_index=True, return_counts=True)
    return shingles, times * mean[first]


def samples(shingles: np.ndarray, logs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A consistent weighted sample per seed and text, as hashes: (samples, texts).

    ``starts`` has the first shingle of each text; every text has one at least.
    """
    out = np.empty((len(SEEDS), len(starts)), np.uint64)
    logs = logs.astype(np.float32)
    of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(shingles))))
    for k, seed in enumerate(SEEDS):
        h = (shingles ^ seed) * W._MIX
        h ^= h >> np.uint64(29)
        h *= W._STEP
        h ^= h >> np.uint64(32)
        r = GAMMA[h >> np.uint64(48)]
        beta = (h & np.uint64(0xFFFFFFFF)).astype(np.float32) * np.float32(2.0**-32)
        t = np.floor(logs / r + beta)
        score = LOG_GAMMA[(h >> np.uint64(32)) & np.uint64(0xFFFF)] - r * (t - beta + np.float32(1))
        least = np.minimum.reduceat(score, starts)
        hits = np.flatnonzero(score == least[of])
        _, first = np.unique(of[hits], return_index=True)
        at = hits[first]
        out[k] = W.mix(shingles[at] * W._MIX + t[at].astype(np.int64).astype(np.uint64) + seed)
    return out


def band_keys(found: np.ndarray) -> np.ndarray:
    """A key per band and text."""
    bands = found.reshape(BANDS, ROWS, -1)
    key = bands[:, 0].copy()
    for i in range(1, ROWS):
        key = W.mix(key * W._MIX + bands[:, i])
    return key


def text_key(text: Column) -> Column:
    """Equal texts share it; 64 bits, so that of 10^9 different texts hardly two do."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def signatures(texts: DataFrame, shared) -> DataFrame:
    """(band, key, node) of every text with a word; ``texts`` has (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            for chunk in W.chunks(batch.column(1)):
                found = W.words_of(chunk, W.LOW_VALUES)
                ends = found.starts
                rows, parts = [], []
                for i in range(len(ends) - 1):
                    if ends[i + 1] > ends[i]:
                        rows.append(chunk.row + i)
                        parts.append(weighted_shingles(found.hashes[ends[i] : ends[i + 1]], weights))
                if not rows:
                    continue
                starts = np.cumsum([0] + [len(s) for s, _ in parts[:-1]])
                shingles = np.concatenate([s for s, _ in parts])
                logs = np.log(np.concatenate([w for _, w in parts]))
                keys = band_keys(samples(shingles, logs, starts)).view(np.int64)
                yield pa.record_batch(
                    [
                        pa.array(np.repeat(np.arange(BANDS, dtype=np.int32), len(rows))),
                        pa.array(keys.reshape(-1)),
                        pa.array(np.tile(nodes[rows], BANDS)),
                    ],
                    ["band", "key", "node"],
                )

    found = texts.select("node", "text").mapInArrow(run, "band int, key long, node long")
    # copies fold into one row before the shuffle
    return found.groupBy("band", "key", "node").agg(F.lit(1).alias("one")).drop("one")


def met_representatives(buckets: DataFrame, scratch: Scratch) -> DataFrame:
    """Every member of a bucket of two or more, with the bucket's size and representatives.

    A hot bucket is folded map-side for its representatives, and split by AQE where they
    are joined.
    """
    flipped = F.col("node").bitwiseXOR(F.lit(FLIP))
    reps = buckets.groupBy("band", "key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("node").alias("r1"),
        F.max("node").alias("r2"),
        F.min(flipped).bitwiseXOR(F.lit(FLIP)).alias("r3"),
        F.max(flipped).bitwiseXOR(F.lit(FLIP)).alias("r4"),
    )
    reps = scratch.stored(reps.where("n > 1"), "representatives")
    return scratch.stored(buckets.join(reps, ["band", "key"]), "met")


def candidate_pairs(met: DataFrame) -> DataFrame:
    """(a, b), a < b: every member of a bucket with its representatives, four at most.

    The pairs grow with the members, not with their square. What the members of a crowded
    bucket may be to each other is left to unmet_pairs().
    """
    met = met.select("node", F.explode(F.array_distinct(F.array("r1", "r2", "r3", "r4"))).alias("rep"))
    pairs = met.where("node <> rep").select(F.least("node", "rep").alias("a"), F.greatest("node", "rep").alias("b"))
    return pairs.groupBy("a", "b").agg(F.lit(1).alias("one")).drop("one")


def strangers(met: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of all members of crowded buckets whose members are not yet one class.

    Two representatives at least meet everyone, so that only from four members on a pair can
    be left unmet. Members of one class need no further link to be in it.
    """
    crowded = met.where("n > 3").select("band", "key", "node")
    named = crowded.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = scratch.stored(named, "crowded")
    mixed = named.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = scratch.stored(mixed.where("low < high").select("band", "key"), "mixed")
    return scratch.stored(named.join(mixed, ["band", "key"]).select("node", "root").distinct(), "strangers")


def shingle_counts(texts: DataFrame, shared) -> np.ndarray:
    """In how many texts the shingles of a bin occur; ``texts`` has (node, text)."""

    def count(batch: pa.RecordBatch) -> np.ndarray:
        total = np.zeros(SHINGLE_BINS, np.int64)
        for _, shingles, _ in _shingled(batch, 0, shared.value):
            total += np.bincount((shingles >> SHINGLE_SHIFT).astype(np.int64), minlength=SHINGLE_BINS)
        return total

    return W.total_counts(texts.select("text"), count, SHINGLE_BINS)


def _shingled(batch: pa.RecordBatch, column: int, weights: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Row, shingles and their weights of every text of a batch that has a word."""
    for chunk in W.chunks(batch.column(column)):
        found = W.words_of(chunk, W.LOW_VALUES)
        ends = found.starts
        for i in range(len(ends) - 1):
            if ends[i + 1] > ends[i]:
                yield chunk.row + i, *weighted_shingles(found.hashes[ends[i] : ends[i + 1]], weights)


def first_shingles(shingles: np.ndarray, weights: np.ndarray, counts: np.ndarray, least: float):
    """The rarest shingles of a text, as far as a similar text must share one of them.

    Texts of similarity ``least`` have that share of either one's weight in common. If the
    first shingle in common, in one order for all texts, came after more than the rest of
    the weight, less than that share would follow. Gives shingles and the weight before each.
    """
    order = np.lexsort((shingles, counts[(shingles >> SHINGLE_SHIFT).astype(np.int64)]))
    weight = weights[order]
    before = np.cumsum(weight) - weight
    first = before <= (1 - least) * weight.sum() + 1e-9
    return shingles[order][first], before[first]


def shingle_marks(shingles: np.ndarray) -> np.ndarray:
    """A bit for every shingle, by its hash, in ``MARK_WORDS`` numbers."""
    bits = np.zeros(64 * MARK_WORDS, np.uint8)
    bits[(W.mix(shingles) % np.uint64(64 * MARK_WORDS)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def most_common(one: str, two: str) -> Column:
    """A bound on the weight that two texts can have in common.

    A bit that only one of them has set stands for a shingle that the other lacks, which weighs
    at least what the lightest shingle of its text does. In a very long text all bits are set
    and the bound says nothing.
    """

    def most(has: str, lacks: str) -> Column:
        alone = [F.bit_count(F.col(f"{has}.m{i}").bitwiseAND(F.bitwise_not(F.col(f"{lacks}.m{i}")))) for i in range(MARK_WORDS)]
        return F.col(f"{has}.total") - F.col(f"{has}.lightest") * sum(alone[1:], alone[0])

    return F.least(most(one, two), most(two, one))


def unmet_pairs(unmet: DataFrame, texts: DataFrame, shared, scratch: Scratch, least: float) -> DataFrame:
    """(a, b), a < b: all pairs of strangers of different classes that can reach a similarity.

    An exact way for what representatives leave out: similar texts share one of their rarest
    shingles, and what follows it weighs enough on both sides (prefix and position filter,
    Xiao et al., 2008), and neither lacks too many of the other's (most_common). A passage that
    many texts share comes last in that order, so those that have only it in common do not meet.
    """
    spark = unmet.sparkSession
    whole = scratch.stored(texts.join(unmet.hint("merge"), "node").select("node", "root", "text"), "unmet")
    counts = spark.sparkContext.broadcast(shingle_counts(whole, shared))
    schema = "shingle long, node long, root long, before double, total double, lightest double"
    names = ["shingle", "node", "root", "before", "total", "lightest", *[f"m{i}" for i in range(MARK_WORDS)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, roots = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, shingles, weights in _shingled(batch, 2, shared.value):
                first, before = first_shingles(shingles, weights, counts.value, least)
                n, marks = len(first), shingle_marks(shingles)
                yield pa.record_batch(
                    [
                        pa.array(first.view(np.int64)),
                        pa.array(np.full(n, nodes[row])),
                        pa.array(np.full(n, roots[row])),
                        pa.array(before),
                        pa.array(np.full(n, weights.sum())),
                        pa.array(np.full(n, weights.min())),
                        *[pa.array(np.full(n, m)) for m in marks],
                    ],
                    names,
                )

    found = whole.mapInArrow(run, f"{schema}, {', '.join(f'm{i} long' for i in range(MARK_WORDS))}")
    found = scratch.stored(found, "first_shingles")
    a, b = found.alias("a"), found.alias("b")
    follows = F.least(F.col("a.total") - F.col("a.before"), F.col("b.total") - F.col("b.before"))
    needed = (F.col("a.total") + F.col("b.total")) * F.lit(least / (1 + least)) - F.lit(1e-6)
    enough = (follows >= needed) & (most_common("a", "b") >= needed)
    meet = (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.root") != F.col("b.root"))
    pairs = a.join(b.hint("merge"), meet & enough).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    return pairs.groupBy("a", "b").agg(F.lit(1).alias("one")).drop("one")


def similarity(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two texts' weighted shingles."""
    _, i, j = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    common = np.minimum(one[1][i], two[1][j]).sum()
    total = one[1].sum() + two[1].sum() - common
    return float(common / total) if total else 0.0


def verified(pairs: DataFrame, texts: DataFrame, shared, least: float = SIMILAR) -> DataFrame:
    """The pairs (a, b) whose similarity reaches the threshold, with it; ``texts`` has (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, recent = shared.value, {}

        def shingled(node: int, text: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
            if node not in recent:
                if len(recent) >= 64:
                    recent.pop(next(iter(recent)))
                chunk = next(W.chunks(pa.array([text.as_py()], pa.large_string())))
                recent[node] = weighted_shingles(W.words_of(chunk, W.LOW_VALUES).hashes, weights)
            return recent[node]

        for batch in batches:
            a, b, one, two = batch.columns
            found = [
                similarity(shingled(x, one[i]), shingled(y, two[i]))
                for i, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist(), strict=True))
            ]
            keep = np.flatnonzero(np.array(found) >= least - 1e-12)
            out = pa.array(np.array(found)[keep], pa.float64())
            yield pa.record_batch([a.take(pa.array(keep)), b.take(pa.array(keep)), out], ["a", "b", "similarity"])

    first = texts.select(F.col("node").alias("a"), F.col("text").alias("one"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("two"))
    # neither side has a bound, so neither is ever broadcast
    both = pairs.join(first.hint("merge"), "a").join(second.hint("merge"), "b").select("a", "b", "one", "two")
    return both.mapInArrow(run, "a long, b long, similarity double")


def linked(docs: DataFrame, scratch: Scratch, least: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b, similarity) between different texts, and (node, root) of all linked.

    Texts meet the representatives of their buckets first. Those that share a crowded bucket
    and are then still of different classes meet in unmet_pairs(), so that no class depends on
    who stands for a bucket.
    """
    texts = docs.select(text_key(F.col("text")).alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    weights = word_weights(*document_frequencies(texts))
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    buckets = scratch.stored(signatures(texts, shared), "buckets")
    met = met_representatives(buckets, scratch)
    pairs = scratch.stored(candidate_pairs(met), "pairs")
    needed = scratch.stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "needed")
    # copies fold map-side before the shuffle; a semi join would be pushed below that fold
    whole = texts.groupBy("node").agg(F.first("text").alias("text"))
    whole = scratch.stored(whole.join(needed.hint("merge"), "node"), "texts")
    found = scratch.stored(verified(pairs, whole, shared, least), "links")
    roots = components(found.select("a", "b"), scratch)

    unmet = strangers(met, roots, scratch)
    left = scratch.stored(unmet_pairs(unmet, whole, shared, scratch, least), "unmet_pairs")
    more = scratch.stored(verified(left, whole, shared, least), "more_links")
    first, second = unmet.toDF("a", "root_a"), unmet.toDF("b", "root_b")
    between = more.join(first, "a").join(second, "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    merged = components(between, Scratch(docs.sparkSession))
    renamed = roots.join(merged.toDF("root", "new"), "root", "left").select("node", F.coalesce("new", "root").alias("root"))
    single = merged.join(roots.select("node"), "node", "left_anti")
    return found.unionByName(more), scratch.stored(renamed.unionByName(single), "all_roots")


def links(docs: DataFrame, scratch: Scratch, least: float = SIMILAR) -> DataFrame:
    """Verified links (a, b, similarity) between different texts, by their keys."""
    return linked(docs, scratch, least)[0]


def classes(docs: DataFrame, least: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """A row per document and one per class.

    The first has doc_id, node, class_key, class_id, class_size and n_links; the second
    class_key, class_id, class_size and the node of the document that stands for it. Class
    members are equal texts and texts that a chain of links joins. ``class_id`` is the
    smallest doc_id (null only if all are), ``class_key`` the smallest text key. Null texts
    count as empty; all texts that are equal form a class, also those without a word.
    """
    scratch = Scratch(docs.sparkSession)
    slim = scratch.stored(docs.select("doc_id", text_key(F.col("text")).alias("node")), "slim")
    found, roots = linked(docs, scratch, least)
    degree = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    nodes = slim.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
    nodes = nodes.join(roots, "node", "left").join(degree, "node", "left")
    nodes = scratch.stored(
        nodes.select("node", "least_id", "copies", F.coalesce("root", "node").alias("class_key"), F.coalesce("n_links", F.lit(0)).alias("n_links")),
        "nodes",
    )
    first = F.min(F.struct(F.col("least_id").isNull(), "least_id", "node")).alias("first")
    groups = nodes.groupBy("class_key").agg(first, F.sum("copies").alias("class_size"))
    groups = scratch.stored(
        groups.select("class_key", F.col("first.least_id").alias("class_id"), "class_size", F.col("first.node").alias("stands")),
        "classes",
    )
    named = scratch.stored(nodes.select("node", "class_key", "n_links").join(groups.drop("stands"), "class_key"), "members")
    return slim.join(named, "node").select("doc_id", "node", "class_key", "class_id", "class_size", "n_links"), groups


def near_duplicates(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """A row per document: doc_id, class_id, class_key, class_size, n_links, and whether it is kept.

    ``n_links`` counts the verified links of its text to different texts. Of a class the
    document with the smallest id is kept; repeated rows of it are all marked.
    """
    rows, groups = classes(docs, least)
    standing = groups.select(F.col("class_key"), "stands")
    rows = rows.join(standing, "class_key")
    kept = (F.col("node") == F.col("stands")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return rows.select("doc_id", "class_id", "class_key", "class_size", "n_links", kept.alias("kept"))


def deduplicated(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """One document of each class, with all its columns: the one with the smallest id.

    Of repeated rows one stays. An empty table gives an empty one.
    """
    _, groups = classes(docs, least)
    node, place = free_name(docs, "node"), free_name(docs, "place")
    order = [F.col("doc_id").asc_nulls_last()]
    one = docs.withColumn(node, text_key(F.col("text")))
    one = one.withColumn(place, F.row_number().over(Over.partitionBy(node).orderBy(*order)))
    standing = groups.select(F.col("stands").alias(node))
    return without(one.where(F.col(place) == 1).join(standing, node, "left_semi"), node, place)
