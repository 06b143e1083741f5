"""Phrases that occur more often than their parts explain, by stripes.

A stripe holds, for one prefix of words, a counter of the words that follow it. Tasks merge
the stripes of their own texts word by word, and Spark merges those of the tasks. From them
come the count of every extension, the total of every prefix (its slot in the stripe of the
prefix one word shorter; the stripe of the empty prefix adds up to all words) and the largest
count of a longer phrase that begins with a prefix. Regrouped by their last words, they give
the largest count of a phrase that ends with it.

Only phrases that may reach the least count get a slot. Which ones may is found first, by
sums over hashes: of pairs of words, then of single words and longer phrases all of whose
pairs may reach it. Phrases that share a hash share a sum, so no phrase that reaches the
count is lost; the hashes that reach it go to the tasks as a bitmap of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Over
from pyspark.sql import functions as F

from mostrador.llm import words as W
from mostrador.llm.common import Scratch

MOST_WORDS = 5
LEAST_COUNT = 100
COVERED_PERCENT = 100
BEST = 2_000
UNKNOWN = "und"
CHUNK_BYTES = 1 << 22

# Sums are kept per 40 bits of a hash, in blocks by the first 14; a bitmap has 2 ** 26 bits.
HASH_BITS, BLOCK_BITS, BITS = 40, 14, 26
SUMS_HELD = 1 << 21  # sums that a task holds before it hands them on
SLOTS_HELD = 1 << 18  # slots of stripes likewise
STRIPE_BLOCK_BITS = 12  # slots travel in blocks by the first bits of their phrase's hash

# What ends a word, and what ends a piece.
_ENDS_PIECE = np.zeros(256, bool)
_ENDS_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_INSIDE = ~_ENDS_PIECE
_INSIDE[[0x20, 0x09]] = False
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_SIZE_SALT = 0xA0761D6478BD642F

_BLOCK = "block int, hashes binary, sums binary"
_SLOT_BLOCK = "block int, lang array<string>, prefix array<string>, next array<string>, count array<long>"
_SLOT = "lang string, prefix string, next string, count long"
_SLOT_KEY = ["block", "lang", "prefix", "next"]


def word_hashes(found: pa.Array) -> np.ndarray:
    """A 64-bit hash of every string without blanks."""
    hashes = [W.words_of(chunk).hashes for chunk in W.chunks(found)]
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)


def phrase_hashes(words: np.ndarray, seeds: np.ndarray, size: int) -> np.ndarray:
    """40 bits per window of words, which tell languages and sizes apart; int64."""
    windows = W.follow(words, size)
    salt = np.uint64(_SIZE_SALT * size % (1 << 64))
    salted = windows ^ seeds[: len(windows)].view(np.uint64) ^ salt
    return (W.mix(salted) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def is_set(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> (HASH_BITS - BITS)
    return (bitmap[slot >> 3] >> (slot & 7) & 1).astype(bool)


class Tokens(NamedTuple):
    """Words of consecutive texts: their strings once, and per word string, piece, text and seed."""

    strings: pa.Array
    ids: np.ndarray
    piece: np.ndarray
    text: np.ndarray
    seeds: np.ndarray

    def one_piece(self, size: int) -> np.ndarray:
        """Whether the window of so many words from each word on lies in one piece."""
        n = max(len(self.ids) - size + 1, 0)
        return self.piece[:n] == self.piece[size - 1 :][:n]


def tokens_of(chunk: W.Chunk, seeds: np.ndarray) -> Tokens:
    data = _LOW[chunk.data]
    inside = _INSIDE[data]
    n = len(data)
    heads = np.zeros(n + 1, bool)
    heads[chunk.starts[:-1]] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | heads[1:n]
    at = np.flatnonzero(begins)
    kept = np.cumsum(inside, dtype=np.int64)
    offsets = np.append(kept[at] - 1, kept[-1] if n else 0)
    strings = pa.LargeStringArray.from_buffers(
        len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[inside])
    ).dictionary_encode()
    piece = np.cumsum(_ENDS_PIECE[data] | heads[:n], dtype=np.int64)[at]
    text = np.searchsorted(chunk.starts, at, "right") - 1 + chunk.row
    ids = strings.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return Tokens(strings.dictionary.cast(pa.string()), ids, piece, text, seeds[text])


def tokenized(batch: pa.RecordBatch) -> Iterator[Tokens]:
    """The texts of a batch of (text, lang, seed), some MiB at a time."""
    seeds = batch.column(2).to_numpy(zero_copy_only=False)
    for chunk in W.chunks(batch.column(0), CHUNK_BYTES):
        tokens = tokens_of(chunk, seeds)
        if len(tokens.ids):
            yield tokens


def frequent_pairs(tokens: Tokens, hashes: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Whether a pair that may reach the least count begins at each word."""
    out = np.zeros(len(hashes), bool)
    out[:-1] = tokens.one_piece(2) & is_set(bitmap, phrase_hashes(hashes, tokens.seeds, 2))
    return out


def windows_to_sum(tokens: Tokens, most_words: int, bitmap: np.ndarray | None) -> Iterator[np.ndarray]:
    """Hashes to add up: those of pairs or, with their bitmap, of what lies in pairs that are set."""
    hashes = word_hashes(tokens.strings)[tokens.ids]
    if bitmap is None:
        yield phrase_hashes(hashes, tokens.seeds, 2)[tokens.one_piece(2)]
        return
    pairs = frequent_pairs(tokens, hashes, bitmap)
    covered = pairs.copy()
    covered[1:] |= pairs[:-1]
    yield phrase_hashes(hashes, tokens.seeds, 1)[covered]
    chain = pairs
    for size in range(3, most_words + 1):
        chain = chain[:-1] & pairs[size - 2 :]
        yield phrase_hashes(hashes, tokens.seeds, size)[chain[: max(len(hashes) - size + 1, 0)]]


def added_up(keys: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each."""
    if not len(keys):
        return keys, sums
    order = np.argsort(keys, kind="stable")
    keys, sums = keys[order], sums[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(sums, first)


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, first bytes first: small numbers leave runs of zeros to compress."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def blocks_of(keys: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """Sums by hash, in a row per block of hashes; a block's hashes as differences."""
    low_bits = HASH_BITS - BLOCK_BITS
    block, low = keys >> low_bits, keys & ((1 << low_bits) - 1)
    edges = edges_of(block)
    ends = np.append(edges, len(keys))[1:]
    hashes = [_planes(np.diff(low[a:b], prepend=0)) for a, b in zip(edges, ends, strict=True)]
    counts = [_planes(sums[a:b]) for a, b in zip(edges, ends, strict=True)]
    return pa.record_batch(
        [pa.array(block[edges], pa.int32()), pa.array(hashes, pa.binary()), pa.array(counts, pa.binary())],
        ["block", "hashes", "sums"],
    )


def reaching(docs: DataFrame, least: int, most_words: int, bits: bytes | None) -> bytes:
    """The bitmap of the hashes whose sum over all texts reaches ``least``.

    A task holds a bounded number of sums, so it may hand on several rows of a block. A
    block's rows meet in one task, block after block; no sum counts beyond ``least``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if shared.value is None else np.frombuffer(shared.value, np.uint8)
        keys, sums, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), []
        for batch in batches:
            for tokens in tokenized(batch):
                waiting += windows_to_sum(tokens, most_words, bitmap)
                if sum(map(len, waiting)) >= SUMS_HELD // 2:
                    new = np.concatenate(waiting)
                    keys, sums = added_up(np.append(keys, new), np.append(sums, np.ones(len(new), np.int64)))
                    waiting = []
                    if len(keys) >= SUMS_HELD:
                        yield blocks_of(keys, np.minimum(sums, least))
                        keys, sums = keys[:0], sums[:0]
        new = np.concatenate([*waiting, keys[:0]])
        keys, sums = added_up(np.append(keys, new), np.append(sums, np.ones(len(new), np.int64)))
        yield blocks_of(keys, np.minimum(sums, least))

    def finished(block: int, rows: list[tuple[bytes, bytes]]) -> np.ndarray:
        low = np.concatenate([np.cumsum(_from_planes(h)) for h, _ in rows])
        keys, sums = added_up(low, np.concatenate([_from_planes(s) for _, s in rows]))
        hashes = (block << (HASH_BITS - BLOCK_BITS)) | keys[sums >= least]
        return np.unique(hashes >> (HASH_BITS - BITS))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = -1, []
        for batch in batches:
            found = []
            for block, hashes, sums in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if block != current and rows:
                    found.append(finished(current, rows))
                    rows = []
                current = block
                rows.append((hashes, sums))
            yield _slots(found)
        if rows:
            yield _slots([finished(current, rows)])

    blocks = docs.select("text", "lang", "seed").mapInArrow(summed, _BLOCK)
    ordered = blocks.repartition("block").sortWithinPartitions("block")
    slots = ordered.mapInArrow(merged, "slot long")
    maps = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for row in maps.collect():  # at most 2 ** BITS bits
        own = np.frombuffer(row.bits, np.uint8)
        out[(row.bucket - 1) * len(own) : row.bucket * len(own)] = own
    return out.tobytes()


def _slots(found: list[np.ndarray]) -> pa.RecordBatch:
    """Spark numbers the positions of its bitmaps from 1."""
    return pa.record_batch([pa.array(np.concatenate([*found, np.zeros(0, np.int64)]) + 1)], ["slot"])


def numbered(keys: np.ndarray) -> np.ndarray:
    """Equal keys by one small number each."""
    return pa.array(keys).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def slots_of_size(tokens: Tokens, lang: pa.DictionaryArray, hashes: np.ndarray, size: int, bitmap: np.ndarray) -> pa.Table:
    """Slots (block, lang, prefix, next, count) of the phrases of ``size`` words whose bit is set.

    Of single words the others are counted together, under ``next`` null.
    """
    langs = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)[tokens.text]
    windows = phrase_hashes(hashes, tokens.seeds, size)
    use = tokens.one_piece(size) & is_set(bitmap, windows)
    block = (windows >> (HASH_BITS - STRIPE_BLOCK_BITS)).astype(np.int32)
    rest = len(tokens.strings)
    if size == 1:
        place, last = np.arange(len(use)), np.where(use, tokens.ids, rest)
        block[~use] = 0
    else:
        place = np.flatnonzero(use)
        last = tokens.ids[place + size - 1]
    columns = [langs[place], *[tokens.ids[place + i] for i in range(size - 1)]]
    prefix = columns[0]
    for column in columns[1:]:
        prefix = numbered(prefix * (rest + 1) + column)
    _, first, count = np.unique(prefix * (rest + 1) + last, return_index=True, return_counts=True)
    parts = [tokens.strings.take(pa.array(c[first])) for c in columns[1:]]
    text = pc.binary_join_element_wise(*parts, " ") if parts else pa.array([""] * len(first), pa.string())
    following = tokens.strings.take(pa.array(last[first], mask=last[first] == rest))
    names = lang.dictionary.take(pa.array(columns[0][first]))
    return pa.table(
        [pa.array(block[place[first]]), names, text, following, pa.array(count, pa.int64())], [*_SLOT_KEY, "count"]
    )


def merged_slots(tables: list[pa.Table]) -> pa.Table:
    """Stripes merged word by word: the counts of equal slots added up."""
    sums = pa.concat_tables(tables).combine_chunks().group_by(_SLOT_KEY).aggregate([("count", "sum")])
    return sums.rename_columns({"count_sum": "count"}).select([*_SLOT_KEY, "count"])


def handed_on(slots: pa.Table) -> pa.RecordBatch:
    """A row per block of slots."""
    slots = slots.sort_by("block").combine_chunks()
    block, *columns = [c.combine_chunks() for c in slots.columns]
    starts = edges_of(block.to_numpy(zero_copy_only=False))
    offsets = pa.array(np.append(starts, len(slots)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, c) for c in columns]
    return pa.record_batch([block.take(pa.array(starts)), *lists], slots.column_names)


def edges_of(keys: np.ndarray) -> np.ndarray:
    """Where each stretch of equal keys begins."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])


def merged_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slots of rows that come in order of block, equal ones merged. What is held at a
    time are the distinct slots of one block and some rows."""
    current, held, ready, most = -1, [], [], SLOTS_HELD
    for batch in batches:
        block = batch.column(0).to_numpy(zero_copy_only=False)
        starts = edges_of(block)
        for a, b in zip(starts, np.append(starts, len(block))[1:], strict=True):
            if block[a] != current and held:
                ready.append(merged_slots(held))
                held, most = [], SLOTS_HELD
            current, part = block[a], batch.slice(a, b - a)
            columns = [part.column(i).flatten() for i in range(1, 5)]
            held.append(pa.table([pa.array(np.full(len(columns[0]), current)), *columns], [*_SLOT_KEY, "count"]))
            if sum(map(len, held)) >= most:
                held = [merged_slots(held)]
                most = max(SLOTS_HELD, 2 * len(held[0]))
        if sum(map(len, ready)) >= SLOTS_HELD // 8:
            yield from pa.concat_tables(ready).drop(["block"]).combine_chunks().to_batches()
            ready = []
    ready += [merged_slots(held)] if held else []
    if ready:
        yield from pa.concat_tables(ready).drop(["block"]).combine_chunks().to_batches()


def counted_stripes(docs: DataFrame, most_words: int, bits: bytes) -> DataFrame:
    """(lang, prefix, next, count) over all texts, ``next`` null for words without a slot.

    ``docs`` has text, lang and seed. A task merges its stripes while they are few and hands
    them on when they are not. Slots meet by the hash of prefix and word, so the stripe of a
    prefix that everything begins with is merged in many tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, held = np.frombuffer(shared.value, np.uint8), []
        for batch in batches:
            lang = batch.column(1).dictionary_encode()
            for tokens in tokenized(batch):
                hashes = word_hashes(tokens.strings)[tokens.ids]
                for size in range(1, most_words + 1):
                    held.append(slots_of_size(tokens, lang, hashes, size, bitmap))
                if sum(map(len, held)) >= SLOTS_HELD:
                    held = [merged_slots(held)]
                    if len(held[0]) >= SLOTS_HELD // 2:
                        yield handed_on(held.pop())
        if held:
            yield handed_on(merged_slots(held))

    blocks = docs.select("text", "lang", "seed").mapInArrow(run, _SLOT_BLOCK)
    return blocks.repartition("block").sortWithinPartitions("block").mapInArrow(merged_blocks, _SLOT)


def joined(*parts: str) -> Column:
    return F.concat_ws(" ", *[F.col(p) for p in parts])


def floor_ratio(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exact up to 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    over = F.lit(1000).cast("decimal(4,0)") * wide(a) * wide(n)
    return F.call_function("div", over.cast("decimal(38,0)"), (wide(left) * wide(right)).cast("decimal(38,0)"))


def collocations(
    docs: DataFrame,
    least: int = LEAST_COUNT,
    most_words: int = MOST_WORDS,
    covered_percent: int = COVERED_PERCENT,
    best: int = BEST,
) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    ``docs`` has text and lang; null texts are empty, null languages ``und``. Texts are split
    into pieces and words as the fixed values above say, A-Z lower-cased. ``a`` counts a
    phrase of 2 to ``most_words`` words inside pieces, ``n`` all words of the language;
    ``l`` and ``r`` count the two parts of the cut that explains the phrase best, whose
    floor(1000 * a * n / (l * r)) is the score. A phrase goes if a longer one that holds it
    has ``covered_percent`` of its count or more. Ties are broken by count, then bytes.
    Repeated rows count as often as they occur; an empty table gives an empty one.
    """
    if not 2 <= most_words or least < 1:
        raise ValueError("phrases have two words or more and occur at least once")
    scratch = Scratch(docs.sparkSession)
    lang = F.coalesce("lang", F.lit(UNKNOWN))
    docs = docs.select("text", lang.alias("lang"), F.xxhash64(lang).alias("seed"))

    pairs = reaching(docs, least, most_words, None)
    others = reaching(docs, least, most_words, pairs)
    bits = (np.frombuffer(pairs, np.uint8) | np.frombuffer(others, np.uint8)).tobytes()
    slots = scratch.stored(counted_stripes(docs, most_words, bits), "stripes")

    # the empty prefix is followed by every word: its stripe adds up to all words
    words = slots.where("prefix = ''").groupBy("lang").agg(F.sum("count").alias("n"))
    usual = slots.where(F.col("next").isNotNull() & (F.col("count") >= least))
    parts = usual.select(
        "lang",
        F.when(F.col("prefix") == "", F.col("next")).otherwise(joined("prefix", "next")).alias("part"),
        F.col("count").alias("f"),
    )
    found = usual.where("prefix <> ''").select("lang", "prefix", joined("prefix", "next").alias("phrase"), F.col("count").alias("a"))
    found = found.withColumn("size", F.size(F.split("phrase", " ")))
    # a phrase inside one that is longer by several words is also inside one longer by one,
    # which is no rarer; a word is no candidate, so covering it says nothing
    longer = found.where("size > 2")
    last = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    covers = longer.select("lang", F.col("prefix").alias("phrase"), "a").unionByName(
        longer.select("lang", last.alias("phrase"), "a")
    )
    covers = covers.groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    candidates = found.join(covers, ["lang", "phrase"], "left").where(
        F.col("cover").isNull() | (100 * F.col("cover") < covered_percent * F.col("a"))
    )
    candidates = scratch.stored(candidates.select("lang", "phrase", "a", "size"), "candidates")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("rest"),
    )
    left = parts.select("lang", F.col("part").alias("first"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(words, "lang")
    score = floor_ratio(F.col("a"), F.col("n"), F.col("l"), F.col("r"))
    cut = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(cut)
    order = Over.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

