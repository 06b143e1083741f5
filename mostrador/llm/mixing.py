"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order, and again from the start once
it is through. The virtual finish time of a document is the words of its queue up to and
with it, over the source's target. Sorted by that time, any prefix of the mix holds the
sources in the ratio of their targets; the mix ends where the total budget is used up.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Over
from pyspark.sql import functions as F

from mostrador.llm.common import Scratch, power_of_two, without, word_count
from mostrador.llm.sharding import numbered

# Weights of the sources in their order, repeated; share of all words; most repeats.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
SEED = "mix"

PREFIX_ROWS = 20_000
BINS = 4_096


class Cut(NamedTuple):
    """The last place of the mix: virtual finish time, rank of the source, words of its queue."""

    finish: float
    rank: int
    queued: int


def shuffle_key(seed: str = SEED) -> Column:
    """The order inside a queue: a hash of id and text, so that reruns agree."""
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}|"), doc, F.lit("|"), F.coalesce(F.col("text"), F.lit(""))))


def with_targets(totals: DataFrame, scratch: Scratch, weights=WEIGHTS, share=SHARE, repeats=REPEATS) -> DataFrame:
    """Sources (unnamed, name, source_size) with rank and target.

    The budget is shared out by weight; a source stops at ``repeats`` times its size and the
    excess goes to the others by weight, until none is above. Each round is one sum over the
    sources; only three numbers reach the driver.
    """
    ranked, _ = numbered(totals, [F.col("unnamed"), F.col("name")], "rank", scratch)
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = ranked.withColumn("weight", F.get(cycle, F.pmod("rank", F.lit(len(weights))).cast("int")))
    ranked = scratch.stored(ranked, "sources")
    most = F.col("source_size") * repeats
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    left, weight, stopped = budget, ranked.agg(F.sum("weight")).first()[0] or 1, 0
    while True:
        stops = most * F.lit(weight) < F.col("weight") * F.lit(left)
        row = ranked.agg(
            F.sum(F.when(stops, most)).alias("taken"),
            F.sum(F.when(~stops, F.col("weight"))).alias("weight"),
            F.count(F.when(stops, 1)).alias("stopped"),
        ).first()
        if row.stopped == stopped or not row.weight:
            break
        stopped, left, weight = row.stopped, budget - (row.taken or 0), row.weight
    open_share = F.col("weight") * F.lit(float(left)) / F.lit(float(weight))
    target = F.when(stops, most.cast("double")).otherwise(F.least(open_share, most.cast("double")))
    return scratch.stored(ranked.select("unnamed", "name", "source_size", "rank", target.alias("target")), "targets")


def queued(rows: DataFrame, starts: DataFrame, digits: int) -> DataFrame:
    """Rows with the words of their queue up to and with them.

    A queue is cut by the first digits of the shuffle key; ``starts`` has the words before
    each cut, so no task holds a whole source.
    """
    cut = ["unnamed", "name", "prefix"]
    keyed = rows.withColumn("prefix", F.substring("key", 1, digits))
    running = Over.partitionBy(*cut).orderBy("key").rowsBetween(Over.unboundedPreceding, 0)
    return keyed.join(starts, cut).withColumn("queued", F.col("before") + F.sum("size").over(running))


def copies(rows: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """A row per document and turn of its queue, with the virtual finish time."""
    turns = rows.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    words = F.col("queued") + F.col("turn") * F.col("source_size")
    return turns.withColumn("queued", words).withColumn("finish", F.col("queued") / F.col("target"))


def find_cut(queue: DataFrame, budget: float) -> Cut:
    """The last place that the budget covers, by sums over ever finer ranges.

    Up to time 1 no source is past its target. Beyond it the range of finish times in which
    the budget ends is cut into bins, and the bin where it ends again, until one time is
    left. Its rows, however many share it, are told apart likewise by the rank of their
    source, and those of one source by the words of its queue. At most ``BINS`` + 1 sums
    reach the driver at a time.
    """
    used = queue.agg(
        F.sum("size").alias("all"),
        F.sum(F.when(F.col("finish") <= 1, F.col("size"))).alias("early"),
        F.min(F.when(F.col("finish") > 1, F.col("finish"))).alias("first"),
        F.max("finish").alias("last"),
    ).first()
    if (used.all or 0) <= budget:
        return Cut(float("inf"), 0, 0)
    spent, low, high = used.early or 0, used.first, used.last
    if low is None:  # not even the queues' first turns fit: no target beyond the sources' sizes
        return Cut(1.0, 2**31, 2**62)
    rows, found = queue, []
    for key, following in zip(Cut._fields, (*Cut._fields[1:], None), strict=True):
        while low < high:
            spent, low, high = _ending_bin(rows, key, low, high, spent, budget)
        found.append(low)
        rows = rows.where(F.col(key) == F.lit(low))
        if following:
            low, high = rows.agg(F.min(following), F.max(following)).first()
    # the row of that place is the first that the budget does not cover
    return Cut(found[0], found[1], found[2] - 1)


def _ending_bin(rows: DataFrame, key: str, low, high, spent: int, budget: float) -> tuple:
    """Of equal bins from ``low`` to ``high``: words spent before the one in which the budget
    ends, and the first and last value in that one."""
    width = (high - low) / BINS
    bins = rows.where(F.col(key).between(F.lit(low), F.lit(high))).groupBy(
        F.floor((F.col(key) - F.lit(low)) / F.lit(width)).alias("bin")
    )
    sums = bins.agg(F.sum("size").alias("words"), F.min(key).alias("first"), F.max(key).alias("last"))
    for found in sorted(sums.collect()):
        if spent + found.words > budget:
            break
        spent += found.words
    return spent, found.first, found.last


def mix(docs: DataFrame, keep: list[str] | None = None, weights=WEIGHTS, share=SHARE, repeats=REPEATS) -> DataFrame:
    """The documents with size, source_size, target, finish and turns.

    ``turns`` is how often the mix takes the document, ``finish`` its first virtual finish
    time; a document without a word (null or empty text, too) has null and is never taken. A
    null source is a source of its own, after the named ones. Repeated rows are queued as
    often as they occur. ``keep`` names the columns to carry along, all by default; those
    named like a result are replaced. An empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession)
    added = ["size", "source_size", "target", "finish", "turns"]
    kept = [c for c in without(docs, *added).columns if keep is None or c in keep]
    shape = [
        F.col("source").isNull().alias("unnamed"),
        F.coalesce("source", F.lit("")).alias("name"),
        word_count(F.col("text")).alias("size"),
        shuffle_key().alias("key"),
    ]
    slim = scratch.stored(docs.select(*shape), "slim")
    digits = len(f"{power_of_two(slim.count() / PREFIX_ROWS, 256) - 1:x}")
    cuts = scratch.stored(
        slim.groupBy("unnamed", "name", F.substring("key", 1, digits).alias("prefix")).agg(F.sum("size").alias("words")),
        "cuts",
    )
    totals = cuts.groupBy("unnamed", "name").agg(F.sum("words").alias("source_size"))
    sources = with_targets(totals, scratch, weights, share, repeats)
    earlier = Over.partitionBy("unnamed", "name").orderBy("prefix").rowsBetween(Over.unboundedPreceding, -1)
    starts = cuts.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    starts = scratch.stored(starts.join(sources, ["unnamed", "name"]), "starts")
    queue = scratch.stored(
        queued(slim.where("size > 0"), starts, digits).select("size", "queued", "source_size", "target", "rank"), "queue"
    )
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    cut = find_cut(copies(queue, repeats), budget)
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), *shape)
    placed = queued(wide, starts, digits)
    place = lambda t: F.struct(
        ((F.col("queued") + t * F.col("source_size")) / F.col("target")).alias("finish"),
        F.col("rank").cast("long").alias("rank"),
        (F.col("queued") + t * F.col("source_size")).alias("queued"),
    )
    last = F.struct(
        F.lit(cut.finish).alias("finish"), F.lit(cut.rank).cast("long").alias("rank"), F.lit(cut.queued).cast("long").alias("queued")
    )
    taken = sum((F.when(place(t) <= last, 1).otherwise(0) for t in range(repeats)), F.lit(0))
    some = F.col("size") > 0
    return placed.select(
        *[F.col("row")[c].alias(c) for c in kept],
        "size",
        "source_size",
        "target",
        F.when(some, F.col("queued") / F.col("target")).alias("finish"),
        F.when(some, taken).otherwise(0).alias("turns"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: the documents, each as often as it is taken, in no particular order."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text", "source")
    turns = mix(rows, keep=["row"]).where("turns > 0")
    return turns.select("row", F.explode(F.sequence(F.lit(1), F.col("turns")))).select("row.*")


def in_order(docs: DataFrame, weights=WEIGHTS, share=SHARE, repeats=REPEATS) -> DataFrame:
    """The mix as a range-sorted table: its rows by virtual finish time, turn by turn."""
    rows = mix(docs, None, weights, share, repeats).where("turns > 0")
    turns = rows.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    finish = F.col("finish") + F.col("turn") * F.col("source_size") / F.col("target")
    return turns.withColumn("finish", finish).drop("turns").orderBy("finish", "source", "turn")
