"""Periodic runs: stretches of words that repeat with a period, two times or more.

A suffix automaton of the words holds every substring; its links form a tree whose path from
the root to the node of a prefix names the substrings that end there. Words are appended one
by one: the access of a link-cut tree recolours that path with the place of the word, and
every segment it meets holds substrings that last ended at one earlier place. If that place
is no further away than the longest of them is long, two copies touch: a square, and the
squares of one run follow each other word by word.

The automaton sees only words that can lie in a run: those covered by windows of words that
occur twice within a stretch, found for many texts at a time in numpy.
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

LEAST_LENGTH = 12
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def suffix_automaton(word: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Link and longest length per state, 0 being the root, and the state of every prefix."""
    follow: list[dict[int, int]] = [{}]
    link, length, prefix = [-1], [0], []
    last = 0
    for c in word:
        state = len(link)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in follow[at]:
            follow[at][c] = state
            at = link[at]
        if at >= 0:
            met = follow[at][c]
            if length[met] == length[at] + 1:
                link[state] = met
            else:
                copy = len(link)
                follow.append(follow[met].copy())
                length.append(length[at] + 1)
                link.append(link[met])
                link[met] = link[state] = copy
                while at >= 0 and follow[at].get(c) == met:
                    follow[at][c] = copy
                    at = link[at]
        last = state
        prefix.append(state)
    return link, length, prefix


class LinkCutPaths:
    """Preferred paths of the link tree, each a splay tree ordered by depth.

    All states of a path were last reached by the same prefix, whose number is kept at the
    top of the path's splay tree. State 0, the root, stands for "none": it names the empty
    substring alone, which no square needs.
    """

    def __init__(self, link: list[int]) -> None:
        n = len(link)
        self.up = [max(p, 0) for p in link]
        self.shallow, self.deep, self.colour = [0] * n, [0] * n, [-1] * n

    def _rotate(self, x: int) -> None:
        up, shallow, deep = self.up, self.shallow, self.deep
        p = up[x]
        g = up[p]
        if shallow[p] == x:
            child = shallow[p] = deep[x]
            deep[x] = p
        else:
            child = deep[p] = shallow[x]
            shallow[x] = p
        if child:
            up[child] = p
        up[p], up[x] = x, g
        if g:
            if shallow[g] == p:
                shallow[g] = x
            elif deep[g] == p:
                deep[g] = x

    def _splay(self, x: int) -> None:
        up, shallow, deep, colour = self.up, self.shallow, self.deep, self.colour
        p = up[x]
        if not p or (shallow[p] != x and deep[p] != x):
            return
        top = p
        while (g := up[top]) and (shallow[g] == top or deep[g] == top):
            top = g
        shown = colour[top]
        while (p := up[x]) and (shallow[p] == x or deep[p] == x):
            if (g := up[p]) and (shallow[g] == p or deep[g] == p):
                self._rotate(p if (shallow[g] == p) == (shallow[p] == x) else x)
            self._rotate(x)
        colour[x] = shown

    def access(self, state: int, number: int) -> Iterator[tuple[int, int]]:
        """Recolour the path from the root; yields each segment's deepest state and old colour."""
        up, deep, colour = self.up, self.deep, self.colour
        below, x = 0, state
        while x:
            self._splay(x)
            yield x, colour[x]
            if cut := deep[x]:
                colour[cut] = colour[x]
            deep[x] = below
            below, x = x, up[x]
        colour[below] = number


def runs_of(word: list[int]) -> list[tuple[int, int, int]]:
    """All maximal runs (start, length, smallest period) of at least two periods, in order.

    The longest substring of a segment is the longest one common to both ends, so its square
    reaches as far left as the run does; the run goes on while the next word reports the
    same start. A distance that is not the smallest period is never the last one.
    """
    link, length, prefix = suffix_automaton(word)
    paths = LinkCutPaths(link)
    growing: dict[int, list[int]] = {}
    out = []
    for here, state in enumerate(prefix):
        for deepest, before in paths.access(state, here):
            period = here - before
            if before >= 0 and period <= length[deepest]:
                start = before - length[deepest] + 1
                run = growing.get(period)
                if run is not None and run[0] == start:
                    run[1] = here
                else:
                    if run is not None:
                        out.append((run[0], run[1] - run[0] + 1, period))
                    growing[period] = [start, here]
    out += [(start, end - start + 1, period) for period, (start, end) in growing.items()]
    return sorted(out, key=lambda r: (r[0], r[2]))


def spans_of_equal(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end (exclusive) of the stretches of equal numbers, negative ones left out."""
    edges = np.flatnonzero(np.diff(group)) + 1
    first, end = np.concatenate([[0], edges]), np.concatenate([edges, [len(group)]])
    use = group[first] >= 0 if len(group) else np.zeros(0, bool)
    return (first[use], end[use]) if len(group) else (np.zeros(0, int), np.zeros(0, int))


def candidate_stretches(hashes: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of words outside which no run of ``least`` words or more can lie.

    A run of length l and period q repeats l - q >= l / 2 words at distance q, and these
    repeats cover it: every word of it lies in a window of half the least length that occurs
    twice within the run. So words without such a window go, and what is left of each
    stretch is tested on its own again, as long as that takes away a tenth of it.
    """
    size = (least + 1) // 2
    windows = W.follow(hashes, size)
    group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    n = len(windows)
    if n <= 0:
        return np.zeros(0, int), np.zeros(0, int)
    left = len(group)
    while True:
        inside = np.flatnonzero((group[:n] == group[size - 1 :]) & (group[:n] >= 0))
        key = W.mix(windows[inside] ^ W.mix(group[inside].astype(np.uint64)))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        at = inside[twice]
        change = np.zeros(len(group) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + size, -1)
        covered = np.cumsum(change[:-1]) > 0
        # a new stretch where cover begins, and where the old stretch ended
        begins = covered.copy()
        begins[1:] &= ~covered[:-1] | (group[1:] != group[:-1])
        group = np.where(covered, np.cumsum(begins) - 1, -1)
        now = int(covered.sum())
        if not now or now > 0.9 * left:
            return spans_of_equal(group)
        left = now


def found_runs(text_words: list[bytes], spans: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    out = []
    for first, end in spans:
        number: dict[bytes, int] = {}
        word = [number.setdefault(w, len(number)) for w in text_words[first:end]]
        out += [(first + s, n, q) for s, n, q in runs_of(word) if n >= least]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(text_words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words but for those that a run holds after its first period."""
    if not runs:
        return text_words
    drop = np.zeros(len(text_words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, d in zip(text_words, np.cumsum(drop[:-1]), strict=True) if not d]


def measured(texts: pa.Array, least: int) -> list[pa.Array]:
    counts, runs, collapsed = [], [], []
    for chunk in W.chunks(texts):
        found = W.words_of(chunk)
        first, end = candidate_stretches(found.hashes, found.starts, least)
        text = np.searchsorted(found.starts, first, "right") - 1
        spans: dict[int, list[tuple[int, int]]] = {}
        for t, a, b in zip(text.tolist(), first.tolist(), end.tolist(), strict=True):
            spans.setdefault(t, []).append((a - int(found.starts[t]), b - int(found.starts[t])))
        for t in range(len(chunk.starts) - 1):
            all_words = chunk.data[chunk.starts[t] : chunk.starts[t + 1]].tobytes().split()
            own = found_runs(all_words, spans.get(t, []), least)
            counts.append(len(all_words))
            runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in own])
            collapsed.append(b" ".join(kept_words(all_words, own)))
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    return [pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(collapsed, pa.binary()).cast(pa.string())]


def periodic_runs(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """The documents with ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` has start, length and smallest period, in words, of every maximal run of two
    periods and ``least`` words or more, by start, then period. ``collapsed`` is the text
    without the words that any run holds after its first period, joined by one blank. A null
    or empty text has no words, no runs and an empty collapsed text. Repeated rows get equal
    results; further columns stay, those named like a result are replaced; an empty table
    gives an empty one. A text is taken whole, however long; its memory is a few hundred
    bytes a word that can lie in a run.
    """
    if least < 2:
        raise ValueError("a run has at least two words")
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType()),
    ]
    kept = without(docs, *[f.name for f in added]).columns
    schema = T.StructType([docs.schema[c] for c in kept] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = measured(batch.column(batch.num_columns - 1), least)
            yield pa.record_batch([*batch.columns[:-1], *new], [f.name for f in schema.fields])

    text = F.col("text").alias(free_name(docs, "text"))
    return docs.select(*[F.col(f"`{c}`") for c in kept], text).mapInArrow(run, schema)
