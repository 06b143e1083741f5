"""Packing of token sequences into windows of a fixed length.

Every task packs its own documents online: it keeps a fixed number of open windows, puts a
piece into the one that it fills best, and when none has room for it emits the fullest. The
pieces of emitted windows leave the task batch by batch. What is still open at a task's end is merged, many tasks' leftovers at a time.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mostrador.llm import words as W
from mostrador.llm.common import Scratch, free_name, without

WINDOW = 1024
OPEN_WINDOWS = 64
TASKS_MERGED = 64
END = 0  # the id that closes a document
TOKENIZER = "byte_bpe_50k.json"


def _byte_symbols() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, others follow 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizer:
    """Ids of the vocabulary file, through the faster of two libraries that agree on it.

    The byte-level BPE of the file is run by tiktoken, whose ranks are the file's ids. A text
    that holds a special token's string goes through ``tokenizers`` itself.
    """

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        symbols = _byte_symbols()
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        ranks = {
            bytes(symbols[c] for c in token): number
            for token, number in content["model"]["vocab"].items()
            if token not in special
        }
        self.path, self.special = path, list(special)
        self.fast = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self.special):
            return self.exact.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    @cached_property
    def exact(self):
        """The other library, opened by the first text that needs it."""
        from tokenizers import Tokenizer as Exact

        return Exact.from_file(self.path)


_LOADED: dict[str, Tokenizer] = {}


def tokenizer(path: str | None) -> Tokenizer:
    """The tokenizer of a vocabulary file, loaded once per process; by default the public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


class Packer:
    """Open windows of one task. ``sealed`` gets the windows that are emitted."""

    def __init__(self, size: int = WINDOW, most_open: int = OPEN_WINDOWS) -> None:
        self.size, self.most_open, self.made = size, most_open, 0
        self.free: list[tuple[int, int]] = []  # (room left, window), sorted
        self.sealed: list[int] = []

    def _new(self) -> int:
        self.made += 1
        return self.made - 1

    def whole(self) -> int:
        """A window that one piece fills."""
        window = self._new()
        self.sealed.append(window)
        return window

    def place(self, length: int) -> tuple[int, int]:
        """The window and the offset of a piece shorter than a window."""
        at = bisect_left(self.free, (length, -1))
        if at < len(self.free):
            room, window = self.free.pop(at)
        else:
            if len(self.free) == self.most_open:
                self.sealed.append(self.free.pop(0)[1])
            room, window = self.size, self._new()
        if room == length:
            self.sealed.append(window)
        else:
            insort(self.free, (room - length, window))
        return window, self.size - room


PIECE = [
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()),
]


def merged(windows: DataFrame, size: int = WINDOW, tasks: int = TASKS_MERGED) -> DataFrame:
    """Leftover windows put together, best fit, the fullest first: (window, sequence_id, base).

    ``windows`` has (window, fill). The leftovers of ``tasks`` tasks meet in one group, at
    most ``tasks * OPEN_WINDOWS`` rows, whatever the size of the input.
    """

    def fit(key, rows):
        rows = rows.sort_values(["fill", "window"], ascending=[False, True])
        free: list[tuple[int, int]] = []
        sequence, base, made = [], [], 0
        for fill in rows["fill"]:
            at = bisect_left(free, (int(fill), -1))
            if at < len(free):
                room, own = free.pop(at)
            else:
                room, own, made = size, made, made + 1
            sequence.append((1 << 62) | (int(key[0]) << 32) | own)
            base.append(size - room)
            if room > fill:
                insort(free, (room - int(fill), own))
        return rows[["window"]].assign(sequence_id=sequence, base=base)

    group = F.floor(F.shiftright("window", 32) / F.lit(tasks)).alias("group")
    return (
        windows.select(group, "window", "fill")
        .groupBy("group")
        .applyInPandas(fit, "window long, sequence_id long, base long")
    )


def pack(
    docs: DataFrame,
    size: int = WINDOW,
    most_open: int = OPEN_WINDOWS,
    path: str | None = None,
    keep: list[str] | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Every document's token ids, and a closing 0, cut into pieces that lie in windows.

    A piece per row: the kept columns of its document (all but ``text`` by default), start,
    length, ids_crc32, doc_tokens, sequence_id and offset; ``with_ids`` adds the ids. A
    document longer than a window is cut into whole windows and a rest. A null or empty text
    is its closing 0 alone. Repeated rows are packed as often as they occur. Columns named
    like a result are replaced; an empty table gives an empty one.
    """
    if not 1 < size <= 1 << 20:
        raise ValueError("size must lie between 2 and 2 ** 20")
    scratch = Scratch(docs.sparkSession)
    names = [f.name for f in PIECE] + ["ids"]
    plain = without(docs, *names)
    kept = [c for c in plain.columns if (c != "text" if keep is None else c in keep)]
    window, last = free_name(plain, "window"), free_name(plain, "open")
    fields = [docs.schema[c] for c in kept] + PIECE
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
    fields += [T.StructField(last, T.BooleanType())]
    head = free_name(plain, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = tokenizer(path).ids, Packer(size, most_open)
        high = TaskContext.get().partitionId() << 32
        open_pieces: pa.Table | None = None  # those in open windows, a bounded number
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            # some texts at a time: what they become, ids above all, is larger than they are
            for chunk in W.chunks(texts):
                part = batch.slice(chunk.row, len(chunk.starts) - 1)
                pieces = pieces_of(part, encode, packer, high)
                pieces = pieces if open_pieces is None else pa.concat_tables([open_pieces, pieces])
                still = np.isin(
                    pieces.column("sequence_id").to_numpy(),
                    np.array([w | high for _, w in packer.free], np.int64),
                )
                # a copy of their own, or the few open pieces would keep whole parts in memory
                open_pieces = pieces.take(pa.array(np.flatnonzero(still)))
                yield from flagged(pieces.filter(pa.array(~still)), False)
        if open_pieces is not None:
            yield from flagged(open_pieces, True)

    def pieces_of(part: pa.RecordBatch, encode, packer: Packer, high: int) -> pa.Table:
        found: list[tuple[int, ...]] = []
        ids: list[np.ndarray] = []
        for row, text in enumerate(part.column(part.num_columns - 1)):
            own = np.array([*(encode(text.as_py()) if text.is_valid else []), END], "<i4")
            for start in range(0, len(own), size):
                piece = own[start : start + size]
                window, offset = (packer.whole(), 0) if len(piece) == size else packer.place(len(piece))
                found.append((row, start, len(piece), zlib.crc32(piece.tobytes()), len(own), window | high, offset))
            if with_ids:
                ids.append(own)
        row, *numbers = np.array(found, np.int64).reshape(-1, 7).T
        arrays = [c.take(pa.array(row)) for c in part.columns[:-1]]
        arrays += [pa.array(np.ascontiguousarray(n)) for n in numbers]
        if with_ids:  # pieces follow each other as the ids do
            ends = pa.array(np.append(0, np.cumsum(numbers[1])), pa.int32())
            arrays.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*ids, np.zeros(0, "<i4")]))))
        return pa.Table.from_arrays(arrays, [f.name for f in fields[:-1]])

    def flagged(pieces: pa.Table, is_open: bool) -> Iterator[pa.RecordBatch]:
        pieces = pieces.append_column(last, pa.array(np.full(len(pieces), is_open)))
        return iter(pieces.to_batches())

    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").alias(head))
    pieces = scratch.stored(source.mapInArrow(run, T.StructType(fields)), "pieces")
    left = pieces.where(F.col(last)).groupBy(F.col("sequence_id").alias("window"))
    left = left.agg(F.max(F.col("offset") + F.col("length")).alias("fill"))
    moves = merged(left, size).toDF(window, "_to", "_base")
    wanted = [f.name for f in fields[:-1]]
    done = pieces.where(~F.col(last)).select(wanted)
    to = {"sequence_id": F.col("_to"), "offset": F.col("offset") + F.col("_base")}
    rest = pieces.where(F.col(last)).join(moves, F.col("sequence_id") == F.col(window))
    rest = rest.select([to[c].alias(c) if c in to else F.col(f"`{c}`") for c in wanted])
    return done.unionByName(rest)
