"""Where packing puts its pieces, against a packer that looks at every open window."""

from __future__ import annotations

import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from mostrador.llm import packing


class PlainPacker:
    def __init__(self, size: int, most_open: int) -> None:
        self.size, self.most_open, self.made = size, most_open, 0
        self.open: dict[int, int] = {}  # room by window
        self.sealed: list[int] = []

    def whole(self) -> int:
        self.made += 1
        self.sealed.append(self.made - 1)
        return self.made - 1

    def place(self, length: int) -> tuple[int, int]:
        fitting = [(room, window) for window, room in self.open.items() if room >= length]
        if fitting:
            room, window = min(fitting)
        else:
            if len(self.open) == self.most_open:
                _, fullest = min((room, window) for window, room in self.open.items())
                del self.open[fullest]
                self.sealed.append(fullest)
            room, window = self.size, self.made
            self.made += 1
        self.open[window] = room - length
        if room == length:
            del self.open[window]
            self.sealed.append(window)
        return window, self.size - room


@settings(max_examples=150, deadline=None)
@given(st.integers(2, 40), st.integers(1, 6), st.lists(st.integers(1, 40), max_size=200))
def test_placement(size, most_open, lengths):
    fast, plain = packing.Packer(size, most_open), PlainPacker(size, most_open)
    for length in lengths:
        if length >= size:
            assert fast.whole() == plain.whole()
        else:
            assert fast.place(length) == plain.place(length)
        assert fast.sealed == plain.sealed
        assert sorted(fast.free) == sorted((room, window) for window, room in plain.open.items())


def test_leftovers_are_merged_best_fit(spark):
    rng = random.Random(8)
    fills = {(task << 32) | w: rng.randint(1, 1023) for task in range(130) for w in range(rng.randint(0, 9))}
    table = spark.createDataFrame(list(fills.items()), "window long, fill long")
    got = {r.window: (r.sequence_id, r.base) for r in packing.merged(table).collect()}
    groups = defaultdict(list)
    for window, fill in fills.items():
        groups[(window >> 32) // packing.TASKS_MERGED].append((-fill, window))
    want, room_of = {}, {}
    for group, members in groups.items():
        rooms: dict[int, int] = {}
        for fill, window in sorted(members):
            fitting = [(room, own) for own, room in rooms.items() if room >= -fill]
            room, own = min(fitting) if fitting else (packing.WINDOW, len(rooms))
            rooms[own] = room + fill
            want[window] = ((1 << 62) | (group << 32) | own, packing.WINDOW - room)
        room_of[group] = rooms
    assert got == want and len(room_of) == 3
