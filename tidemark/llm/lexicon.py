r"""A minimal acyclic transducer from words to token ids, built once and memory-mapped by readers.

Words come in byte order. A state is shared as soon as no later word can change it: two states are one if they agree in
their arcs, in what these emit and in what they emit at the end of a word. Ids are emitted as early as they are certain:
an arc carries the longest prefix common to all words behind it, and the rest moves on towards the ends.

File: a header of five 32-bit numbers (states, arcs, ids, root, 0), then first arc of each state, targets, where each
arc's and each state's ids begin, counts of ids, the ids, and the labels. A state without final output has count 255.
"""

from __future__ import annotations

import mmap
from array import array
from collections.abc import Iterable

MAGIC = b"TMDLEX1\n"
#: No word ends here. Words of as many ids are left out.
NO_END = 255


class _State:
    __slots__ = ("arcs", "end")

    def __init__(self) -> None:
        self.arcs: dict[int, list] = {}  # label -> [state or its number, emitted ids]
        self.end: tuple[int, ...] | None = None


def _common(a: tuple[int, ...], b: tuple[int, ...]) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def compile_lexicon(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """The transducer of distinct non-empty words with their ids; words come sorted by their bytes."""
    known: dict[tuple, int] = {}
    states: list[tuple] = []

    def settle(state: _State) -> int:
        shape = (state.end, *((label, to, out) for label, (to, out) in state.arcs.items()))
        if shape not in known:
            known[shape] = len(states)
            states.append(shape)
        return known[shape]

    path, last = [_State()], b""
    for word, ids in entries:
        if len(ids) >= NO_END or not word:
            continue
        if word <= last:
            raise ValueError("words must come sorted and once each")
        shared = 0
        while shared < len(last) and word[shared] == last[shared]:
            shared += 1
        while len(path) > shared + 1:
            done = path.pop()
            path[-1].arcs[last[len(path) - 1]][0] = settle(done)
        for depth in range(shared):
            arc, below = path[depth].arcs[word[depth]], path[depth + 1]
            n = _common(arc[1], ids)
            if held := arc[1][n:]:
                arc[1] = arc[1][:n]
                for after in below.arcs.values():
                    after[1] = held + after[1]
                if below.end is not None:
                    below.end = held + below.end
            ids = ids[n:]
        for label in word[shared:]:
            path[-1].arcs[label] = [None, ids]
            path.append(_State())
            ids = ()
        path[-1].end = ids
        last = word
    while len(path) > 1:
        done = path.pop()
        path[-1].arcs[last[len(path) - 1]][0] = settle(done)
    return _packed(states, settle(path[0]))


def _packed(states: list[tuple], root: int) -> bytes:
    pool: dict[tuple[int, ...], int] = {(): 0}
    ids = array("I")

    def place(out: tuple[int, ...]) -> int:
        if out not in pool:
            pool[out] = len(ids)
            ids.extend(out)
        return pool[out]

    first, target, arc_at, end_at = array("I", [0]), array("I"), array("I"), array("I")
    arc_n, end_n, labels = bytearray(), bytearray(), bytearray()
    for end, *arcs in states:
        end_at.append(place(end or ()))
        end_n.append(NO_END if end is None else len(end))
        for label, to, out in arcs:
            labels.append(label)
            target.append(to)
            arc_at.append(place(out))
            arc_n.append(len(out))
        first.append(len(labels))
    head = array("I", [len(states), len(labels), len(ids), root, 0])
    return MAGIC + b"".join(x.tobytes() for x in (head, first, target, arc_at, end_at, ids)) + bytes(arc_n + end_n + labels)


class Lexicon:
    """Look-ups in a compiled file, which is mapped and not read: processes of a machine share its pages."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        if self.map[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        view, at = memoryview(self.map), len(MAGIC)

        def numbers(n: int) -> memoryview:
            nonlocal at
            at += 4 * n
            return view[at - 4 * n : at].cast("I")

        self.states, self.arcs, n_ids, self.root, _ = numbers(5)
        self.first, self.target = numbers(self.states + 1), numbers(self.arcs)
        self.arc_at, self.end_at, self.ids = numbers(self.arcs), numbers(self.states), numbers(n_ids)
        self.arc_n, self.end_n = view[at : at + self.arcs], view[at + self.arcs : at + self.arcs + self.states]
        self.labels = at + self.arcs + self.states
        self.read: dict[int, dict[int, tuple[int, list[int]]]] = {}

    def _arcs(self, state: int) -> dict[int, tuple[int, list[int]]]:
        """label -> (target, ids emitted) of a state, kept once it has been read."""
        low, high = self.first[state], self.first[state + 1]
        labels = self.map[self.labels + low : self.labels + high]
        emitted = (self.ids[self.arc_at[a] : self.arc_at[a] + self.arc_n[a]].tolist() for a in range(low, high))
        self.read[state] = arcs = dict(zip(labels, zip(self.target[low:high], emitted, strict=True), strict=True))
        return arcs

    def find(self, word: bytes) -> list[int] | None:
        """The ids of `word`, None if it is not in the lexicon."""
        state, out, read = self.root, [], self.read
        for label in word:
            found = (read.get(state) or self._arcs(state)).get(label)
            if found is None:
                return None
            state = found[0]
            if found[1]:
                out += found[1]
        n = self.end_n[state]
        if n == NO_END:
            return None
        return out + self.ids[self.end_at[state] : self.end_at[state] + n].tolist()
