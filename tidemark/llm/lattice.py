"""Subword lattices of words: forward and forward-backward recursions in log space, vectorised over many words.

A word is its UTF-8 bytes with a space before it. Arcs are the pieces of an existing subword vocabulary, where a space
stands for the word-start mark, and every single byte, so each word has a segmentation. Words of a length are run
together; position by position, arcs of each length are looked up by hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np

from tidemark.llm.shingles import _BASE, mix

_U = np.uint64
NONE = -1e30
#: Words of more bytes are run one by one, their arcs looked up over all positions at once.
LONG = 512


def pieces_of(model_file: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece model as bytes, single bytes first, and their scores; unusable pieces are left out."""
    import sentencepiece as spm

    model = spm.SentencePieceProcessor(model_file=model_file)
    found: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            piece = model.id_to_piece(i).replace("▁", " ").encode()
            # words are lower case and hold no inner space
            if b" " not in piece[1:] and piece == piece.lower():
                found[piece] = max(found.get(piece, NONE), model.get_score(i))
    single = [bytes([b]) for b in range(256)]
    lowest = min(found.values())
    pieces = single + [p for p in found if len(p) > 1]
    return pieces, np.array([found.get(p, lowest) for p in pieces])


def rank_log_probs(scores: np.ndarray) -> np.ndarray:
    """Natural log probabilities from scores that are negated merge ranks: a piece of rank r weighs 1 / (r + 2.7)."""
    weight = 1.0 / (np.minimum(-scores, 1e7) + 2.7)
    return np.log(weight / weight.sum())


class Lattice:
    """Recursions over a fixed set of pieces; `log_p` can change between calls."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        data = np.zeros((len(pieces), self.longest), np.uint8)
        for i, p in enumerate(pieces):
            data[i, : len(p)] = np.frombuffer(p, np.uint8)
        lengths = np.array([len(p) for p in pieces])
        hashes = np.zeros(len(pieces), _U)
        self._bits = max(16, (32 * len(pieces)).bit_length())
        # Where some piece goes on; a place taken by chance only costs a look.
        self._open = np.zeros(1 << self._bits, bool)
        for k in range(self.longest):
            on = lengths > k
            hashes[on] = self._extend(hashes[on], data[on, k])
            self._open[self._place(hashes[on], 0)] = True
        self._hash = hashes
        # Three tables of places; a piece that finds its place in one taken goes to the next.
        self._tables = [np.full(1 << self._bits, -1, np.int32) for _ in range(3)]
        left = np.arange(len(pieces))
        for k, table in enumerate(self._tables):
            places = self._place(hashes[left], k)
            taken, first = np.unique(places, return_index=True)
            table[taken] = left[first]
            left = np.delete(left, first)
        if len(left):
            raise ValueError("no place for a piece")

    @staticmethod
    def _extend(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
        return (h ^ (byte.astype(_U) + _U(1))) * _U(_BASE) ^ ((h + byte.astype(_U)) >> _U(29))

    def _place(self, h: np.ndarray, k: int) -> np.ndarray:
        return (mix(np.atleast_1d(h) + _U(k)) >> _U(64 - self._bits)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, -1 for none."""
        out = self._tables[0][self._place(h, 0)]
        at = np.flatnonzero(out >= 0)
        for k in (1, 2, 3):
            at = at[self._hash[out[at]] != h[at]]
            out[at] = self._tables[k][self._place(h[at], k)] if k < 3 else -1
            at = at[out[at] >= 0]
        return out

    def _arcs(self, block: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) of all arcs in a block of equally long words, by start."""
        n, length = block.shape
        columns = np.ascontiguousarray(block.T)
        for s in range(length):
            rows, h = np.arange(n), np.zeros(n, _U)
            for e in range(s + 1, min(length, s + self.longest) + 1):
                h = self._extend(h, columns[e - 1][rows])
                on = self._open[self._place(h, 0)]
                if not on.all():
                    rows, h = rows[on], h[on]
                if not len(rows):
                    break
                found = self.find(h)
                hit = found >= 0
                if hit.any():
                    yield s, e, rows[hit], found[hit]

    def _long_arcs(self, word: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, pieces) of all arcs of a long word, by start."""
        data = np.frombuffer(b" " + word, np.uint8)
        parts = []
        for a in range(0, len(data), 1 << 18):
            starts = np.arange(a, min(a + (1 << 18), len(data)))
            h = np.zeros(len(starts), _U)
            found = []
            for k in range(self.longest):
                starts = starts[starts + k < len(data)]
                h = self._extend(h[: len(starts)], data[starts + k])
                ids = self.find(h)
                on = np.flatnonzero(ids >= 0)
                found.append((starts[on], starts[on] + k + 1, ids[on]))
            s, e, ids = (np.concatenate(c) for c in zip(*found, strict=True))
            order = np.argsort(s, kind="stable")
            parts.append((s[order].astype(np.int32), e[order].astype(np.int32), ids[order]))
        s, e, ids = (np.concatenate(c) for c in zip(*parts, strict=True))
        return s, e, ids

    @staticmethod
    def _passed(froms: np.ndarray, tos: np.ndarray, gains: np.ndarray, size: int, origin: int) -> np.ndarray:
        """Log sums over all paths from `origin` to each place, arcs in an order in which places are whole when left."""
        reach = [NONE] * size
        reach[origin] = 0.0
        for a, b, g in zip(froms.tolist(), tos.tolist(), gains.tolist(), strict=True):
            x, y = reach[a] + g, reach[b]
            reach[b] = x + math.log1p(math.exp(y - x)) if x > y else y + math.log1p(math.exp(x - y))
        return np.array(reach)

    @staticmethod
    def _blocks(words: list[bytes], most: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, bytes) of words of one length, each with a space before it; long words are left out."""
        lengths = np.array([len(w) for w in words], np.int64)
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] <= LONG]
        if not len(order):
            return
        edges = np.flatnonzero(np.diff(lengths[order], prepend=-1) > 0)
        for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
            step = max(1, most // (int(lengths[order[a]]) + 1))
            for i in range(a, b, step):
                at = order[i : min(b, i + step)]
                block = np.frombuffer(b"".join(b" " + words[k] for k in at), np.uint8).reshape(len(at), -1)
                yield at, block

    def log_likelihood(self, words: list[bytes], log_p: np.ndarray) -> np.ndarray:
        """Natural log of the probability of each word, summed over all its segmentations.

        With piece weights of several models, one per row of `log_p`, the result has a column for each.
        """
        models = np.atleast_2d(log_p)
        out = np.empty((len(words), len(models)))
        for at, block in self._blocks(words, (1 << 22) // len(models)) if words else ():
            forward = np.full((block.shape[1] + 1, len(models), len(at)), NONE)
            forward[0] = 0.0
            for s, e, rows, ids in self._arcs(block):
                forward[e][:, rows] = np.logaddexp(forward[e][:, rows], forward[s][:, rows] + models[:, ids])
            out[at] = forward[-1].T
        for i in [i for i, word in enumerate(words) if len(word) > LONG]:
            s, e, ids = self._long_arcs(words[i])
            out[i] = [self._passed(s, e, gains[ids], len(words[i]) + 2, 0)[-1] for gains in models]
        return out if log_p.ndim > 1 else out[:, 0]

    def expected_counts(self, words: list[bytes], counts: np.ndarray, log_p: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece in `counts` occurrences of the words."""
        total = np.zeros(len(self.pieces))
        for at, block in self._blocks(words, 1 << 20) if words else ():
            forward = np.full((block.shape[1] + 1, len(at)), NONE)
            forward[0] = 0.0
            arcs = []
            for s, e, rows, ids in self._arcs(block):
                forward[e, rows] = np.logaddexp(forward[e, rows], forward[s, rows] + log_p[ids])
                arcs.append((s, e, rows, ids))
            backward = np.full_like(forward, NONE)
            backward[-1] = 0.0
            weight = counts[at].astype(float)
            for s, e, rows, ids in reversed(arcs):
                reach = log_p[ids] + backward[e, rows]
                backward[s, rows] = np.logaddexp(backward[s, rows], reach)
                use = np.exp(forward[s, rows] + reach - forward[-1, rows]) * weight[rows]
                total += np.bincount(ids, use, len(total))
        for i in [i for i, word in enumerate(words) if len(word) > LONG]:
            s, e, ids = self._long_arcs(words[i])
            size, gains = len(words[i]) + 2, log_p[ids]
            forward = self._passed(s, e, gains, size, 0)
            backward = self._passed(e[::-1], s[::-1], gains[::-1], size, size - 1)
            use = np.exp(forward[s] + gains + backward[e] - forward[-1]) * counts[i]
            total += np.bincount(ids, use, len(total))
        return total
