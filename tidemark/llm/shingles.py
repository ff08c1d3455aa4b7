"""64-bit hashes of word shingles, vectorised over whole batches of texts.

Words are runs of `[^\\x20\\x09-\\x0D]` after A-Z are lower-cased. A word's hash is a polynomial in its bytes, taken from
prefix sums over the batch; a shingle's mixes the hashes of its words. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

_U = np.uint64
#: Texts are hashed together up to this many bytes; a longer text is hashed alone, in pieces of about this size.
CHUNK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class _Powers:
    """Powers of the base and of its inverse, kept for the longest batch so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, dtype=_U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up = np.cumprod(np.full(size, _U(_BASE)), dtype=_U)
            self.down = np.cumprod(np.full(size, _U(_INVERSE)), dtype=_U)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of a byte array that begins and ends with white space."""
    space = _SPACE[data]
    turns = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = turns[0::2], turns[1::2]
    up, down = _powers.to(len(data))
    sums = np.cumsum(_BYTE[data] * up, dtype=_U)
    raw = (sums[ends - 1] - sums[starts - 1]) * down[starts]
    return starts, mix(raw ^ (ends - starts).astype(_U))


def shingle_sets(texts: list[str | None], width: int = 5) -> Iterator[tuple[int, np.ndarray]]:
    """(position, sorted distinct hashes) of each text's shingles; a shorter text is one shingle, an empty one none."""
    part: list[bytes] = []
    size = first = 0
    for i, text in enumerate(texts):
        raw = (text or "").encode().lower()
        if part and size + len(raw) > CHUNK:
            yield from ((first + k, h) for k, h in enumerate(_chunk_sets(part, width)))
            part, size, first = [], 0, i
        if len(raw) > CHUNK:
            yield i, _set_of(_long_words(raw), width)
            first = i + 1
        else:
            part.append(raw)
            size += len(raw) + 1
    yield from ((first + k, h) for k, h in enumerate(_chunk_sets(part, width)))


def _long_words(raw: bytes) -> np.ndarray:
    """Word hashes of a long text, made in pieces that end with a word; only a longer word makes a longer piece."""
    out, at = [], 0
    while at < len(raw):
        gap = _GAP.search(raw, at + CHUNK)
        end = gap.start() if gap else len(raw)
        out.append(_word_hashes(np.frombuffer(b" " + raw[at:end] + b" ", dtype=np.uint8))[1])
        at = end
    return np.concatenate(out)


def _factors(width: int) -> np.ndarray:
    return mix(np.arange(1, width + 1, dtype=_U)) | _U(1)


def _rolled(words: np.ndarray, width: int) -> np.ndarray:
    factors = _factors(width)
    rolled = np.zeros(max(0, len(words) - width + 1), dtype=_U)
    for j in range(width):
        rolled += words[j : len(rolled) + j] * factors[j]
    return mix(rolled)


def _short(words: np.ndarray, width: int) -> np.ndarray:
    """The one shingle of a text of fewer words, none without words."""
    n = len(words)
    return mix(np.array([np.sum(words * _factors(width)[:n], dtype=_U) + _U(n)], dtype=_U)) if n else np.zeros(0, dtype=_U)


def _set_of(words: np.ndarray, width: int) -> np.ndarray:
    return np.unique(_rolled(words, width)) if len(words) >= width else _short(words, width)


def _chunk_sets(part: list[bytes], width: int) -> Iterator[np.ndarray]:
    data = np.frombuffer(b" " + b" ".join(part) + b" ", dtype=np.uint8)
    starts, words = _word_hashes(data)
    limits = np.cumsum([len(p) + 1 for p in part]) + 1
    rolled = _rolled(words, width)
    begin = 0
    for end in np.searchsorted(starts, limits):
        if end - begin >= width:
            yield np.unique(rolled[begin : end - width + 1])
        else:
            yield _short(words[begin:end], width)
        begin = end


def set_signature(hashes: np.ndarray) -> int:
    """A signed 64-bit signature of a set of hashes."""
    total = np.sum(mix(hashes + _U(0x2545F4914F6CDD1D)), dtype=_U, keepdims=True)
    return int(mix(total + np.array([len(hashes)], dtype=_U) * _U(_BASE)).view(np.int64)[0])
