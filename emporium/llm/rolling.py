"""Vectorised hashes of byte spans and of windows over them (polynomials modulo 2**64)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Bytes of text that are hashed together; the tables of powers are of this size.
SLICE = 1 << 20
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=6)
def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base and of its inverse."""
    up, down = np.ones(n + 1, np.uint64), np.ones(n + 1, np.uint64)
    up[1:] = base
    down[1:] = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        return np.cumprod(up), np.cumprod(down)


def table_size(n: int) -> int:
    """One size of table for all slices; a longer text gets a larger one of its own."""
    return SLICE + (SLICE >> 2) if n <= SLICE + (SLICE >> 2) else 1 << n.bit_length()


def long_pieces(text: bytes) -> list[bytes]:
    """A text cut at white space into pieces of about a slice; a longer word stays whole."""
    out, at = [], 0
    while len(text) - at > SLICE:
        cut = max((text.rfind(c, at, at + SLICE) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")), default=-1)
        if cut <= at:
            cut = min((p for p in (text.find(c, at + SLICE) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
                       if p >= 0), default=len(text))
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


class Hasher:
    """One lane: random value per byte and an odd base, both from a seed."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 64, 256, np.uint64)
        self.base, self.outer = (int(x) | 1 for x in rng.integers(1 << 32, 1 << 63, 2))
        self.mul = np.uint64(int(rng.integers(1 << 62, 1 << 63)) | 1)

    def mix(self, h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(32))) * self.mul
        return h ^ (h >> np.uint64(29))

    def prefix(self, values: np.ndarray, base: int) -> np.ndarray:
        size = table_size(len(values))
        up, _ = powers(base, size)
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:len(values)])])

    def take(self, prefix: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = table_size(len(prefix) - 1)
        _, down = powers(base, size)
        return self.mix((prefix[end] - prefix[start]) * down[start])

    def spans(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the byte strings ``buf[start:end]``."""
        with np.errstate(over="ignore"):
            return self.take(self.prefix(self.values[buf], self.base), self.base, start, end)

    def every(self, buf: np.ndarray, width: int) -> np.ndarray:
        """Hashes of all byte strings of ``width``, as ``spans`` has them."""
        n = len(buf) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            prefix = self.prefix(self.values[buf], self.base)
            _, down = powers(self.base, table_size(len(buf)))
            h = prefix[width:] - prefix[:n]
            del prefix
            h *= down[:n]
            return self.mix(h)

    def windows(self, items: np.ndarray, width: int) -> np.ndarray:
        """Hashes of every ``width`` consecutive items (64-bit hashes)."""
        n = len(items) - width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        at = np.arange(n)
        with np.errstate(over="ignore"):
            return self.take(self.prefix(items, self.outer), self.outer, at, at + width)


def word_hashes(texts: list[bytes], lane: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and words per text; long texts go piece by piece."""
    if len(texts) == 1 and len(texts[0]) > SLICE:
        parts = [word_hashes([p], lane)[0] if len(p) <= SLICE else _hashed([p], lane)[0]
                 for p in long_pieces(texts[0])]
        found = np.concatenate(parts)
        return found, np.array([len(found)])
    return _hashed(texts, lane)


def _hashed(texts: list[bytes], lane: Hasher) -> tuple[np.ndarray, np.ndarray]:
    buf, start, end, count = words(texts)
    return lane.spans(buf, start, end), count


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(buffer, start, end, count)``: the words' spans in the joined texts, and words per text."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sep = SEPARATORS[buf]
    edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
    if len(buf) and not sep[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    bounds = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    return buf, start, end, np.diff(np.searchsorted(start, bounds), prepend=0)
