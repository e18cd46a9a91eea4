"""Elias-Fano sequences and an n-gram trie of such levels in one memory-mapped file."""

from __future__ import annotations

import json
import os
import tempfile

import numpy as np

# Place of the k-th one of every byte.
IN_BYTE = np.array([[([b for b in range(8) if byte >> b & 1] + [0] * 8)[k] for k in range(8)] for byte in range(256)])


class EliasFano:
    """A non-decreasing sequence: low bits packed, high parts as a bit vector with a rank directory."""

    WORD = 64

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ranks: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ranks = n, low_bits, low, high, ranks

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        low_bits = max(0, (top // max(1, n)).bit_length() - 1)
        lows = values & np.uint64((1 << low_bits) - 1)
        packed = np.zeros(0, np.uint8)
        if low_bits:
            size = -(-n * low_bits // 8) + 9
            packed = np.zeros(size, np.uint8)
            for at in range(0, n, 1 << 18):  # a multiple of 8 numbers ends on a byte
                part = lows[at:at + (1 << 18)]
                bits = (part[:, None] >> np.arange(low_bits, dtype=np.uint64)[None, :] & np.uint64(1)).astype(np.uint8)
                put = np.packbits(bits.ravel(), bitorder="little")
                first = at * low_bits // 8
                packed[first:first + len(put)] = put
        length = n + (int(values[-1] >> np.uint64(low_bits)) if n else 0) + 1
        bits = np.zeros(-(-length // cls.WORD) * cls.WORD, np.uint8)
        bits[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        words = bits.reshape(-1, cls.WORD)
        high = np.packbits(words, axis=1, bitorder="little").ravel()
        ranks = np.concatenate([[0], np.cumsum(words.sum(1, dtype=np.int64))]).astype(np.int64)
        return cls(n, low_bits, packed, high, ranks)

    def arrays(self) -> dict[str, np.ndarray]:
        return {"low": self.low, "high": self.high, "ranks": self.ranks}

    def _in_word(self, word: np.ndarray, left: np.ndarray, zeros: bool) -> np.ndarray:
        """Place of the ``left``-th one (or zero) in each 64-bit word: first its byte, then its bit."""
        bytes_ = self.high.reshape(-1, self.WORD // 8)[word]
        if zeros:
            bytes_ = ~bytes_
        seen = np.cumsum(np.bitwise_count(bytes_), axis=1, dtype=np.uint8)
        byte = (seen <= left[:, None]).sum(1)
        row = np.arange(len(word))
        before = np.where(byte > 0, seen[row, np.maximum(byte - 1, 0)], 0)
        return word * self.WORD + byte * 8 + IN_BYTE[bytes_[row, byte], left - before]

    def select(self, i: np.ndarray) -> np.ndarray:
        """Positions of the i-th ones."""
        word = np.searchsorted(self.ranks, i, "right") - 1
        return self._in_word(word, i - self.ranks[word], False)

    def select_zero(self, i: np.ndarray) -> np.ndarray:
        """Positions of the i-th zeros; the end of the vector where there are fewer."""
        zeros = np.arange(len(self.ranks)) * self.WORD - self.ranks
        word = np.searchsorted(zeros, i, "right") - 1
        out = np.full(len(i), (len(self.ranks) - 1) * self.WORD, np.int64)
        ok = np.flatnonzero(word < len(self.ranks) - 1)
        out[ok] = self._in_word(word[ok], i[ok] - zeros[word[ok]], True)
        return out

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.int64) * self.low_bits
        byte = bit >> 3
        word = np.zeros(len(i), np.uint64)
        for k in range(8):
            word |= self.low[byte + k].astype(np.uint64) << np.uint64(8 * k)
        shift = (bit & 7).astype(np.uint64)
        over = self.low[byte + 8].astype(np.uint64)
        word = (word >> shift) | np.where(shift > 0, over << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return word & np.uint64((1 << self.low_bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        out = np.empty(len(i), np.uint64)
        for at in range(0, len(i), 1 << 16):
            j = i[at:at + (1 << 16)]
            out[at:at + (1 << 16)] = ((self.select(j) - j).astype(np.uint64) << np.uint64(self.low_bits)) | self.lows(j)
        return out

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first element not below each ``x`` (``n`` if there is none)."""
        out = np.empty(len(x), np.int64)
        for at in range(0, len(x), 1 << 16):
            out[at:at + (1 << 16)] = self._successor(x[at:at + (1 << 16)].astype(np.uint64))
        return out

    def _successor(self, x: np.ndarray) -> np.ndarray:
        h = (x >> np.uint64(self.low_bits)).astype(np.int64)
        low = x & np.uint64((1 << self.low_bits) - 1)
        # Elements of one high part lie between two zeros of the bit vector.
        begin = np.where(h > 0, self.select_zero(np.maximum(h - 1, 0)) - (h - 1), 0)
        begin = np.minimum(begin, self.n)
        end = np.minimum(self.select_zero(h) - h, self.n)
        end = np.maximum(begin, end)
        while True:
            open_ = np.flatnonzero(begin < end)
            if not len(open_):
                return begin
            mid = (begin[open_] + end[open_]) >> 1
            less = self.lows(mid) < low[open_]
            begin[open_[less]] = mid[less] + 1
            end[open_[~less]] = mid[~less]


class NgramTrie:
    """Levels of a trie of n-grams over numbers, each an Elias-Fano sequence of successors.

    Level 0 holds the words; a node's children lie side by side on the next level, found through
    monotone pointers. To make a level monotone, the children of the i-th parent are raised by
    ``i * span`` (their place relative to the context), so a child is found by one successor
    search for ``i * span + child``. Every node has a quantised value, every parent a second one."""

    def __init__(self, levels: list[dict], span: int):
        self.levels, self.span = levels, span

    @classmethod
    def build(cls, grams: list[np.ndarray], values: list[np.ndarray], backoffs: list[np.ndarray], span: int) -> NgramTrie:
        """``grams[k]``: sorted distinct (k+1)-grams as rows; every prefix is a gram of the level above."""
        levels = []
        parent_count = 1
        parents = np.zeros(len(grams[0]), np.int64)
        for k, g in enumerate(grams):
            if k:
                # Number the parents in order: a new one begins where the prefix changes.
                before = grams[k - 1]
                keys = {tuple(r): i for i, r in enumerate(before.tolist())} if k > 1 else None
                parents = (np.searchsorted(before[:, 0], g[:, 0]) if k == 1 else
                           np.array([keys[tuple(r)] for r in g[:, :-1].tolist()], np.int64))
                parent_count = len(before)
            pointers = np.searchsorted(parents, np.arange(parent_count + 1))
            levels.append({"nodes": EliasFano.encode(parents.astype(np.uint64) * np.uint64(span if k else 0)
                                                     + g[:, -1].astype(np.uint64)),
                           "pointers": EliasFano.encode(pointers), "value": values[k].astype(np.uint8),
                           "backoff": backoffs[k].astype(np.uint8) if k < len(backoffs) else np.zeros(0, np.uint8)})
        return cls(levels, span)

    def find(self, level: int, parent: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Node numbers of the children under the given parents; -1 where there is none."""
        nodes = self.levels[level]["nodes"]
        out = np.full(len(parent), -1, np.int64)
        ok = np.flatnonzero((parent >= 0) & (child >= 0)) if len(parent) else np.zeros(0, np.int64)
        if not nodes.n or not len(ok):
            return out
        x = (parent[ok].astype(np.uint64) * np.uint64(self.span if level else 0)) + child[ok].astype(np.uint64)
        at = nodes.successor(x)
        inside = np.flatnonzero(at < nodes.n)
        hit = inside[nodes.access(at[inside]) == x[inside]]
        out[ok[hit]] = at[hit]
        return out

    def children(self, level: int, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the children of a node begin and end on the next level."""
        p = self.levels[level + 1]["pointers"]
        return p.access(parent).astype(np.int64), p.access(parent + 1).astype(np.int64)

    # One file: a header, then the arrays one after the other.
    def write(self, path: str) -> None:
        head, arrays, at = {"span": self.span, "levels": []}, [], 0
        for level in self.levels:
            described = {}
            for name in ("nodes", "pointers"):
                ef = level[name]
                described[name] = {"n": ef.n, "low_bits": ef.low_bits}
                for part, a in ef.arrays().items():
                    described[f"{name}.{part}"] = [at, str(a.dtype), len(a)]
                    arrays.append((at, a))
                    at += -(-a.nbytes // 8) * 8
            for name in ("value", "backoff"):
                a = level[name]
                described[name] = [at, str(a.dtype), len(a)]
                arrays.append((at, a))
                at += -(-a.nbytes // 8) * 8
            head["levels"].append(described)
        text = json.dumps(head).encode()
        begin = -(-(len(text) + 8) // 8) * 8
        with open(path, "wb") as f:
            f.write(len(text).to_bytes(8, "little") + text)
            for place, a in arrays:
                f.seek(begin + place)
                f.write(np.ascontiguousarray(a).tobytes())
            f.truncate(begin + at)

    @classmethod
    def open(cls, path: str) -> NgramTrie:
        with open(path, "rb") as f:
            n = int.from_bytes(f.read(8), "little")
            head = json.loads(f.read(n))
        begin = -(-(n + 8) // 8) * 8
        whole = np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)

        def view(at: int, kind: str, count: int) -> np.ndarray:
            return whole[begin + at:begin + at + np.dtype(kind).itemsize * count].view(kind)

        levels = []
        for d in head["levels"]:
            level = {}
            for name in ("nodes", "pointers"):
                level[name] = EliasFano(d[name]["n"], d[name]["low_bits"],
                                        *(view(*d[f"{name}.{part}"]) for part in ("low", "high", "ranks")))
            for name in ("value", "backoff"):
                level[name] = view(*d[name])
            levels.append(level)
        return cls(levels, head["span"])

    def mapped(self) -> NgramTrie:
        """The same trie read back from a memory-mapped file that goes with the last reader."""
        handle, path = tempfile.mkstemp(suffix=".trie")
        os.close(handle)
        self.write(path)
        trie = NgramTrie.open(path)
        os.unlink(path)  # the mapping stays valid until it is dropped
        return trie
