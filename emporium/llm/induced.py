"""External induced sorting of suffixes, with common-prefix values.

``repeated_starts`` finds the positions of a text whose next ``depth`` bytes also start elsewhere.
Suffixes are sorted by induction: the suffixes that begin a rise (after a fall) are sorted through
the recursion on the shorter string of their names, then induce all falling suffixes in ascending and all
rising ones in descending order. Tuples of position and common-prefix value wait in a priority queue by first
symbol, in order of arrival; what exceeds its memory goes to disk. Beyond ``IN_MEMORY`` bytes each, the
text's classes and runs and the names are memory-mapped files, but seeds, orders, hashes and marks are whole
arrays: a sort needs memory in proportion to its text, and callers bound that. On the way down, neighbours
with a common prefix of ``depth`` mark their positions; no suffix array is stored.
"""

from __future__ import annotations

import heapq
import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np

from . import rolling

RANGES = 64
PIECE = 1 << 20  # tuples read back at a time
IN_MEMORY = 24 << 20  # bytes of one array that need no file
SPACED = 16  # seeds from one that is compared in full to the next
LANE = rolling.Hasher(1001)  # the lane of the segments, so that a worker holds one table of powers


class DiskQueue:
    """Tuples (position, prefix value) by bucket, first in first out; spills to one file a bucket."""

    def __init__(self, folder: str, buckets: int, memory: int):
        self.folder, self.memory = tempfile.mkdtemp(dir=folder), memory
        self.held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(buckets)]
        self.sizes, self.spilled = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        self.read = np.zeros(buckets, np.int64)  # a bucket that is read may get new tuples: other files
        self.total = 0

    def _paths(self, bucket: int) -> tuple[str, str]:
        return tuple(f"{self.folder}/{bucket}.{self.read[bucket]}.{part}" for part in ("position", "prefix"))

    def push(self, bucket: int, position: np.ndarray, prefix: np.ndarray | None = None) -> None:
        if not len(position):
            return
        prefix = np.zeros(len(position), np.uint16) if prefix is None else prefix
        self.held[bucket].append((position, prefix))
        self.sizes[bucket] += len(position)
        self.total += len(position)
        while self.total * 10 > self.memory:
            self._spill(int(np.argmax(self.sizes)))

    def _spill(self, bucket: int) -> None:
        for path, part in zip(self._paths(bucket), zip(*self.held[bucket])):
            with open(path, "ab") as f:
                for a in part:
                    a.tofile(f)
        self.spilled[bucket] += self.sizes[bucket]
        self.total -= int(self.sizes[bucket])
        self.sizes[bucket], self.held[bucket] = 0, []

    def pop(self, bucket: int, backwards: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All tuples of a bucket in order of arrival (or the reverse), piece by piece."""
        held, n = self.held[bucket], int(self.spilled[bucket])
        paths = self._paths(bucket)
        self.total -= int(self.sizes[bucket])
        self.held[bucket], self.sizes[bucket], self.spilled[bucket] = [], 0, 0
        self.read[bucket] += 1

        def disk() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            starts = range(0, n, PIECE)
            for at in reversed(starts) if backwards else starts:
                k = min(PIECE, n - at)
                yield (np.fromfile(paths[0], np.int64, k, offset=at * 8),
                       np.fromfile(paths[1], np.uint16, k, offset=at * 2))
            for path in paths if n else ():
                os.unlink(path)

        memory = [tuple(map(np.concatenate, zip(*held)))] if held else []
        if backwards:
            yield from ((p[::-1], x[::-1]) for p, x in memory)
            yield from ((p[::-1], x[::-1]) for p, x in disk())
        else:
            yield from disk()
            yield from memory


class Inducer:
    """Induced sorting of one string of symbols that ends with its only 0.

    Symbols are dealt into ranges. A range of one symbol is handled in whole arrays; a range of
    several (names of a recursion) symbol by symbol."""

    def __init__(self, text: np.ndarray, folder: str, memory: int, depth: int = 0):
        self.text, self.folder, self.memory, self.depth = text, folder, memory, depth
        n = len(text)
        self.n, self.top = n, int(text.max()) + 1
        last = np.concatenate([np.flatnonzero(text[1:] != text[:-1]), [n - 1]])  # ends of runs
        length = np.diff(last, prepend=-1)
        after = np.append(text[last[:-1] + 1], 0)
        rises = np.append(after[:-1] > text[last[:-1]], True)
        self.rising = mapped(folder, bool, n)
        self.rising[:] = np.repeat(rises, length)
        if depth:  # symbols left in the run that a position is in
            self.run = mapped(folder, np.uint16, n)
            self.run[:] = np.minimum(np.repeat((last + 1).astype(np.int64), length) - np.arange(n), depth)
        self.lms = np.flatnonzero(self.rising[1:] & ~self.rising[:-1]) + 1
        if depth or self.top <= RANGES:
            self.bounds = np.arange(self.top + 1)
        else:  # ranges of about equal numbers of positions
            counts = np.cumsum(np.bincount(text, minlength=self.top))
            cuts = np.searchsorted(counts, np.arange(1, RANGES) * (n / RANGES)) + 1
            self.bounds = np.unique(np.concatenate([[0], cuts, [self.top]]))
        self.single = np.diff(self.bounds) == 1

    def range_of(self, symbols: np.ndarray) -> np.ndarray:
        if len(self.bounds) == self.top + 1:  # one symbol each
            return symbols
        return np.searchsorted(self.bounds, symbols, "right") - 1

    # -- one pass over whole arrays ---------------------------------------------------------------
    def _deal(self, queue: DiskQueue, prev: np.ndarray, pick: np.ndarray, scanned: np.ndarray | None, state) -> None:
        """Push the picked predecessors to their buckets; prefixes are least values since the last push."""
        target = self.range_of(self.text[prev[pick]]) if len(pick) else pick
        order = np.argsort(target.astype(np.uint16), kind="stable")
        target, pick = target[order], pick[order]
        cut = np.flatnonzero(np.diff(target, prepend=-1, append=-1)) if len(target) else np.zeros(1, np.int64)
        if scanned is not None:
            since, begun = state
            old = since.copy()
            if len(scanned):
                np.minimum(since, scanned.min(), out=since)
        for a, b in zip(cut[:-1], cut[1:]):
            t, at = int(target[a]), pick[a:b]
            if scanned is None:
                queue.push(t, prev[at])
                continue
            least = np.minimum.reduceat(scanned[:at[-1] + 1], np.concatenate([[0], at[:-1] + 1])).astype(np.int64)
            least[0] = min(least[0], old[t])
            least = np.minimum(least + 1, self.depth).astype(np.uint16)
            if not begun[t]:
                least[0], begun[t] = 0, True
            rest = scanned[at[-1] + 1:]
            since[t] = rest.min() if len(rest) else self.depth
            queue.push(t, prev[at], least)

    def _state(self):
        n = len(self.bounds) - 1
        return np.full(n, self.depth, np.int64), np.zeros(n, bool)

    def induce(self, seeds: np.ndarray, prefixes: np.ndarray | None, seen) -> None:
        """Sort all suffixes from sorted ``seeds``; ``seen(positions, prefixes)`` gets them descending."""
        falling = DiskQueue(self.folder, len(self.single), self.memory)
        done = DiskQueue(self.folder, len(self.single), self.memory)
        seed_range = self.range_of(self.text[seeds])
        cuts = np.searchsorted(seed_range, np.arange(len(self.single) + 1))
        state = self._state() if self.depth else None
        for r, single in enumerate(self.single):
            own = slice(cuts[r], cuts[r + 1])
            if not single:
                position, seed = self._several(r, falling, self._arrived(falling, r), seeds[own], False)
                done.push(r, position[~seed])
                continue
            last = -1
            while falling.sizes[r] + falling.spilled[r]:
                for position, prefix in falling.pop(r):
                    done.push(r, position, prefix)
                    self._scan(falling, position, prefix, False, state)
                    last = int(position[-1])
            if cuts[r] < cuts[r + 1]:
                position, prefix = seeds[own], None
                if self.depth:
                    prefix = prefixes[own].copy()
                    prefix[0] = min(self.run[last], self.run[position[0]]) if last >= 0 else 0
                for at in range(0, len(position), PIECE):
                    piece = slice(at, at + PIECE)
                    self._scan(falling, position[piece], None if prefix is None else prefix[piece], False, state)
        rising = falling  # empty again
        state = self._state() if self.depth else None
        for r in range(len(self.single) - 1, -1, -1):
            if not self.single[r]:
                seen(self._several(r, rising, self._arrived(rising, r), self._arrived(done, r)[::-1], True)[0], None)
                continue
            last = -1
            while rising.sizes[r] + rising.spilled[r]:
                for position, prefix in rising.pop(r):
                    seen(position, prefix)
                    self._scan(rising, position, prefix, True, state)
                    last = int(position[-1])
            carried = None
            for position, prefix in done.pop(r, backwards=True):
                if self.depth:
                    # Going down, a suffix has the prefix value its greater neighbour had going up.
                    if carried is None:
                        carried = min(self.run[last], self.run[position[0]]) if last >= 0 else 0
                    down = np.concatenate([[carried], prefix[:-1]]).astype(np.uint16)
                    carried = prefix[-1]
                    prefix = down
                seen(position, prefix)
                self._scan(rising, position, prefix, True, state)
        seen(np.array([self.n - 1]), np.zeros(1, np.uint16))

    def _scan(self, queue: DiskQueue, position, prefix, rising: bool, state) -> None:
        prev = position - 1
        pick = np.flatnonzero((position > 0) & (self.rising[prev] == rising))
        self._deal(queue, prev, pick, prefix if self.depth else None, state)

    # -- ranges of several symbols ------------------------------------------------------------------
    def _arrived(self, queue: DiskQueue, r: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.int64), *(p for p, _ in queue.pop(r))])

    def _several(self, r: int, queue: DiskQueue, arrived: np.ndarray, others: np.ndarray,
                 rising: bool) -> tuple[np.ndarray, np.ndarray]:
        """Handle a range of several symbols; returns its suffixes in scanning order, and which are ``others``.

        Suffixes of a symbol are scanned in three classes: those that arrived from other ranges,
        those induced inside this range, and ``others`` (seeds on the way up, falling ones on the
        way down). Few are induced inside, so only those are placed one by one."""
        sign, low, high = -1 if rising else 1, int(self.bounds[r]), int(self.bounds[r + 1])
        classes = []
        for kind, position in ((0, arrived), (2, others)):
            symbol = sign * self.text[position]
            order = np.argsort(symbol, kind="stable")
            classes.append((symbol[order], np.full(len(order), kind), np.arange(len(order)), position[order]))
        waiting: dict[int, list[tuple]] = {}
        heap: list[int] = []

        def wait(parent: tuple, q: int) -> None:
            d = sign * int(self.text[q])
            if d not in waiting:
                waiting[d] = []
                heapq.heappush(heap, d)
            waiting[d].append((parent, q))

        for symbol, kind, nth, position in classes:
            q = position - 1
            prev = self.text[q]
            for i in np.flatnonzero((position > 0) & (self.rising[q] == rising) & (prev >= low) & (prev < high)).tolist():
                wait((int(symbol[i]), int(kind[i]), i), int(q[i]))
        inside = []
        while heap:
            d = heap[0]
            items = sorted(waiting[d])
            for k, (_, q) in enumerate(items):  # grows while it is read
                inside.append((d, 1, k, q))
                if q and bool(self.rising[q - 1]) == rising and low <= self.text[q - 1] < high:
                    if sign * int(self.text[q - 1]) == d:
                        items.append(((d, 1, k), q - 1))
                    else:
                        wait((d, 1, k), q - 1)
            heapq.heappop(heap)
            del waiting[d]
        classes.append(tuple(np.array(x, np.int64) for x in zip(*inside)) if inside
                       else tuple(np.zeros(0, np.int64) for _ in range(4)))
        symbol, kind, nth, position = map(np.concatenate, zip(*classes))
        order = np.lexsort((nth, kind, symbol))
        position, kind = position[order], kind[order]
        q = position - 1
        prev = self.text[q]
        pick = np.flatnonzero((position > 0) & (self.rising[q] == rising) & ((prev < low) | (prev >= high)))
        self._deal(queue, q, pick, None, None)
        return position, kind == 2

    # -- the order of the seeds ------------------------------------------------------------------------
    def sorted_seeds(self) -> np.ndarray:
        """Positions that begin a rise, in the order of their suffixes."""
        depth, self.depth = self.depth, 0
        lms, m = self.lms, len(self.lms)
        is_lms = np.zeros(self.n, bool)
        is_lms[lms] = True
        parts: list[np.ndarray] = []
        first = lms[np.argsort(self.text[lms], kind="stable")]
        self.induce(first, None, lambda position, _: parts.append(position[is_lms[position]]))
        self.depth = depth
        order = np.concatenate(parts)[::-1]
        # Names: equal pieces from one such position to the next get one name.
        place = np.searchsorted(lms, order)
        end = (np.append(lms[1:], self.n - 1) + 1)[place]
        length = end - order
        hashes = spans_by_piece(self.text, order, end)
        name = np.cumsum((np.diff(length, prepend=-1) != 0) | (np.diff(hashes.view(np.int64), prepend=0) != 0))
        if m <= 1 or name[-1] == m:
            return order
        names = mapped(self.folder, np.int64, m + 1)
        names[place] = name
        names[m] = 0
        deeper = Inducer(names, self.folder, self.memory)
        found: list[np.ndarray] = []
        deeper.induce(deeper.sorted_seeds(), None, lambda position, _: found.append(position))
        return lms[np.concatenate(found)[::-1][1:]]


def mapped(folder: str, kind, n: int) -> np.ndarray:
    """An array of zeros; a large one lies in a file that the system pages in and out."""
    if n * np.dtype(kind).itemsize <= IN_MEMORY:
        return np.zeros(n, kind)
    handle, path = tempfile.mkstemp(dir=folder)
    os.close(handle)
    return np.memmap(path, kind, "w+", shape=n).view(np.ndarray)


def spans_by_piece(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of short spans of a long text, by stretches of it."""
    out = np.empty(len(start), np.uint64)
    piece = rolling.SLICE
    group = start // piece
    with np.errstate(over="ignore"):
        for g in np.unique(group):
            pick = np.flatnonzero(group == g)
            a, b = int(g) * piece, int(end[pick].max())
            prefix = LANE.prefix(text[a:b].astype(np.uint64) + np.uint64(1), LANE.base)
            out[pick] = LANE.take(prefix, LANE.base, start[pick] - a, end[pick] - a)
    return out


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each seed with the one before it in ``order``, up to ``depth``.

    Every ``SPACED``-th seed of the text is compared in full. If it agrees with its predecessor for l symbols, and
    the place d further in the predecessor is a seed too, then the seed d further agrees with its own
    predecessor for l - d symbols at least: the others are compared from there."""
    n, m = len(text), len(order)
    rank = np.empty(m, np.int64)
    by_place = np.argsort(order)
    rank[:] = by_place
    seeds = order[by_place]  # in order of the text
    before = np.full(m, -1)  # predecessors, in order of the text
    inner = rank > 0
    before[inner] = order[rank[inner] - 1]
    out = np.zeros(m, np.int64)
    sampled = np.arange(0, m, SPACED)
    out[sampled] = agreeing(text, seeds[sampled], before[sampled], out[sampled], depth)
    rest = np.flatnonzero(np.arange(m) % SPACED)
    sample = rest // SPACED * SPACED
    further = seeds[rest] - seeds[sample]
    least = np.maximum(out[sample] - further, 0)
    is_seed = np.zeros(n, bool)
    is_seed[seeds] = True
    least[~is_seed[np.where(least > 0, before[sample] + further, 0)]] = 0
    out[rest] = agreeing(text, seeds[rest], before[rest], least, depth)
    found = np.zeros(m, np.uint16)
    found[rank] = out
    return found


def agreeing(text: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray, depth: int) -> np.ndarray:
    """How many symbols agree at ``a`` and ``b`` (none if that is negative), up to ``depth``, of which the first
    ``known`` do; compared in growing steps while they agree."""
    out = known.copy()
    open_ = np.flatnonzero((b >= 0) & (known < depth))
    step = 8
    # The text ends with its only 0, so suffixes differ before either of them ends.
    padded = np.concatenate([text, np.zeros(32, text.dtype)])
    while len(open_):
        rows = np.lib.stride_tricks.sliding_window_view(padded, step)
        keep = []
        for lo in range(0, len(open_), 1 << 15):
            here = open_[lo:lo + (1 << 15)]
            differ = rows[a[here] + out[here]] != rows[b[here] + out[here]]
            first = differ.argmax(1)
            same = ~differ[np.arange(len(here)), first]
            out[here] += np.where(same, step, first)
            keep.append(here[same & (out[here] < depth)])
        open_ = np.concatenate(keep)
        step = 32
    return np.minimum(out, depth)


def repeated_starts(pieces: Iterable[bytes], depth: int, memory: int = 32 << 20) -> np.ndarray:
    """Which positions of the joined pieces (each followed by one separator) start ``depth`` bytes that
    also start elsewhere in a piece. The pieces are read once and written to disk."""
    with tempfile.TemporaryDirectory() as folder:
        n = 0
        with open(f"{folder}/text", "wb") as f:
            for p in pieces:
                f.write((np.frombuffer(p, np.uint8).astype(np.uint16) + 2).tobytes() + b"\x01\x00")
                n += len(p) + 1
            f.write(b"\x00\x00")
        text = np.memmap(f"{folder}/text", np.uint16, "r+").view(np.ndarray)
        marks = np.zeros(n + 1, bool)
        last = n

        def seen(position: np.ndarray, prefix: np.ndarray) -> None:
            nonlocal last
            hit = np.flatnonzero(prefix >= depth)
            before = np.concatenate([[last], position[:-1]])
            marks[position[hit]] = True
            marks[before[hit]] = True
            last = int(position[-1]) if len(position) else last

        sorter = Inducer(text, folder, memory, depth)
        seeds = sorter.sorted_seeds()
        sorter.induce(seeds, common_prefixes(text, seeds, depth), seen)
        # A common prefix that holds a separator is no match inside the pieces.
        ends = np.flatnonzero(text == 1)
        room = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(n)
        return marks[:n] & (room >= depth)
