"""Cutting texts into segments whose equal byte windows meet under one key.

Every window of ``width`` bytes has a minimizer: the least hash of its ``gram``-byte strings. Equal
windows have equal minimizers, so windows grouped by minimizer are complete. Consecutive
windows of one minimizer make one segment. Longer grams make smaller groups; a gram of the whole
window makes one group for each distinct window."""

from __future__ import annotations

import numpy as np

from . import rolling

GRAM = 96
PLACE_BITS = 22  # places in a joined slice


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones, by spans that double."""
    least, span = x, 1
    while 2 * span <= width:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    rest = width - span
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def starts_inside(lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the joined texts where a window begins that ends in the same text, and windows of each text."""
    ends = np.cumsum(lengths)
    inside = np.ones(max(0, int(lengths.sum()) - width + 1), bool)
    for end in ends.tolist():
        inside[max(0, end - width + 1):end] = False
    return np.flatnonzero(inside), np.maximum(lengths - width + 1, 0)


def segments(texts: list[bytes], width: int, lane: rolling.Hasher, gram: int = GRAM):
    """``(keys of minimizer occurrences, key, text, start, windows)`` of all segments of the texts."""
    buf = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    none = np.zeros(0, np.int64)
    if len(buf) > 1 << PLACE_BITS:
        raise ValueError(f"{len(buf)} joined bytes; places have {PLACE_BITS} bits")
    if len(buf) < width:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    keyed = lane.every(buf, gram)
    keyed >>= np.uint64(PLACE_BITS)
    keyed <<= np.uint64(PLACE_BITS)
    keyed |= np.arange(len(keyed), dtype=np.uint64)
    least = sliding_min(keyed, width - gram + 1)
    ends = np.cumsum(lengths)
    valid, count = starts_inside(lengths, width)
    least, text = least[valid], np.repeat(np.arange(len(texts)), count)
    if not len(valid):
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    value = least >> np.uint64(PLACE_BITS)
    new = np.concatenate([[True], value[1:] != value[:-1]])
    new[(np.cumsum(count) - count)[count > 0]] = True  # the first window of a text
    place = np.concatenate([[True], least[1:] != least[:-1]])
    cut = np.flatnonzero(new)
    windows = np.diff(cut, append=len(valid))
    return value[place], value[cut], text[cut], valid[cut] - (ends - lengths)[text[cut]], windows
