"""Word shingles as sets of 64-bit hashes, computed with numpy over whole Arrow string buffers.

Words are the runs of bytes other than space and \\x09-\\x0D, with A-Z lower-cased. A text's set
holds the hash of every distinct run of ``k`` consecutive words; a text with fewer words has one
shingle, its whole word sequence; a text without words has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_M = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), elementwise."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    """A 64-bit value per byte; A-Z get the values of a-z."""
    v = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    v[65:91] = v[97:123]
    return v


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends) of a string column; null entries are empty."""
    column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    starts, ends = offsets[:-1].copy(), offsets[1:].copy()
    if column.null_count:
        ends = np.where(np.asarray(column.is_null()), starts, ends)
    return data, starts, ends


_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_STRETCH = 1 << 14


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n, np.uint64(base), dtype=np.uint64))))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every word ``data[start:end]``; words are in order and do not overlap.

    The hash is a polynomial over the bytes' 64-bit values, taken as a difference of prefix sums and
    moved to the word's own start, then mixed with the length. Powers are those of the place within a
    fixed stretch of bytes, so their tables stay small; a word that leaves its stretch is summed alone.
    """
    value, up, down = _byte_values(), _powers(_BASE, 2 * _STRETCH), _powers(_INVERSE, 2 * _STRETCH)
    out = np.zeros(len(starts), dtype=np.uint64)
    place = starts // _STRETCH
    first = 0
    while first < len(starts):
        lo = int(place[first]) * _STRETCH
        last = int(np.searchsorted(place, place[first], side="right"))
        s, e = starts[first:last] - lo, ends[first:last] - lo
        piece = data[lo:lo + 2 * _STRETCH]
        total = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(value[piece] * up[:len(piece)], out=total[1:])
        h = (total[np.minimum(e, len(piece))] - total[s]) * down[s]
        for i in np.flatnonzero(e > len(piece)):  # a word longer than a stretch
            word = value[data[lo + s[i]:lo + e[i]]]
            h[i] = (word * _powers(_BASE, len(word))[:-1]).sum(dtype=np.uint64)
        out[first:last] = mix(h ^ (e - s).astype(np.uint64))
        first = last
    return out


def text_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts of a buffer, and per text the number of its first word."""
    if not len(data) or not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(starts) + 1, np.int64)
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    blank = (data == 32) | ((data >= 9) & (data <= 13)) | (np.cumsum(inside[:-1], dtype=np.int8) <= 0)
    change = np.zeros(len(data) + 1, dtype=bool)
    change[1:-1] = blank[1:] != blank[:-1]
    change[0], change[-1] = not blank[0], not blank[-1]
    full = starts[starts < ends]
    change_starts = np.zeros(len(data) + 1, dtype=bool)
    change_starts[full] = True
    begins = np.flatnonzero((change | change_starts)[:-1] & ~blank)
    stops_at = np.flatnonzero((change | change_starts))
    # a word stops at the next change or at the next text
    after = np.searchsorted(stops_at, begins, side="right")
    stops = stops_at[after]
    return word_hashes(data, begins, stops), np.searchsorted(begins, np.append(starts, ends[-1]))


def shingle_sets(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int = 5):
    """Yields each text's sorted distinct shingle hashes (uint64)."""
    with np.errstate(over="ignore"):
        words, first = text_words(data, starts, ends)
        gold = np.uint64(0x9E3779B97F4A7C15)
        runs = np.zeros(0, np.uint64)
        if len(words) >= k:
            runs = np.full(len(words) - k + 1, np.uint64(k), dtype=np.uint64)
            for j in range(k):
                runs = mix(runs * gold + words[j:len(words) - k + 1 + j])
        for a, b in zip(first[:-1], first[1:], strict=True):
            n = b - a
            if n >= k:
                h = np.sort(runs[a:b - k + 1])
                yield h[np.concatenate(([True], h[1:] != h[:-1]))]
            elif n:
                h = np.full(1, np.uint64(n), dtype=np.uint64)
                for w in words[a:b]:
                    h = mix(h * gold + w)
                yield h
            else:
                yield words[:0]


def sets_of(column: pa.Array, k: int = 5, batch_bytes: int = 4 << 20):
    """Yields the shingle set of every row of a string column, a few MB of text at a time."""
    data, starts, ends = string_bytes(column)
    at, n = 0, len(starts)
    while at < n:
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + batch_bytes, side="right")))
        lo, hi = starts[at], ends[at:stop].max()
        yield from shingle_sets(data[lo:hi], starts[at:stop] - lo, ends[at:stop] - lo, k)
        at = stop
