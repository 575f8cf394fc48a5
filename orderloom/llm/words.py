"""The words of whole texts, found and hashed in the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from orderloom.llm.common import offsets_of, ranges

# Bytes of text that one step inside a task handles at once, unless a single text has more.
# Arrow batches are cut to it, so memory does not follow the long documents in a batch.
STEP_BYTES = 2 << 20

# Words are what lies between these bytes, space and tab to carriage return. No
# character of more bytes contains one of them.
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the value."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTOR = 0x9E3779B97F4A7C15
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


class _Powers:
    """Powers of the factor and of its inverse, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up = self._grown(_FACTOR, size)
            self.down = self._grown(pow(_FACTOR, -1, 1 << 64), size)
        return self.up, self.down

    @staticmethod
    def _grown(factor: int, size: int) -> np.ndarray:
        found = np.ones(size, np.uint64)
        have = 1
        while have < size:
            more = min(have, size - have)
            found[have : have + more] = found[:more] * np.uint64(pow(factor, have, 1 << 64))
            have += more
        return found


_POWERS = _Powers()


@dataclass
class Words:
    """The words of consecutive texts: text ``i`` has words ``ends[i]`` up to ``ends[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray


def string_slices(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of at most ``limit`` bytes, or of one longer text."""
    ends = offsets_in(texts)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(ends, ends[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield start, stop
        start = stop


def text_steps(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[list[str]]:
    """The texts as Python strings, a few at a time."""
    for i, j in string_slices(texts, limit):
        yield texts.slice(i, j - i).to_pylist()


def offsets_in(texts: pa.Array) -> np.ndarray:
    """Where the texts of a string column start in its bytes, and the end of the last."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    raw = np.frombuffer(texts.buffers()[1], kind) if len(texts) else np.zeros(1, kind)
    return raw[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def words_of(texts: pa.Array, hashed: bool = True) -> Words:
    """Find all words of a string column without NULLs."""
    offsets = offsets_in(texts)
    base, size = int(offsets[0]), int(offsets[-1] - offsets[0])
    buffer = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(buffer, np.uint8)[base : base + size] if buffer is not None else np.zeros(0, np.uint8)
    offsets = offsets - base
    blank = np.ones(size + 1, bool)
    blank[:size] = _BLANK[data]
    # A word starts behind a blank or at the start of a text.
    fresh = np.zeros(size + 1, bool)
    fresh[0] = True
    fresh[1:] = blank[:-1]
    fresh[offsets] = True
    starts = np.flatnonzero(fresh[:size] & ~blank[:size])
    # It stops at the next blank or the end of its text.
    stop = blank.copy()
    stop[offsets] = True
    places = np.flatnonzero(stop)
    stops = places[np.searchsorted(places, starts, "right")] if len(starts) else starts
    ends = np.searchsorted(starts, offsets).astype(np.int64)
    hashes = _hashes(data, starts, stops) if hashed else np.zeros(0, np.uint64)
    return Words(data, starts, stops, ends, hashes)


def _hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64 bits for every word, from sums over its bytes that do not depend on where it stands."""
    up, down = _POWERS.of(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=total[1:])
    return mixed((total[stops] - total[starts]) * down[starts] + (stops - starts).astype(np.uint64))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words, over all texts together."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = np.zeros(n, np.uint64)
    for k in range(size):
        found *= np.uint64(_FACTOR)
        found += hashes[k : k + n]
    return mixed(found)


def window_owners(ends: np.ndarray, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ``n`` windows the text each starts in, and whether it lies in that text whole."""
    counts = np.diff(ends)
    owner = np.repeat(np.arange(len(counts)), counts)[:n]
    return owner, np.arange(n) + size <= ends[owner + 1]


def joined(words: Words, chosen: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Texts of chosen words joined by one space: text ``i`` has ``chosen[bounds[i]:bounds[i + 1]]``."""
    spaced = np.ones(len(chosen), bool)
    spaced[bounds[:-1][bounds[:-1] < bounds[1:]]] = False
    # A word is copied behind a space unless it is the first of its text.
    sizes = words.stops[chosen] - words.starts[chosen]
    places = offsets_of(sizes + spaced)
    out = np.full(int(places[-1]), 0x20, np.uint8)
    out[ranges(places[:-1] + spaced, sizes)] = words.data[ranges(words.starts[chosen], sizes)]
    ends = places[bounds].astype(np.int32)
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(ends.tobytes()), pa.py_buffer(out.tobytes()))


def kept_texts(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of every text, joined by one space."""
    chosen = np.flatnonzero(kept)
    return joined(words, chosen, np.searchsorted(chosen, words.ends))


def stretches(words: Words, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """The words from ``first[i]`` up to ``last[i]``, joined by one space."""
    return joined(words, ranges(first, last - first), offsets_of(last - first))
