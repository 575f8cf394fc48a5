"""Tables of distinct chunks: what is known of a chunk is computed once and found again by position."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np

from orderloom.llm.common import offsets_of, ranges

# Entries of one table; with the keys it takes some 40 MB. A full one forgets the chunks that came
# up once or seldom, which costs time and changes no result. New chunks are worked on so many at a time.
MOST_CHUNKS = 200_000
LEARN_CHUNKS = 50_000

# Bytes of text that are looked up together: their words are Python strings meanwhile.
STEP_BYTES = 1 << 19


def flattened(lists: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The lengths of all lists, and their numbers one after another."""
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    return lengths, np.fromiter(chain.from_iterable(lists), np.int32, int(lengths.sum()))


class ChunkTable(dict):
    """Numbers distinct chunks, and hands new ones to ``_learn`` many at a time.

    A table lives as long as its Python worker, so a chunk is worked on once per
    worker and not once per batch or document.
    """

    def __init__(self, most: int = MOST_CHUNKS):
        super().__init__()
        self._most = most
        self._new: list[str] = []
        self._uses = np.zeros(0, np.int64)

    def _keep(self, places: np.ndarray) -> None:
        """Keep what is known of the chunks at these places, in this order, and drop the rest."""
        raise NotImplementedError

    def _forget(self) -> None:
        """Keep the chunks that came up several times, half a table at most. Earlier uses count half."""
        often = np.flatnonzero(self._uses > 1)
        if len(often) > self._most // 2:
            often = np.sort(often[np.argsort(-self._uses[often], kind="stable")[: self._most // 2]])
        # Chunks stand in the order of their places.
        chunks = list(self)
        self.clear()
        self.update((chunks[place], k) for k, place in enumerate(often.tolist()))
        self._uses = self._uses[often] // 2
        self._keep(often)

    def _learn(self, chunks: list[str]) -> None:
        raise NotImplementedError

    def __missing__(self, chunk: str) -> int:
        self[chunk] = place = len(self)
        self._new.append(chunk)
        return place

    def places(self, documents: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Where the chunks of each document start among all, and the number of every chunk."""
        if len(self) > self._most:
            self._forget()
        ends = offsets_of([len(chunks) for chunks in documents])
        places = np.empty(int(ends[-1]), np.int64)
        for k, chunks in enumerate(documents):
            places[ends[k] : ends[k + 1]] = np.fromiter(map(self.__getitem__, chunks), np.int64, len(chunks))
        self._used(places)
        return ends, places

    def coded_places(self, chunks: list[str], codes: np.ndarray) -> np.ndarray:
        """The number of every chunk ``chunks[codes[i]]``; so each is looked up once, however often it comes."""
        if len(self) > self._most:
            self._forget()
        places = np.fromiter(map(self.__getitem__, chunks), np.int64, len(chunks))[codes]
        self._used(places)
        return places

    def _used(self, places: np.ndarray) -> None:
        """Learn the new chunks, and count the uses of all."""
        if self._new:
            new, self._new = self._new, []
            for k in range(0, len(new), LEARN_CHUNKS):
                self._learn(new[k : k + LEARN_CHUNKS])
            self._uses = np.concatenate((self._uses, np.zeros(len(new), np.int64)))
        self._uses += np.bincount(places, minlength=len(self))


class ChunkIds(ChunkTable):
    """The ids of every distinct chunk; ``encode_many`` gives their numbers and all of them."""

    def __init__(self, encode_many: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int = MOST_CHUNKS):
        super().__init__(most)
        self._encode = encode_many
        self._starts = np.zeros(0, np.int64)
        self._lengths = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.int32)

    def _keep(self, places: np.ndarray) -> None:
        lengths = self._lengths[places]
        self._ids = self._ids[ranges(self._starts[places], lengths)]
        self._starts, self._lengths = np.cumsum(lengths) - lengths, lengths

    def ids(self, documents: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of every document, given as its chunks, and the ids of all."""
        return self._at(*self.places(documents))

    def coded_ids(self, chunks: list[str], codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for documents whose chunks are ``chunks[codes[i]]``, document ``k`` from ``ends[k]`` on."""
        return self._at(ends, self.coded_places(chunks, codes))

    def _at(self, ends: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self._lengths[places]
        flat = self._ids[ranges(self._starts[places], lengths)]
        return np.diff(offsets_of(lengths)[ends]), flat

    def _learn(self, chunks: list[str]) -> None:
        lengths, flat = self._encode(chunks)
        starts = len(self._ids) + np.cumsum(lengths) - lengths
        self._starts = np.concatenate((self._starts, starts))
        self._lengths = np.concatenate((self._lengths, lengths))
        self._ids = np.concatenate((self._ids, flat))
