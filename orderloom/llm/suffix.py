"""A suffix automaton over words, with matching statistics."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence

import numpy as np


class WordAutomaton:
    """All word sequences that occur in any of the texts it was built from."""

    def __init__(self, texts: Iterable[Sequence[Hashable]]):
        self._moves: list[dict] = [{}]
        self._links = [-1]
        self._lengths = [0]
        for text in texts:
            self._add(text)

    def _add(self, text: Sequence[Hashable]) -> None:
        """Another text; no sequence runs on from one text into the next."""
        moves, links, lengths = self._moves, self._links, self._lengths
        last = 0
        for word in text:
            known = moves[last].get(word)
            if known is not None and lengths[known] == lengths[last] + 1:
                last = known
                continue
            if known is not None:
                last = self._copy(last, word, known)
                continue
            state = len(moves)
            moves.append({})
            links.append(0)
            lengths.append(lengths[last] + 1)
            at = last
            while at >= 0 and word not in moves[at]:
                moves[at][word] = state
                at = links[at]
            if at >= 0:
                target = moves[at][word]
                same = lengths[target] == lengths[at] + 1
                links[state] = target if same else self._copy(at, word, target)
            last = state

    def _copy(self, at: int, word: Hashable, target: int) -> int:
        """A state for the shorter sequences of ``target``, those that ``word`` ends behind ``at``."""
        moves, links, lengths = self._moves, self._links, self._lengths
        copy = len(moves)
        moves.append(dict(moves[target]))
        links.append(links[target])
        lengths.append(lengths[at] + 1)
        while at >= 0 and moves[at].get(word) == target:
            moves[at][word] = copy
            at = links[at]
        links[target] = copy
        return copy

    def matches(self, text: Sequence[Hashable]) -> np.ndarray:
        """How many words up to each word, that one included, occur here in a row."""
        moves, links, lengths = self._moves, self._links, self._lengths
        found = np.zeros(len(text), np.int64)
        state = length = 0
        for i, word in enumerate(text):
            following = moves[state].get(word)
            while following is None and state > 0:
                state = links[state]
                length = lengths[state]
                following = moves[state].get(word)
            if following is not None:
                state, length = following, length + 1
            else:
                length = 0
            found[i] = length
        return found


def covered(matches: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a match of ``least`` or more words."""
    ends = np.flatnonzero(matches >= least)
    change = np.zeros(len(matches) + 1, np.int64)
    np.add.at(change, ends + 1 - least, 1)
    np.add.at(change, ends + 1, -1)
    return np.cumsum(change[:-1]) > 0
