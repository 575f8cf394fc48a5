"""Word shingles of whole texts as bags of hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from orderloom.llm.common import offsets_of, ranges
from orderloom.llm.words import window_owners, windows, words_of

SHINGLE = 5

# Texts that shingle_bags handles at once: their numbers have 12 bits beside a shingle's 52.
MOST_TEXTS = 1 << 12


def shingle_bags(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of all texts: the text's number, the shingle's hash (52 bits), how often.

    A text of one to four words has one shingle, all its words; a text without words has none.
    """
    if len(texts) > MOST_TEXTS:
        raise ValueError(f"at most {MOST_TEXTS} texts at once")
    words = words_of(texts)
    counts = np.diff(words.ends)
    values = windows(words.hashes, SHINGLE)
    owners, inside = window_owners(words.ends, SHINGLE, len(values))
    values, owners = values[inside], owners[inside]
    few = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(few):
        whole = [windows(words.hashes[words.ends[i] : words.ends[i + 1]], int(counts[i]))[0] for i in few]
        values, owners = np.concatenate((values, np.array(whole, np.uint64))), np.concatenate((owners, few))
    keys = (owners.astype(np.uint64) << np.uint64(52)) | (values >> np.uint64(12))
    distinct, times = np.unique(keys, return_counts=True)
    return (distinct >> np.uint64(52)).astype(np.int64), distinct & np.uint64((1 << 52) - 1), times


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """The weighted Jaccard similarity of the shingle bags of each pair; 0 if either has no words."""
    n = len(left)
    owners, shingles, times = shingle_bags(pa.concat_arrays([left, right]))
    total = np.bincount(owners, weights=times, minlength=2 * n)
    # Shingles of a pair meet when both sides have the pair's number.
    keys = ((owners % n).astype(np.uint64) << np.uint64(52)) | shingles
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], times[order]
    both = np.flatnonzero(keys[1:] == keys[:-1])
    pair = (keys[both] >> np.uint64(52)).astype(np.int64)
    shared = np.bincount(pair, weights=np.minimum(counts[both], counts[both + 1]), minlength=n)
    union = total[:n] + total[n:] - shared
    return np.divide(shared, union, out=np.zeros(n), where=union > 0)


# Columns of a dense product, and increments of sparse ones, taken at once.
_COLUMNS, _STEPS = 2048, 1 << 21


def cross_similarities(
    owners: np.ndarray, values: np.ndarray, times: np.ndarray, left: np.ndarray, right: np.ndarray
) -> np.ndarray:
    """The weighted Jaccard similarity of every left with every right text, given the bags of all.

    Shingles that many texts have are compared by a product of matrices, the others one by one.
    """
    # The k-th occurrence of a shingle is an element of its own, so what two bags share is a count of elements.
    number = np.unique(values, return_inverse=True)[1].astype(np.int64)
    most = int(times.max(initial=1))
    occurrence = ranges(np.zeros(len(times), np.int64), times)
    elements = np.unique(np.repeat(number, times) * most + occurrence, return_inverse=True)[1]
    owner, size = np.repeat(owners, times), int(elements.max(initial=-1)) + 1
    sides = [_side(owner, elements, chosen, size) for chosen in (left, right)]
    counts = [np.bincount(e, minlength=size) for _, e, _ in sides]
    shared = _shared(sides, counts, len(left), len(right))
    union = sides[0][2][:, None] + sides[1][2][None, :] - shared
    return np.divide(shared, union, out=np.zeros_like(shared), where=union > 0)


def _side(owner: np.ndarray, elements: np.ndarray, chosen: np.ndarray, size: int) -> tuple:
    """Places in ``chosen`` and elements, ordered by element, and the size of each chosen bag."""
    place = np.full(int(owner.max(initial=-1)) + 1, -1)
    place[chosen[chosen < len(place)]] = np.flatnonzero(chosen < len(place))
    at = place[owner]
    order = np.flatnonzero(at >= 0)
    order = order[np.argsort(elements[order], kind="stable")]
    return at[order], elements[order], np.bincount(at[order], minlength=len(chosen)).astype(np.float64)


def _shared(sides: list[tuple], counts: list[np.ndarray], n: int, m: int) -> np.ndarray:
    both = counts[0] * counts[1]
    dense = np.flatnonzero(both * 64 > n * m)
    found = np.zeros((n, m))
    for k in range(0, len(dense), _COLUMNS):
        some = dense[k : k + _COLUMNS]
        column = np.full(len(both), -1)
        column[some] = np.arange(len(some))
        factors = []
        for (at, elements, _), rows in zip(sides, (n, m), strict=True):
            chosen = column[elements] >= 0
            factors.append(np.zeros((rows, len(some)), np.float32))
            factors[-1][at[chosen], column[elements[chosen]]] = 1
        found += factors[0] @ factors[1].T
    # Every entry of the right side meets those of its element on the left.
    starts = offsets_of(counts[0])
    at, elements, _ = sides[1]
    rest = np.flatnonzero((both[elements] > 0) & (both[elements] * 64 <= n * m))
    at, elements = at[rest], elements[rest]
    lengths = counts[0][elements]
    steps = np.cumsum(lengths) // _STEPS
    for i, j in zip(*(lambda b: (b[:-1], b[1:]))(np.flatnonzero(np.diff(steps, prepend=-1, append=-2))), strict=True):
        met = sides[0][0][ranges(starts[elements[i:j]], lengths[i:j])]
        flat = met * m + np.repeat(at[i:j], lengths[i:j])
        found += np.bincount(flat, minlength=n * m).reshape(n, m)
    return found
