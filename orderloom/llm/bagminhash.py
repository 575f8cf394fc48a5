"""BagMinHash: signatures whose agreement is the weighted Jaccard similarity of two bags."""

from __future__ import annotations

import numpy as np

from orderloom.llm.words import mixed

_STEP = np.uint64(0xD1B54A32D192ED03)
_BUCKET = np.uint64(0x8CB92BA72F3D8DD7)
_PLACE = np.uint64(0xABC98388FB8FAC03)


def _uniform(bits: np.ndarray) -> np.ndarray:
    """Numbers above 0 and up to 1."""
    return ((bits >> np.uint64(11)).astype(np.float64) + 1) / float(1 << 53)


def _processes(owners: np.ndarray, elements: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """The Poisson processes of all elements.

    An element's weight axis is cut, the same way for every bag, at 1, 2, 4, 8
    and so on; each octave below its weight has one process with as many points
    per time as the octave is wide. In the last octave only points below the
    weight count. So heavy elements cost as many processes as their weight has
    binary digits, and bags share the points of the weight they share.
    """
    found = []
    low, width = 0, 1
    live = np.arange(len(weights))
    while len(live):
        seeds = mixed(elements[live] * _STEP + np.uint64(low + 1))
        found.append((owners[live], seeds, np.full(len(live), width, np.int64), weights[live] - low))
        low, width = low + width, max(1, low + width)
        live = live[weights[live] > low]
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def signatures(owners: np.ndarray, elements: np.ndarray, weights: np.ndarray, bags: int, size: int) -> np.ndarray:
    """A row of ``size`` hashes for each of ``bags`` bags; all bags must have an element.

    Points of every process come in ascending time and fall into one of
    ``size`` buckets each; a bucket keeps its first point. A process ends at its
    first point behind the last bucket's, so most give one point only.
    """
    first = np.full(bags * size, np.inf)
    kept = np.zeros(bags * size, np.uint64)
    if not len(owners):
        return kept.reshape(bags, size)
    owner, seed, width, room = _processes(owners, elements, weights)
    time = np.zeros(len(owner))
    last = np.full(bags, np.inf)
    step = 0
    while len(owner):
        step += 1
        bits = mixed(seed + np.uint64(step * int(_STEP) % (1 << 64)))
        time = time - np.log(_uniform(bits)) / width
        alive = time <= last[owner]
        owner, seed, width, room, time, bits = (a[alive] for a in (owner, seed, width, room, time, bits))
        if not len(owner):
            break
        place = mixed(bits ^ _PLACE) % width.astype(np.uint64)
        bucket = owner * size + (mixed(bits ^ _BUCKET) % np.uint64(size)).astype(np.int64)
        better = (place.astype(np.int64) < room) & (time < first[bucket])
        at, when, what = bucket[better], time[better], bits[better]
        order = np.argsort(-when, kind="stable")
        # Of several points in one bucket the last assignment stays, so the earliest comes last.
        first[at[order]] = when[order]
        kept[at[order]] = what[order]
        touched = np.unique(owner)
        last[touched] = first.reshape(bags, size)[touched].max(axis=1)
    return kept.reshape(bags, size)


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One hash per band of ``rows`` neighbouring hashes, the band's number included."""
    bags, size = signature.shape
    bands = signature[:, : size // rows * rows].reshape(bags, -1, rows)
    keys = np.broadcast_to(np.arange(1, bands.shape[1] + 1, dtype=np.uint64), bands.shape[:2])
    for k in range(rows):
        keys = mixed(keys * _STEP + bands[:, :, k])
    return keys
