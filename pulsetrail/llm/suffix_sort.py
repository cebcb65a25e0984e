"""Which strings of a fixed length a buffer holds more than once, by blockwise suffix sorting.

Suffixes are sorted one bucket at a time, a bucket being a range of first words. A bucket is sorted by the
first ``PERIOD`` bytes only. Suffixes that agree in these are told apart by ranks that were worked out
beforehand for a sample of the places of the buffer, a difference cover: for any two places there is a
distance below ``PERIOD`` at which both meet the sample, and there the ranks decide. So ties of any length
cost the same, and besides the buffer only the ranks of the sample and one bucket are held.

Suffixes are compared to a depth that is no less than the length asked for; the order beyond it is
left open. In sorted order equal strings are neighbours, and neighbours are compared byte for byte.
"""

from __future__ import annotations

import numpy as np

from pulsetrail.llm.common import mix64

PERIOD = 64
_STEP = 8  # its root
# Places 0 to 7 and every eighth: 8 (q + 1) less 8 - s makes any difference 8 q + s.
COVER = np.array([*range(_STEP), *range(_STEP, PERIOD, _STEP)])
# A bucket holds about so many suffixes.
BUCKET = 1 << 17
# Suffixes of tied runs compared at once.
MERGE = 1 << 20
# Bytes behind the buffer that may be looked at.
PAD = 1024

_PLACE = np.full(PERIOD, -1)
_PLACE[COVER] = np.arange(len(COVER))
_IN = _PLACE >= 0
_TURNS = (np.arange(PERIOD)[:, None] + np.arange(PERIOD)) % PERIOD
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# The first distance at which places of two residues both meet the sample.
MEET = np.argmax(_IN[_TURNS][:, None, :] & _IN[_TURNS][None, :, :], axis=2)


class Buffer:
    """Bytes to look into, with a difference cover's ranks by 4 * ``PERIOD`` bytes."""

    def __init__(self, data: np.ndarray):
        self.data = np.concatenate([data, np.zeros(PAD + -len(data) % PERIOD, np.uint8)])
        # Eight bytes from any place as a number in lexicographic order.
        self.words = np.ndarray(len(self.data) - 7, ">u8", self.data, strides=(1,))
        self.rank = self._ranks(len(data))

    def _ranks(self, n: int) -> np.ndarray:
        blocks = -(-n // PERIOD) + 4
        places = (np.arange(blocks)[:, None] * PERIOD + COVER).ravel()
        rank = _dense([self.word(places, k) for k in range(PERIOD // 8)])
        for shift in (1, 2):
            # Ranks by twice as many bytes: those of a place and of the one as many blocks on.
            after = np.zeros_like(rank)
            ahead = shift * len(COVER)
            after[:-ahead] = rank[ahead:] + 1
            rank = _dense([rank, after])
        return rank

    def word(self, places: np.ndarray, k: int) -> np.ndarray:
        return self.words[places + 8 * k].astype(np.uint64)

    def rank_at(self, places: np.ndarray) -> np.ndarray:
        return self.rank[places // PERIOD * len(COVER) + _PLACE[places % PERIOD]]

    def same(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        """Whether the strings from places ``a`` and ``b`` are equal."""
        equal = np.arange(len(a))
        for at in [*range(0, length - 7, 8), length - 8]:
            equal = equal[self.words[a[equal] + at] == self.words[b[equal] + at]]
        out = np.zeros(len(a), bool)
        out[equal] = True
        return out


def repeated(data: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """For each of the ``places`` whether the ``length`` bytes from there also start at another of them.

    ``length`` is from 8 to 4 * ``PERIOD``, and that many bytes follow each place.
    """
    out = np.zeros(len(places), bool)
    if len(places) < 2:
        return out
    buffer = Buffer(data)
    first = buffer.word(places, 0)
    by_word = np.argsort(first, kind="stable")
    new = np.flatnonzero(np.diff(first[by_word]) != 0) + 1
    start = 0
    while start < len(places):
        # Up to the next first word, so that a bucket is whole.
        stop = new[min(np.searchsorted(new, start + BUCKET), len(new) - 1)] if len(new) else 0
        stop = int(stop) if stop > start else len(places)
        bucket = by_word[start:stop]
        bucket = bucket[sort_bucket(buffer, places[bucket])]
        a, b = bucket[:-1], bucket[1:]
        equal = buffer.same(places[a], places[b], length)
        out[a[equal]] = True
        out[b[equal]] = True
        start = stop
    return out


def sort_bucket(buffer: Buffer, places: np.ndarray) -> np.ndarray:
    """The order of the suffixes from ``places``."""
    tie = _dense([buffer.word(places, k) for k in range(PERIOD // 8)])
    residue = places % PERIOD
    # Suffixes of one residue meet the sample at the same distance.
    own = buffer.rank_at(places + MEET[residue, residue])
    order = np.lexsort([own, residue, tie])
    tie, residue, sorted_places = tie[order], residue[order], places[order]
    new = np.ones(len(order), bool)
    new[1:] = (tie[1:] != tie[:-1]) | (residue[1:] != residue[:-1])
    runs = np.flatnonzero(new)
    place = np.arange(len(order)) - np.repeat(runs, np.diff(np.append(runs, len(order))))
    _merge_runs(buffer, sorted_places, tie, residue, runs, place)
    return order[np.lexsort([place, tie])]


def _merge_runs(buffer: Buffer, places: np.ndarray, tie: np.ndarray, residue: np.ndarray, runs: np.ndarray, place: np.ndarray) -> None:
    """Add to the ``place`` of each suffix in its run how many of the other runs of its tie rank below it.

    ``runs`` are where suffixes of one tie and one residue begin. Two runs are compared where their
    residues meet the sample.
    """
    first = np.searchsorted(tie[runs], tie[runs])
    several = np.searchsorted(tie[runs], tie[runs], side="right") - first
    size = np.diff(np.append(runs, len(tie)))
    mixed = np.flatnonzero(several > 1)
    # Suffixes that meet in all pairs of a run; pairs are taken so many at a time.
    load = np.cumsum(several[mixed] * size[mixed])
    start = 0
    while start < len(mixed):
        before = load[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(load, before + MERGE, side="right")))
        some = mixed[start:stop]
        start = stop
        one = np.repeat(some, several[some])
        other = first[one] + _counting(several[some])
        one, other = one[one != other], other[one != other]
        pair = np.arange(len(one)) << 32
        meet = MEET[residue[runs[one]], residue[runs[other]]]
        mine = np.repeat(runs[one], size[one]) + _counting(size[one])
        theirs = np.repeat(runs[other], size[other]) + _counting(size[other])
        keys = np.repeat(pair, size[other]) | buffer.rank_at(places[theirs] + np.repeat(meet, size[other]))
        keys.sort()
        wanted = np.repeat(pair, size[one]) | buffer.rank_at(places[mine] + np.repeat(meet, size[one]))
        below = np.searchsorted(keys, wanted) - np.repeat(np.searchsorted(keys, pair), size[one])
        place += np.bincount(mine, below, len(place)).astype(np.int64)


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0 up to each size, one after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _dense(keys: list[np.ndarray]) -> np.ndarray:
    """Ranks from 0 by ``keys``, the first of most weight; equal rows share one.

    Most rows come up several times, so rows are grouped by a hash first and only one of each is sorted.
    """
    mixed = np.zeros(len(keys[0]), np.uint64)
    for key in keys:
        mixed = mix64(mixed * _FACTOR + key.astype(np.uint64))
    _, chosen, group = np.unique(mixed, return_index=True, return_inverse=True)
    if any((key[chosen][group] != key).any() for key in keys):  # two rows with one hash
        chosen = group = np.arange(len(mixed))
    keys = [key[chosen] for key in keys]
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for key in keys:
        sorted_key = key[order]
        new[1:] |= sorted_key[1:] != sorted_key[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank[group]
