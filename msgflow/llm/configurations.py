"""Configurations of lengths that fill sequences, chosen by a linear program over a histogram of lengths.

A configuration is a multiset of lengths of at most ``capacity`` together. The program covers the histogram's counts with
as few configurations as it can; its columns are never listed. ``price`` finds the most valuable configuration under dual
prices of the lengths by a knapsack recursion over the capacity, and multiplicative weights set the prices: a length's
price is its share of the capacity, to the power ``LARGE``, times exp(-``ETA`` * share of its count already covered), so
what is covered least is worth most. ``program`` returns the fractional solution and a lower bound that the first prices
prove.

Rounding: whole parts are taken; for what is left the prices go on with whole configurations only, and the last
sequences are filled best fit decreasing, which also is the result where it alone needs fewer sequences. All numbers here
are histograms of at most ``capacity`` lengths: the work does not grow with the number of documents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np

ETA = 0.5
LARGE = 1.2  # above 1: of two ways to fill a sequence, the one with longer pieces is worth more
STEP = 0.25  # share of a length's count that one configuration may cover at once
SEEDS = 8  # one length in so many starts a configuration of a round
TAIL = 32  # sequences always left to best fit
REST = 0.05  # share of the tokens that the fractional solution may leave to rounding
NEAR = 0.998  # share of the best value that a configuration needs once lengths of the best ran out
LITTLE = 0.003  # share of the tokens left that a round must cover, or rounding takes over

Configuration = tuple[int, ...]  # lengths, descending


def price(values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Most value of each capacity 0.. and the length to take there (0: none); ``values[length]`` is -inf where absent."""
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        offers = best[room - 1 :: -1] + values[1 : room + 1] if room > 1 else best[:1] + values[1:2]
        length = int(offers.argmax()) + 1
        if offers[length - 1] > best[room - 1]:
            best[room], take[room] = offers[length - 1], length
        else:
            best[room] = best[room - 1]
    return best, take


def _configuration(seed: int, take: np.ndarray, capacity: int, left: np.ndarray, present: np.ndarray, whole: bool) -> Counter:
    """The most valuable configuration that has ``seed``; where a length ran out meanwhile, the longest that fit and are there."""
    out, room = Counter({seed: 1}), capacity - seed
    while room > 0 and (length := int(take[room])):
        if left[length] < max(1e-9, whole * (out[length] + 1)):
            break
        out[length] += 1
        room -= length
    at = np.searchsorted(present, room, side="right") - 1
    while room > 0 and at >= 0:
        length = int(present[at])
        if length <= room and left[length] >= max(1e-9, whole * (out[length] + 1)):
            out[length] += 1
            room -= length
        else:
            at -= 1
    return +out


def _prices(counts: np.ndarray, left: np.ndarray, capacity: int) -> np.ndarray:
    """Prices of the lengths of which something is left."""
    lengths = np.arange(capacity + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        covered = np.where(counts > 0, 1 - left / counts, 1)
    return np.where(left > 0, (lengths / capacity) ** LARGE * np.exp(-ETA * covered), -np.inf)


def _spread(counts: np.ndarray, capacity: int, whole: bool, until: float) -> tuple[Counter, float]:
    """Configurations with their amounts, covering no count twice, until ``until`` tokens are left; and a lower bound on
    the number of sequences that all of ``counts`` need."""
    left, amounts, bound = counts.astype(float), Counter(), 0.0
    lengths = np.arange(capacity + 1)
    while (before := float((left * lengths).sum())) > until:
        values = _prices(counts, left, capacity)
        best, take = price(values, capacity)
        if not bound:  # later prices only know the lengths that are left
            bound = float((np.where(counts > 0, values, 0.0) * counts).sum() / best[capacity])
        present = np.flatnonzero(left > 0)
        worth = values[present] + best[capacity - present]
        for seed in present[np.lexsort((-present, -worth))][: max(32, len(present) // SEEDS)].tolist():
            if left[seed] <= 0:
                continue
            need = _configuration(seed, take, capacity, left, present, whole)
            if sum(values[n] * k for n, k in need.items()) < NEAR * (values[seed] + best[capacity - seed]):
                continue
            room = min(left[n] / k for n, k in need.items())
            amount = min(room, STEP * min(counts[n] / k for n, k in need.items()))
            if whole:
                amount = float(min(int(room), max(1, int(amount))))
            if amount <= 0:
                continue
            for n, k in need.items():
                left[n] = rest if (rest := left[n] - amount * k) > 1e-9 else 0.0
            amounts[tuple(sorted(need.elements(), reverse=True))] += amount
        if float((left * lengths).sum()) > (1 - LITTLE) * before:
            break
    return amounts, bound


def _without(counts: np.ndarray, amounts: dict[Configuration, int]) -> np.ndarray:
    left = counts.copy()
    for chosen, amount in amounts.items():
        for n, k in Counter(chosen).items():
            left[n] -= amount * k
    return left


def _best_fit(counts: np.ndarray, capacity: int) -> Counter:
    """Best fit decreasing, for all sequences of equal content at once: steps follow the lengths, not the pieces."""
    groups: Counter = Counter()  # contents: sequences
    rooms: list[tuple[int, Configuration]] = []  # ascending, one entry for each of the groups

    def put(chosen: Configuration, amount: int) -> None:
        if amount and chosen not in groups:
            insort(rooms, (capacity - sum(chosen), chosen))
        if amount:
            groups[chosen] += amount

    for length in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[length])
        while n:
            at = bisect_left(rooms, (length, ()))
            room, chosen = rooms.pop(at) if at < len(rooms) else (capacity, ())
            there = groups.pop(chosen, n)
            each = room // length
            full = min(there, n // each)
            put(chosen + (length,) * each, full)
            n -= full * each
            there -= full
            if there and 0 < n < each:
                put(chosen + (length,) * n, 1)
                n, there = 0, there - 1
            if chosen:
                put(chosen, there)
    return groups


def program(counts: np.ndarray, capacity: int) -> tuple[Counter, float]:
    """Fractional amounts of configurations that cover all but ``REST`` of the tokens, and a lower bound on sequences."""
    return _spread(counts, capacity, False, REST * float((counts * np.arange(capacity + 1)).sum()))


def pack(counts: np.ndarray, capacity: int) -> tuple[list[tuple[Configuration, int]], float]:
    """Whole configurations that use every length exactly ``counts[length]`` times, and a lower bound on their number.

    ``counts`` has an entry for each length from 0 to ``capacity``; none of length 0.
    """
    counts = counts.astype(np.int64)
    packed: Counter = Counter()
    if counts[capacity]:  # a full piece is a sequence
        packed[(capacity,)] = int(counts[capacity])
    left = counts.copy()
    left[capacity] = 0
    tokens = int((counts * np.arange(capacity + 1)).sum())
    amounts, bound = program(left, capacity) if left.any() else (Counter(), 0.0)
    whole = Counter({c: int(x) for c, x in amounts.items() if x >= 1})
    packed += whole
    left = _without(left, whole)
    dived = {c: int(x) for c, x in _spread(left, capacity, True, TAIL * capacity)[0].items()}
    packed.update(dived)
    packed.update(_best_fit(_without(left, dived), capacity))
    plain = _best_fit(counts, capacity)
    if sum(plain.values()) < sum(packed.values()):  # few lengths, or few pieces of each: rounding can cost more than it brings
        packed = plain
    return sorted(packed.items(), reverse=True), max(bound + int(counts[capacity]), tokens / capacity)
