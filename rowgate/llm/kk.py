"""Karmarkar-Karp multiway differencing over integer sizes."""

from __future__ import annotations

import heapq

import numpy as np


class _Part:
    """A partial k-way partition: ``sums`` of its non-empty subsets in falling
    order (subsets not listed are empty), ``sets`` the item lists beside them."""

    __slots__ = ("sums", "sets")

    def __init__(self, sums: np.ndarray, sets: list[list[int]]):
        self.sums, self.sets = sums, sets

    def spread(self, k: int) -> int:
        return int(self.sums[0] - (self.sums[-1] if len(self.sums) == k else 0))


def _merge(a: _Part, b: _Part, k: int) -> _Part:
    """Pair the largest subset of one with the smallest of the other: a's i-th
    largest subset takes b's i-th smallest."""
    na, nb = len(a.sums), len(b.sums)
    overlap = max(0, na + nb - k)
    sums = np.empty(na + nb - overlap, dtype=np.int64)
    sums[:na] = a.sums
    # b's subsets in rising order fill the empty slots last, the non-empty from the end of a
    sums[na:] = b.sums[: nb - overlap]
    sets = a.sets + b.sets[: nb - overlap]
    if overlap:
        # a's smallest subsets take what is left of b, smallest with b's largest of the rest
        tail = b.sums[nb - overlap:]
        at = np.arange(na - overlap, na)
        sums[at] += tail[::-1]
        for i, j in zip(at.tolist(), range(nb - 1, nb - overlap - 1, -1)):
            sets[i] = sets[i] + b.sets[j]
    order = np.argsort(-sums, kind="stable")
    return _Part(sums[order], [sets[i] for i in order.tolist()])


def partition(sizes: list[int], k: int) -> list[list[int]]:
    """Item indexes of ``k`` subsets with near-equal sums (some may be empty).

    The two partial partitions with the largest imbalances are merged with
    opposing order until one is left.  Ties fall to the earlier item, so the
    result depends on ``sizes`` alone.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if not sizes:
        return [[] for _ in range(k)]
    if k == 1:
        return [list(range(len(sizes)))]
    heap = [(-int(s), i, _Part(np.array([s], dtype=np.int64), [[i]])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        if len(a.sums) < len(b.sums):
            a, b = b, a
        c = _merge(a, b, k)
        heapq.heappush(heap, (-c.spread(k), n, c))
        n += 1
    sets = heap[0][2].sets
    return sets + [[] for _ in range(k - len(sets))]


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Subsets of at most ``capacity`` each: differencing over the fewest windows
    that could hold all, and one window more whenever the fullest is over."""
    if any(s > capacity for s in sizes):
        raise ValueError("an item is larger than the capacity")
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        sets = partition(sizes, k)
        if max((sum(sizes[i] for i in s) for s in sets), default=0) <= capacity:
            return [s for s in sets if s]
        k += 1
