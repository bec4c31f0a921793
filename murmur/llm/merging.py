"""Byte-pair merging, and a memo of bounded size."""

from __future__ import annotations

from collections.abc import Callable
from heapq import heapify, heappop, heappush

#: Pieces longer than this wait in a heap, shorter ones are searched.
SEARCHED = 96


def count_merges(symbols: list[int], ranks: dict[int, int], merged: list[int], base: int) -> int:
    """Merge neighbours of lowest rank, the leftmost of equals, until no pair has a rank; `symbols` is used up.

    ranks[a * base + b] is the rank of a pair, merged[rank] what it becomes. Pairs wait in a
    heap as rank * n + place over a linked list; a place's entry counts only while its pair
    still has that rank. n symbols cost n log n.
    """
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = ranks.get
    at = [get(a * base + b, -1) for a, b in zip(symbols, symbols[1:])]
    heap = [rank * n + i for i, rank in enumerate(at) if rank >= 0]
    heapify(heap)
    at.append(-1)
    merges = 0
    while heap:
        rank, i = divmod(heappop(heap), n)
        if at[i] != rank:
            continue
        merges += 1
        whole = symbols[i] = merged[rank]
        j = after[i]
        at[j] = at[i] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = at[i] = get(whole * base + symbols[k], -1)
            if rank >= 0:
                heappush(heap, rank * n + i)
        h = before[i]
        if h >= 0:
            rank = at[h] = get(symbols[h] * base + whole, -1)
            if rank >= 0:
                heappush(heap, rank * n + h)
    return merges


def merged_slices(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The piece's parts after merging neighbours whose joint bytes have the lowest rank, the leftmost of equals."""
    none = len(ranks) + 1 << 32
    get = ranks.get
    if len(piece) > SEARCHED:
        return _merged_by_heap(piece, get)
    ends = list(range(len(piece) + 1))
    at = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while at:
        least = min(at)
        if least == none:
            break
        i = at.index(least)
        del ends[i + 1], at[i]
        if i < len(at):
            at[i] = get(piece[ends[i]:ends[i + 2]], none)
        if i:
            at[i - 1] = get(piece[ends[i - 1]:ends[i + 1]], none)
    return [piece[a:b] for a, b in zip(ends, ends[1:])]


def _merged_by_heap(piece: bytes, get: Callable) -> list[bytes]:
    n = len(piece)
    after, before = list(range(1, n + 2)), list(range(-1, n))
    at = {i: r for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None}
    heap = [(r, i) for i, r in at.items()]
    heapify(heap)

    def put(i: int) -> None:
        end = after[after[i]] if after[i] < n else n + 1
        rank = get(piece[i:end]) if end <= n else None
        if rank is None:
            at.pop(i, None)
        else:
            at[i] = rank
            heappush(heap, (rank, i))
    while heap:
        rank, i = heappop(heap)
        if at.get(i) != rank:
            continue
        j = after[i]
        at.pop(j, None)
        after[i] = after[j]
        before[after[j]] = i
        put(i)
        if before[i] >= 0:
            put(before[i])
    out, i = [], 0
    while i < n:
        out.append(piece[i:after[i]])
        i = after[i]
    return out


class Memo(dict):
    """`make(key)` remembered for short keys in two halves: when the new one is full, it becomes the old one."""

    def __init__(self, make: Callable, entries: int = 300_000, longest: int = 64):
        super().__init__()
        self.make, self.entries, self.longest, self.old = make, entries, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
