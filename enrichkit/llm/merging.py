"""Exact pair merging of one long row of symbols in n log n."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

_PLACE_BITS = 40
_PLACE = (1 << _PLACE_BITS) - 1


def merge_long(ids: list[int], pairs: dict[int, tuple[int, int]]) -> list[int]:
    """Merge the pair of the lowest rank, of equal ones the leftmost, until none is left.

    ``pairs``: ``left << 32 | right -> (rank, merged id)``; a negative id joins no pair. A heap
    holds the pairs and a linked list the symbols; an entry counts only while the pair at its
    place still has its rank.
    """
    ids, n = list(ids), len(ids)
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = pairs.get

    def rank_at(i: int, j: int) -> int:
        found = get(ids[i] << 32 | ids[j]) if ids[i] >= 0 and ids[j] >= 0 else None
        return -1 if found is None else found[0]

    heap = [r << _PLACE_BITS | i for i in range(n - 1) if (r := rank_at(i, i + 1)) >= 0]
    heapify(heap)
    gone = bytearray(n)
    while heap:
        entry = heappop(heap)
        i = entry & _PLACE
        if gone[i] or (j := following[i]) >= n or rank_at(i, j) != entry >> _PLACE_BITS:
            continue
        ids[i] = get(ids[i] << 32 | ids[j])[1]
        gone[j] = 1
        following[i] = k = following[j]
        if k < n:
            before[k] = i
            if (r := rank_at(i, k)) >= 0:
                heappush(heap, r << _PLACE_BITS | i)
        if (h := before[i]) >= 0 and (r := rank_at(h, i)) >= 0:
            heappush(heap, r << _PLACE_BITS | h)
    return [x for x, out in zip(ids, gone) if not out]
