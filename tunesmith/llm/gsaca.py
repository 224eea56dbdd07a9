"""Suffix arrays by grouping suffixes on their Lyndon prefixes.

First phase: suffixes start in groups by their first symbol; a group is an
interval of one array.  Groups are processed in descending order.  Every
member looks left for the nearest position of a smaller group (its pointer
to the previous smaller one, found by following pointers already set); that
position's Lyndon prefix grows by the processed group's, so it moves up into
a new group behind its old one, once for every member that points to it.
Second phase: suffixes are emitted in ascending order; each emitted suffix
releases its left neighbour and the chain of pointers from there, every one
to the next free place of its group.  Nothing is renamed or solved again for
a shorter text.
"""

from __future__ import annotations


def suffix_array(symbols: list[int]) -> list[int]:
    """Order of all suffixes of ``symbols`` (any integers)."""
    n = len(symbols)
    if n == 0:
        return []
    order = sorted(range(n), key=symbols.__getitem__)
    place = [0] * n          # where a suffix stands in ``order``
    group = [0] * n          # first place of its group
    stop = [0] * n           # by first place: end of the group
    first = 0
    for i, s in enumerate(order):
        if symbols[s] != symbols[order[first]]:
            stop[first] = i
            first = i
        place[s], group[s] = i, first
    stop[first] = n
    smaller = [-1] * n       # nearest position to the left in a smaller group

    end = n
    while end > 0:
        start = group[order[end - 1]]
        counts: dict[int, int] = {}
        for s in sorted(order[start:end]) if end - start > 1 else (order[start],):
            p = s - 1
            while p >= 0 and group[p] >= start:
                p = smaller[p]
            smaller[s] = p
            if p >= 0:
                counts[p] = counts.get(p, 0) + 1
        wave = list(counts)
        need = 1
        while wave:
            moved: dict[int, int] = {}
            for p in wave:
                g = group[p]
                edge = stop[g] - moved.get(g, 0) - 1
                moved[g] = moved.get(g, 0) + 1
                other, at = order[edge], place[p]
                order[at], order[edge] = other, p
                place[other], place[p] = at, edge
            for p in wave:
                g = group[p]
                new = stop[g] - moved[g]
                if new != g:
                    group[p] = new
            for g, k in moved.items():
                old = stop[g]
                if old - k != g:
                    stop[old - k], stop[g] = old, old - k
            need += 1
            wave = [p for p in wave if counts[p] >= need]
        end = start

    free = list(range(n))    # by first place of a group: its next free place
    out = [-1] * n
    put = [False] * n

    def release(p: int) -> None:
        while p >= 0 and not put[p]:
            g = group[p]
            out[free[g]] = p
            free[g] += 1
            put[p] = True
            p = smaller[p]

    release(n - 1)           # the empty suffix comes first
    for i in range(n):
        release(out[i] - 1)
    return out
