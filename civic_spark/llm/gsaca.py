"""Suffix sorting of integer sequences by linear grouping (Lyndon prefixes), without recursive renaming.

Phase 1 groups suffixes by a common prefix, at first one symbol, and refines the groups from the greatest down.  For
each suffix of the group at hand, the previous-smaller pointer names the nearest suffix to the left whose group is
lower; that suffix's prefix grows by this group's.  The suffixes pointed at leave their groups for new, higher ones,
those pointed at most often highest.  In the end a suffix's group is its longest Lyndon prefix, in order.

Phase 2 emits the order: going through the sorted suffixes, the chain of previous-smaller pointers that starts left of
each fills the next places of the groups it meets.  Every pointer is followed once in either phase.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np


def suffix_order(seq: list[int]) -> list[int]:
    """Starts of the suffixes of ``seq`` in order; a suffix that is a prefix of another sorts first."""
    n = len(seq) + 1
    # A least symbol of its own ends the sequence.
    symbols = np.append(np.asarray(seq, dtype=np.int64), np.int64(-(1 << 62)))
    order = np.argsort(symbols, kind="stable")
    new = np.append(True, np.diff(symbols[order]) != 0)
    begin = np.flatnonzero(new)
    group = np.empty(n, np.int64)
    group[order] = np.repeat(begin, np.diff(np.append(begin, n)))
    order, group = order.tolist(), group.tolist()
    place = [0] * n
    for k, s in enumerate(order):
        place[s] = k
    size = dict(zip(begin.tolist(), np.diff(np.append(begin, n)).tolist(), strict=True))
    pointer = [-1] * n
    stop = n
    while stop > 0:
        start = group[order[stop - 1]]
        members = order[start:stop]
        if len(members) > 1:
            members.sort()
        counts: dict[int, int] = defaultdict(int)
        for s in members:
            p = s - 1
            while p >= 0 and group[p] >= start:
                p = pointer[p]
            pointer[s] = p
            if p >= 0:
                counts[p] += 1
        if counts:
            _split(counts, order, place, group, size)
        stop = start
    free = {}
    out = [0] * n
    out[0] = n - 1
    placed = [False] * n
    placed[n - 1] = True
    for k in range(n):
        p = out[k] - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            at = free.get(g, g)
            free[g] = at + 1
            out[at] = p
            placed[p] = True
            p = pointer[p]
    return out[1:]


def _split(counts: dict[int, int], order: list[int], place: list[int], group: list[int], size: dict[int, int]) -> None:
    """Moves the suffixes pointed at into new groups above their old ones, by how often they are pointed at."""
    by_count: dict[int, list[int]] = defaultdict(list)
    for p, c in counts.items():
        by_count[c].append(p)
    for c in sorted(by_count, reverse=True):
        moved: dict[int, list[int]] = defaultdict(list)
        for p in by_count[c]:
            moved[group[p]].append(p)
        for g, members in moved.items():
            left = size[g]
            if left == len(members):
                continue  # the whole group grows by the same: it stays together
            end = g + left
            for p in members:  # swap to the end of what is left of the old group
                end -= 1
                q, at = order[end], place[p]
                order[at], order[end] = q, p
                place[q], place[p] = at, end
            size[g] = left - len(members)
            size[end] = len(members)
            for p in members:
                group[p] = end


def common_prefixes(seq: list[int], order: list[int]) -> list[int]:
    """Length of the common prefix of each suffix in ``order`` with the one before it (Kasai et al.); 0 for the first."""
    n = len(seq)
    place = [0] * n
    for k, s in enumerate(order):
        place[s] = k
    out, h = [0] * n, 0
    for s in range(n):
        k = place[s]
        if k:
            t = order[k - 1]
            limit = n - max(s, t)
            while h < limit and seq[s + h] == seq[t + h]:
                h += 1
            out[k] = h
            if h:
                h -= 1
        else:
            h = 0
    return out
