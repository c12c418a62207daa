"""Suffix arrays by linear grouping, without recursion or renaming.

Suffixes are first grouped by symbol. Groups are taken from the highest down: each
place of a group gets a pointer to the last place before it in a lower group, and
the places pointed at leave their groups for new ones right above, those with most
pointers highest. At the end a group holds the suffixes of one Lyndon prefix. A scan
from the lowest suffix up then puts every suffix at its group's next free rank, by
following the pointers leftwards.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> list[int]:
    """Places of all suffixes in ascending order; the last symbol must be the only least one."""
    n = len(text)
    if n < 2:
        return list(range(n))
    order = np.argsort(text, kind="stable")
    sorted_text = text[order]
    fresh = np.flatnonzero(np.diff(sorted_text, prepend=sorted_text[0] - 1))
    sizes = np.zeros(n, dtype=np.int64)
    sizes[fresh] = np.diff(fresh, append=n)
    group_of = np.empty(n, dtype=np.int64)
    group_of[order] = np.repeat(fresh, np.diff(fresh, append=n))
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    lows = _lyndon_groups(order.tolist(), place.tolist(), group_of_list := group_of.tolist(), sizes.tolist())
    return _ranked(group_of_list, lows)


def _lyndon_groups(order: list[int], place: list[int], group: list[int], size: list[int]) -> list[int]:
    """Regroup by Lyndon prefixes in place (``group``: first rank of each place's group); pointers to the last lower place."""
    lower = [-1] * len(order)
    pointers = [0] * len(order)
    end = len(order)
    while end > 0:
        start = group[order[end - 1]]
        pointed = []
        for i in sorted(order[start:end]) if end - start > 1 else (order[start],):
            j = i - 1
            # places of this group and of higher ones have their pointers already
            while j >= 0 and group[j] >= start:
                j = lower[j]
            lower[i] = j
            if j >= 0:
                if not pointers[j]:
                    pointed.append(j)
                pointers[j] += 1
        end = start
        if not pointed:
            continue
        if len(pointed) == 1:  # the most frequent case: one place goes to its group's end
            (j,) = pointed
            pointers[j] = 0
            g = group[j]
            rest = size[g] - 1
            if rest:
                new, at = g + rest, place[j]
                other = order[new]
                order[new], place[j], order[at], place[other] = j, new, other, at
                group[j] = new
                size[g], size[new] = rest, 1
            continue
        by_count: dict[int, dict[int, list[int]]] = {}
        for j in pointed:
            by_count.setdefault(pointers[j], {}).setdefault(group[j], []).append(j)
            pointers[j] = 0
        for count in sorted(by_count, reverse=True):
            for g, leaving in by_count[count].items():
                rest = size[g] - len(leaving)
                if not rest:
                    continue
                new = rank = g + rest
                for j in leaving:
                    other, at = order[rank], place[j]
                    order[at], place[other] = other, at
                    order[rank], place[j] = j, rank
                    group[j] = new
                    rank += 1
                size[g], size[new] = rest, len(leaving)
    return lower


def _ranked(group: list[int], lower: list[int]) -> list[int]:
    """Each group's suffixes at their ranks, from the lowest suffix up."""
    n = len(group)
    free = list(range(n))
    out = [0] * n
    done = bytearray(n + 1)
    done[-1] = 1  # place -1 ends every walk
    out[0] = n - 1
    done[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while not done[j]:
            g = group[j]
            rank = free[g]
            free[g] = rank + 1
            out[rank] = j
            done[j] = 1
            j = lower[j]
    return out
