"""Linear-time suffix sorting by Lyndon-prefix groups.

Suffixes are kept in groups of an interval each; at the end of the first phase a
group holds the suffixes with one longest Lyndon prefix. Groups are processed
from the highest to the lowest: for each suffix of the group the previous
smaller one is found over pointers of suffixes that are already done, and the
suffixes pointed at, now known to be followed by this group's word as often as
they are pointed at, move to new groups right above what is left of theirs. The
second phase emits suffixes in order: whoever precedes an emitted suffix, and
the chain of previous smaller ones above it, takes the next place in its group.
Nothing is renamed or sorted recursively.
"""

from __future__ import annotations

import numpy as np


def lyndon_groups(text: np.ndarray) -> tuple[list[int], list[int]]:
    """(group, previous smaller) of each suffix; a group is named by the first place of its interval.

    ``text`` ends with its only least symbol. Its suffix is place 0, alone in the
    lowest group, so index -1 (before the text) is lower than any other group.
    """
    n = len(text)
    order = np.argsort(text, kind="stable")
    new = np.flatnonzero(np.concatenate(([True], np.diff(text[order]) != 0)))
    counts = np.diff(np.append(new, n))
    group_of, place_of, sizes = np.zeros((3, n), np.int64)
    group_of[order] = np.repeat(new, counts)
    place_of[order] = np.arange(n)
    sizes[new] = counts
    held, group, place, size = order.tolist(), group_of.tolist(), place_of.tolist(), sizes.tolist()
    smaller = [-1] * n
    end = n
    while end > 1:
        g = group[held[end - 1]]
        if end - g == 1:  # the usual case: one suffix, one pointer
            s = held[g]
            p = s - 1
            while group[p] >= g:
                p = smaller[p]
            smaller[s] = p
            end = g
            h = group[p]
            if size[h] > 1:
                size[h] = m = size[h] - 1
                tail, at = h + m, place[p]
                other = held[tail]
                held[at], held[tail] = other, p
                place[other], place[p] = at, tail
                group[p], size[tail] = tail, 1
            continue
        times: dict[int, int] = {}
        for s in sorted(held[g:end]):
            p = s - 1
            while group[p] >= g:
                p = smaller[p]
            smaller[s] = p
            times[p] = times.get(p, 0) + 1
        times.pop(-1, None)
        end = g
        # Those followed by the word most often go highest.
        by_times: dict[int, list[int]] = {}
        for p, k in times.items():
            by_times.setdefault(k, []).append(p)
        for k in sorted(by_times, reverse=True):
            moved = by_times[k]
            for p in moved:
                h = group[p]
                size[h] = m = size[h] - 1
                tail, at = h + m, place[p]
                other = held[tail]
                held[at], held[tail] = other, p
                place[other], place[p] = at, tail
            # A group that moved whole keeps its interval and name.
            for p in moved:
                h = group[p]
                group[p] = h + size[h]
            for p in moved:
                size[group[p]] += 1
    return group, smaller


def suffix_array(text: np.ndarray) -> list[int]:
    """The suffixes of ``text``, which ends with its only least symbol, in order."""
    n = len(text)
    if not n:
        return []
    group, smaller = lyndon_groups(np.asarray(text))
    free = list(range(n))  # next free place by group
    out, placed = [0] * n, bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1  # also ends a chain at -1
    for i in range(n):
        s = out[i] - 1
        while not placed[s]:
            g = group[s]
            at = free[g]
            free[g] = at + 1
            out[at] = s
            placed[s] = 1
            s = smaller[s]
    return out
