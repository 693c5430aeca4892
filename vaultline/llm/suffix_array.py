"""Suffix arrays of many independent strings at once, by linear grouping.

Phase 1 groups the suffixes of each string by their longest Lyndon prefix. Groups are taken in descending order; every
suffix of the group points to the nearest one before it that lies in a lower group (its previous smaller), and the
suffixes that are pointed to leave their group for new ones just above it, the higher the more pointers they get. Phase
2 emits each group's order in one pass from the smallest suffix: the one before a suffix just placed, and along its
pointers those before it, take the next places of their groups. Nothing is renamed and nothing recurs.

All strings of a batch move in step, so that numpy works on one group of every string at a time. Every string ends
with a 0 that it has nowhere else.
"""

from __future__ import annotations

import numpy as np


def suffix_arrays(symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``symbols[offsets[i]:offsets[i + 1]]`` is string i. Returns positions in ``symbols``, string by string, each
    string's in the order of its suffixes."""
    group, order, link = _group(symbols, offsets)
    return _emit(symbols, offsets, group, link)


def _group(symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each suffix's group, as the first place that the group takes, the suffixes by group, and the pointers (the
    number of symbols where there is none)."""
    n, starts, ends = len(symbols), offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    string = np.repeat(np.arange(len(starts)), ends - starts)
    order = np.lexsort((symbols, string)).astype(np.int64)  # one group per string and symbol at first
    first = np.ones(n, bool)
    first[1:] = (symbols[order][1:] != symbols[order][:-1]) | (string[order][1:] != string[order][:-1])
    begin = np.flatnonzero(first)
    size = np.zeros(n + 1, np.int64)
    size[begin] = np.diff(np.append(begin, n))
    group = np.full(n + 1, -1, np.int64)
    group[order] = np.repeat(begin, size[begin])
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    link = np.arange(-1, n, dtype=np.int64)  # to the position before, at first
    link[starts], link[n] = n, n
    pointed = np.zeros(n + 1, bool)
    high, active = ends.copy(), np.arange(len(starts))
    while True:
        low = group[order[high[active] - 1]]
        active, low = active[low > starts[active]], low[low > starts[active]]  # the last group is the final 0's
        if not len(active):
            return group, order, link
        length = high[active] - low
        high[active] = low
        if len(active) == length.sum():
            members, floor = order[low], low
        else:
            members = order[np.repeat(low - np.cumsum(length) + length, length) + np.arange(length.sum())]
            floor = np.repeat(low, length)
        # previous smaller: skip what lies in this group or above; pointers of this group shorten each other
        to = link[members]
        skip = np.flatnonzero(group[to] >= floor)
        while len(skip):
            to[skip] = link[to[skip]]
            link[members[skip]] = to[skip]
            skip = skip[group[to[skip]] >= floor[skip]]
        link[members] = to
        targets, times = np.unique(to, return_counts=True)
        if targets[-1] == n:
            targets, times = targets[:-1], times[:-1]
        if not len(targets):
            continue
        # they go to the end of their groups, by number of pointers
        old = group[targets]
        by = np.lexsort((times, old))
        targets, times, old = targets[by], times[by], old[by]
        head = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
        count = np.diff(np.append(head, len(old)))
        tail = old[head] + size[old[head]] - count
        slots = np.repeat(tail - head, count) + np.arange(len(old))
        pointed[targets] = True
        there = order[slots]
        moved = there[~pointed[there]]
        if len(moved):
            free = place[targets]
            free = free[free < np.repeat(tail, count)]
            order[free], place[moved] = moved, free
        pointed[targets] = False
        order[slots], place[targets] = targets, slots
        size[old[head]] -= count
        run = np.flatnonzero(np.append(True, (old[1:] != old[:-1]) | (times[1:] != times[:-1])))
        lengths = np.diff(np.append(run, len(old)))
        size[slots[run]] = lengths
        group[targets] = np.repeat(slots[run], lengths)


def _emit(symbols: np.ndarray, offsets: np.ndarray, group: np.ndarray, link: np.ndarray) -> np.ndarray:
    n, starts, ends = len(symbols), offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    result, taken, done = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n + 1, bool)
    done[n] = True
    result[starts], done[ends - 1] = ends - 1, True  # the final 0 is the smallest suffix
    before = np.arange(-1, n - 1, dtype=np.int64)
    before[starts] = n
    at, begin, end = starts.copy(), starts, ends
    now = before[result[at]]
    while True:
        idle = np.flatnonzero(done[now])
        if len(idle):  # the next suffix in order takes over
            at[idle] += 1
            over = at[idle] >= end[idle]
            if over.any():
                stay = np.ones(len(at), bool)
                stay[idle[over]] = False
                at, end, now = at[stay], end[stay], now[stay]
                if not len(at):
                    return result
                idle = np.flatnonzero(done[now])
            now[idle] = before[result[at[idle]]]
        busy = np.flatnonzero(~done[now])
        if len(busy):
            suffix = now[busy]
            slot = group[suffix]
            result[slot + taken[slot]] = suffix
            taken[slot] += 1
            done[suffix] = True
            now[busy] = link[suffix]
