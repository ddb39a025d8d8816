"""Suffix arrays by linear grouping (the first linear-time construction without recursion).

Phase 1 sorts all suffixes into groups by their Lyndon prefix. It takes the groups in descending order; for a group, each
member points to the previous suffix of a lower group, and the suffixes pointed to are split off their groups, the more
pointers the higher, as immediate successors. Pointers skip what is known to be higher, so previous-smaller lookups are
cheap. Phase 2 then emits the order: it walks the suffix array from its smallest entry and moves, for each entry, the
chain of previous-smaller suffixes before it to the front of their groups. No renaming and no recursion take place.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes of a sequence of non-negative integers, in order.

    A suffix that is a prefix of another comes first. Equal texts give equal arrays; an empty sequence gives none.
    """
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    # A sentinel below all symbols ends the sequence; it is the smallest suffix.
    text = np.append(np.asarray(symbols, np.int64) + 1, 0)
    n += 1
    by_symbol = np.argsort(text, kind="stable")
    ordered = text[by_symbol]
    firsts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    # A group is the interval of places that its suffixes will take; the place it starts at names it.
    name = np.empty(n, np.int64)
    name[by_symbol] = np.repeat(firsts, np.diff(np.append(firsts, n)))
    group = name.tolist()
    bounds = [*firsts.tolist(), n]
    order = by_symbol.tolist()
    members = {a: order[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)}
    end_of = dict(zip(bounds[:-1], bounds[1:], strict=True))
    ending = {b: a for a, b in end_of.items()}
    previous = [-1] * n

    top = n
    while top > 0:
        g = ending[top]
        top = g
        pointed: list[int] = []
        times: list[int] = []
        last = -1
        for i in members.pop(g):
            if group[i] != g:
                continue  # split off since
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = previous[j]
            previous[i] = j
            if j < 0:
                continue
            if j == last:
                times[-1] += 1
            else:
                pointed.append(j)
                times.append(1)
                last = j
        if not pointed:
            continue
        if max(times) == 1:
            classes = (pointed,)
        else:
            by_times: dict[int, list[int]] = {}
            for j, t in zip(pointed, times, strict=True):
                by_times.setdefault(t, []).append(j)
            classes = tuple(by_times[t] for t in sorted(by_times, reverse=True))
        for chosen in classes:
            split: dict[int, list[int]] = {}
            for j in chosen:
                split.setdefault(group[j], []).append(j)
            for h, some in split.items():
                end = end_of[h]
                start = end - len(some)
                if start == h:
                    continue  # all of the group
                end_of[h] = start
                ending[start] = h
                end_of[start] = end
                ending[end] = start
                members[start] = some
                for j in some:
                    group[j] = start

    place = list(range(n))  # the next free place of the group that starts there
    placed = [False] * n
    suffixes = [0] * n
    suffixes[0] = n - 1
    placed[n - 1] = True
    for k in range(n):
        j = suffixes[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            suffixes[place[g]] = j
            place[g] += 1
            placed[j] = True
            j = previous[j]
    return np.array(suffixes[1:], np.int64)
