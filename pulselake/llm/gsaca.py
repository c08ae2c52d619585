"""A suffix array by Lyndon groups, in linear time and without recursion."""

from __future__ import annotations

from collections.abc import Sequence


def lyndon_groups(text: Sequence[int]) -> tuple[list[list[int]], list[int]]:
    """(groups in ascending order, prev): places with the same Lyndon prefix, and the nearest
    place before each whose group is lower.

    Groups start as the places of each symbol and are taken in descending order. Every place of
    the group points to the nearest one before it that is in a lower group: its own Lyndon
    prefix is a further part of that one's. Places that get more pointers have more copies of
    it and so a greater prefix: they go into new groups right behind their old one.
    """
    n = len(text)
    members: list[list[int]] = []
    below: list[int] = []  # the next lower group
    above: list[int] = []
    group = [0] * n
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        by_symbol.setdefault(c, []).append(i)
    for g, c in enumerate(sorted(by_symbol)):
        members.append(by_symbol[c])
        below.append(g - 1)
        above.append(g + 1)
        for i in by_symbol[c]:
            group[i] = g
    size = [len(m) for m in members]
    if above:
        above[-1] = -1
    taken = [False] * n
    prev = [-1] * n
    current = len(members) - 1
    while current >= 0:
        here = members[current]
        if size[current] == 1:
            i = next(j for j in here if group[j] == current) if len(here) > 1 else here[0]
            members[current] = [i]
            taken[i] = True
            p = i - 1
            while p >= 0 and taken[p]:
                p = prev[p]
            prev[i] = p
            if p >= 0:
                old = group[p]
                if size[old] > 1:
                    size[old] -= 1
                    new, up = len(members), above[old]
                    members.append([p])
                    size.append(1)
                    below.append(old)
                    above.append(up)
                    above[old] = new
                    if up >= 0:
                        below[up] = new
                    group[p] = new
        elif size[current]:
            here = sorted([j for j in here if group[j] == current])
            members[current] = here
            for i in here:
                taken[i] = True
            pointers: dict[int, int] = {}
            for i in here:
                p = i - 1
                while p >= 0 and taken[p]:
                    p = prev[p]
                prev[i] = p
                if p >= 0:
                    pointers[p] = pointers.get(p, 0) + 1
            moves: dict[tuple[int, int], list[int]] = {}
            for p, k in pointers.items():
                moves.setdefault((k, group[p]), []).append(p)
            for k, old in sorted(moves, reverse=True) if len(moves) > 1 else moves:
                moved = moves[k, old]
                if len(moved) == size[old]:
                    continue  # all that is left of the group: it keeps its place
                size[old] -= len(moved)
                new, up = len(members), above[old]
                members.append(moved)
                size.append(len(moved))
                below.append(old)
                above.append(up)
                above[old] = new
                if up >= 0:
                    below[up] = new
                for p in moved:
                    group[p] = new
        current = below[current]
    ordered, g = [], 0
    while 0 <= g < len(members):
        if size[g]:
            ordered.append(members[g])
        g = above[g]
    return ordered, prev


def suffix_array(text: Sequence[int]) -> list[int]:
    """The places of ``text`` in the order of the suffixes that start there.

    Taking the suffixes in ascending order, each one decides the order within their groups of the
    places that its predecessors' chain of pointers leads to: the next free place of
    their group is theirs.
    """
    ordered, prev = lyndon_groups(text)
    n = len(text)
    out, free, group = [0] * n, [], [0] * n
    at = 0
    for g, members in enumerate(ordered):
        free.append(at)
        at += len(members)
        for i in members:
            group[i] = g
    placed = [False] * n
    i, p = -1, n - 1
    while True:
        while p >= 0 and not placed[p]:
            placed[p] = True
            g = group[p]
            out[free[g]] = p
            free[g] += 1
            p = prev[p]
        i += 1
        if i >= n:
            return out
        p = out[i] - 1
