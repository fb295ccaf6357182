"""Linear-time suffix array by grouping, with common prefixes and nearest-earlier queries.

Suffixes are grouped by their Lyndon prefix.  Groups are taken in descending order; each
member's previous-smaller pointer finds the suffix before it in a lower group, and suffixes
that are pointed at move behind the rest of their own group, the further the more members
point at them.  When all groups are done, each one's order is emitted from the sorted front:
the suffixes that end where a sorted suffix starts follow the pointers.  No part of the text
is renamed or sorted again.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of the suffixes of ``text`` in ascending order; the last symbol must be the unique smallest."""
    n = len(text)
    group, before = lyndon_groups(text)
    out, placed = [-1] * n, [False] * n
    front = list(range(n))  # of a group, by its first place: where its next member goes
    out[0], placed[n - 1] = n - 1, True
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[front[g]] = j
            front[g] += 1
            placed[j] = True
            j = before[j]
    return out


def lyndon_groups(text: Sequence[int]) -> tuple[list[int], list[int]]:
    """(first place of each suffix's group, its previous-smaller pointer or -1)."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place, group, last = [0] * n, [0] * n, [0] * n  # last: of a group, by its first place
    g = 0
    for i, s in enumerate(order):
        if i and text[s] != text[order[i - 1]]:
            g = i
        place[s], group[s], last[g] = i, g, i
    before = [-1] * n
    end = n - 1
    while end >= 0:
        g = group[order[end]]
        if g == end:  # one member, as in most groups: what it points at moves alone
            s = order[g]
            p = s - 1
            while p >= 0 and group[p] > g:
                p = before[p]
            before[s] = p
            if p >= 0:
                h = group[p]
                back = last[h]
                if back > h:
                    i, q = place[p], order[back]
                    order[i], order[back] = q, p
                    place[q], place[p] = i, back
                    last[h] = back - 1
                    group[p] = last[back] = back
            end = g - 1
            continue
        members = order[g : end + 1]
        members.sort()
        points = []
        for s in members:
            p = s - 1
            while p >= 0 and group[p] > g:
                p = before[p]
            if p >= 0 and group[p] == g:
                p = before[p]  # set already: the members come in order of the text
            before[s] = p
            if p >= 0:
                points.append(p)
        if len(set(points)) == len(points):
            sets = [points]  # as in most groups, no suffix is pointed at twice
        else:
            pointed: dict[int, int] = {}
            for p in points:
                pointed[p] = pointed.get(p, 0) + 1
            by_count: dict[int, list[int]] = {}
            for p, k in pointed.items():
                by_count.setdefault(k, []).append(p)
            sets = [by_count[k] for k in sorted(by_count, reverse=True)]
        for moving in sets:
            moved: dict[int, int] = {}
            for p in moving:
                h = group[p]
                back = last[h]
                # swap p with the last member of its group that has not moved
                i, q = place[p], order[back]
                order[i], order[back] = q, p
                place[q], place[p] = i, back
                last[h] = back - 1
                moved[h] = moved.get(h, 0) + 1
            for h, many in moved.items():
                new = last[h] + 1
                last[new] = new + many - 1
                for i in range(new, new + many):
                    group[order[i]] = new
        end = g - 1
    return group, before


def common_prefixes(text: Sequence[int], order: Sequence[int], first: int = 0, last: int | None = None) -> list[int]:
    """Symbols that each suffix of ``order[first:last]`` shares with the one before it; 0 for the first."""
    n = len(text)
    last = n if last is None else last
    rank = [-1] * n
    for i in range(first, last):
        rank[order[i]] = i
    out, k = [0] * (last - first), 0
    for s in range(n):
        r = rank[s]
        if r <= first:
            k = 0
            continue
        q = order[r - 1]
        while s + k < n and q + k < n and text[s + k] == text[q + k]:
            k += 1
        out[r - first] = k
        if k:
            k -= 1
    return out


def longest_earlier(age: Sequence[int], shared: Sequence[int]) -> list[int]:
    """Symbols that each suffix shares with the one of smaller age that shares most; 0 if none.

    ``age`` and ``shared`` are in order of the suffixes.  That suffix is the nearest of smaller
    age to one side or the other.
    """
    n = len(age)
    out = [0] * n
    for places in (range(n), range(n - 1, -1, -1)):
        ages: list[int] = []  # ages on the stack, and what each entry shares with the one below
        links: list[int] = []
        up = places.step == 1
        link = 0
        for i in places:
            if up:
                link = shared[i]
            if not link:
                ages, links = [age[i]], [0]
            else:
                a, least = age[i], link
                while ages and ages[-1] >= a:
                    ages.pop()
                    below = links.pop()
                    if below < least:
                        least = below
                if ages and least > out[i]:
                    out[i] = least
                ages.append(a)
                links.append(least)
            if not up:
                link = shared[i]
    return out
