"""Suffix arrays by grouping, for texts that fit into a task.

The suffixes are first grouped by their Lyndon prefix (the text up to the next smaller suffix), then every
group is put in order. Both steps take linear time, without recursion and without new names for parts.

Grouping. Groups start as equal first symbols and are settled from the greatest down. When group G is
settled, all members of greater groups are; each member finds the last position before it that lies in
a smaller group by previous-smaller pointers, which skip what is settled. The text between the two is a run of
settled factors, so the position found belongs to a factor that G continues: the positions are taken
out of their groups into new ones right above, one for each number of members of G that follow in a row.

Ordering. Suffixes are visited in ascending order, the end of the text first. The suffixes whose next
smaller suffix is the visited one are found by following previous-smaller pointers; each takes the next
free place of its group, as suffixes of one group are ordered by what comes after their equal prefix.
"""

from __future__ import annotations

from collections.abc import Sequence


def lyndon_groups(symbols: Sequence[int]) -> tuple[list[int], list[int], list[int], list]:
    """(group of each suffix, previous-smaller pointers, groups in descending order, members of each group).

    Pointers are shifted by one: ``previous[i + 1] - 1`` belongs to suffix i, 0 means none.
    """
    n = len(symbols)
    first: dict[int, list[int]] = {}
    for i, symbol in enumerate(symbols):
        first.setdefault(symbol, []).append(i)
    members: list = [()]
    below, above, group = [0], [1], [0] * n
    for symbol in sorted(first):
        number = len(members)
        members.append(first[symbol])
        below.append(number - 1)
        above.append(number + 1)
        for i in first[symbol]:
            group[i] = number
    above[-1] = 0
    left = [len(m) for m in members]                           # members that have not moved on
    previous = list(range(n + 1))                              # of suffixes not settled yet: themselves
    descending = []

    def move_up(positions, old):
        left[old] -= len(positions)
        new, up = len(members), above[old]
        members.append(positions)
        left.append(len(positions))
        below.append(old)
        above.append(up)
        above[old] = below[up] = new
        for i in positions:
            group[i] = new

    number = len(members) - 1
    while number:
        if left[number]:
            descending.append(number)
            own = members[number]
            if len(own) != left[number]:
                own = members[number] = [i for i in own if group[i] == number]
            followers: dict[int, int] = {}                     # position before G -> members of G in a row
            for i in own:
                at, then = i, previous[i]
                while then != at:
                    at, then = then, previous[then]
                previous[i + 1] = at
                if at:
                    followers[at] = followers.get(at, 0) + 1
            if len(followers) == 1:
                (at, _), = followers.items()
                if left[group[at - 1]] > 1:
                    move_up((at - 1,), group[at - 1])
            elif followers:
                parts: dict[tuple[int, int], list[int]] = {}
                for at, count in followers.items():
                    parts.setdefault((group[at - 1], count), []).append(at - 1)
                for old, count in sorted(parts, reverse=True):
                    if len(parts[old, count]) < left[old]:     # else the whole group moves: it keeps its place
                        move_up(parts[old, count], old)
        number = below[number]
    return group, previous, descending, members


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """The positions of all suffixes in ascending order."""
    n = len(symbols)
    group, previous, descending, members = lyndon_groups(symbols)
    free, place = [0] * len(members), n
    for number in descending:
        place -= len(members[number])
        free[number] = place
    order = [0] * n
    waiting = bytearray(b"\0" + b"\1" * n)
    at, rank = n, 0
    while True:
        while waiting[at]:
            waiting[at] = 0
            number = group[at - 1]
            order[free[number]] = at - 1
            free[number] += 1
            at = previous[at]
        if rank == n:
            return order
        at = order[rank]
        rank += 1
