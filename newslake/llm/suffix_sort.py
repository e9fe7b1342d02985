"""Deep-shallow sorting of suffixes, vectorised with numpy.

The shallow part is a multikey quicksort whose symbols are eight bytes wide: all
groups of suffixes that are equal so far are ordered by their next symbol at once,
and only groups of two or more go one symbol deeper. Groups that are still equal
at the shallow depth share a long prefix; a blind trie orders them. It is grown a
path at a time: the first suffix of a group is its path, every other one is compared
with it once to find where it leaves the path and by which byte, and those that leave
at the same place by the same byte form the sub-trie that is grown next.
"""

from __future__ import annotations

import numpy as np

SYMBOL = 8
SHALLOW = 24


def symbols(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a big-endian number; zeros follow the end."""
    x = np.concatenate([data, np.zeros(SYMBOL, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        x = (x[:-step] << np.uint64(8 * step)) | x[step:]
    return x[: len(data)]


def _groups(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of each member, and the group sizes."""
    number = np.cumsum(first) - 1
    return number, np.bincount(number) if len(number) else np.zeros(0, np.int64)


def sort_suffixes(data: np.ndarray, positions: np.ndarray, depth: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``positions`` by their first ``depth`` bytes, and where a new string begins.

    Returns indices into ``positions`` in sorted order, and for each a flag that it
    differs from the one before it within ``depth`` bytes. Every suffix must have
    ``depth`` bytes; ``depth`` must be a multiple of eight or at least eight.
    """
    n = len(positions)
    order = np.arange(n)
    new = np.zeros(n, bool)
    if n == 0:
        return order, new
    new[0] = True
    word = symbols(data)
    offsets = [*range(0, depth - SYMBOL + 1, SYMBOL)]
    if offsets[-1] != depth - SYMBOL:
        offsets.append(depth - SYMBOL)
    place = np.arange(n)  # slots of ``order`` that are still in groups of two or more
    for at in offsets[: shallow // SYMBOL]:
        members = order[place]
        key = word[positions[members] + at]
        group, _ = _groups(new[place])
        by = np.lexsort((key, group))
        members, key, group = members[by], key[by], group[by]
        order[place] = members
        differs = np.ones(len(place), bool)
        differs[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        new[place] |= differs
        number, sizes = _groups(differs)
        place = place[sizes[number] > 1]
        if not len(place):
            return order, new
    deep = offsets[shallow // SYMBOL :]
    while len(place) and deep:
        place = _grow(order, new, place, positions, word, deep)
    return order, new


def _grow(order, new, place, positions, word, deep) -> np.ndarray:
    """Grow one path of the blind trie of every group; returns the slots of the sub-tries left."""
    members = order[place]
    group, sizes = _groups(new[place])
    heads = np.cumsum(sizes) - sizes
    mine, path = positions[members], positions[members[heads]][group]
    leaves = np.full(len(place), len(deep), np.int64)  # symbol at which a member leaves the path
    own = np.zeros(len(place), np.uint64)
    theirs = np.zeros(len(place), np.uint64)
    on = np.arange(len(place))
    for i, at in enumerate(deep):
        a, b = word[mine[on] + at], word[path[on] + at]
        off = a != b
        gone = on[off]
        leaves[gone], own[gone], theirs[gone] = i, a[off], b[off]
        on = on[~off]
        if not len(on):
            break
    # Those that leave downwards stand before the path, the earliest leavers first;
    # those that leave upwards stand behind it, the earliest leavers last.
    side = np.where(leaves == len(deep), 1, np.where(own < theirs, 0, 2))
    rank = np.where(side == 0, leaves, np.where(side == 2, -leaves, 0))
    by = np.lexsort((own, rank, side, group))
    order[place] = members[by]
    group, leaves, own, side = group[by], leaves[by], own[by], side[by]
    differs = np.ones(len(place), bool)
    differs[1:] = (group[1:] != group[:-1]) | (side[1:] != side[:-1]) | (leaves[1:] != leaves[:-1]) | (own[1:] != own[:-1])
    new[place] |= differs
    number, sizes = _groups(differs)
    return place[(sizes[number] > 1) & (side != 1)]
