"""Sorting of suffixes by deep-shallow sorting.

Shallow: multikey quicksort down to a fixed depth. A "character" is a run of eight bytes,
and suffixes that agree so far are split by their next run, all open groups at once, as
array operations. Deep: groups that still agree at that depth have long common prefixes;
each is put in order by a blind trie, a compact trie that holds only branching bytes and
depths: a suffix walks down without comparing, is compared with one leaf to find where it
parts, and its branch is put in there.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 64
"""Bytes that multikey quicksort looks at."""


def keys_at(data: np.ndarray, start: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes at `depth` of each suffix as big-endian numbers; `data` is padded behind."""
    key = np.zeros(len(start), np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | data[start + depth + i]
    return key


def order(data: bytes, start: np.ndarray, length: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The sorted order of suffixes and the common prefix of each with the one before it.

    Suffix i is the `length[i]` bytes at `start[i]`; ends count as smaller than any byte.
    Equal suffixes stay in their given order. The common prefix of the first one is 0.
    """
    n = len(start)
    padded = np.frombuffer(data + bytes(shallow + 16), np.uint8)
    order = np.arange(n)
    group = np.zeros(n, np.int64)  # start of the group that each place belongs to
    prefix = np.zeros(n, np.int64)
    open_places = np.arange(n)
    for depth in range(0, shallow, 8):
        if not len(open_places):
            break
        rows = order[open_places]
        left = np.clip(length[rows] - depth, 0, 8)
        key = keys_at(padded, start[rows], depth) >> ((8 - left) * 8).astype(np.uint64) % np.uint64(64)
        key = np.where(left == 0, np.uint64(0), key << ((8 - left) * 8).astype(np.uint64) % np.uint64(64))
        by = np.lexsort((left, key, group[open_places]))
        rows, key, left = rows[by], key[by], left[by]
        order[open_places] = rows
        owner = group[open_places]
        same_group = np.zeros(len(rows), bool)
        same_group[1:] = owner[1:] == owner[:-1]
        same = same_group.copy()
        same[1:] &= (key[1:] == key[:-1]) & (left[1:] == left[:-1])
        parts = same_group & ~same
        at = np.flatnonzero(parts)
        if len(at):
            agree = _agreeing_bytes(key[at] ^ key[at - 1])
            prefix[open_places[at]] = depth + np.minimum(agree, np.minimum(left[at], left[at - 1]))
        heads = np.maximum.accumulate(np.where(same, -1, np.arange(len(rows))))
        group[open_places] = open_places[heads]
        grouped = same | np.append(same[1:], False)
        ended = left < 8
        finished = grouped & ended & same
        prefix[open_places[finished]] = length[rows[finished]]
        open_places = open_places[grouped & ~ended]
    if len(open_places):
        cuts = np.flatnonzero(np.append(True, group[open_places][1:] != group[open_places][:-1]))
        for places in np.split(open_places, cuts[1:]):
            sorted_rows, common = blind_order(data, order[places].tolist(), start, length, shallow)
            order[places] = sorted_rows
            prefix[places[1:]] = common[1:]
    return order, prefix


def _agreeing_bytes(different: np.ndarray) -> np.ndarray:
    """Leading bytes in which two numbers agree, from their exclusive or."""
    agree = np.zeros(len(different), np.int64)
    running = np.ones(len(different), bool)
    for shift in range(56, -1, -8):
        running &= (different >> np.uint64(shift)) & np.uint64(255) == 0
        agree += running
    return agree


def blind_order(data: bytes, rows: list[int], start: np.ndarray, length: np.ndarray, known: int) -> tuple[list[int], list[int]]:
    """Order of suffixes that agree in `known` bytes, and common prefixes with the one before.

    A node is [depth, {byte: child}, leaves]: its suffixes agree in `depth` bytes; `leaves`
    are those that end there. A child is a node, or a row that is alone below it.
    """
    text = [data[start[r] : start[r] + length[r]] for r in rows]
    root: list | None = None
    for i in range(len(rows)):
        own = text[i]
        if root is None:
            root = [len(own), {}, [i]]
            continue
        # Blind descent: branch by single bytes only.
        node = root
        while node[0] < len(own) and own[node[0]] in node[1]:
            node = node[1][own[node[0]]]
        while not node[2]:
            node = next(iter(node[1].values()))
        other = text[node[2][0]]
        at, most = known, min(len(own), len(other))
        if own[known:most] == other[known:most]:
            at = most
        else:
            step = 1 << max(most - known - 1, 1).bit_length()
            while step:
                if at + step <= most and own[at : at + step] == other[at : at + step]:
                    at += step
                step >>= 1
        # Second descent: to the first node at or below the place where they part.
        above, node = None, root
        while node[0] < at:
            above, node = node, node[1][own[node[0]]]
        if node[0] > at:
            split = [at, {other[at]: node}, []]
            if above is None:
                root = split
            else:
                above[1][own[above[0]]] = split
            node = split
        if len(own) == at:
            node[2].append(i)
        else:
            node[1][own[at]] = [len(own), {}, [i]]
    out, common, stack, shared = [], [], [(root, 0)], 0
    while stack:
        node, part = stack.pop()
        shared = part
        for i in node[2]:
            out.append(rows[i])
            common.append(shared)
            shared = node[0]
        for k, byte in enumerate(sorted(node[1], reverse=True)):
            first = k == len(node[1]) - 1 and not node[2]
            stack.append((node[1][byte], part if first else node[0]))
    return out, common
