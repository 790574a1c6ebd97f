"""Suffix arrays of byte strings by two-stage sorting, in numpy.

Only suffixes smaller than their successors are sorted directly, eight bytes at a time and to a
bounded depth. The others are induced: the array is scanned once, bucket by bucket, and each suffix
found puts its predecessor, if that is the larger one, next in the bucket of its first byte.
"""

from __future__ import annotations

import numpy as np


def words_at(text: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes from every position on as a number, past the end filled with 255."""
    x = np.concatenate([text, np.full(depth + 16, 255, np.uint8)]).astype(np.uint64)
    for width in (1, 2, 4):
        x = (x[:-width] << np.uint64(8 * width)) | x[width:]
    return x


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts one byte later."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1:] = -1  # the last suffix is larger than the empty one
    # equal bytes: as at the next position that differs
    at = np.where(step != 0, np.arange(n), n - 1)
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def sort_direct(positions: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of the ``depth`` bytes from each of them on; equal ones in any order."""
    order = np.argsort(words[positions], kind="stable")
    positions = positions[order]
    group = np.cumsum(np.concatenate([[0], np.diff(words[positions]) != 0])) if len(positions) else positions
    for at in range(8, depth, 8):
        same = group[1:] == group[:-1]
        tied = np.zeros(len(positions), bool)
        tied[1:] |= same
        tied[:-1] |= same
        open_ = np.flatnonzero(tied)  # places of suffixes still equal to a neighbour
        if not len(open_):
            break
        word = words[positions[open_] + at]
        order = np.lexsort((word, group[open_]))
        positions[open_], word = positions[open_[order]], word[order]
        fresh = np.concatenate([[True], (word[1:] != word[:-1]) | (group[open_][1:] != group[open_][:-1])])
        # numbers stay ascending: a group's first member keeps its place as its number
        group[open_] = np.maximum.accumulate(np.where(fresh, open_, 0)) + len(positions)
        closed = ~tied
        group[closed] = np.flatnonzero(closed) + len(positions)
    return positions


def suffix_array(text: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """All positions in order of their suffixes, exact for the first ``depth`` bytes at least."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    small = smaller_than_next(text)
    direct = sort_direct(np.flatnonzero(small), words, depth)
    first = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]  # larger suffixes of each bucket, in order
    out = []

    def induce(found: np.ndarray, own: int) -> np.ndarray:
        """Deals the larger predecessors out to their buckets; those of this bucket are returned."""
        before = found[found > 0] - 1
        before = before[~small[before]]
        byte = text[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        cuts = np.flatnonzero(np.diff(byte)) + 1
        here = before[:0]
        for part in np.split(before, cuts) if len(before) else []:
            c = text[part[0]]
            if c == own:
                here = part
            else:
                waiting[c].append(part)
        return here

    waiting[text[n - 1]].append(np.array([n - 1]))
    for c in range(256):
        found = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(found):
            out.append(found)
            found = induce(found, c)
        found = direct[first[c]:first[c + 1]]
        if len(found):
            out.append(found)
            induce(found, c)
    return np.concatenate(out)


def common_prefixes(array: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in the array, ``depth`` at most; 0 for the first."""
    shared = np.zeros(len(array), np.int64)
    open_ = np.arange(1, len(array))
    for at in range(0, depth, 8):
        if not len(open_):
            break
        x = words[array[open_] + at] ^ words[array[open_ - 1] + at]
        equal = np.zeros(len(x), np.int64)
        for k in range(1, 9):
            equal += (x >> np.uint64(64 - 8 * k)) == 0
        shared[open_] += equal
        open_ = open_[equal == 8]
    return np.minimum(shared, depth)
