"""Signature trees over token sets: exact similarity links within a group, in numpy.

Leaves are sets as bitmaps over the group's own tokens; a node is the OR of its children with the
range of their sizes. Two nodes can hold a linked pair only if the bits they share reach the overlap
that their smallest sizes need, and their size ranges allow it. Pairs of nodes are traversed
together from each common ancestor down. Pairs of nodes that lie in one component already are
skipped, since they cannot change it, so a family of copies costs about as much as its size.
"""

from __future__ import annotations

import numpy as np

from daybook.llm import textblocks as tb

FAN = 8
#: 64-bit words that one step of the traversal holds.
STEP_WORDS = 4 << 20


def linked(overlap, a, b):
    """Whether 100 * intersection >= 80 * union, from the overlap and both sizes."""
    return 180 * overlap >= 80 * (a + b)


class Labels:
    """Components under way; a label is the number of its first member."""

    def __init__(self, start: np.ndarray):
        self.of = start

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        x, y = self.of[a], self.of[b]
        differ = x != y
        if not differ.any():
            return
        parent: dict[int, int] = {}

        def top(v: int) -> int:
            while parent.get(v, v) != v:
                parent[v] = parent.get(parent[v], parent[v])
                v = parent[v]
            return v

        for p, q in np.unique(np.stack([x[differ], y[differ]], 1), axis=0).tolist():
            p, q = top(p), top(q)
            if p != q:
                parent[max(p, q)] = min(p, q)
        table = np.arange(int(self.of.max()) + 1)
        for v in list(parent):
            table[v] = top(v)
        self.of = table[self.of]


class Tree:
    def __init__(self, bits: np.ndarray, sizes: np.ndarray, labels: Labels):
        self.labels = labels
        self.levels = [(bits, sizes, sizes)]
        while len(self.levels[-1][1]) > 1:
            b, low, high = self.levels[-1]
            at = np.arange(0, len(low), FAN)
            self.levels.append((np.bitwise_or.reduceat(b, at), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at)))

    def _overlap(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        bits = self.levels[level][0]
        return np.bitwise_count(bits[a] & bits[b]).sum(1, dtype=np.int64)

    def _apart(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs of nodes that are not wholly within one component."""
        low = high = self.labels.of
        for _ in range(level):
            at = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
        return (low[a] != high[a]) | (low[b] != high[b]) | (low[a] != low[b])

    def join(self) -> None:
        """Finds links until all pairs of leaves are linked, pruned or in one component."""
        n = len(self.levels)
        for level in range(n - 1):  # nodes of this level below one parent
            count = len(self.levels[level][1])
            for step in range(1, FAN):
                a = np.arange(count - step)
                a = a[a // FAN == (a + step) // FAN]
                self._descend(level, a, a + step)

    def _room(self) -> int:
        return max(1, STEP_WORDS // max(1, self.levels[0][0].shape[1]))

    def _descend(self, level: int, a: np.ndarray, b: np.ndarray) -> None:
        room = self._room()
        for at in range(0, len(a), room):
            self._step(level, a[at:at + room], b[at:at + room])

    def _step(self, level: int, a: np.ndarray, b: np.ndarray) -> None:
        _, low, high = self.levels[level]
        keep = self._apart(level, a, b) & (100 * high[a] >= 80 * low[b]) & (100 * high[b] >= 80 * low[a])
        a, b = a[keep], b[keep]
        shared = self._overlap(level, a, b)
        if not level:
            sizes = self.levels[0][1]
            hit = linked(shared, sizes[a], sizes[b])
            self.labels.join(a[hit], b[hit])
            return
        keep = linked(shared, low[a], low[b])
        a, b = a[keep], b[keep]
        if not len(a):
            return
        # one pair of leaves per pair of nodes often settles all
        x, y, sizes = a * FAN ** level, b * FAN ** level, self.levels[0][1]
        hit = linked(self._overlap(0, x, y), sizes[x], sizes[y])
        self.labels.join(x[hit], y[hit])
        keep = self._apart(level, a, b)
        a, b, below = a[keep], b[keep], len(self.levels[level - 1][1])
        i, j = np.divmod(np.arange(FAN * FAN), FAN)
        room = max(1, self._room() // (FAN * FAN))
        for at in range(0, len(a), room):  # all pairs of children at once: many pairs have few
            x = (a[at:at + room, None] * FAN + i).ravel()
            y = (b[at:at + room, None] * FAN + j).ravel()
            fits = (x < below) & (y < below)
            self._descend(level - 1, x[fits], y[fits])


def links(tokens: np.ndarray, lengths: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Component labels of sets given as distinct tokens, set after set.

    Sets are linked by ``linked``; ``label`` holds components known before (equal numbers). A set's
    label is the position of a set of its component.
    """
    n = len(lengths)
    start = np.arange(n) if label is None else _first(label)
    labels = Labels(start.copy())
    owner = np.repeat(np.arange(n), lengths)
    _, token = np.unique(tokens, return_inverse=True)
    live = np.ones(len(token), bool)
    # a token of one set takes no part in an overlap; a set keeps at least 80 % of its tokens
    while True:
        df = np.bincount(token[live], minlength=0 if not len(token) else int(token.max()) + 1)
        count = np.bincount(owner[live & (df[token] > 1)], minlength=n) if len(token) else np.zeros(n, np.int64)
        good = (100 * count >= 80 * lengths) & (lengths > 0)
        now = live & (df[token] > 1) & good[owner]
        if now.sum() == live.sum():
            break
        live = now
    token, owner = token[live], owner[live]
    if not len(token):
        return labels.of
    for members in _families(token, owner, lengths, n):
        _family(members, token, owner, lengths, labels)
    return labels.of


def _first(label: np.ndarray) -> np.ndarray:
    _, at, back = np.unique(label, return_index=True, return_inverse=True)
    return at[back]


def _families(token, owner, lengths, n) -> list[np.ndarray]:
    """Sets that can be linked through their rarest tokens, one family at a time.

    Two linked sets share one of the rarest floor(size / 5) + 1 tokens of either.
    """
    df = np.bincount(token)
    order = np.lexsort((token, df[token], owner))
    token, owner = token[order], owner[order]
    count = np.bincount(owner, minlength=n)
    place = np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
    prefix = place < (lengths // 5 + 1 - (lengths - count))[owner]
    token, owner = token[prefix], owner[prefix]
    if not len(token):
        return []
    by_token = np.argsort(token, kind="stable")
    t, o = token[by_token], owner[by_token]
    t_at = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
    t_len = np.diff(np.append(t_at, len(t)))
    o_at = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    back = np.empty(len(t), np.int64)
    back[by_token] = np.arange(len(t))
    family = np.arange(n)
    while True:  # the smallest family number spreads over tokens and sets
        low = np.repeat(np.minimum.reduceat(family[o], t_at), t_len)[back]
        best = family.copy()
        best[owner[o_at]] = np.minimum(best[owner[o_at]], np.minimum.reduceat(low, o_at))
        best = best[best]
        if (best == family).all():
            break
        family = best
    members = np.unique(owner)
    order = np.argsort(family[members], kind="stable")
    cuts = np.flatnonzero(np.diff(family[members][order])) + 1
    return [m for m in np.split(members[order], cuts) if len(m) > 1]


def _family(members, token, owner, lengths, labels: Labels) -> None:
    first, last = np.searchsorted(owner, members), np.searchsorted(owner, members, "right")
    own = tb.ranges(first, last - first)
    words, local = np.unique(token[own], return_inverse=True)
    row = np.repeat(np.arange(len(members)), last - first)
    # alike sets side by side: by size, then by smallest token
    low = np.minimum.reduceat(local, np.cumsum(last - first) - (last - first))
    order = np.lexsort((low, lengths[members]))
    place = np.empty(len(members), np.int64)
    place[order] = np.arange(len(members))
    bits = np.zeros((len(members), -(-len(words) // 64)), np.uint64)
    np.bitwise_or.at(bits, (place[row], local >> 6), np.uint64(1) << (local & 63).astype(np.uint64))
    inner = Labels(_first(labels.of[members[order]]))
    Tree(bits, lengths[members[order]], inner).join()
    labels.join(members[order], members[order][inner.of])
