"""Suffix order of window starts by Larsson-Sadakane refinement, common prefixes by Kasai, merging by search.

A shard is a byte string made of snippets. Its windows are strings of one fixed length, each inside one
snippet; a snippet's windows begin at consecutive places.
"""

from __future__ import annotations

import numpy as np

from logsight.llm.text import U64, ranges

WORD = 8


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, most significant first; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(WORD, np.uint8)])
    out = np.zeros(len(text), U64)
    for k in range(WORD):
        out = (out << U64(8)) | padded[k : k + len(text)].astype(U64)
    return out


def _numbered(keys: np.ndarray, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of keys; for each in that order where its group of equal keys begins; whether it is alone."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    at = np.flatnonzero(new)
    begins = np.repeat(at, np.diff(np.append(at, len(keys))))
    return order, begins, new & np.append(new[1:], True)


def suffix_ranks(text: np.ndarray, length: int, words: np.ndarray | None = None) -> np.ndarray:
    """Ranks of all places by the `length` bytes from there on; equal ones share a rank.

    The ranks by h bytes give those by 2 h: only groups that are not yet single are sorted again, by the rank
    h bytes further on. A group's rank is the number of suffixes before it, so ranks of single ones are final.
    """
    n = len(text)
    order, begins, alone = _numbered(words_at(text) if words is None else words)
    rank = np.zeros(n + length + 1, np.int64)  # past the end everything is equal and least
    rank[order] = begins + 1
    open_places, depth = order[~alone], WORD
    while depth < length and len(open_places):
        step = min(depth, length - depth)
        here, there = rank[open_places], rank[open_places + step]
        order, begins, alone = _numbered((here << 32) | there)
        sorted_places = open_places[order]
        own = here[order]
        first = np.concatenate([[True], own[1:] != own[:-1]])
        at = np.flatnonzero(first)
        group = np.repeat(at, np.diff(np.append(at, len(own))))
        rank[sorted_places] = own + (begins - group)
        open_places, depth = sorted_places[~alone], depth + step
    return rank[:n]


def common_prefixes(
    text: np.ndarray, begin: np.ndarray, windows: np.ndarray, order: np.ndarray, length: int
) -> np.ndarray:
    """How many bytes, up to length, each window shares with the one before it in suffix order (-1: none).

    begin and windows give each snippet's first window and their number, order all windows in suffix order. All
    snippets are walked at once, a window a step: what window i shares with the one before it, window i + 1
    shares with its own but for one byte, if that one's next place is a window too and before i + 1 in the
    order. (Strings equal in all their bytes that count may stand in any order, so it need not be.)
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(length, np.uint8)])
    standing = np.full(n + 1, n, np.int64)
    standing[order] = np.arange(len(order))
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    shared = np.zeros(len(begin), np.int64)
    last = np.full(len(begin), -1, np.int64)
    lanes = np.arange(len(begin))
    for t in range(int(windows.max(initial=0))):
        lanes = lanes[windows[lanes] > t]
        i = begin[lanes] + t
        j = before[i]
        known = (last[lanes] >= 0) & (standing[last[lanes] + 1] < standing[i])
        h = np.where(known, np.maximum(shared[lanes] - 1, 0), 0)
        active = np.flatnonzero((j >= 0) & (h < length))
        while len(active):
            same = padded[i[active] + h[active]] == padded[j[active] + h[active]]
            active = active[same]
            h[active] += 1
            active = active[h[active] < length]
        h[j < 0] = 0
        out[i], shared[lanes], last[lanes] = h, h, j
    return out


class Shard:
    """Sorted windows of a shard with the least owner of each distinct one."""

    def __init__(self, text: np.ndarray, begin: np.ndarray, windows: np.ndarray, owner: np.ndarray, length: int):
        """owner is each snippet's, the least of those it occurs in."""
        self.text, self.length = text, length
        self.words = words_at(text)
        places = ranges(begin, windows)
        rank = suffix_ranks(text, length, self.words)
        self.order = places[np.argsort(rank[places], kind="stable")]
        shared = common_prefixes(text, begin, windows, self.order, length)
        new = shared[self.order] < length
        new[:1] = True
        self.group = np.cumsum(new) - 1  # of each place in order
        at_place = np.zeros(len(text), np.int64)
        at_place[places] = np.repeat(owner, windows)
        self.places, self.place_owner = places, at_place
        self.first = self.order[new]
        self.least = np.minimum.reduceat(at_place[self.order], np.flatnonzero(new)) if len(places) else owner[:0]

    def keys(self, which: np.ndarray | None = None) -> np.ndarray:
        """The distinct windows in order, or some of them, as rows of whole words."""
        first = self.first if which is None else self.first[which]
        wide = np.concatenate([self.words, np.zeros(self.length, U64)])
        columns = [wide[first + k] for k in range(0, self.length - WORD + 1, WORD)]
        if self.length % WORD:
            columns.append(wide[first + self.length - WORD])
        return np.stack(columns, axis=1)

    def earlier(self) -> np.ndarray:
        """Of each window, in the order of `places`: whether its string has a lesser owner elsewhere."""
        out = np.zeros(len(self.text), bool)
        out[self.order] = self.least[self.group] < self.place_owner[self.order]
        return out[self.places]


def lower_bound(rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted row would stand among sorted rows, by binary search word by word."""
    low = np.zeros(len(wanted), np.int64)
    high = np.full(len(wanted), len(rows), np.int64)
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        mid = (low[open_] + high[open_]) // 2
        less, decided = np.zeros(len(open_), bool), np.zeros(len(open_), bool)
        for k in range(rows.shape[1]):
            a, b = rows[mid, k], wanted[open_, k]
            less |= ~decided & (a < b)
            decided |= a != b
        low[open_[less]] = mid[less] + 1
        high[open_[~less]] = mid[~less]


def merge_shards(shards: list[Shard]) -> None:
    """Gives each distinct window the least owner that it has in any of the shards.

    Shards are merged one by one into one sorted list, each by binary search for its windows; then each looks
    its windows up there.
    """
    rows, least = shards[0].keys(), shards[0].least
    for s in shards[1:]:
        own = s.keys()
        at = lower_bound(rows, own)
        found = at < len(rows)
        found[found] = (rows[at[found]] == own[found]).all(axis=1)
        least[at[found]] = np.minimum(least[at[found]], s.least[found])
        rows = np.insert(rows, at[~found], own[~found], axis=0)
        least = np.insert(least, at[~found], s.least[~found])
    for s in shards:
        s.least = least[lower_bound(rows, s.keys())]
