"""Applying ranked merges to the symbols of words; runs inside tasks."""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence

import numpy as np

# A rank after all others, and how many words are looked at together.
NO_RANK = np.iinfo(np.int64).max
WORDS_TOGETHER = 8192


def merge_symbols(
    symbols: Sequence[str], ranks: Mapping[tuple[str, str], tuple[int, str]]
) -> list[str]:
    """Merge the lowest ranked pair, leftmost first, until no pair has a rank.

    ``ranks`` gives ``(rank, merged symbol)`` of a pair. Merged symbols keep the
    place of their left part, so neighbours are found through two link lists.
    """
    parts = list(symbols)
    count = len(parts)
    queue = []
    for i in range(count - 1):
        merge = ranks.get((parts[i], parts[i + 1]))
        if merge:
            queue.append((merge[0], i, merge[1]))
    if not queue:
        return parts
    heapq.heapify(queue)
    after = list(range(1, count + 1))
    before = list(range(-1, count - 1))
    while queue:
        _, i, merged = heapq.heappop(queue)
        j = after[i]
        if not parts[i] or j == count:
            continue
        now = ranks.get((parts[i], parts[j]))
        if not now or now[1] != merged:
            continue
        parts[i], parts[j] = merged, ""
        k = after[i] = after[j]
        if k < count:
            before[k] = i
            merge = ranks.get((merged, parts[k]))
            if merge:
                heapq.heappush(queue, (merge[0], i, merge[1]))
        h = before[i]
        if h >= 0:
            merge = ranks.get((parts[h], merged))
            if merge:
                heapq.heappush(queue, (merge[0], h, merge[1]))
    return [part for part in parts if part]


class Merges:
    """Ranked merges as sorted arrays, which many words are encoded with at once.

    Symbols and tokens have numbers here; ``-1`` stands for none.
    """

    def __init__(self, ids: Mapping[str, int], ranks: Mapping[tuple[str, str], tuple[int, str]], symbols: Sequence[str]) -> None:
        number = {token: k for k, token in enumerate(ids)}
        for (left, right), (_, merged) in ranks.items():
            for token in (left, right, merged):
                number.setdefault(token, len(number))
        self.size = max(len(number), 1)
        keys = np.array([number[left] * self.size + number[right] for left, right in ranks], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.rank = np.array([rank for rank, _ in ranks.values()], np.int64)[order]
        self.merged = np.array([number[merged] for _, merged in ranks.values()], np.int64)[order]
        self.symbols = np.array([number[s] if s in ids else -1 for s in symbols], np.int64)
        self.ids = np.array([ids.get(token, -1) for token in number], np.int64)

    def encode(self, words: Sequence[bytes]) -> list[bytes]:
        """The ids of every word, as 32-bit numbers; words are best short."""
        found: list[bytes] = [b""] * len(words)
        order = np.argsort([len(w) for w in words], kind="stable")
        for start in range(0, len(order), WORDS_TOGETHER):
            part = order[start : start + WORDS_TOGETHER]
            grid = self._merge(self._grid([words[k] for k in part]))
            ids = self.ids[grid[grid >= 0]]
            if (ids < 0).any():
                raise KeyError("a merged token is not in the vocabulary")
            ends = 4 * np.cumsum((grid >= 0).sum(axis=1))
            data = ids.astype(np.int32).tobytes()
            for k, first, end in zip(part.tolist(), [0, *ends[:-1].tolist()], ends.tolist()):
                found[k] = data[first:end]
        return found

    def _grid(self, words: list[bytes]) -> np.ndarray:
        """A row of symbols for each word, with one column more than the longest needs."""
        numbers = self.symbols[np.frombuffer(b"".join(words), np.uint8)]
        row = np.repeat(np.arange(len(words)), [len(w) for w in words])[numbers >= 0]
        sizes = np.bincount(row, minlength=len(words))
        grid = np.full((len(words), sizes.max() + 1), -1)
        grid[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = numbers[numbers >= 0]
        return grid

    def _places(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pairs stand among the keys, and which of them do."""
        key = left * self.size + right
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return place, (self.keys[place] == key) & (left >= 0) & (right >= 0)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        place, there = self._places(left, right)
        return np.where(there, self.rank[place], NO_RANK)

    def _merge(self, grid: np.ndarray) -> np.ndarray:
        """Merge in every row the lowest ranked pair, leftmost first, until no pair has a rank."""
        done, where = grid.copy(), np.arange(len(grid))
        if not len(self.keys) or grid.shape[1] < 2:
            return done
        ranks, columns = self._ranks(grid[:, :-1], grid[:, 1:]), np.arange(grid.shape[1])
        while True:
            at = ranks.argmin(axis=1)
            more = ranks[np.arange(len(at)), at] < NO_RANK
            done[where[~more]] = grid[~more]
            grid, ranks, at, where = grid[more], ranks[more], at[more], where[more]
            if not len(where):
                return done
            row = np.arange(len(at))
            merged = self.merged[self._places(grid[row, at], grid[row, at + 1])[0]]
            after = np.minimum(columns + (columns > at[:, None]), len(columns) - 1)
            grid = np.take_along_axis(grid, after, axis=1)
            ranks = np.take_along_axis(ranks, np.minimum(after[:, :-1], len(columns) - 2), axis=1)
            grid[row, at] = merged
            ranks[row, at] = self._ranks(merged, grid[row, at + 1])
            back = np.flatnonzero(at)
            ranks[back, at[back] - 1] = self._ranks(grid[back, at[back] - 1], merged[back])
