"""Exact byte-pair merges of many short words at a time, in numpy."""

from __future__ import annotations

import numpy as np

_NONE = np.int64(1 << 40)


class Merger:
    """Merges words by the ranks of pairs ``(left id, right id) -> (rank, merged id)``."""

    def __init__(self, byte_ids: list[int], ranks: dict[tuple[int, int], tuple[int, int]], n_ids: int):
        self.byte_ids = np.array(byte_ids, np.int64)
        self.n = n_ids
        pairs = np.array(list(ranks), np.int64).reshape(-1, 2)
        values = np.array(list(ranks.values()), np.int64).reshape(-1, 2)
        keys = pairs[:, 0] * n_ids + pairs[:, 1]
        order = np.argsort(keys)
        # the end is a key that no pair has
        self.keys = np.append(keys[order], np.int64(n_ids) * n_ids)
        self.rank, self.made = np.append(values[order, 0], _NONE), np.append(values[order, 1], -1)

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of pairs, and where they stand in the table; places without an id have no rank."""
        key = left * self.n + right
        at = np.searchsorted(self.keys[:-1], key)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank[at], _NONE), at

    def __call__(self, words: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_size.setdefault(len(word), []).append(i)
        for size, places in by_size.items():
            raw = np.frombuffer(b"".join([words[i] for i in places]), np.uint8).reshape(len(places), size)
            for i, ids in zip(places, self._merge(self.byte_ids[raw])):
                out[i] = ids
        return out

    def _merge(self, ids: np.ndarray) -> list[list[int]]:
        """All rows of one length: each turn merges the first pair of lowest rank in every row."""
        count, size = ids.shape
        if size < 2:
            return ids.tolist()
        rank = self._look(ids[:, :-1], ids[:, 1:])[0]
        rank = np.hstack([rank, np.full((count, 1), _NONE)])
        lengths = np.full(count, size)
        live = np.arange(count)
        done = ids.copy()
        columns = np.arange(size)
        while len(live):
            at = rank.argmin(axis=1)
            rows = np.arange(len(live))
            going = rank[rows, at] < _NONE
            if not going.all():
                stop = ~going
                done[live[stop]] = ids[stop]
                ids, rank, live, at = ids[going], rank[going], live[going], at[going]
                rows = np.arange(len(live))
                if not len(live):
                    break
            _, place = self._look(ids[rows, at], ids[rows, at + 1])
            ids[rows, at] = self.made[place]
            # what stands right of the pair moves up by one
            source = np.minimum(columns + (columns > at[:, None]), size - 1)
            ids = np.take_along_axis(ids, source, axis=1)
            rank = np.take_along_axis(rank, source, axis=1)
            ids[:, -1], rank[:, -1] = -1, _NONE
            lengths[live] -= 1
            # two pairs are new: the one that starts here and the one that ends here
            after = np.minimum(at + 1, size - 1)
            rank[rows, at] = np.where(at + 1 < size, self._look(ids[rows, at], ids[rows, after])[0], _NONE)
            before = np.maximum(at - 1, 0)
            left = self._look(ids[rows, before], ids[rows, at])[0]
            rank[rows, before] = np.where(at > 0, left, rank[rows, before])
        return [row[:n] for row, n in zip(done.tolist(), lengths.tolist())]
