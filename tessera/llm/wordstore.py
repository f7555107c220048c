"""A store of token ids by word, filled as words are met."""

from __future__ import annotations

import numpy as np

from tessera.llm.common import prefix_hash, ragged, window_hash


class WordStore:
    """Ids of words in one growing array; words are found by a 64-bit hash.

    Slot 0 holds ``first``. Past ``limit`` words the store starts afresh, so a
    process keeps a bounded number of words whatever it reads.
    """

    def __init__(self, first: np.ndarray, limit: int):
        self.first, self.limit = first, limit
        self._reset()

    def _reset(self):
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.at = self.first, np.zeros(1, np.int64)
        self.length = np.array([len(self.first)], np.int64)

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        raise NotImplementedError

    def slots(self, starts: np.ndarray, ends: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """Store slot of every word raw[start:end], encoding the new ones."""
        import pandas as pd
        if not len(starts):
            return np.zeros(0, np.int64)
        if len(self.at) > self.limit:
            self._reset()
        which, distinct = pd.factorize(window_hash(prefix_hash(raw), starts, ends))
        place = np.searchsorted(self.keys, distinct)
        found = np.zeros(len(distinct), bool)
        inside = place < len(self.keys)
        found[inside] = self.keys[place[inside]] == distinct[inside]
        slot = np.zeros(len(distinct), np.int64)
        slot[found] = self.slot[place[found]]
        new = np.flatnonzero(~found)
        if len(new):
            first = np.empty(len(distinct), np.int64)
            first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
            view = raw.tobytes()
            words = [view[s:e].decode("utf-8", "replace") for s, e in
                     zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            ids = self.encode_words(words)
            lens = np.fromiter(map(len, ids), np.int64, len(ids))
            slot[new] = np.arange(len(self.at), len(self.at) + len(new))
            self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(lens) - lens])
            self.length = np.concatenate([self.length, lens])
            self.ids = np.concatenate([self.ids, *ids])
            keys, slots = np.concatenate([self.keys, distinct[new]]), np.concatenate([self.slot, slot[new]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.slot = keys[order], slots[order]
        return slot[which]

    def gather(self, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the slots one after the other, running total of ids with a leading 0)."""
        lens = self.length[stream]
        return self.ids[ragged(self.at[stream], lens)], np.concatenate([[0], np.cumsum(lens)])
