"""A bounded memo of the ids of words, for tokenizers that treat words one by one.

Words are numbered as they come, and the ids of all words lie in one array. So a text
costs one look-up a word; its ids are then gathered by array operations. When the memo
is full, the half that was used most stays.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count, islice

import numpy as np

# Ids of a word that the memo makes room for, on average.
ROOM = 16

# Places among the words given, their ids one behind the other, and how many each has.
Learnt = tuple[list[int], np.ndarray, np.ndarray]


class WordMemo:
    """``learn`` gives the ids of new words. Words longer than ``longest`` are not kept."""

    def __init__(self, limit: int, longest: int, learn: Callable[[list[str]], Iterator[Learnt]]) -> None:
        self.limit, self.longest, self.learn = limit, longest, learn
        self._hold([], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4"), np.zeros(0, np.int64))

    def _hold(self, words: list[str], first: np.ndarray, size: np.ndarray, ids: np.ndarray, uses: np.ndarray) -> None:
        self.numbers: defaultdict[str, int] = defaultdict(count(len(words)).__next__, zip(words, range(len(words))))
        self.first, self.size, self.ids, self.uses = first, size, ids, uses

    def _add(self, words: list[str]) -> None:
        first, size, parts, at = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [self.ids], len(self.ids)
        for places, ids, sizes in self.learn(words):
            first[places], size[places] = at + np.cumsum(sizes) - sizes, sizes
            parts.append(ids)
            at += len(ids)
        self.first, self.size = np.concatenate((self.first, first)), np.concatenate((self.size, size))
        self.ids, self.uses = np.concatenate(parts), np.concatenate((self.uses, np.zeros(len(words), np.int64)))

    def _halve(self) -> None:
        words, number = list(self.numbers), np.fromiter(self.numbers.values(), np.int64, len(self.numbers))
        # Of words used equally often the newest stay.
        stay = np.sort(np.argsort(self.uses[number], kind="stable")[-(self.limit // 2):])
        words, number = [words[i] for i in stay.tolist()], number[stay]
        self.numbers.clear()
        size = self.size[number]
        self._hold(words, np.cumsum(size) - size, size, self._of(number)[0], self.uses[number] >> 1)

    def _of(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[number]
        ends = np.concatenate(([0], np.cumsum(size)))
        return self.ids[np.arange(ends[-1]) + np.repeat(self.first[number] - ends[:-1], size)], ends

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one behind the other, and where each word's begin, with the end of the last."""
        if len(self.numbers) > self.limit or len(self.ids) > ROOM * self.limit:
            self._halve()
        known = len(self.numbers)
        number = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        new = list(islice(reversed(self.numbers), len(self.numbers) - known))[::-1]
        if new:
            self._add(new)
        self.uses += np.bincount(number, minlength=len(self.uses))
        for word in new:
            if len(word) > self.longest:
                del self.numbers[word]
        return self._of(number)
