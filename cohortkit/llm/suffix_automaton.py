"""Generalised suffix automaton of several sequences of numbers.

A state stands for the substrings that end at the same places; it holds the
longest of them and all its suffixes down to one longer than what the state
behind its suffix link holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    def __init__(self, sequences: Iterable[Sequence[int]] = ()):
        self.step: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for sequence in sequences:
            self.add(sequence)

    def add(self, sequence: Sequence[int]) -> None:
        last = 0
        for symbol in sequence:
            last = self._append(last, symbol)

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _exact(self, before: int, symbol: int) -> int:
        """The state whose longest string is ``before``'s longest and ``symbol``; parted off if need be."""
        target = self.step[before][symbol]
        if self.length[target] == self.length[before] + 1:
            return target
        parted = self._state(self.length[before] + 1, self.link[target], dict(self.step[target]))
        self.link[target] = parted
        while before >= 0 and self.step[before].get(symbol) == target:
            self.step[before][symbol] = parted
            before = self.link[before]
        return parted

    def _append(self, last: int, symbol: int) -> int:
        if symbol in self.step[last]:
            return self._exact(last, symbol)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and symbol not in self.step[last]:
            self.step[last][symbol] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._exact(last, symbol)
        return new

    def advance(self, state: int, matched: int, symbol: int) -> tuple[int, int]:
        """State and length of the longest match that ends with ``symbol``."""
        while symbol not in self.step[state]:
            state = self.link[state]
            if state < 0:
                return 0, 0
            matched = self.length[state]
        return self.step[state][symbol], matched + 1

    def holder(self, state: int, n: int) -> int:
        """The state that holds the last ``n`` symbols of the strings of ``state``."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state
