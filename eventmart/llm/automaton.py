"""Suffix automaton of several token sequences."""

from __future__ import annotations

from collections.abc import Hashable, Sequence


class SuffixAutomaton:
    """Accepts exactly the contiguous parts of the sequences added so far.

    State 0 is the root.  A state stands for parts of lengths ``length[link[s]] + 1`` to ``length[s]`` that
    occur at the same places.
    """

    def __init__(self):
        self.edges: list[dict[Hashable, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, edges: dict, link: int) -> int:
        self.edges.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, state: int, token: Hashable, target: int) -> int:
        """Part of ``target``'s class that can follow ``state`` becomes a state of its own."""
        copy = self._state(self.length[state] + 1, dict(self.edges[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.edges[state].get(token) == target:
            self.edges[state][token] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, token: Hashable) -> int:
        known = self.edges[last].get(token)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, token, known)
        new = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and token not in self.edges[state]:
            self.edges[state][token] = new
            state = self.link[state]
        if state >= 0:
            target = self.edges[state][token]
            fits = self.length[target] == self.length[state] + 1
            self.link[new] = target if fits else self._split(state, token, target)
        return new

    def add(self, tokens: Sequence[Hashable]) -> None:
        last = 0
        for token in tokens:
            last = self._extend(last, token)

    def step(self, state: int, matched: int, token: Hashable) -> tuple[int, int]:
        """State and length of the longest suffix of the text read so far that is known, after one more token."""
        edges, link = self.edges, self.link
        while state and token not in edges[state]:
            state = link[state]
            matched = self.length[state]
        target = edges[state].get(token)
        return (0, 0) if target is None else (target, matched + 1)

    def ancestor(self, state: int, length: int) -> int:
        """The state of the suffix of that length of any part of ``state`` that is at least as long."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state
