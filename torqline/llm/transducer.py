"""A minimal acyclic transducer from sorted terms to their numbers."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class _State:
    __slots__ = ("final", "labels", "targets")

    def __init__(self):
        self.final, self.labels, self.targets = False, [], []


class Transducer:
    """Looks up terms and spells numbers; ``arrays`` holds all of it.

    An arc is a state and a byte, ``key = state * 256 + byte``, sorted; it leads to a state and adds the terms that come
    before those behind it. The number of a term is the sum over its arcs.
    """

    def __init__(self, keys: np.ndarray, targets: np.ndarray, adds: np.ndarray, final: np.ndarray, longest: int):
        self.keys, self.targets, self.adds, self.final, self.longest = keys, targets, adds, final, longest

    @staticmethod
    def build(terms: Iterable[bytes]) -> Transducer:
        """From distinct terms in byte order. States with the same future become one as soon as no later term can
        change them, so no more than the path of the last term is ever unshared."""
        known: dict[tuple, int] = {}
        terms_of: list[int] = []  # terms behind each state

        def settled(state: _State) -> int:
            key = (state.final, tuple(state.labels), tuple(state.targets))
            number = known.setdefault(key, len(known))
            if number == len(terms_of):
                terms_of.append(state.final + sum(terms_of[t] for t in state.targets))
            return number

        path = [_State()]
        previous, longest = b"", 0
        for term in terms:
            same = next((i for i, (a, b) in enumerate(zip(previous, term)) if a != b), min(len(previous), len(term)))
            while len(path) > same + 1:
                state = path.pop()
                path[-1].targets.append(settled(state))
            for byte in term[same:]:
                path[-1].labels.append(byte)
                path.append(_State())
            path[-1].final = True
            previous, longest = term, max(longest, len(term))
        while len(path) > 1:
            state = path.pop()
            path[-1].targets.append(settled(state))
        settled(path[0])  # the root has the last number
        keys, targets, adds, final = [], [], [], []
        for is_final, labels, nexts in known:
            state, before = len(final), int(is_final)
            for label, target in zip(labels, nexts):
                keys.append(state * 256 + label)
                targets.append(target)
                adds.append(before)
                before += terms_of[target]
            final.append(is_final)
        return Transducer(np.array(keys, np.int64), np.array(targets, np.int64), np.array(adds, np.int64), np.array(final), longest)

    def ordinals(self, terms: list[bytes]) -> np.ndarray:
        """The number of each term, -1 for terms that are not in it."""
        out = np.full(len(terms), -1, np.int64)
        left = np.array([i for i, t in enumerate(terms) if len(t) <= self.longest], np.int64)
        if not len(left) or not len(self.final):
            return out
        data = np.frombuffer(b"".join(terms[i] for i in left.tolist()), np.uint8).astype(np.int64)
        size = np.array([len(terms[i]) for i in left.tolist()], np.int64)
        start = np.cumsum(size) - size
        state, number = np.full(len(left), len(self.final) - 1, np.int64), np.zeros(len(left), np.int64)
        step = 0
        while len(left):
            over = size == step
            done = over & self.final[state]
            out[left[done]] = number[done]
            go = np.flatnonzero(~over)
            if not len(self.keys):
                break
            key = state[go] * 256 + data[start[go] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[arc] == key
            go, arc = go[found], arc[found]
            left, size, start = left[go], size[go], start[go]
            state, number = self.targets[arc], number[go] + self.adds[arc]
            step += 1
        return out

    def term(self, ordinal: int) -> bytes:
        """The term with this number."""
        state, out = len(self.final) - 1, bytearray()
        while ordinal or not self.final[state]:
            low, high = np.searchsorted(self.keys, [state * 256, state * 256 + 256])
            arc = low + int(np.searchsorted(self.adds[low:high], ordinal, side="right")) - 1
            out.append(int(self.keys[arc]) & 255)
            ordinal -= int(self.adds[arc])
            state = int(self.targets[arc])
        return bytes(out)
