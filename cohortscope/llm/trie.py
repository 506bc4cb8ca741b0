"""Double-array tries over sequences of numbers, walked from many places of a text at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# A number is read as three digits of 11 bits, so a node has at most so many children.
BITS = 11
DIGIT = 1 << BITS
SHIFTS = (2 * BITS, BITS, 0)


def digits(numbers: np.ndarray) -> np.ndarray:
    """The digits of each number, highest first, along a new last axis."""
    return np.stack([(numbers >> shift) & (DIGIT - 1) for shift in SHIFTS], axis=-1)


@dataclass
class Trie:
    """Child t = base[s] + digit of node s is there when check[t] = s; number[t] is that of the sequence it ends."""

    base: np.ndarray
    check: np.ndarray
    number: np.ndarray

    def step(self, states: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which states have a child for their digit, and those children."""
        child = self.base[states] + digit
        going = np.flatnonzero(self.check[child] == states)
        return going, child[going]

    def walk(self, sequence: np.ndarray, longest: int):
        """From every place at once: for each length up to ``longest``, (places, states) that got so far.

        0 in the sequence ends every walk; its last entry must be 0.
        """
        places = np.flatnonzero(sequence)
        states = np.zeros(len(places), np.int32)
        for length in range(longest):
            follow = sequence[places + length]
            on = np.flatnonzero(follow)
            places, states, follow = places[on], states[on], follow[on]
            for shift in SHIFTS:
                going, states = self.step(states, (follow >> shift) & (DIGIT - 1))
                places, follow = places[going], follow[going]
            yield length + 1, places, states


class _Slots:
    """Free slots of a growing double array."""

    def __init__(self, size: int):
        self.used = np.zeros(size, bool)
        # Below DIGIT stand no children but the root's, so that no base is negative.
        self.start = DIGIT
        self.top = DIGIT

    def grow(self, size: int) -> None:
        if size > len(self.used):
            self.used = np.append(self.used, np.zeros(max(size - len(self.used), len(self.used)), bool))

    def take(self, slots: np.ndarray) -> None:
        self.used[slots] = True
        self.top = max(self.top, int(slots.max(initial=0)) + 1)

    def single(self, count: int) -> np.ndarray:
        """So many free slots, lowest first."""
        self.grow(self.top + count)
        found = np.flatnonzero(~self.used[self.start : self.top + count])[:count] + self.start
        self.take(found)
        return found

    def place(self, children: np.ndarray) -> int:
        """A base at which all of a node's (sorted) children are free."""
        at = self.start
        for _ in range(4):
            window = np.flatnonzero(~self.used[at : min(at + 4096, self.top)])[:256] + at
            if not len(window):
                break
            self.grow(int(window[-1]) + DIGIT + 1)
            bases = window - children[0]
            free = ~self.used[bases[:, None] + children].any(axis=1)
            if free.any():
                base = int(bases[free.argmax()])
                self.take(base + children)
                return base
            at = int(window[-1]) + 1
        base = self.top - int(children[0])
        self.grow(base + DIGIT + 1)
        self.take(base + children)
        # What lies far below is nearly full.
        self.start = max(self.start, self.top - 16 * DIGIT)
        return base


def build(sequences: np.ndarray) -> Trie:
    """The trie of the rows of a matrix of positive numbers, 0 after the end of shorter ones; rows are sorted and differ.

    The number of row i is i + 1.
    """
    count, width = sequences.shape
    depths = len(SHIFTS) * width
    table = digits(sequences).reshape(count, depths)
    sizes = (sequences > 0).sum(axis=1) * len(SHIFTS)
    slots = _Slots(DIGIT * 4)
    slots.used[0] = True
    node = np.zeros(count, np.int64)
    alive = np.arange(count)
    base_at, base_of, check_at, check_of, number_at, number_of = ([] for _ in range(6))
    for depth in range(depths):
        alive = alive[sizes[alive] > depth]
        if not len(alive):
            break
        parent, digit = node[alive], table[alive, depth]
        fresh = np.append(True, (parent[1:] != parent[:-1]) | (digit[1:] != digit[:-1]))
        firsts = np.flatnonzero(fresh)
        of, children = parent[firsts], digit[firsts]
        begin = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        many = np.diff(np.append(begin, len(of)))
        bases = np.zeros(len(begin), np.int64)
        for i in np.argsort(-many, kind="stable"):
            if many[i] == 1:
                break
            bases[i] = slots.place(children[begin[i] : begin[i] + many[i]])
        alone = np.flatnonzero(many == 1)
        bases[alone] = slots.single(len(alone)) - children[begin[alone]]
        child = np.repeat(bases, many) + children
        base_at.append(of[begin])
        base_of.append(bases)
        check_at.append(child)
        check_of.append(of)
        node[alive] = child[np.cumsum(fresh) - 1]
        ended = alive[sizes[alive] == depth + 1]
        number_at.append(node[ended])
        number_of.append(ended + 1)
    # No base reaches further than one digit beyond the last slot.
    length = slots.top + DIGIT
    base, check, number = (np.full(length, fill, np.int32) for fill in (0, -1, 0))
    for out, at, of in ((base, base_at, base_of), (check, check_at, check_of), (number, number_at, number_of)):
        if at:
            out[np.concatenate(at)] = np.concatenate(of)
    return Trie(base, check, number)
