"""Edit distance of two texts."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np


def distance(a: str, b: str, most: int | None = None) -> int:
    """Edit distance, a column of the table at a time as the bits of one number.

    With ``most``, some number above it as soon as the distance is known to be above it.
    """
    if a == b:
        return 0
    if not a or not b:
        return max(len(a), len(b))
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    top = 1 << (len(a) - 1)
    more, less, distance = full, 0, len(a)
    limit = len(a) + len(b) if most is None else most
    for left, c in zip(range(len(b) - 1, -1, -1), b):
        eq = places.get(c, 0)
        xv = eq | less
        xh = (((eq & more) + more) ^ more) | eq
        ph = less | (~(xh | more) & full)
        mh = more & xh
        if ph & top:
            distance += 1
            # Each further column can take one off at most.
            if distance - left > limit:
                return distance - left
        elif mh & top:
            distance -= 1
        ph = (ph << 1 | 1) & full
        mh = mh << 1 & full
        more = mh | (~(xv | ph) & full)
        less = ph & xv
    return distance


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    unlike = a[:n] != b[:n]
    at = int(unlike.argmax()) if n else 0
    return at if n and unlike[at] else n


def by_words(a: list[str], b: list[str]) -> int:
    """A number of edits that is enough: a longest run of common words stays, what lies between them is replaced."""
    places: dict[str, list[int]] = {}
    for j, word in enumerate(b):
        places.setdefault(word, []).append(j)
    # Of the runs of each length, the one that ends first in ``b``; each end names the run before it.
    ends: list[int] = []
    last: list[tuple] = []
    for i, word in enumerate(a):
        for j in reversed(places.get(word, ())):
            k = bisect_left(ends, j)
            end = (i, j, last[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                last.append(end)
            else:
                ends[k], last[k] = j, end
    edits, right, below = 0, len(a), len(b)
    step = last[-1] if last else (-1, -1, None)
    while True:
        i, j, before = step
        # Words between two common ones, each with the space behind it.
        gaps = (sum(map(len, x[k + 1 : end])) + end - k - 1 for x, k, end in ((a, i, right), (b, j, below)))
        edits += max(gaps)
        if i < 0:
            return edits
        right, below, step = i, j, before or (-1, -1, None)


def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance is at most ``most``; bounds settle most pairs before it is computed."""
    if abs(len(a) - len(b)) > most:
        return False
    x, y = (np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (a, b))
    head = _common(x, y)
    tail = _common(x[head:][::-1], y[head:][::-1])
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    # Replacing all that is left, or word by word, is one way to edit.
    if max(len(a), len(b)) <= most:
        return True
    words, others = a.split(" "), b.split(" ")
    if len(words) == len(others):
        if sum(max(len(w), len(o)) for w, o in zip(words, others) if w != o) <= most:
            return True
    if by_words(words, others) <= most:
        return True
    return distance(a, b, most) <= most
