"""A table of awkward documents, the same without rows, and slow versions of what the operators do."""

import collections
import random
import re
import unicodedata

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; a table may have them as well.
EXTRA = ", doc long, row long, fp long, key string, words string, size long, start long, n_lines long, it string, hits string"
CORE = ["doc_id", "text", "lang", "source", "n_chars"]


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def rows():
    rng = random.Random(5)
    base = [sentence(rng, 40) for _ in range(6)]
    long = "\n".join(sentence(rng, 60) for _ in range(400))
    texts = [
        (1, base[0] + "\n" + base[1]),
        (2, base[0] + "\n" + base[1]),
        (3, base[0].replace("a", "A") + "!\n" + base[2]),
        (4, None),
        (5, ""),
        (6, " \t\n\r\x0b\x0c "),
        (7, long),
        (8, base[3] + " " + base[4] + "\n\n" + base[3]),
        (9, "word"),
        (9, "word"),
        (10, "word word word word word word word word " * 12),
        (None, base[5]),
        (None, base[5]),
        (11, "日本語の文章 Γειά σου κόσμε привет мир 12345 !!!   é" + base[2]),
        (12, "x" * 30_000),
        (13, base[5] + " " + base[0]),
        (14, None),
        (15, "1234 5678 ..."),
    ]
    out = []
    for i, (doc, text) in enumerate(texts):
        source = [None, "a", "b", ""][i % 4]
        out.append((doc, text, ["en", None, "de"][i % 3], source, len(text or "")))
    return out


def table(spark, data=None, extra=True):
    data = rows() if data is None else data
    schema = COLUMNS + (EXTRA if extra else "")
    more = (7, 8, 9, "k", "w", 1, 2, 3, "i", "h") if extra else ()
    return spark.createDataFrame([(*r, *more) for r in data], schema).repartition(3)


def empty(spark):
    return table(spark, [])


def plain_line(line):
    kept = "".join(c if not c.isascii() or c.isalnum() else " " for c in line.lower())
    return " ".join(w for w in kept.split(" ") if w)


def edits(a, b):
    previous = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        current = [i]
        for j, y in enumerate(b, 1):
            current.append(min(previous[j] + 1, current[-1] + 1, previous[j - 1] + (x != y)))
        previous = current
    return previous[-1]


def groups(count, pairs):
    """Smallest member of each member's group."""
    parent = list(range(count))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(count)]


def near_pairs(fps, radius):
    fps = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= radius):
            yield i, i + 1 + int(j)


def removed_words(docs, width):
    """docs: (order key, words); of each, a mask of the words in a window that starts earlier."""
    ordered = sorted(docs, key=lambda d: d[0])
    seen = {}
    for n, (_, words) in enumerate(ordered):
        for k in range(len(words) - width + 1):
            seen.setdefault(tuple(words[k : k + width]), (ordered[n][0], k))
    out = {}
    for key, words in ordered:
        mask = [False] * len(words)
        for k in range(len(words) - width + 1):
            if seen[tuple(words[k : k + width])] < (key, k):
                mask[k : k + width] = [True] * width
        out[key] = mask
    return out


def tokens(text):
    """Lower-case runs of letters and digits (by Unicode category)."""
    parts = "".join(c if unicodedata.category(c)[0] in "L" or unicodedata.category(c) in ("Nd", "Nl", "No") else " " for c in (text or "").lower())
    return parts.split()


def leaks(docs, items, masks, window, agreement):
    span = len(masks[0])
    out = set()
    for doc, text in docs:
        words = tokens(text)
        for item, passage in items:
            other = tokens(passage)
            shifts = set()
            for mask in masks:
                picks = [i for i, bit in enumerate(mask) if bit == "1"]
                places = collections.defaultdict(list)
                for k in range(len(other) - span + 1):
                    places[tuple(other[k + i] for i in picks)].append(k)
                for k in range(len(words) - span + 1):
                    shifts.update(k - p for p in places.get(tuple(words[k + i] for i in picks), ()))
            wide = min(window, len(other))
            for shift in shifts:
                span_of = range(max(0, -shift), min(len(other), len(words) - shift))
                same = [other[k] == words[k + shift] for k in span_of]
                if any(sum(same[k : k + wide]) >= agreement * wide for k in range(len(same) - wide + 1)):
                    out.add((doc, item))
    return out
