"""Plain versions of the operators, for small tables."""

import re
from collections import Counter

import numpy as np


def words_left(rows, length):
    lists = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    seen = Counter(tuple(w[k:k + length]) for w in lists for k in range(len(w) - length + 1))
    out = []
    for (doc, *_), w in zip(rows, lists):
        gone = set()
        for k in range(len(w) - length + 1):
            if seen[tuple(w[k:k + length])] > 1:
                gone.update(range(k, k + length))
        out.append((doc, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return Counter(out)


def bytes_left(rows, length):
    rows = sorted(((doc is not None, doc or 0, (t or "").encode()) for doc, t, *_ in rows))
    first, out = {}, []
    for known, doc, raw in rows:
        for k in range(len(raw) - length + 1):
            first.setdefault(raw[k:k + length], (known, doc, k))
    for known, doc, raw in rows:
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            if first[raw[k:k + length]] < (known, doc, k):
                gone[k:k + length] = True
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(gone) else 0
        out.append((doc if known else None, len(raw), int(gone.sum()), spans,
                    bytes(np.frombuffer(raw, np.uint8)[~gone])))
    return Counter(out)


def shingles(t):
    words = "".join(c.lower() if c.isascii() and c.isalnum() else c if ord(c) > 127 else " "
                    for c in t or "").split()
    seen, out = {}, []
    for k in range(max(min(1, len(words)), len(words) - 4)):
        s = tuple(words[k:k + 5])
        seen[s] = seen.get(s, 0) + 1
        out.append((s, seen[s]))
    return out


def matched(a, b):
    """Longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for k, y in enumerate(b):
            row[k + 1] = before[k] + 1 if x == y else max(row[k], before[k + 1])
    return row[-1]


def classes(rows, least=0.8):
    """Least id of the class of each row; pairs that share too few shingles are not aligned."""
    lists = [shingles(t) for _, t, *_ in rows]
    sets = [set(x) for x in lists]
    up = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = lists[i], lists[j]
            same = rows[i][1] and rows[i][1] == rows[j][1]
            if not same and a and b and min(len(a), len(b)) >= least * max(len(a), len(b)):
                both = len(sets[i] & sets[j])
                if both >= least * (len(a) + len(b) - both) - 1e-9:
                    m = matched(a, b)
                    same = m >= least * (len(a) + len(b) - m) - 1e-9
            if same:
                one, two = up[i], up[j]
                up = [two if u == one else u for u in up]
    return {rows[i][0]: min(rows[j][0] for j in range(len(rows)) if up[j] == up[i])
            for i in range(len(rows))}
