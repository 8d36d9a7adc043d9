"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def decontaminate(docs, items, window=10):
    lists = [(i, ALNUM.findall((t or "").translate(LOWER))) for i, t in items]
    windows = defaultdict(set)
    for i, w in lists:
        n = min(window, len(w))
        for p in range(len(w) - n + 1) if n else ():
            windows[tuple(w[p : p + n])].add(i)
    lengths = {len(k) for k in windows}
    out = []
    for d, t in docs:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in lengths:
            for p in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[p : p + n]))) is not None:
                    hit.update(range(p, p + n))
                    found |= {str(i) for i in own if i is not None}
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def shingles(text, k=3):
    w = SPACED.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def near(docs, percent=85):
    sets = [(d, shingles(t)) for d, t in docs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    full = [i for i, (d, s) in enumerate(sets) if d is not None and s]
    for a in full:
        for b in full:
            if a < b and 100 * len(sets[a][1] & sets[b][1]) >= percent * len(sets[a][1] | sets[b][1]):
                root[find(a)] = find(b)
    least = {}
    for i in full:
        least[find(i)] = min(least.get(find(i), sets[i][0]), sets[i][0])
    out = []
    for i, (d, s) in enumerate(sets):
        c = d if d is None or not s else least[find(i)]
        out.append((d, len(s), c, True if d is None else c == d))
    return out


def substrings(docs, window=13):
    words = [(d, SPACED.findall(t or "")) for d, t in docs]
    first = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - window + 1):
                k = tuple(w[i : i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1) if d is not None else ():
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out
