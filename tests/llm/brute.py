"""Plain versions of the operators, for comparison."""

from __future__ import annotations

import re
from collections import Counter

WORD_1 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD_5 = re.compile(r"[^\x20\x09-\x0D]+")
ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def leaks(text, items, window=10):
    """Words, hit flags and found items of a text."""
    own = WORD_1.findall(lower(text))
    hit, found = [False] * len(own), set()
    for item, t in items:
        words = WORD_1.findall(lower(t))
        for k in range(max(1, len(words) - window + 1) if words else 0):
            w = words[k : k + window]
            for i in range(len(own) - len(w) + 1):
                if own[i : i + len(w)] == w:
                    found.add(str(item))
                    hit[i : i + len(w)] = [True] * len(w)
    return own, hit, sorted(found)


def shingle_set(text, k):
    words = WORD_5.findall(lower(text))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def groups(rows, k, threshold=80):
    """{id: (size, component, kept)}."""
    sets = {i: shingle_set(t, k) for i, t in rows}
    holders = {}
    for i, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(i)
    common = Counter((a, b) for own in holders.values() for n, b in enumerate(own) for a in own[:n])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= threshold * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def secrets(text):
    """Base spans (start, kind's place, end) in order."""
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])
