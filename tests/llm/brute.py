"""Brute-force versions the tests compare with."""

from __future__ import annotations

import re

SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def word_set(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute_components(rows, link=(85, 100)):
    sets = [(i, word_set(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and link[1] * len(a & b) >= link[0] * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups.setdefault(norm, []).append((-len(t or ""), i is not None, -1 if i is None else i, i))
    return {norm: (min(of)[3], len(of)) for norm, of in groups.items()}


def plain(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text)) if w]


def brute_hits(rows, items, window=10):
    phrases = {}
    for item, text in items:
        words = plain(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            phrases.setdefault(tuple(words[i : i + window]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in rows:
        words, hit, of = plain(text), set(), set()
        for width in {len(p) for p in phrases}:
            for i in range(len(words) - width + 1):
                if found := phrases.get(tuple(words[i : i + width])):
                    hit |= set(range(i, i + width))
                    of |= found
        out.append((doc, len(words), len(hit), sorted(of)))
    return out
