"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows, k, percent):
    """Component of each row's id under exact Jaccard similarity."""
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            both = len(a & b)
            if a and b and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def removed(rows, length=100):
    """Flags of removed bytes for each (id, text), in id order; equal ids are one document."""
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        for s in range(len(raw) - length + 1):
            key = raw[s : s + length]
            first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        flags = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if first[raw[s : s + length]] < (i, s):
                flags[s : s + length] = b"\1" * length
        out.append((i, raw, flags))
    return out


def hits(text, items, window=13):
    """(words, hit words, item ids) of a text against [(item, text)]."""
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    doc = split.findall((text or "").translate(LOWER))
    covered, found = set(), set()
    for item, body in items:
        w = split.findall((body or "").translate(LOWER))
        n = min(window, len(w))
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(doc) - n + 1 if n else 0):
            if tuple(doc[i : i + n]) in grams:
                covered.update(range(i, i + n))
                found.add(str(item))
    return len(doc), len(covered), sorted(found)


def counts(text):
    w = WORD.findall(text or "")
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    cover = {i + d for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for d in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(cover)
