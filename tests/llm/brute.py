"""The contracts, computed the plain way on lists of (id, text)."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def removal(rows, length=400):
    raw = [(i, (t or "").encode()) for i, t in rows]
    starts = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if starts[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}


def near(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x in range(len(sets)):
        for y in range(x):
            (i, a), (j, b) = sets[x], sets[y]
            both = len(a & b)
            if a and b and 100 * both >= 75 * (len(a) + len(b) - both):
                i, j = sorted((root(i), root(j)))
                parent[j] = i
    return [(i, len(s), root(i), root(i) == i) for i, s in sets]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(rows, items, window=13):
    cut = lambda t: WORD.findall((t or "").translate(UPPER))
    windows = {}
    for name, text in items:
        own = cut(text)
        size = min(window, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[k : k + size]), set()).add(name)
    out = []
    for i, t in rows:
        own, hit, names = cut(t), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(own) - size + 1):
                found = windows.get(tuple(own[k : k + size]))
                if found:
                    hit.update(range(k, k + size))
                    names |= found
        named = sorted(map(str, names))
        digest = hashlib.sha256(",".join(named).encode()).hexdigest()
        out.append((i, len(own), len(hit), len(named), digest, len(hit) > 0 and 20 * len(hit) >= len(own)))
    return out


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
