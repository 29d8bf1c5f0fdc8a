"""Plain versions of the operators, for small inputs."""

import hashlib
import itertools
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text, words=4):
    split = WORD.findall(lower(text))
    shingles = [" ".join(split[i:i + words]) for i in range(max(1, len(split) - words + 1))] if split else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def components(nodes, linked):
    """The smallest member of each node's component."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def order(rows):
    return sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))


def covered(sequences, width):
    """Which members of each sequence lie in a stretch that also starts earlier."""
    seen, out = set(), []
    for seq in sequences:
        drop = [False] * len(seq)
        for i in range(len(seq) - width + 1):
            stretch = tuple(seq[i:i + width])
            if stretch in seen:
                drop[i:i + width] = [True] * width
            seen.add(stretch)
        out.append(drop)
    return out


def windows(rows, width=20):
    rows = [rows[i] for i in order(rows)]
    words = [WORD.findall(t or "") for _, t in rows]
    return [(key, len(w), sum(d), sha(" ".join(x for x, y in zip(w, d) if not y)))
            for (key, _), w, d in zip(rows, words, covered(words, width))]


def strings(rows, length=100):
    rows = [rows[i] for i in order(rows)]
    data = [(t or "").encode() for _, t in rows]
    return [(key, len(b), sum(d), sum(y and not (i and d[i - 1]) for i, y in enumerate(d)),
             hashlib.sha256(bytes(x for x, y in zip(b, d) if not y)).hexdigest())
            for (key, _), b, d in zip(rows, data, covered(data, length))]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
