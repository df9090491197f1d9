"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def near_duplicates(rows, words, num, den):
    """{id: (set size, component)} of (id, text) rows with distinct ids."""
    sets = {}
    for d, t in rows:
        w = WORD.findall(low(t))
        sets[d] = frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    seen = collections.defaultdict(list)
    for d in sorted(sets):
        shared = collections.Counter(o for s in sets[d] for o in seen[s])
        for s in sets[d]:
            seen[s].append(d)
        for o, k in shared.items():
            if den * k >= num * (len(sets[d]) + len(sets[o]) - k):
                a, b = sorted((find(d), find(o)))
                root[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


def without_repeats(rows, length, whole_chars=False):
    """{id: (bytes, removed, spans, kept)} of (id, text) rows with distinct ids; ``whole_chars``: characters go as a whole."""
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(w)
        if whole_chars:
            at = 0
            for c in t or "":
                n = len(c.encode())
                if any(gone[at : at + n]):
                    gone[at : at + n] = b"\x01" * n
                at += n
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out


def base_scores(rows, train):
    """{id: (tokens, known, N, score)}; train: ids to learn from."""
    tokens = {d: [*WORD.findall(low(t)), None] for d, t in rows}
    count = collections.Counter(w for d in train for w in tokens[d])
    n, v = sum(count.values()), len(count)
    return {d: (len(ts), sum(count[w] > 0 for w in ts), n, sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ts)) for d, ts in tokens.items()}
