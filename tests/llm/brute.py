"""Plain versions of the operators, for small inputs."""

import hashlib
import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def components(texts, n, top, bottom):
    """texts: {id: text}; {id: (set size, smallest id reachable)}."""
    sets = {i: shingles(t, n) for i, t in texts.items()}
    label = {i: i for i in texts}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and bottom * len(sets[a] & sets[b]) >= top * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def repeats(rows):
    """rows: (id, text); for each (bytes, removed, spans, digest of what is kept)."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    for _, x in raw:
        for k in range(len(x) - 199):
            seen[x[k : k + 200]] = seen.get(x[k : k + 200], 0) + 1
    out = []
    for i, x in raw:
        gone = bytearray(len(x))
        for k in range(len(x) - 199):
            if seen[x[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(x, gone) if not g)
        spans = sum(1 for k in range(len(x)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def words(text):
    return len(SPACE.findall(text or ""))
