"""Plain Python versions that the tests compare with."""

from __future__ import annotations

import hashlib
import re
from collections import Counter


def lower_az(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def space_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text: str | None, size: int) -> set:
    w = space_words(lower_az(text))
    if not w:
        return set()
    return {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))}


def near_components(rows: list[tuple], size: int, percent: int = 80) -> dict:
    """doc_id: (set size, component) by comparing all pairs."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def without_repeats(rows: list[tuple], span: int = 200) -> list[tuple]:
    """(id, n_bytes, n_removed, n_spans, sha256 of what is left) per row."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[k:k + span] for _, b in texts for k in range(len(b) - span + 1))
    out = []
    for i, b in texts:
        mark = bytearray(len(b))
        for k in range(len(b) - span + 1):
            if counts[b[k:k + span]] > 1:
                mark[k:k + span] = b"\1" * span
        kept = bytes(c for c, m in zip(b, mark) if not m)
        spans = sum(1 for k in range(len(b)) if mark[k] and (not k or not mark[k - 1]))
        out.append((i, len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return out


def generalised_jaccard(a: str | None, b: str | None) -> float:
    x, y = (Counter(space_words(t) or [""]) for t in (a, b))
    terms = set(x) | set(y)
    return sum(min(x[t], y[t]) for t in terms) / sum(max(x[t], y[t]) for t in terms)


def hit_words(docs: list[tuple], items: list[tuple], size: int = 13) -> dict:
    """doc_id: (n_words, n_hit, sorted item ids with occurring windows)."""
    split = lambda t: re.findall(r"[0-9a-z\x80-\U0010FFFF]+", lower_az(t))
    windows = []
    for i, t in items:
        w = split(t)
        n = min(size, len(w))
        windows += [(i, tuple(w[k:k + n])) for k in range(len(w) - n + 1)] if n else []
    out = {}
    for d, t in docs:
        w = split(t)
        hit, found = set(), set()
        for i, win in windows:
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k:k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    found.add(str(i))
        out[d] = (len(w), len(hit), sorted(found))
    return out
