"""Plain Python versions of the training-data operators, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def last(doc_id):
    return (doc_id is None, doc_id)


def signals(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    n = len(w)
    return dict(n_words=n, word_chars=sum(map(len, w)), n_symbols=sum((text or "").count(c) for c in "#*$%&|<>"),
                n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(hit),
                base_failed=n < 10 or 100 * len(hit) > 20 * n)


def shingles(text, n):
    w = words((text or "").translate(LOWER))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def components(rows, n, percent=80):
    """{doc_id: smallest linked doc_id} by comparing all pairs."""
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    return {i: find(i) for i in up}


def contained(text, items, percent=80):
    """Ascending item ids of which the text holds ``percent`` of the shingles."""
    out = []
    for item, t in items:
        need = shingles(t, 5)
        if need:
            n = len(next(iter(need)))
            own = shingles(text, n) if len(words(text)) >= n else set()
            if 100 * len(need & own) >= percent * len(need):
                out.append(item)
    return sorted(set(out))


def cut_lines(rows, least):
    """{(doc_id, text): (lines, removed, kept text)}; later copies of windows of ``least`` lines go."""
    seen, out = {}, {}
    for i, t in rows:
        lines = (t or "").split("\n")
        solid = [k for k, x in enumerate(lines) if WORD.search(x)]
        gone = set()
        for k in range(len(solid) - least + 1):
            at = tuple(lines[p] for p in solid[k:k + least])
            if seen.setdefault(at, (i, t, k)) != (i, t, k):
                gone.update(solid[k:k + least])
        out[i, t] = (len(solid), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def cut_windows(rows, width):
    """{(doc_id, text): (words, removed, kept text)}; windows that start in a smaller doc_id go."""
    first = {}
    for i, t in sorted(rows, key=lambda r: last(r[0])):
        w = words(t)
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k:k + width]), i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - width + 1):
            if last(first[tuple(w[k:k + width])]) < last(i):
                gone.update(range(k, k + width))
        out[i, t] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


SECRETS = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                          r"""([A-Za-z0-9+/_.=-]+)""", re.A), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
]


def secret_spans(text):
    spans = [(m.start(), k, m.end()) for k, (_, rx, group, least) in enumerate(SECRETS)
             for m in rx.finditer(text or "") if len(m.group(group)) >= least]
    return ",".join(f"{SECRETS[k][0]}:{a}:{b}" for a, k, b in sorted(spans))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
