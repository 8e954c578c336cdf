"""Plain versions of the operators' results, one text at a time."""

from __future__ import annotations

import collections
import hashlib
import re

import numpy as np

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode())


def folded(text):
    return ALNUM.findall((text or "").encode().translate(LOWER))


def repeats(docs, window=50):
    """docs: (id, text). Per line the words that repeat an earlier document."""
    first: dict = {}
    for i, text in docs:
        if i is not None:
            own = words(text)
            for p in range(len(own) - window + 1):
                key = tuple(own[p:p + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in docs:
        own = words(text)
        gone = [False] * len(own)
        for p in range(len(own) - window + 1):
            if i is not None and first[tuple(own[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        out.append(gone)
    return out


def hits(docs, items, window=10):
    """docs: (id, text), items: (id, text). Per line (words, hit words, item ids)."""
    phrases = collections.defaultdict(set)
    for name, text in items:
        own = folded(text)
        size = min(window, len(own))
        for p in range(len(own) - size + 1 if size else 0):
            phrases[tuple(own[p:p + size])].add(name)
    sizes = {len(p) for p in phrases}
    out = []
    for _, text in docs:
        own, found = folded(text), set()
        gone = [False] * len(own)
        for p in range(len(own)):
            for size in sizes:
                names = phrases.get(tuple(own[p:p + size])) if p + size <= len(own) else None
                if names:
                    found |= names
                    gone[p:p + size] = [True] * size
        out.append((len(own), sum(gone), sorted(str(n) for n in found if n is not None)))
    return out


def shingles(text, size=5):
    own = words(text)
    if len(own) < size:
        return {tuple(own)} if own else set()
    return {tuple(own[p:p + size]) for p in range(len(own) - size + 1)}


def classes(docs):
    """docs: (id, text) with distinct ids. id -> (class, first copy, copies, links)."""
    first, copies = {}, collections.Counter()
    for i, text in sorted(docs):
        key = text if text is not None else ("null", i)
        copies[first.setdefault(key, i)] += 1
    heads = {h: shingles(t) for (t, h) in first.items() if not isinstance(t, tuple)}
    heads |= {h: set() for (t, h) in first.items() if isinstance(t, tuple)}
    root, links = {h: h for h in heads}, collections.Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = sorted(heads)
    for k, b in enumerate(names):
        for a in names[:k]:
            both = len(heads[a] & heads[b])
            if both and both * 5 >= 4 * (len(heads[a]) + len(heads[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    out = {}
    for i, text in docs:
        head = first[text if text is not None else ("null", i)]
        out[i] = (find(head), head, copies[head], links[head])
    return out


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    own = [w.decode() for w in words(text)]
    windows = [tuple(own[p:p + 3]) for p in range(len(own) - 2)]
    often = collections.Counter(windows)
    covered = {p + k for p, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def sha(parts, by=b" "):
    return hashlib.sha256(by.join(parts)).hexdigest()


def _law(mean, cov, error, floors):
    """Centre, inverse Cholesky factor, mean error, log determinant of one group."""
    low = np.linalg.cholesky(cov + np.diag(np.square(floors)) + np.diag([0, 0, 0, 0, error]))
    return mean, np.linalg.inv(low), error, 2 * np.log(np.diag(low)).sum()


def _squared(x, errors, law):
    mean, inverse, error, _ = law
    z = ((x - mean) @ inverse.T) ** 2
    more = np.maximum(errors - error, 0) * inverse[4, 4] ** 2
    return z[:, :4].sum(1) + z[:, 4] / (1 + more)


def robust_law(x, floors, spread, near, near_spread, fall):
    """Minimum covariance determinant of the different rows of one group: a half of them, from
    four starts, then all rows near to the best half."""
    x = np.unique(x, axis=0)
    errors = 0.75 * np.exp(-x[:, 0])

    def rank(values, share):
        return np.sort(values, axis=0)[max(int(np.ceil(share * len(values))) - 1, 0)]

    def moments(rows, wider):
        return _law(x[rows].mean(0), wider * np.cov(x[rows].T, bias=True), errors[rows].mean(), floors)

    q = np.array([rank(x, k / 20) for k in range(21)])
    halves = [min((q[k + 10, i] - q[k, i], (q[k + 10, i] + q[k, i]) / 2) for k in range(11)) for i in range(5)]
    cov = np.diag([(length / 1.349) ** 2 for length, _ in halves])
    best = None
    for centre in (q[10], np.array([m for _, m in halves]), q[5], q[15]):
        law, size = _law(centre, cov, errors.mean(), floors), np.inf
        while True:
            d = _squared(x, errors, law)
            law = moments(d <= rank(d, 0.5), spread)
            if law[3] > size - fall:
                break
            size = law[3]
        if best is None or law[3] < best[3]:
            best = law
    return moments(_squared(x, errors, best) <= near, near_spread)


def distances(rows, least, **limits):
    """Squared distance of each (lang, source, features) from the law of its group: those of its
    language and source, if these have ``least`` different rows, or of its language, or all."""
    groups = [(lang, source) for lang, source, _ in rows]
    x = np.array([f for _, _, f in rows])
    for wider in (lambda g: (g[0],), lambda g: ()):
        counts = {g: len(np.unique(x[[h == g for h in groups]], axis=0)) for g in set(groups)}
        level = 2 if wider(("", "")) else 1
        groups = [wider(g) if len(g) == level and counts[g] < least else g for g in groups]
    out = np.zeros(len(rows))
    for g in set(groups):
        own = np.array([h == g for h in groups])
        out[own] = _squared(x[own], 0.75 * np.exp(-x[own, 0]), robust_law(x[own], **limits))
    return out
