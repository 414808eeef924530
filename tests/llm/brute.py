"""Plain loops that restate the operators on small tables."""

import hashlib
from collections import Counter


def groups(ids, links):
    least = {i: i for i in ids}

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        least[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def lowered(text):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())


def words(text):
    """Words between the six ASCII spaces."""
    table = bytes.maketrans(b"\t\n\v\f\r", b"     ")
    return [w for w in text.translate(table).split(b" ") if w]


def near(docs, k, percent):
    """(set size, least id reachable) of every document."""
    sets = {}
    for i, text in docs:
        w = words(lowered(text))
        grams = [tuple(w[p : p + k]) for p in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)] if w else []
        sets[i] = set(grams)
    links = []
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    found = groups(sets, links)
    return {i: (len(sets[i]), found[i]) for i in sets}


def repeated_bytes(docs, length):
    """(bytes, removed bytes, removed runs, digest of the rest) of every document."""
    texts = [(i, (text or "").encode()) for i, text in docs]
    seen = Counter(b[p : p + length] for _, b in texts for p in range(len(b) - length + 1))
    out = {}
    for i, b in texts:
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        runs = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        rest = bytes(c for c, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest())
    return out


def repeated_words(docs, length):
    """(words, removed words, digest of the rest) of every document."""
    texts = sorted((i, words((text or "").encode())) for i, text in docs)
    first = {}
    for i, w in texts:
        for p in range(len(w) - length + 1):
            first.setdefault(tuple(w[p : p + length]), i)
    out = {}
    for i, w in texts:
        gone = set()
        for p in range(len(w) - length + 1):
            if first[tuple(w[p : p + length])] < i:
                gone.update(range(p, p + length))
        rest = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(rest).hexdigest())
    return out


def words_elsewhere(docs, length):
    """Number of words of every document in windows that also start elsewhere."""
    texts = [(i, words((text or "").encode())) for i, text in docs]
    seen = Counter(tuple(w[p : p + length]) for _, w in texts for p in range(len(w) - length + 1))
    out = {}
    for i, w in texts:
        found = [p for p in range(len(w) - length + 1) if seen[tuple(w[p : p + length])] > 1]
        out[i] = len({x for p in found for x in range(p, p + length)})
    return out


def trimmed(docs, length):
    """Kept words of every document: none of a window that started before, by id and position."""
    texts = sorted((i, words((text or "").encode())) for i, text in docs)
    first, out = {}, {}
    for i, w in texts:
        gone = set()
        for p in range(len(w) - length + 1):
            if first.setdefault(tuple(w[p : p + length]), (i, p)) != (i, p):
                gone.update(range(p, p + length))
        out[i] = [x for p, x in enumerate(w) if p not in gone]
    return out


def targets(sizes, weights, total, most):
    """Targets of sources in order: the excess above the limit goes to the others by weight, again and again."""
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    aim, left, free = {}, total * sum(sizes.values()), set(sizes)
    while free:
        unit = left / sum(weigh[s] for s in free)
        full = {s for s in free if weigh[s] * unit > most * sizes[s]}
        if not full:
            aim.update({s: weigh[s] * unit for s in free})
            break
        for s in full:
            aim[s] = most * sizes[s]
            left -= aim[s]
        free -= full
    return aim
