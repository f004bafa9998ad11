"""The operators' results by plain loops, for small tables."""

import hashlib
import re
import string
from collections import Counter, defaultdict

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def passages(texts, window):
    """Per text (words, removed, kept text)."""
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def hits(text, items, n):
    """(words, hit words, items) of one text; items: list of (id, text)."""
    w, covered, found = item_words(text), set(), set()
    for name, t in items:
        v = item_words(t)
        size = min(n, len(v))
        grams = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if size else set()
        for i in range(len(w) - size + 1) if size else []:
            if tuple(w[i : i + size]) in grams:
                covered |= set(range(i, i + size))
                found.add(str(name))
    return len(w), len(covered), sorted(found)


def apart(a, b):
    """At most one word put in, taken out or replaced."""
    if a == b:
        return True
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def clean_lines(docs, min_words):
    """docs: list of (id, text), ids distinct. Per id (lines, dropped, clean text)."""
    earlier, out = [], {}
    for name, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        if text is None:
            out[name] = (0, 0, None)
            continue
        kept, lines = [], text.split("\n")
        for line in lines:
            w = words(line)
            if not w:
                kept.append(line)
                continue
            if not any(w == v or (min(len(w), len(v)) >= min_words and apart(w, v)) for v in earlier):
                kept.append(line)
            earlier.append(w)
        out[name] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def shingles(text, size=5):
    w = words((text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}


def groups(docs, percent=85):
    """docs: list of (id, text). Per id (shingles, component)."""
    sets = [(name, shingles(text)) for name, text in docs]
    root = {name: name for name, _ in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((top(a), top(b)))
                root[q] = p
    return {name: (len(x), top(name)) for name, x in sets}


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """sizes: source -> size; cut and share out again until nothing is above its bound."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = dict.fromkeys(order, 0.0), set(order), share * sum(sizes.values())
    while free and left > 1e-9:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        over = {s for s in free if target[s] > most * sizes[s]}
        left = sum(target[s] - most * sizes[s] for s in over)
        for s in over:
            target[s] = most * sizes[s]
        free -= over
    return target


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by(rows, *names):
    out = defaultdict(list)
    for r in rows:
        out[r[names[0]]].append(tuple(r[n] for n in names[1:]))
    return out
