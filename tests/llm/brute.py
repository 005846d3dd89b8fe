"""Plain-Python versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOW) if lower else text)


def order_key(doc_id):
    return -(1 << 63) if doc_id is None else doc_id


def dedup(docs, width=20):
    """[(doc_id, text)] -> [(doc_id, words, removed, kept text)]"""
    first = {}
    for i, t in docs:
        w = words(t)
        for p in range(len(w) - width + 1):
            k, at = tuple(w[p:p + width]), (order_key(i), p)
            first[k] = min(first.get(k, at), at)
    out = []
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            if first[tuple(w[p:p + width])] < (order_key(i), p):
                gone[p:p + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), kept))
    return out


def shingles(text, k=3):
    w = words(text, True)
    if len(w) >= k:
        return {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}
    return {tuple(w)} if w else set()


def linked(docs, percent=90):
    """[(doc_id, text)] -> {(doc_id, set size, component)}"""
    sets = {order_key(i): shingles(t) for i, t in docs}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= percent * len(sets[a] | sets[b]):
                    x, y = root(a), root(b)
                    up[max(x, y)] = min(x, y)
    back = lambda i: None if i == order_key(None) else i
    return {(back(i), len(sets[i]), back(root(i))) for i in ids}


def katz(docs, discounts, keep=0.999):
    """[(doc_id, text)] -> {position: (held out, tokens, known, N, base, score)}"""
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    seqs = [words(t, True) + ["</s> "] for _, t in docs]
    c1, c2, ch = Counter(), Counter(), Counter()
    for h, s in zip(held, seqs):
        if not h:
            c1.update(s)
            for a, b in zip(["<s> ", *s], s):
                c2[a, b] += 1
                ch[a] += 1
    n, v = sum(c1.values()), len(c1)
    of = lambda c: [sum(x == r for x in c.values()) for r in range(1, 7)]
    d1, d2 = discounts(of(c1)), discounts(of(c2))
    star = lambda r, d: r * (d[r - 1] if r <= 5 else keep)
    unseen = 1 - sum(star(r, d1) for r in c1.values()) / n if n else 1.0
    p = lambda w: star(c1[w], d1) / n if c1[w] else unseen
    mass, covered = defaultdict(float), defaultdict(float)
    for (h, w), r in c2.items():
        mass[h] += star(r, d2)
        covered[h] += p(w)

    def pair(h, w):
        if c2[h, w]:
            return star(c2[h, w], d2) / ch[h]
        return (1 - mass[h] / ch[h]) / (1 - covered[h]) * p(w) if ch[h] else p(w)
    out = []
    for (i, _), h, s in zip(docs, held, seqs):
        out.append((i, h, len(s), sum(c1[w] > 0 for w in s), n,
                    sum(math.log10((c1[w] + 1) / (n + v + 1)) for w in s),
                    sum(math.log10(pair(a, b)) for a, b in zip(["<s> ", *s], s))))
    sums = {h: sum(pair(h, w) for w in c1) + pair(h, "never seen") for h in list(ch)[:50]}
    return out, sums


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
