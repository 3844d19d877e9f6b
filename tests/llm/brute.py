"""Plain forms of the operators, for small tables."""

import hashlib
import zlib

import numpy as np
import xxhash


def crc_mod(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def words(text):
    return (text or "").encode().split()


def simhash(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, ids):
    """Smallest id reachable over links of at most 4 bits; None where all are None."""
    group = list(range(len(fps)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                group[find(i)] = find(j)
    low = {}
    for i, v in enumerate(ids):
        r = find(i)
        low[r] = v if low.get(r) is None else low[r] if v is None else min(v, low[r])
    return [low[find(i)] for i in range(len(fps))]


def mix(docs):
    """Per source: name, copies, hashes taken once more by pass, size, target, rows (id, source, size, hash); of [(doc_id, source, text)]."""
    rows = [(i, s, len(words(t)), int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)) for i, s, t in docs]
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is None, "" if s is None else s))
    size = {s: sum(r[2] for r in rows if r[1] == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    open_, left, target = set(sources), float(sum(size.values())), {}
    while True:  # share, cap, share again
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > 3 * size[s]} if total else set()
        if not full:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in full:
            target[s] = 3.0 * size[s]
        left -= sum(target[s] for s in full)
        open_ -= full
        if not open_:
            break
    for s in sources:
        copies = int(target[s] // size[s]) if size[s] else 0
        rest, low, once = int(target[s] - copies * size[s]), -1, set()
        for _ in range(3):
            if rest <= 0:
                break
            used = 0
            fits = [r for r in rows if r[1] == s and r[3] > low and r[2] <= rest]
            new = low
            for h in sorted({r[3] for r in fits}):
                n = sum(r[2] for r in fits if r[3] == h)
                if used + n > rest:
                    new = h - 1
                    break
                used += n
                once |= {(r[0], h) for r in fits if r[3] == h}
            else:
                break
            rest, low = rest - used, new
        yield s, copies, once, size[s], target[s], [r for r in rows if r[1] == s]


def sketch(text, fraction):
    """Shingle hashes below the fraction of the range, or the smallest one."""
    w, mask = (text or "").encode().lower().split(), 2**64 - 1
    if not w:
        return set()
    found = set()
    for i in range(max(1, len(w) - 4)):
        h = 0
        for x in w[i : i + 5]:
            h = (h * 0x9E3779B97F4A7C15 + xxhash.xxh64_intdigest(x)) & mask
            h ^= h >> 29
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
            h = (h ^ h >> shift) * factor & mask
        found.add(h)
    return {h for h in found if h < fraction * 2**64} or {min(found)}


def likeness(a, b, fraction):
    if not a or not b:
        return float(len(a) == len(b))
    top = min(max(max(s), fraction * 2**64 - 1) if len(s) == 1 else fraction * 2**64 - 1 for s in (a, b))
    a, b = {h for h in a if h <= top}, {h for h in b if h <= top}
    return len(a & b) / len(a | b) if a and b else float(a == b)


def features(text, buckets):
    """Of a text: the bucket of every feature occurrence, by the classifier's rule."""
    w, out = (text or "").encode().split(), []
    for x in w:
        out.append(xxhash.xxh32_intdigest(x, 1) % buckets)
        m = b"<" + x + b">"
        out += [xxhash.xxh32_intdigest(m[i : i + n], 2) % buckets for n in (3, 4) for i in range(len(m) - n + 1)]
    for n in (2, 3):
        for i in range(len(w) - n + 1):
            seen, pattern = {}, ""
            for x in w[i : i + n]:
                pattern += seen.setdefault(x, "abc"[len(seen)])
            out.append(xxhash.xxh32_intdigest(pattern.encode(), 3) % buckets)
    return out


def kneser(train, texts):
    """log10 probability of each text under an interpolated modified Kneser-Ney bigram model."""
    from collections import Counter

    end, start = "</e>", "<b>"
    seqs = [[start, *[w.decode() for w in words(t.lower() if t else t)], end] for t in train]
    two = Counter(p for s in seqs for p in zip(s, s[1:]))
    cont = Counter(w for _, w in two)
    vocabulary = set(cont)

    def discount(counter):
        n = [sum(v == i for v in counter.values()) for i in (1, 2, 3, 4)]
        if not n[0] or not n[1]:
            return [0, 0.5, 1.0, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1] if n[2] else 1.0, 3 - 4 * y * n[3] / n[2] if n[2] and n[3] else 1.5]
        return [0, *(min(max(x, 0.05), i + 0.95) for i, x in enumerate(d))]

    d2, d1 = discount(two), discount(cont)
    total = sum(cont.values())
    uniform = sum(d1[min(v, 3)] for v in cont.values()) / total / (len(vocabulary) + 1)
    by = {}
    for (v, _), n in two.items():
        by.setdefault(v, []).append(n)

    def p(v, w):
        low = max(cont[w] - d1[min(cont[w], 3)], 0) / total + uniform
        if v not in by:
            return low
        n = two[v, w]
        return max(n - d2[min(n, 3)], 0) / sum(by[v]) + sum(d2[min(x, 3)] for x in by[v]) / sum(by[v]) * low

    out = []
    for t in texts:
        s = [start, *[w.decode() for w in words(t.lower() if t else t)], end]
        out.append(sum(np.log10(p(v, w)) for v, w in zip(s, s[1:])))
    return out


def base_scores(train, texts):
    """n_known and the add-0.1 unigram score of each text."""
    from collections import Counter

    seq = lambda t: [*((t or "").encode().lower().split()), b"\n"]
    c = Counter(w for t in train for w in seq(t))
    n, v = sum(c.values()), len(c)
    for t in texts:
        yield sum(c[w] > 0 for w in seq(t)), sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in seq(t))
