"""Plain versions of the operators, for comparison on small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

WS = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, width=3):
    w = words(lower(text))
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def jaccard_components(docs, width=3, percent=90):
    """docs: {id: text} -> {id: (set size, component)}"""
    sets = {i: shingle_set(t, width) for i, t in docs.items()}
    parent = {i: i for i in docs}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by_token = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            by_token[x].append(i)
    pairs = {(a, b) for ids in by_token.values() for k, a in enumerate(ids) for b in ids[k + 1 :]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in docs}


def repeated_words(rows, width=35):
    """rows: [(id, text)] -> [(id, words, removed, digest of what is kept)]"""
    split = [words(t) for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for (i, _), w in zip(rows, split, strict=True):
        gone = set()
        for k in range(len(w) - width + 1):
            if seen[tuple(w[k : k + width])] > 1:
                gone.update(range(k, k + width))
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return out


def exact_groups(rows):
    """rows: [(id, text)] -> [(id, keep id, group size, kept, digest)]"""
    groups = defaultdict(list)
    for i, t in rows:
        groups[WS.sub("", t or "")].append((-len(t or ""), i))
    out = []
    for i, t in rows:
        norm = WS.sub("", t or "")
        n, keep = min(groups[norm])
        out.append((i, keep, len(groups[norm]), (-len(t or ""), i) == (n, keep), hashlib.sha256(norm.encode()).hexdigest()))
    return out


BASE = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
]


def base_secrets(text):
    spans = []
    for order, (kind, pattern, good) in enumerate(BASE):
        spans += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text or "") if good(m)]
    spans.sort()
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans), Counter(k for _, _, k, _ in spans)


def mix_targets(sizes, weights, ratio=Fraction(3, 2), most=2):
    total = sum(sizes.values()) * ratio
    capped = {}
    while True:
        rest = [s for s in sizes if s not in capped and sizes[s] > 0]
        share = total - sum(capped.values())
        w = sum(weights[s] for s in rest)
        got = {s: share * weights[s] / w for s in rest} if rest else {}
        over = [s for s in rest if got[s] > most * sizes[s]]
        if not over:
            return {s: float(capped.get(s, got.get(s, 0))) for s in sizes}
        for s in over:
            capped[s] = Fraction(most * sizes[s])


def whitened(vectors, k, scale=64, offset=1_000_000):
    """vectors: lists of floats -> (n, deviations, covariance as fractions, eigenvalues, explained)"""
    x = [[math.floor(scale * c) + offset for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(dims)]
    deviations = [sum((n * r[d] - sums[d]) ** 2 for d in range(dims)) for r in x]
    centred = [[Fraction(r[d] * n - sums[d], n) for d in range(dims)] for r in x]
    cov = [[sum(r[i] * r[j] for r in centred) / n for j in range(dims)] for i in range(dims)]
    return n, deviations, cov, centred


def product_codes(rows, scale=4096, parts=8, entries=16, rounds=6):
    """rows: [(id, vector, label)] in any order -> ([(id, code, error)], codebooks digest), by plain scans"""
    dims = max(len(v) for _, v, _ in rows)
    width = -(-dims // parts)
    whole = [(i, [math.floor(scale * c) for c in v] + [0] * (parts * width - len(v)), lab) for i, v, lab in rows]
    first = sorted(zip(whole, (v for _, v, _ in rows), strict=True), key=lambda r: (r[0][0] is None, r[0][0] or 0, r[1]))[:entries]
    codes, errors = [[] for _ in rows], [0] * len(rows)
    books = []
    for p in range(parts):
        cut = [v[p * width : (p + 1) * width] for _, v, _ in whole]
        book = [r[0][1][p * width : (p + 1) * width] for r in first]

        def nearest(x, book):
            return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

        for _ in range(rounds):
            own = defaultdict(list)
            for x in cut:
                own[nearest(x, book)[1]].append(x)
            book = [[sum(c) // len(own[k]) for c in zip(*own[k], strict=True)] if k in own else e for k, e in enumerate(book)]
        for i, x in enumerate(cut):
            d, k = nearest(x, book)
            codes[i].append(k)
            errors[i] += d
        books += [c for e in book for c in e]
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    return [(i, bytes(c).hex(), e) for (i, _, _), c, e in zip(whole, codes, errors, strict=True)], digest
