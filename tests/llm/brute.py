"""Plain-Python versions of the operators' definitions, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pandas as pd

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def crc(i, m):
    return zlib.crc32(str(i).encode()) % m


def repeats(docs, length=50):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    low = {}
    for i, t in docs:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            low[w] = min(low.get(w, i), i)
    out = []
    for i, t in docs:
        b = (t or "").encode()
        hit = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if low[b[s:s + length]] < i:
                hit[s:s + length] = b"\x01" * length
        kept = bytes(x for x, h in zip(b, hit, strict=True) if not h)
        runs = sum(1 for q in range(len(b)) if hit[q] and (not q or not hit[q - 1]))
        out.append((i, len(b), sum(hit), runs, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, k=5):
    w = words(text)
    return frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def near_duplicates(docs, threshold=0.8):
    """doc_id -> (class_id, n_links, group_id), ids distinct."""
    sets = {i: shingles(t) for i, t in docs}
    ids = sorted(sets)
    links = []
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and both / len(sets[a] | sets[b]) >= threshold:
                links.append((a, b))
    group, n, cls = components(ids, links), Counter(), {}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    for i in ids:
        cls[i] = min((j for j in ids if sets[j] == sets[i]), default=i) if sets[i] else i
    return {i: (cls[i], n[i], group[i]) for i in ids}


def license_labels(text, base, templates, gap=3, drift=8, cover=0.8):
    """(places of base phrases, base labels, all labels, best share): the definition, by plain loops."""
    w = words(text)
    places, own, every, best = [], set(), set(), 0.0
    for phrase, label in base:
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
        places += at
        if at:
            own.add(label)
            best = 1.0
    for phrase, label in templates:
        p = phrase.split()
        pairs = list(zip(p, p[1:], strict=False))
        found = sorted({(i - t, t) for i in range(len(w) - 1) for t, q in enumerate(pairs) if (w[i], w[i + 1]) == q})
        groups = []
        for d, t in found:
            if not groups or d - groups[-1][-1][0] > gap:
                groups.append([])
            groups[-1].append((d, t))
        for g in groups:
            count = Counter(d for d, _ in g)
            anchor = min(d for d in count if count[d] == max(count.values()))
            first = {}
            for d, t in g:
                if abs(d - anchor) <= drift:
                    first[t] = min(first.get(t, d + t), d + t)
            last, n = -1, 0
            for t in sorted(first):
                if first[t] > last:
                    last, n = first[t], n + 1
            if len({t for _, t in g}) >= cover * len(pairs) and n >= cover * len(pairs):
                every.add(label)
                best = max(best, n / len(pairs))
    return places, own, every | own, best


def windows(text, size=13):
    w = words(text)
    k = min(size, len(w))
    return {tuple(w[s:s + k]) for s in range(len(w) - k + 1)} if w else set()


def decontaminate(docs, bench):
    """doc_id -> (n_words, n_hit, items)."""
    own = defaultdict(set)
    for k, t in bench:
        for w in windows(t):
            own[w].add(str(k))
    out = {}
    for i, t in docs:
        w, hit, items = words(t), set(), set()
        for k in {len(x) for x in own}:
            for s in range(len(w) - k + 1):
                if tuple(w[s:s + k]) in own:
                    hit |= set(range(s, s + k))
                    items |= own[tuple(w[s:s + k])]
        out[i] = (len(w), len(hit), sorted(items))
    return out


def suffix_tree(docs, training, discount=0.7):
    """doc_id -> (n_tokens, n_known, train_tokens, base_score, score)."""
    end = object()
    toks = [(i, TOKEN.findall((t or "").translate(LOWER)) + [end], training(i)) for i, t in docs]
    c = [Counter(), Counter(), Counter()]
    for _, t, on in toks:
        if on:
            c[0].update((x,) for x in t)
            c[1].update(zip(t, t[1:], strict=False))
            c[2].update(zip(t, t[1:], t[2:], strict=False))
    total, kinds = sum(c[0].values()), len(c[0])
    follow = [defaultdict(list), defaultdict(list)]
    for d in (1, 2):
        for g, n in c[d].items():
            follow[d - 1][g[:-1]].append((g[-1], n))

    def p0(x):
        return (c[0][(x,)] + 1) / (total + kinds + 1)

    def state(ctx, parent):
        n = c[len(ctx) - 1][ctx]
        f = follow[len(ctx) - 1][ctx]
        again = [(x, m) for x, m in f if m >= 2]
        if n < 2 or not again:
            return None
        gain = sum(m * math.log((m - 1 - discount) / (n - 1) / parent(x)) for x, m in again)
        once = sum(m == 1 for _, m in f)
        if once:
            gain += once * math.log(discount * max(len(f) - 1, 1e-9) / (n - 1))
        return (n, len(f)) if gain > 0 else None

    one = {u: s for u in c[0] if u[0] is not end and (s := state(u, p0))}

    def p1(u, x):
        if u in one:
            n, k = one[u]
            return (max(c[1][(*u, x)] - discount, 0) + discount * k * p0(x)) / n
        return p0(x)

    two = {g: s for g in c[1] if g[1] is not end and (s := state(g, lambda x: p1(g[1:], x)))}
    out = []
    for i, t, _ in toks:
        score = 0.0
        for j, x in enumerate(t):
            p = p1((t[j - 1],), x) if j else p0(x)
            g = tuple(t[j - 2:j])
            if j >= 2 and g in two:
                n, k = two[g]
                p = (max(c[2][(*g, x)] - discount, 0) + discount * k * p) / n
            score += math.log10(p)
        out.append((i, len(t), sum((x,) in c[0] for x in t), total, sum(math.log10(p0(x)) for x in t), score))
    return out


def _plain(v):
    if pd.isna(v):
        return None
    return v if isinstance(v, (str, bool)) else round(float(v), 9)


def same(a, b):
    """Equal rows, in any order; column order is free."""
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    rows = lambda d: sorted(repr(tuple(_plain(x) for x in r)) for r in d[cols].itertuples(index=False, name=None))
    assert rows(a) == rows(b)
