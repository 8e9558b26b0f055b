"""Plain versions of the clustering, collocation and personal-data operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

from wearspan.llm import pii


def clusters(rows, count, rounds, seed, dimensions, most):
    """rows: (vec_id, list). vec_id, cluster, distance, cluster_inertia, inertia, sha."""
    kept = []
    for i, v in rows:
        if v is None or len(v) != dimensions or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(max(-most, min(most, x * 256))) for x in v]))
    name = lambda i: (i is None, "" if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:count]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for step in range(rounds + 1):
        at = [min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c)) for _, v in kept]
        if step < rounds:
            for c in range(len(centroids)):
                mine = [v for (_, v), a in zip(kept, at) if a == c]
                if mine:
                    centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    d = [far(v, centroids[a]) for (_, v), a in zip(kept, at)]
    own = defaultdict(int)
    for a, x in zip(at, d):
        own[a] += x
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, a, x, own[a], sum(d), sha[a]) for (i, _), a, x in zip(kept, at, d)]


def phrase_counts(rows, max_words):
    """rows: (text, lang). Words per lang, and per (lang, phrase) count, before, behind."""
    n, f = Counter(), defaultdict(lambda: [0, 0, 0])
    for text, lang in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split("[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for size in range(1, max_words + 1):
                for i in range(len(w) - size + 1):
                    c = f[lang, " ".join(w[i : i + size])]
                    c[0] += 1
                    c[1] += i > 0
                    c[2] += i + size < len(w)
    return n, f


def collocations(rows, max_words, least, top):
    n, f = phrase_counts(rows, max_words)
    out = defaultdict(list)
    candidates = {k: c[0] for k, c in f.items() if " " in k[1] and c[0] >= least}
    for (lang, phrase), a in candidates.items():
        w = phrase.split(" ")
        if any(g == lang and len(q.split(" ")) > len(w) and f" {phrase} " in f" {q} " and 100 * b >= 50 * a for (g, q), b in candidates.items()):
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = f[lang, " ".join(w[:k])][0], f[lang, " ".join(w[k:])][0]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, phrase.encode(), left, right))
    return [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, found in out.items() for i, (s, a, p, x, y) in enumerate(sorted(found)[:top])]


def luhn(found):
    digits = [int(c) for c in found if c.isdigit()][::-1]
    return len(digits) <= 19 and sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def base_matches(text):
    """kind number, match, good."""
    out = []
    for rank, kind in enumerate(pii.BASE_KINDS):
        for m in re.finditer(pii.PLAIN[kind], text):
            n = sum(c in "0123456789" for c in m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= n <= 19 and luhn(m[0]),
                "phone": 8 <= n <= 15,
            }[kind]
            out.append((rank, m, good))
    return out


def _key(kind, m, text, last):
    name = pii.KINDS[kind]
    before, after = text[max(last, m.start() - 32) : m.start()], text[m.end() : m.end() + 1]
    vote = lambda s, against, good: 0 if re.search(against, s) else 2 if re.search(good, s) else 1
    shape = (2 if luhn(m[0]) else 0) if name == "card" else vote(m[0], *pii.SHAPE[name])
    side = lambda c: 2 if re.search("[A-Za-z0-9]", c) else 1 if re.search(r"[^\x20\x09-\x0D]", c) else 0
    n, digits = len(m[0]), sum(c in "0123456789" for c in m[0])
    votes = (shape, vote(m[0], *pii.GAZETTEER[name]), vote(before.lower(), pii.AGAINST_CUES, pii.CUES[name]))
    return (kind, votes, (min(3, n // 8), digits * 4 // (n + 1), side(before[-1:]), side(after)))


def personal(rows):
    """doc_id, four counts, sha of base spans, all spans; rows: (doc_id, text). Also the estimates."""
    docs, n = [], Counter()
    for doc_id, text in rows:
        text, base, loose = text or "", [], []
        for rank, kind in enumerate(pii.BASE_KINDS):
            last = 0
            for r, m, good in base_matches(text):
                if r != rank or kind == "card" and sum(c in "0123456789" for c in m[0]) < 13:
                    continue
                if good:
                    base.append((rank, m.start(), m.end(), _key(rank, m, text, last)))
                elif kind == "card" and sum(c in "0123456789" for c in m[0]) <= 19:
                    loose.append((rank, m.start(), m.end(), _key(rank, m, text, last)))
                last = m.end()
        for kind, pattern in pii.LOOSE.items():
            last = 0
            for m in re.finditer(pattern, text):
                loose.append((pii.KINDS.index(kind), m.start(), m.end(), _key(pii.KINDS.index(kind), m, text, last)))
                last = m.end()
        loose = [x for x in loose if not any(b[1] < x[2] and x[1] < b[2] for b in base)]
        n.update(x[3] for x in base + loose)
        docs.append((doc_id, base, loose))
    taken, states = set(), {}
    for kind in range(len(pii.KINDS)):
        mine = {k: c for k, c in n.items() if k[0] == kind}
        if not mine:
            continue
        belief = {k: 0.5 + pii.LEAN * (sum(k[1]) - 3) for k in mine}
        for _ in range(pii.ROUNDS + 1):
            yes = sum(c * belief[k] for k, c in mine.items())
            no = sum(c * (1 - belief[k]) for k, c in mine.items())
            chance = lambda j, v, w, whole: (sum(c * w(k) for k, c in mine.items() if k[1][j] == v) + 1) / (whole + 3)
            t = [[chance(j, v, lambda k: belief[k], yes) for v in range(3)] for j in range(3)]
            u = [[chance(j, v, lambda k: 1 - belief[k], no) for v in range(3)] for j in range(3)]
            prior = (yes + 1) / (yes + no + 2)
            states[kind] = (prior, t, u)
            belief = {}
            for k in mine:
                a = prior * math.prod(t[j][k[1][j]] for j in range(3))
                b = (1 - prior) * math.prod(u[j][k[1][j]] for j in range(3))
                belief[k] = a / (a + b)
        yes, no = sum(c * belief[k] for k, c in mine.items()), sum(c * (1 - belief[k]) for k, c in mine.items())
        sizes = [3, 3, 3, 4, 4, 3, 3]
        for k in mine:
            odds = math.log((yes + 1) / (no + 1))
            for place, size in enumerate(sizes):
                same = [x for x in mine if (x[1] + x[2])[place] == (k[1] + k[2])[place]]
                odds += math.log((sum(mine[x] * belief[x] for x in same) + 1) / (yes + size))
                odds -= math.log((sum(mine[x] * (1 - belief[x]) for x in same) + 1) / (no + size))
            if round(odds, 6) > 0 and k[1][0] != 0:
                taken.add(k)
    line = lambda spans: ",".join(f"{pii.KINDS[r]}:{s}:{e}" for r, s, e, _ in sorted(spans, key=lambda x: x[:3]))
    out = []
    for doc_id, base, loose in docs:
        counts = [sum(b[0] == r for b in base) for r in range(4)]
        out.append((doc_id, *counts, hashlib.sha256(line(base).encode()).hexdigest(), line(base + [x for x in loose if x[3] in taken])))
    return out, states
