"""Plain versions of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import groupby

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def covered(n, win, starts):
    gone = [False] * n
    for s in starts:
        gone[s : s + win] = [True] * win
    return gone


def repeated(sequences, win):
    """Per sequence which units a window covers that also starts elsewhere."""
    count = Counter(tuple(s[i : i + win]) for s in sequences for i in range(len(s) - win + 1))
    return [covered(len(s), win, [i for i in range(len(s) - win + 1) if count[tuple(s[i : i + win])] > 1]) for s in sequences]


def substring(rows, win):
    texts = [words(t) for _, t in rows]
    out = []
    for (doc_id, _), w, gone in zip(rows, texts, repeated(texts, win)):
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((doc_id, len(w), len(w) - len(kept), sha(" ".join(kept))))
    return out


def parsing(rows, win):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (doc_id, _), b, gone in zip(rows, texts, repeated(texts, win)):
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def shingle_set(text, size=4):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def jaccard(rows, percent=85, size=4):
    """doc_id, n_shingles, component_id; doc_ids must differ."""
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        least[r] = doc_id if least[r] is None else min(least[r], doc_id)
    return [(d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id))
    out = []
    for doc_id, text in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        keep = min(groups[key])[1]
        out.append((doc_id, keep, len(groups[key]), doc_id == keep, sha(key)))
    return out


def quality_measures(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    (gone,) = repeated([w], 8)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    n_repeat = sum(gone)
    failed = len(w) < 20 or 100 * n_repeat > 30 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), n_repeat, failed


def entropy_spans(text, base, pattern, window, limits, allowed):
    """Every stretch of a run beside the base spans, by the entropy of all windows that no cut-out part touches."""
    inside = {i for b, e in base for i in range(b, e)}
    out = []
    for run in re.finditer(pattern, text):
        for _, group in groupby(range(run.start(), run.end()), lambda i: i in inside):
            places = list(group)
            found = text[places[0] : places[-1] + 1]
            if places[0] in inside or len(found) < window or any(re.search(a, found) for a in allowed if a[0] == "^"):
                continue
            hidden = set()
            for token in re.finditer("[A-Za-z0-9]+", found):
                if re.search(allowed[3], token[0]):
                    hidden |= set(range(*token.span()))
            for same in re.finditer(r"(.)\1{5,}", found):
                hidden |= set(range(*same.span()))
            best = -1.0
            for i in range(len(found) - window + 1):
                if not any(j in hidden for j in range(i, i + window)):
                    count = Counter(found[i : i + window])
                    best = max(best, math.log2(window) - sum(c * math.log2(c) for c in count.values()) / window)
            kind = "hex" if re.fullmatch("[0-9a-fA-F]+", found) else "alnum" if re.fullmatch("[A-Za-z0-9]+", found) else "base64"
            if best * 1e6 >= limits[kind]:
                out.append((places[0], 3, places[-1] + 1, "entropy"))
    return out


def base_spans(text):
    text = text or ""
    out = []
    assign = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    for rank, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 20), (2, "hex", "[0-9a-f]+", 24)):
        for m in re.finditer(pattern, text):
            if len(m[0]) >= least:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def water_fill(sizes, weights, cap):
    """Targets by clamping and sharing out the excess until none is above."""
    open_, target, left = set(sizes), {}, sum(sizes.values())
    while open_:
        total = sum(weights[s] for s in open_)
        full = {s for s in open_ if left * weights[s] / total > cap * sizes[s]}
        if not full:
            for s in open_:
                target[s] = left * weights[s] / total
            break
        for s in full:
            target[s] = float(cap * sizes[s])
            left -= cap * sizes[s]
        open_ -= full
    return target
