"""Toxicity against a plain fit: features as strings, FTRL-proximal one coordinate at a time."""

from __future__ import annotations

import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from wearspan.llm import toxicity

VOCABULARY = "stupid stupidly idiots River maple, don't garten-zaun été paper lantern winter x9".split()


def plain_features(text):
    folded = "".join(c.lower() if c.isascii() and c.isalnum() else " " if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20]+", folded)
    found = {("word", w) for w in words}
    for w in words:
        raw = w.encode()
        found |= {("stem", raw[:n]) for n in toxicity.STEMS if len(raw) > n}
    for gap in (1, 2):
        found |= {(gap, a, b) for a, b in zip(words, words[gap:], strict=False)}
    return found


def plain_weights(rows):
    """rows: (features, label) in the order of the fit."""
    often = [f for found, _ in rows for f in found]
    frequent = {f for f in set(often) if often.count(f) >= toxicity.MIN_DOCS}
    z, n = {}, {}

    def weight(f):
        l1 = 0.0 if f == "bias" else toxicity.L1
        at = z.get(f, 0.0)
        if abs(at) <= l1:
            return 0.0
        return -(at - math.copysign(l1, at)) / ((toxicity.BETA + math.sqrt(n[f])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for found, label in rows:
            used = sorted(found & frequent, key=repr) + ["bias"]
            w = {f: weight(f) for f in used}
            g = 1 / (1 + math.exp(-sum(w.values()))) - label
            for f in used:
                before = n.get(f, 0.0)
                n[f] = before + g * g
                z[f] = z.get(f, 0.0) + g - (math.sqrt(n[f]) - math.sqrt(before)) / toxicity.ALPHA * w[f]
    return {f: weight(f) for f in z if weight(f)}


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(17)
    rows = []
    for i in range(240):
        label = int(rng.random() < 0.4)
        weights = [4 if label and w.startswith(("stupid", "idiot")) else 1 for w in VOCABULARY]
        rows.append((i, " ".join(rng.choices(VOCABULARY, weights, k=rng.randrange(1, 9))), int(label ^ (rng.random() < 0.05))))
    return [*rows, (240, None, 0), (241, "", 1), (242, "? !", 0)]


def test_weights_and_scores_equal_the_plain_fit(spark, make, labelled):
    docs = make([(i, t) for i, t, _ in labelled])
    known = [(i, label) for i, _, label in labelled]
    labels = spark.createDataFrame([*known, known[3], (5, None), (None, 1)], "doc_id BIGINT, toxic INT")
    weights = toxicity.train(docs, labels)

    ids = spark.createDataFrame([(i,) for i, _ in known], "of BIGINT").select("of", F.xxhash64("of", F.lit("toxicity")).alias("turn"))
    order = [r["of"] for r in sorted(ids.collect(), key=lambda r: (r["turn"], r["of"])) if zlib.crc32(str(r["of"]).encode()) % toxicity.FOLDS]
    text, label = {i: t for i, t, _ in labelled}, dict(known)
    plain = plain_weights([(plain_features(text[i]), label[i]) for i in order])

    assert sorted(weights.values()) == pytest.approx(sorted(plain.values()), abs=1e-9)
    assert weights[1 << toxicity.BITS] == pytest.approx(plain["bias"], abs=1e-9)
    got = {r["doc_id"]: r for r in toxicity.score(docs, weights).collect()}
    assert len(got) == len(labelled)
    for i, t, _ in labelled:
        total = plain["bias"] + sum(plain.get(f, 0.0) for f in plain_features(t))
        assert got[i]["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9), t
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % toxicity.FOLDS == 0)
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.5)
