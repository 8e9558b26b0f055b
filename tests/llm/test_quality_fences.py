"""Thresholds come from each group's own sketch, and each of them can reject what the base rules pass."""

import random

from llm import brute
from wearspan.llm import quality


def texts(rng, n, prefix="word"):
    return [" ".join(f"{prefix}{rng.randrange(3000)}" for _ in range(100)) for _ in range(n)]


def test_each_rate_rejects(make):
    rng = random.Random(8)
    plain = texts(rng, 400)
    odd = {
        "symbols": " ".join(f"a{rng.randrange(3000)}$" if i % 8 == 0 else f"word{rng.randrange(3000)}" for i in range(100)),
        "lines": "\n".join([f"line{i} of some words" for i in range(10)] + ["line1 of some words"] * 3),
        "repeats": plain[0] + " " + " ".join(plain[0].split()[:12]),
        "length": " ".join("x" * 40 for _ in range(5)) + " " + " ".join(f"{'y' * 30}{i}" for i in range(95)),
    }
    rows = [(i, t, "en", "a") for i, t in enumerate(plain)] + [(1000 + i, t, "en", "a") for i, t in enumerate(odd.values())]
    got = {r["doc_id"]: r for r in quality.verdicts(make(rows), 30).collect()}
    assert not any(got[i]["base_failed"] for i in got)
    assert all(got[i]["kept"] for i in range(400))
    assert [got[1000 + i]["kept"] for i in range(4)] == [False] * 4


def test_thresholds_differ_between_languages(make):
    rng = random.Random(9)
    rows = [(i, t, "en", "a") for i, t in enumerate(texts(rng, 400))]
    for i, t in enumerate(texts(rng, 400)):  # a language whose texts often repeat a passage
        rows.append((1000 + i, t + " " + " ".join(t.split()[: rng.randrange(8, 12)]) if i % 10 == 0 else t, "de", "b"))
    passage = rows[0][1] + " " + " ".join(rows[0][1].split()[:10])
    rows += [(5000, passage, "en", "a"), (5001, passage, "de", "b")]
    assert not any(brute.quality_measures(t)[-1] for _, t, _, _ in rows)
    docs = make(rows)
    d = quality.with_rates(quality.measured(docs, [docs["doc_id"], docs["lang"], docs["source"]]))
    limits = {r["lang"]: r for r in quality.thresholds(quality.sketch(d), 30).collect()}
    assert limits["en"]["repeats_high"] < limits["de"]["repeats_high"]
    kept = {r["doc_id"]: r["kept"] for r in quality.verdicts(docs, 30).collect()}
    assert not kept[5000] and kept[5001]
