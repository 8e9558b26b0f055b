"""Clustering, collocations and personal data against their plain versions, on odd and empty tables."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from llm import brute_new as brute
from llm.conftest import rows_of
from wearspan.llm import clustering, collocations, fm, pii


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


# --- 12 clustering ------------------------------------------------------------

VECTORS = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT, cluster STRING, v INT"


def vectors(rng, n, dimensions, groups=6):
    centres = [[rng.uniform(-1, 1) for _ in range(dimensions)] for _ in range(groups)]
    return [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize(("seed", "n", "count"), [(1, 400, 12), (2, 300, 40), (3, 9, 12)])
def test_clusters_equal_plain_rounds(spark, monkeypatch, seed, n, count):
    monkeypatch.setattr(clustering, "BLOCK", 64)
    rows = vectors(random.Random(seed), n, 5)
    rows += [(None, [0.5] * 5), (None, [0.25] * 5), (7, list(rows[3][1])), (8, [1e9, -1e9, 0.0, 0.1, 3e4]), (9, [5e5, 0.0, 0.0, 0.0, 1.0])]
    rows += [(1000 + i, [0.0] * 5) for i in range(20)]  # ties and repeated vectors
    odd = [(900, None), (901, []), (902, [1.0] * 4), (903, [1.0, None, 1.0, 1.0, 1.0]), (904, [float("nan")] * 5), (905, [float("inf")] * 5)]
    table = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows + odd], VECTORS).repartition(3)
    got = clustering.cluster(table, count, 5, 2, 5)
    assert rows_of(got) == ordered(brute.clusters(rows + odd, count, 5, 2, 5, clustering.MOST))


def test_no_vectors(spark):
    assert clustering.cluster(spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<FLOAT>")).count() == 0
    assert clustering.cluster(spark.createDataFrame([(1, [1.0])], "vec_id BIGINT, embedding ARRAY<FLOAT>")).count() == 0


def test_bounds_loosen_less_than_the_drift_and_hold():
    rng = np.random.default_rng(5)
    tighter = 0
    for _ in range(30):
        old = rng.integers(-300, 300, (8, 6))
        new = old + rng.integers(-40, 40, old.shape)
        radius = rng.uniform(0, 200, 8)
        bound = clustering.loosening(old, new, radius)
        for i in range(8):
            way = rng.normal(size=(300, 6))
            x = old[i] + way / np.linalg.norm(way, axis=1)[:, None] * radius[i] * rng.uniform(0, 1, (300, 1))
            others = [j for j in range(8) if j != i]
            shrink = max((np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)).max() for j in others)
            drift = max(np.linalg.norm(new[j] - old[j]) for j in others)
            assert shrink <= bound[i] <= drift * (1 + 1e-8) + 1e-5
            tighter += bound[i] < 0.9 * drift
    assert tighter > 50


def test_few_vectors_are_scanned():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(2000, 8)) * 40 + rng.integers(-4, 4, (2000, 1)) * 400).astype(np.int64)
    c = x[:10].copy()
    at, upper, lower = clustering.assign(x, c, np.full(2000, -1), np.zeros(2000), np.zeros(2000))
    moved = c + rng.integers(-3, 3, c.shape)
    drift = np.sqrt(((moved - c) ** 2).sum(1))
    radius = np.array([upper[at == k].max(initial=0) for k in range(10)])
    upper, lower = upper + drift[at], lower - clustering.loosening(c, moved, radius)[at]
    assert (~clustering.clearly_below(upper, lower)).mean() < 0.9
    again, _, _ = clustering.assign(x, moved, at, upper, lower)
    assert (again == clustering.squares(x, moved).argmin(1)).all()


# --- 13 collocations ----------------------------------------------------------


def phrase_rows(seed, n=160):
    rng = random.Random(seed)
    word = lambda: rng.choice("aa Bb cc dd É \xa0x f-g 日本 hh ii".split(" "))
    out = []
    for i in range(n):
        text = "".join(rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b!"]) + word() for _ in range(rng.randrange(0, 30)))
        out.append((text, rng.choice(["en", "de", None, "und", "x"])))
    out += [(None, "en"), ("", None), (" \t . ", "zz"), ("aa bb cc " * 400, "en"), ("solo", "only")]
    return out


@pytest.mark.parametrize(("seed", "max_words", "shard"), [(1, 3, 200), (2, 4, 3 << 20), (3, 2, 900)])
def test_collocations(make, monkeypatch, seed, max_words, shard):
    monkeypatch.setattr(collocations, "PART_ENTRIES", 500)
    rows = phrase_rows(seed)
    docs = make([(i, t, lang, "s") for i, (t, lang) in enumerate(rows)]).repartition(3)
    n, f = brute.phrase_counts(rows, max_words)
    sizes, found = collocations.phrases(docs, max_words, 6, shard)
    assert rows_of(sizes.where("n > 0"), "lang", "n") == ordered((k, c) for k, c in n.items() if c)
    want = ordered((*k, *c) for k, c in f.items() if c[0] >= 6)
    assert rows_of(found, "lang", "phrase", "a", "before", "behind") == want
    got = collocations.collocations(docs, max_words, 6, 15, shard)
    assert rows_of(got) == ordered(brute.collocations(rows, max_words, 6, 15))


def test_collocations_of_odd_tables(docs, corpus, nothing):
    assert collocations.collocations(nothing).count() == 0
    got = collocations.collocations(docs, shard_bytes=20_000)
    assert rows_of(got) == ordered(brute.collocations([(t, lang) for _, t, lang, _ in corpus], 3, 10, 2000))


def test_extension_in_both_directions():
    rng = random.Random(9)
    symbols = np.array([rng.choice([0, 1, 1, 2, 3]) for _ in range(500)] + [0])
    index = fm.FmIndex.of(symbols, 4)
    grams = index.single_words()
    for size in range(1, 5):
        want = {}
        for i in range(len(symbols) - size + 1):
            g = tuple(symbols[i : i + size])
            if all(g):
                c = want.setdefault(g, [0, 0, 0])
                c[0] += 1
                c[1] += symbols[i - 1] > 0
                c[2] += symbols[i + size] > 0
        got = {tuple(int(w[k]) for w in grams.words): [int(grams.count[k]), int(grams.left[k]), int(grams.right[k])] for k in range(len(grams))}
        assert got == want
        if size < 4:
            grams = index.extended(grams)


# --- 11 personal data -----------------------------------------------------------

PERSONAL = [
    None,
    "",
    "mail a.b@c.de_f@g.h.i. x@y @z a@b.c.@d.e",
    "ip 1.2.3.4.5 host 256.1.1.1 000255.1.2.3 1.2.3 10.0.0.1x 99999999999999.1.1.1",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 378282246310005, 4111  1111 1111 1111 12345678901234567890",
    "call +1 (115) 555-9688 or +49 30 1234 -- +1234567 +1 2 3 tel (212) 555-0147, 212.555.0147 x 012 345 6789",
    "+1 (826) 555-4081 190.137.223.204 du 4111111111111111 1.2.3.4",
    "write to jane.doe (at) example [dot] com or bob[at]host.org, Dr. Anna Schmidt signed, Maria The 2001:0db8:85a3:0000:0000:8a2e:0370:7334",
    "é日 Mr Smith Petra Weber @ 00:11:22:33:44:55:66:77 token 5500000000000004",
    " ".join(f"u{i}@h{i % 7}.example.com" for i in range(700)),
]


def test_personal_data(make):
    rng = random.Random(6)
    rows = list(enumerate(PERSONAL))
    for i in range(100, 400):
        number = "".join(rng.choice("0123456789") for _ in range(rng.choice([13, 15, 16, 16])))
        kinds = [f"call (2{rng.randrange(10, 99)}) 555-{rng.randrange(1000, 9999)}", f"card {number}", f"order {number}", f"name Anna Berg{'x' * rng.randrange(5)}", "version 1.2.3.4", f"+1 {rng.randrange(10**9, 10**10)}"]
        rows.append((i, " and ".join(rng.sample(kinds, 2))))
    rows += rows[:9]
    docs = make(rows).repartition(3)
    want, states = brute.personal(rows)
    assert rows_of(pii.scan(docs)) == ordered(want)
    assert any("name:" in w[-1] for w in want) and all("card:" not in w[-1] or w[3] or "37828" in PERSONAL[4] for w in want)
    table = pii.patterns(pii.candidates(docs))
    for r in pii.reliabilities(table).collect():
        prior, yes, no = states[r["kind"]]
        assert r["state"]["prior"] == pytest.approx(prior)
        assert np.allclose(r["state"]["yes"], yes) and np.allclose(r["state"]["no"], no)


def test_personal_data_runs_no_python_and_takes_linear_time(spark, make, nothing):
    assert pii.scan(nothing).count() == 0
    plan = pii.scan(make([(1, "a@b.c")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    long = ["7" * 400_000, "a" * 400_000, "+1" + " " * 400_000, "1.1." * 100_000, "a.b@c.d " * 60_000, "a@" + "b." * 200_000, "a" * 300_000 + "(at)"]
    begin = time.time()
    got = {r["doc_id"]: r for r in pii.scan(make(list(enumerate(long))).repartition(1)).collect()}
    assert got[4]["n_email"] == 60_000 and got[5]["n_email"] == 1 and got[3]["n_ip"] == 100_000 // 2
    assert time.time() - begin < 60


def test_estimates_learn_which_labeler_errs(spark):
    """The third labeler votes at random: its chances come out even, the others' do not."""
    rng, rows = random.Random(3), []
    for _ in range(3000):
        truth = rng.random() < 0.4
        votes = [2 * truth if rng.random() < 0.9 else 2 * (not truth) for _ in range(2)] + [rng.choice([0, 2])]
        rows.append((0, *votes, 1))
    table = spark.createDataFrame(rows, "kind INT, shape INT, gazetteer INT, context INT, n BIGINT")
    state = pii.reliabilities(table, 30).collect()[0]["state"]
    assert state["prior"] == pytest.approx(0.4, abs=0.06)
    assert state["yes"][0][2] > 0.8 and state["no"][1][0] > 0.8 and state["yes"][2][2] == pytest.approx(0.5, abs=0.08)
