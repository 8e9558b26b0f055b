"""The near_dedup stage against a plain version at its own shingles: 5 words and 80 percent."""

from __future__ import annotations

import random

import corpus_pipeline
from llm import brute
from llm.conftest import prose, rows_of


def kept(rows, size, percent):
    """doc_ids of the least document of each component."""
    sets = {i: brute.shingle_set(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted(((i,) for i in sets if find(i) == i), key=repr)


def test_near_stage_takes_five_words_and_80_percent(spark, make):
    rng = random.Random(12)
    rows = []
    for i in range(40):
        text = prose(rng, 100, 100_000)
        rows += [(2 * i, text), (2 * i + 1, f"{text} {prose(rng, 10 + i % 20, 100_000)}")]
    want = kept(rows, 5, 80)
    assert len(kept(rows, 4, 85)) > len(want) > 40
    assert rows_of(corpus_pipeline.near_dedup(spark, make(rows).repartition(3), ""), "doc_id") == want


def test_near_stage_of_the_corpus(spark, docs, corpus):
    pairs = [(i, t) for i, t, _, _ in corpus]
    assert rows_of(corpus_pipeline.near_dedup(spark, docs, ""), "doc_id") == kept(pairs, 5, 80)
