"""The pipeline stage by stage against plain versions, and the registered queries beside their SQL."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from check_queries import _plain, connect
from llm import brute
from wearspan.llm import quality
from wearspan.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of documents, then of each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out, home = [docs], tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], FOLDER).write.parquet(str(home / name))
        out.append(spark.read.parquet(str(home / name)))
    return out


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_quality_stage(stages):
    kept = {r["doc_id"] for r in quality.verdicts(stages[0]).where("kept").collect()}
    assert {i for i, _ in texts(stages[1])} == kept
    assert not any(brute.quality_measures(t)[-1] for _, t in texts(stages[1]))


def test_clean_documents_stay(spark, stages):
    clean = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").select("doc_id")
    good = {i: t for i, t in texts(stages[0].join(clean, "doc_id")) if not brute.quality_measures(t)[-1]}
    assert good and set(good) <= {i for i, _ in texts(stages[1])}


def test_exact_stage(stages):
    want = {r[0] for r in brute.exact(texts(stages[1])) if r[3]}
    assert Counter(i for i, _ in texts(stages[2])) == Counter(want)


def test_near_stage(stages):
    want = {r[0] for r in brute.jaccard(texts(stages[2]), 80, 5) if r[0] == r[2]}
    assert Counter(i for i, _ in texts(stages[3])) == Counter(want)


def test_mix_stage(stages):
    rows = stages[3].select("doc_id", "text", "source").collect()
    sizes, of = defaultdict(int), {r["doc_id"]: (len(brute.words(r["text"])), r["source"]) for r in rows}
    for n, s in of.values():
        sizes[s] += n
    order = sorted(sizes)
    want = brute.water_fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    copies = Counter(i for i, _ in texts(stages[4]))
    assert max(copies.values()) <= 3 and set(copies) <= set(of)
    taken = defaultdict(int)
    for i, n in copies.items():
        taken[of[i][1]] += n * of[i][0]
    for s in sizes:
        longest = max(n for n, x in of.values() if x == s)
        assert abs(taken[s] - want[s]) <= longest / 2 + 1


def test_pack_stage(stages):
    copies = Counter(i for i, _ in texts(stages[4]))
    tokens, length = defaultdict(int), {}
    for r in stages[5].collect():
        tokens[r["doc_id"]] += r["length"]
        length[r["doc_id"]] = r["doc_tokens"]
    assert {i: n // length[i] for i, n in tokens.items()} == copies
    assert all(n % length[i] == 0 for i, n in tokens.items())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    mine = QUERIES[name](spark, FOLDER).toPandas()
    theirs = connect(FOLDER).execute(ORACLES[name]).df()
    assert _plain(mine).equals(_plain(theirs))


def test_every_operator_has_its_query():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
