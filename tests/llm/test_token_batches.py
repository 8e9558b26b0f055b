"""The batches that op5_token_counts commits: deletes reach the totals."""

from __future__ import annotations

from check_queries import _plain, connect
from wearspan.llm import queries, rollups

FOLDER = "/root/testdata/sf0.001"


def test_query_commits_deletes(spark, monkeypatch):
    made = []

    class Recorded(rollups.TokenRollup):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(self)

    monkeypatch.setattr(rollups, "TokenRollup", Recorded)
    mine = queries.op5_token_counts(spark, FOLDER).toPandas()
    (rollup,) = made
    deltas = rollup.deltas()
    assert deltas.where("docs < 0 AND tokens < 0 AND lang IS NULL").count() > 0
    assert deltas.where("docs > 0 AND lang IS NULL").count() > 0
    assert _plain(mine).equals(_plain(connect(FOLDER).execute(queries.ORACLES["op5_token_counts"]).df()))
