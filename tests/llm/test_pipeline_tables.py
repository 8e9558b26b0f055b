"""The whole pipeline on an empty table and on rows with nulls, repeats, very long texts and extra columns."""

from __future__ import annotations

import pytest

import corpus_pipeline
from llm.conftest import rows_of


@pytest.mark.parametrize("kind", ["empty", "odd"])
def test_run_on_tables_of_any_kind(spark, docs, nothing, tmp_path, kind):
    table = nothing if kind == "empty" else docs.unionByName(docs.where("doc_id % 3 = 0")).unionByName(
        docs.limit(1).selectExpr(*[f"CAST(NULL AS {t}) AS `{c}`" for c, t in docs.dtypes])
    )
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(corpus_pipeline.run(spark, str(tmp_path)), "doc_id", "start", "length", "sequence_id", "offset")
    if kind == "empty":
        assert got == []
        return
    assert got and all(r[0] is not None for r in got)
    filled = {}
    for _, _, length, sequence, offset in sorted(got, key=lambda r: (r[3], r[4])):
        assert offset == filled.get(sequence, 0)
        filled[sequence] = offset + length
    assert max(filled.values()) <= 4096
