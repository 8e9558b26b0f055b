"""Rows without words link with nothing, so keep_one keeps each of them, also repeated ones."""

from __future__ import annotations

from llm.conftest import rows_of
from wearspan.llm import jaccard


def test_keep_one_keeps_repeated_wordless_rows(make):
    docs = make([(None, ""), (None, ""), (None, None), (4, " \n"), (4, " \n"), (5, "some words"), (5, "some words"), (None, "some words")])
    want = sorted([(None, ""), (None, ""), (None, None), (4, " \n"), (4, " \n"), (5, "some words")], key=repr)
    assert rows_of(jaccard.keep_one(docs), "doc_id", "text") == want
