"""Substring dedup of texts by words: seed on winnowed anchors, extend both ways, cut the repeats.

Anchors are winnowed 8-word runs, so that each window of MIN_WORDS words holds one. Documents
that share an anchor are compared by extending the match from it to both sides; what is at
least MIN_WORDS words long is a repeat (see ``repeats`` for the steps).

Defined cases: a null or empty text has no words and keeps none; texts under MIN_WORDS words
stay whole; of repeated texts every copy is removed, as each occurs elsewhere; repeated rows
are such copies; a null doc_id is kept; an empty table gives no rows; other columns are
ignored. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from wearspan.llm.hashing import SPACES
from wearspan.llm.repeats import covered, named, repeated_starts, word_units

MIN_WORDS = 35
ANCHOR_WORDS = 8
SPANS = "doc_id BIGINT, n_words BIGINT, n_removed BIGINT, kept_sha256 STRING, kept STRING"
TO_SPACE = bytes.maketrans(SPACES, b" " * len(SPACES))


def _cut(win: int, with_text: bool):
    names = [c.split()[0] for c in SPANS.split(", ")][: 5 if with_text else 4]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    schema = pa.schema(list(zip(names, kinds, strict=False)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, runs in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                words = text.translate(TO_SPACE).split()
                kept, at = [], 0
                for begin, end in covered(runs, win):
                    kept += words[at:begin]
                    at = end
                kept += words[at:]
                joined = b" ".join(kept)
                row = (doc_id, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest())
                out.append((*row, joined.decode()) if with_text else row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, anchor_words: int = ANCHOR_WORDS, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept (the words left, joined by spaces)."""
    runs = repeated_starts(docs, word_units, 8, min_words, anchor_words)
    docs = docs.withColumn("doc_id", docs["doc_id"].cast("long"))
    rows = named(docs, "doc_id").join(runs, ["k", "nb"], "left").select("doc_id", "text", "runs")
    return rows.mapInArrow(_cut(min_words, with_text), SPANS if with_text else SPANS.rpartition(",")[0])
