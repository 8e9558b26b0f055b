"""Substring dedup by bytes, by the method of op2 (``repeats``) with bytes as units.

Winnowing picks an anchor of TRIGGER bytes (the least of a window, so that every string of
MIN_BYTES bytes holds one). The different contexts of an anchor are sorted by what follows and
by what precedes it; neighbours give the strings of MIN_BYTES bytes that occur twice. No phrase
dictionary, parse or suffix array is built. Anchors with one context only are not sorted.

Defined cases: a null or empty text has no bytes; texts under MIN_BYTES bytes stay whole; of
repeated texts every copy is removed, as each occurs elsewhere; repeated rows are such copies;
a null doc_id is kept; an empty table gives no rows; other columns are ignored. Cuts may split
a character: what is left is bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from wearspan.llm.repeats import byte_units, covered, named, repeated_starts

MIN_BYTES = 200
TRIGGER = 48
SPANS = "doc_id BIGINT, n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept_sha256 STRING, kept BINARY"


def _cut(win: int, with_text: bool):
    names = [c.split()[0] for c in SPANS.split(", ")][: 6 if with_text else 5]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    schema = pa.schema(list(zip(names, kinds, strict=False)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, runs in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                spans = covered(runs, win)
                kept, at = [], 0
                for begin, end in spans:
                    kept.append(text[at:begin])
                    at = end
                left = b"".join([*kept, text[at:]])
                row = (doc_id, len(text), len(text) - len(left), len(spans), hashlib.sha256(left).hexdigest())
                out.append((*row, left) if with_text else row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def remove_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, trigger: int = TRIGGER, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (the bytes left)."""
    runs = repeated_starts(docs, byte_units, 1, min_bytes, trigger)
    docs = docs.withColumn("doc_id", docs["doc_id"].cast("long"))
    rows = named(docs, "doc_id").join(runs, ["k", "nb"], "left").select("doc_id", "text", "runs")
    return rows.mapInArrow(_cut(min_bytes, with_text), SPANS if with_text else SPANS.rpartition(",")[0])
