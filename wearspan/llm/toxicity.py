"""Toxicity scores by FTRL-proximal logistic regression over hashed n-grams.

Features are the words of a text, their beginnings, pairs of neighbours, and pairs that skip
one word, each present or not, hashed to 2**BITS indices. Training reads at most SAMPLE
labelled rows (a documented bound: the rows first in a seeded hash order) in one task, with a
learning rate per coordinate and L1, which leaves most weights at zero. The few that remain
are broadcast (at most 2**BITS numbers) and every document is scored in the scan, whole.

Defined cases: a null or empty text has no features and scores the bias alone; labels that are
null or without document are ignored, repeated ones count as toxic if one is; a null doc_id is
scored and not held out; repeated rows score the same; without labels every score is 0.5;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearspan.llm.common import settled, text_of
from wearspan.llm.hashing import Prefix, Words, mix, rows_of, text_blocks

BITS = 20
SAMPLE = 20_000
EPOCHS = 5
#: Sampled documents that must have a feature.
MIN_DOCS = 5
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 0.1
FOLDS = 5
SALTS = (0x9E37, 0x79B9, 0x7F4A, 0x7C15)
#: Lengths in bytes of the word beginnings that are features too, for inflected and compound words.
STEMS = (4, 5, 6, 7, 8)

#: Letters and digits as they are, in lower case; other ASCII separates words.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[:128][~np.isin(np.arange(128), [*range(48, 58), *range(65, 91), *range(97, 123)])] = 32


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, index) of the features of a block; an index may come several times."""
    words = Words(_FOLD[data], offsets)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    prefix, doc = Prefix(words.data), rows_of(words.offsets)
    h = prefix.hash(words.starts, words.ends)
    docs, found = [doc], [mix(h + np.uint64(SALTS[0]))]
    for length in STEMS:
        longer = words.ends - words.starts > length
        begin = words.starts[longer]
        docs.append(doc[longer])
        found.append(mix(prefix.hash(begin, begin + length) + np.uint64(SALTS[3])))
    for gap in (1, 2):
        same = doc[gap:] == doc[:-gap]
        docs.append(doc[gap:][same])
        found.append(mix(h[:-gap][same] * np.uint64(2 * gap + 1) + h[gap:][same] + np.uint64(SALTS[gap])))
    return np.concatenate(docs), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """FTRL-proximal for binary features; the last coordinate is the bias, without L1."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.size = size

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == self.size, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _train(table: pa.Table) -> pa.Table:
    """FTRL over the sample, in its hash order. Two passes over the texts: only frequent features are held."""
    table = table.sort_by([("turn", "ascending"), ("of", "ascending")])
    labels, size = table.column("toxic").to_pylist(), 1 << BITS
    seen, rows = np.zeros(size, np.int64), []
    for keep in (False, True):
        for _, _, data, offsets in text_blocks(table.column("text")):
            doc, index = features(data, offsets)
            pairs = np.unique(doc << BITS | index)
            doc, index = pairs >> BITS, pairs & (size - 1)
            if not keep:
                seen += np.bincount(index, minlength=size)
                continue
            frequent = seen[index] >= MIN_DOCS
            doc, index = doc[frequent], index[frequent]
            bounds = np.searchsorted(doc, np.arange(len(offsets)))
            rows += [np.append(index[a:b], size).astype(np.int32) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    model = Ftrl(size)
    for _ in range(EPOCHS):
        for at, label in zip(rows, labels, strict=True):
            model.learn(at, label)
    weights = model.weights(np.arange(size + 1))
    kept = np.flatnonzero(weights)
    return pa.table({"at": pa.array(kept, pa.int64()), "weight": pa.array(weights[kept], pa.float64())})


def in_fold(doc_id: Column) -> Column:
    """Whether a document is held out: crc32 of its id as text is divisible by FOLDS."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[int, float]:
    """Non-zero weights by index (2**BITS is the bias), learnt from labelled rows that are not held out."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~in_fold(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("of")).agg(F.max("toxic").cast("int").alias("toxic"))
    turn = F.xxhash64("of", F.lit("toxicity"))
    chosen = settled(known.withColumn("turn", turn).orderBy("turn", "of").limit(sample), "sample")
    # at most `sample` rows of a few bytes, whatever the input
    rows = docs.select(docs["doc_id"].cast("long").alias("of"), text_of(docs).cast("binary").alias("text")).join(F.broadcast(chosen), "of")
    fitted = rows.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(_train, "at BIGINT, weight DOUBLE")
    return {r["at"]: r["weight"] for r in fitted.collect()}  # at most 2**BITS + 1


def _score(weights):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, value = weights.value
        dense = np.zeros((1 << BITS) + 1)
        dense[at] = value
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            for row, end, data, offsets in text_blocks(batch.column("text")):
                doc, index = features(data, offsets)
                hit = dense[index] != 0
                pairs = np.unique(doc[hit] << BITS | index[hit])
                total = np.bincount(pairs >> BITS, dense[pairs & ((1 << BITS) - 1)], minlength=end - row) + dense[-1]
                scores[row:end] = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(scores)})

    return run


def score(docs: DataFrame, weights: dict[int, float]) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    pairs = sorted(weights.items())
    compact = (np.array([a for a, _ in pairs], np.int64), np.array([w for _, w in pairs], np.float64))
    shared = docs.sparkSession.sparkContext.broadcast(compact)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), in_fold(docs["doc_id"]).alias("held_out"), text_of(docs).cast("binary").alias("text"))
    scored = rows.mapInArrow(_score(shared), "doc_id BIGINT, held_out BOOLEAN, score DOUBLE")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
