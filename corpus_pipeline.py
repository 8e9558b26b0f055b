"""A corpus pipeline of five operators: filter, dedup twice, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet in
the shared working folder and reads it back as the documents of the next stage. All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wearspan.llm import exact, jaccard, mixing, packing, quality
from wearspan.llm.common import documents, settled
from wearspan.llm.queries import vocabulary

#: What near_dedup takes for near copies; op6_ngram_jaccard alone is bound to 4 words and 85 percent.
NEAR_WORDS = 5
NEAR_PERCENT = 80
#: Words whose ids a packing worker remembers; workers stay in memory beside the other stages.
CACHE_WORDS = 250_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the adaptive rules accept."""
    return quality.accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, by a digest index of this run."""
    return exact.keep_first(docs, exact.DigestIndex(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: four fifths of the shingles of NEAR_WORDS words in common."""
    return jaccard.keep_one(docs, NEAR_WORDS, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeat(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    return packing.pack(docs, vocabulary(), cache_words=CACHE_WORDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Packing needs a tokenizer, which SQL has not; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
