"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.llm import clustering, collocations, exact, jaccard, mixing, packing, parsing, pii, quality, rollups, secrets, sql, substring, toxicity
from wearspan.llm.common import documents, text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle.strip()
        return fn

    return add


@query(sql.MIX)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query(sql.SUBSTRING)
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(documents(spark, sf_dir))


def vocabulary() -> str:
    """The word tokenizer's file; this module is installed beside the public vocabularies."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op3_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary())


@query(sql.EXACT)
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.dedup(documents(spark, sf_dir), exact.DigestIndex(spark))


#: One in so many documents of op5_token_counts gets its language after it was loaded.
LATE = 8


@query(sql.TOKEN_COUNTS)
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisional counts first, then revised by reading the texts, with a second tokenizer version.

    Every LATE-th document, by a hash, is loaded before its language is known; a batch then deletes
    it and inserts it under its language.
    """
    docs, rollup = documents(spark, sf_dir), rollups.TokenRollup(spark)
    late = F.expr(f"pmod(xxhash64(doc_id), {LATE}) = 0")
    loaded = docs.withColumn("lang", F.when(~late, F.col("lang")))
    early = rollups.inserts(rollups.provisional(loaded, "words-1"))
    rollup.commit("load", early)
    unknown, known = (rollups.provisional(d.where(late), "words-1") for d in (loaded, docs))
    rollup.commit("languages", rollups.deletes(unknown), rollups.inserts(known))
    exact_counts = docs.select(
        "source",
        "lang",
        F.expr("coalesce(n_chars, 0) div 4").alias("old_tokens"),
        rollups.token_column(text_of(docs), "words-1").alias("words"),
        rollups.token_column(text_of(docs), "pieces-1").alias("pieces"),
    )
    revised = rollups.revisions(exact_counts.withColumns({"tokenizer": F.lit("words-1"), "tokens": F.col("words")}))
    added = rollups.inserts(exact_counts.withColumns({"tokenizer": F.lit("pieces-1"), "tokens": F.col("pieces")}))
    rollup.commit("exact", revised, added)
    rollup.commit("load", early)  # a batch that comes again changes nothing
    return rollup.totals()


@query(sql.JACCARD)
def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    weights = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, weights)


@query(sql.PARSING)
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.remove_repeats(documents(spark, sf_dir))


@query(sql.QUALITY)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(documents(spark, sf_dir)).drop("lang", "source")


@query(sql.SECRETS)
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


@query()
def op11_pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(documents(spark, sf_dir))


@query(sql.CLUSTERS)
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query(sql.COLLOCATIONS)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))
