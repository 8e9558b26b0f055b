"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are sums of signed deltas. A batch inserts
documents (+), deletes them (-) or revises their counts (- the old, + the new). Each batch is
aggregated first and written to a folder of its own; the folder counts once Spark has put its
success marker there. So a batch that breaks off leaves nothing, and one that is committed
again is skipped: commits are idempotent by batch name. ``compact`` folds committed batches
into a snapshot, with the list of their names, which replaces them on reading.

Defined cases: a null or empty text has no tokens and still counts as a document; a null
source or language is a group; repeated rows count each; an empty batch commits; groups
whose documents and tokens have all gone are not listed; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.llm.common import WORD, released_shuffles, text_of
from wearspan.session import work_folder

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source STRING, lang STRING, tokenizer STRING, docs BIGINT, tokens BIGINT"

#: Tokenizer versions: how each counts the tokens of a text.
PIECES = r"[A-Za-z\x{80}-\x{10FFFF}]+|[0-9]|[^\x20\x09-\x0DA-Za-z0-9\x{80}-\x{10FFFF}]"
TOKENIZERS: dict[str, str] = {"words-1": WORD, "pieces-1": PIECES}


def counted(docs: DataFrame, tokenizers: Mapping[str, str] = TOKENIZERS) -> DataFrame:
    """source, lang, tokenizer, tokens: one row per document and version, one pass over the texts."""
    text = text_of(docs)
    each = [F.struct(F.lit(k).alias("tokenizer"), F.regexp_count(text, F.lit(p)).cast("long").alias("tokens")) for k, p in tokenizers.items()]
    return docs.select("source", "lang", F.explode(F.array(*each)).alias("c")).select("source", "lang", "c.tokenizer", "c.tokens")


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).cast("long").alias("docs"), F.col("tokens").cast("long").alias("tokens"))


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("docs"), (-F.col("tokens").cast("long")).alias("tokens"))


def revisions(counts: DataFrame, old: str = "old_tokens", new: str = "tokens") -> DataFrame:
    """Documents that stay and whose count changes from `old` to `new`."""
    return counts.select(*KEYS, F.lit(0).cast("long").alias("docs"), (F.col(new) - F.col(old)).cast("long").alias("tokens"))


class TokenRollup:
    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = (path or work_folder(spark, "llm-rollup")).rstrip("/")

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(target)

    def _folders(self) -> list[str]:
        """Folders that Spark has finished writing."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(n for n in names if self._exists(f"{self.path}/{n}/_SUCCESS"))

    def _state(self) -> tuple[list[str], set[str]]:
        """Folders to read (the newest snapshot, and the batches it does not hold), and all committed names."""
        folders = self._folders()
        batches = {f.removeprefix("batch="): f for f in folders if f.startswith("batch=")}
        snapshots = sorted(f for f in folders if f.startswith("snapshot="))
        if not snapshots:
            return list(batches.values()), set(batches)
        newest = snapshots[-1]
        held = {r[0] for r in self.spark.read.text(f"{self.path}/held-{newest}").collect()}
        return [newest, *(f for n, f in batches.items() if n not in held)], held | set(batches)

    def committed(self) -> set[str]:
        """Names of the batches whose deltas count, also those folded into a snapshot."""
        return self._state()[1]

    def commit(self, batch: str, *deltas: DataFrame) -> bool:
        """Add signed deltas under a batch name (letters, digits, - and _); False if it was committed before."""
        if not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"batch name {batch!r} must be letters, digits, - or _")
        if batch in self.committed():
            return False
        rows = deltas[0]
        for more in deltas[1:]:
            rows = rows.unionByName(more)
        rows = rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        with released_shuffles(self.spark):
            rows.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return True

    def deltas(self) -> DataFrame:
        folders = [f"{self.path}/{f}" for f in self._state()[0]]
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*folders)

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens over all committed batches."""
        sums = self.deltas().groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 OR tokens <> 0")

    def compact(self) -> None:
        """Fold the committed batches into one snapshot; readers see either the batches or the snapshot."""
        folders, names = self._state()
        if len(folders) > 1:
            snapshot = f"snapshot={sum(f.startswith('snapshot=') for f in self._folders()):06d}"
            self.spark.createDataFrame([(n,) for n in sorted(names)], "name string").coalesce(1).write.mode("overwrite").text(f"{self.path}/held-{snapshot}")
            self.totals().write.mode("overwrite").parquet(f"{self.path}/{snapshot}")


def provisional(docs: DataFrame, tokenizer: str) -> DataFrame:
    """A first count without reading texts: one token for four characters by ``n_chars``."""
    return docs.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.expr("coalesce(n_chars, 0) div 4").alias("tokens"))


def token_column(text: Column, tokenizer: str) -> Column:
    return F.regexp_count(text, F.lit(TOKENIZERS[tokenizer])).cast("long")
