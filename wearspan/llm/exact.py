"""Exact dedup against a persistent digest index, bucketed and sorted by hash.

Texts are equal when they are identical after deleting space, \\t, \\n, \\v, \\f and \\r.
The index has one row per distinct text ever seen. A new batch is reduced to one row per
digest, compared with the index by sort-merge anti-join, and what is new is appended.

Defined cases: a null text is the empty text; empty texts are copies of each other; a
null ``doc_id`` loses to any other among equals and may be a ``keep_id``; repeated rows
are copies, one of them stays; texts of any length are hashed whole; of equals with the same number
of characters and doc_id any one stays; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearspan.llm.common import settled, text_of, without_spaces
from wearspan.session import work_folder

COLUMNS = "digest BINARY, keep_id BIGINT, keep_chars INT"
#: Spark's readers skip names that begin with an underscore.
MARK = "_buckets-"


class DigestIndex:
    """A bucketed table of text digests in a folder; opening the folder again finds it.

    An append that breaks off leaves no visible rows, and repeating a batch adds nothing,
    because its digests are then in the index already.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        """buckets counts for a new index, by default the session's shuffle partitions; an index keeps its own number.

        That number names an empty file in the folder. Asking for another one is an error, as rows would be looked for in wrong buckets.
        """
        self.spark = spark
        self.path = path or work_folder(spark, "llm-digests")
        self.buckets = self._layout(buckets)
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} ({COLUMNS}) USING parquet LOCATION '{self.path}' "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS"
        )

    def _layout(self, asked: int | None) -> int:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        fs.mkdirs(folder)
        marks = [s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith(MARK)]
        if marks:
            kept = int(marks[0].removeprefix(MARK))
            if asked not in (None, kept):
                raise ValueError(f"{self.path} has {kept} buckets, not {asked}")
            return kept
        count = asked or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        fs.create(self.spark._jvm.org.apache.hadoop.fs.Path(folder, f"{MARK}{count}"), False).close()
        return count

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, winners: DataFrame) -> None:
        """Add the rows (digest, keep_id, keep_chars, one per digest) whose digest is not yet there."""
        new = winners.hint("merge").join(self.rows(), "digest", "left_anti")
        new = settled(new.select("digest", "keep_id", "keep_chars"), "fresh")  # the index can't be read and written at once
        new.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(without_spaces(text), 256))


def digests(docs: DataFrame) -> DataFrame:
    """One row per document, written once: row, doc_id, digest, chars (code points of the original text)."""
    text = text_of(docs)
    return settled(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            digest(text).alias("digest"),
            F.char_length(text).alias("chars"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )


def groups(rows: DataFrame) -> DataFrame:
    """Per digest the row that stays (most characters, then smallest doc_id) and the number of rows."""
    best = F.max(F.struct("chars", F.bitwise_not("doc_id").alias("low"), (-F.col("row")).alias("up"))).alias("best")
    return (
        rows.groupBy("digest")
        .agg(best, F.count("*").alias("group_size"))
        .select(
            "digest",
            "group_size",
            F.bitwise_not("best.low").alias("keep_id"),
            F.col("best.chars").alias("keep_chars"),
            (-F.col("best.up")).alias("keep_row"),
        )
    )


def dedup(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Verdict per document of a batch, and the batch's new texts appended to the index.

    Returns doc_id, keep_id, group_size (copies in this batch), kept, text_sha256. A text
    that an earlier batch brought keeps that batch's document, so all its copies go.
    """
    rows = digests(docs)
    batch = settled(groups(rows), "groups")
    seen = batch.hint("merge").join(index.rows().select("digest", F.col("keep_id").alias("old_id")), "digest")
    seen = settled(seen.select("digest", "old_id", F.lit(True).alias("old")), "seen")
    index.append(batch.select("digest", "keep_id", "keep_chars"))
    verdict = batch.join(seen, "digest", "left")
    old = F.coalesce("old", F.lit(False))
    # two plain shuffles: adaptive execution splits the partitions of frequent digests
    return rows.join(verdict.withColumnRenamed("keep_id", "best_id"), "digest").select(
        "doc_id",
        F.when(old, F.col("old_id")).otherwise(F.col("best_id")).alias("keep_id"),
        "group_size",
        (~old & (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The documents, with all their columns, whose text is new to the index; one of equals stays."""
    rows = digests(docs)
    batch = groups(rows).hint("merge").join(index.rows().select("digest"), "digest", "left_anti")
    batch = settled(batch, "groups")
    index.append(batch.select("digest", "keep_id", "keep_chars"))
    text = text_of(docs)
    mine = docs.select(F.struct("*").alias("doc"), digest(text).alias("digest"), F.char_length(text).alias("chars"))
    same = F.col("doc.doc_id").cast("long").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    winners = batch.select("digest", "keep_id", "keep_chars")
    kept = mine.join(winners, "digest").where(same)
    if not rows.groupBy("digest", "doc_id", "chars").count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["digest"])  # rows that nothing tells apart
    return kept.select("doc.*")
