"""Near-duplicate documents: an exact Jaccard join on word shingles by several global orders.

Two sets that link share a token among their first ``n - ceil(t * n) + 1`` tokens, whichever
global order of tokens is taken. Candidates must do so under each of two orders, and pass the
length and position filters, before their texts are compared. Both orders put frequent tokens
last: frequencies come from a counter sketch of fixed size over all documents, whose cells
only influence the order, never the result.

Documents with the same set are one class. To keep large groups of near copies from meeting
pair by pair, classes are first tied to one class that has the same first token under one of
several orders: the one with the largest share of frequent tokens, which in a group of near
copies is the least edited (a link is only made after comparing the texts). The exact join
then asks only for pairs between different components of these links: a token whose classes
are all in one component gives no candidates, and copies with many tokens of their own fail
the position filter, as these come first.

Defined cases: a null, empty or wordless text has no shingles, links with nothing and is its
own component; under SHINGLE words the whole sequence is the one shingle; copies and repeated
rows are one class; a null doc_id is kept and is a component's id only if it has no other; an
empty table gives no rows; other columns are ignored by ``near_duplicates``. Shingles and texts
are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearspan.llm.common import WORD, dropped, settled
from wearspan.llm.components import components
from wearspan.llm.hashing import Prefix, Words, mix, text_blocks
from wearspan.llm.repeats import named

SHINGLE = 4
PERCENT = 85
#: Counters of the frequency sketch; it is broadcast as a byte for each.
CELLS = 1 << 20
PARTS = 64
#: Tasks that add up a part of the counters before the last.
SALTS = 8
#: Mixing constants of the two orders of the exact join, and of those whose first tokens tie classes together.
ORDERS = (0x0, 0xA0761D6478BD642F)
SEEDS = (0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

SIGNATURES = pa.schema(
    [("doc_id", pa.int64()), ("k", pa.int64()), ("nb", pa.int32()), ("cid", pa.int64()), ("n", pa.int32())]
    + [("share", pa.int32()), ("first", pa.list_(pa.int64())), ("one", pa.list_(pa.int64())), ("two", pa.list_(pa.int32()))]
)
SIGNATURES_DDL = "doc_id BIGINT, k BIGINT, nb INT, cid BIGINT, n INT, share INT, first ARRAY<BIGINT>, one ARRAY<BIGINT>, two ARRAY<INT>"


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a block, by document, and their offsets."""
    words = Words(_LOWER[data], offsets)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    prefix, begin = Prefix(words.hashes()), words.offsets
    n = np.diff(begin)
    count = np.where(n == 0, 0, np.maximum(1, n - size + 1))
    at = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(n)), count)
    starts = begin[doc] + np.arange(at[-1]) - at[doc]
    ends = np.minimum(starts + size, begin[doc + 1])
    return prefix.hash(starts, ends), at


def _count_cells(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.uint32)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column("text")):
                h, _ = shingles(data, offsets, size)
                cells += np.bincount((h & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS).astype(np.uint32)
        if cells.any():
            parts = [p.tobytes() for p in np.split(cells, PARTS)]
            yield pa.RecordBatch.from_pydict({"part": pa.array(range(PARTS), pa.int32()), "cells": pa.array(parts, pa.binary())})

    return run


def _sum_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters by part, added up as they stream in."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, cells in zip(batch.column("part").to_pylist(), batch.column("cells"), strict=True):
            raw = cells.as_buffer()
            counts = np.frombuffer(raw, np.uint32 if raw.size == CELLS // PARTS * 4 else np.uint64)
            total[part] = total[part] + counts if part in total else counts.astype(np.uint64)
    for part, counts in total.items():
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "cells": pa.array([counts.tobytes()], pa.binary())})

#: Rows of a batch that goes to Python; it holds their whole texts.
FEW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def levels(texts: DataFrame, size: int = SHINGLE) -> bytes:
    """A byte per cell: 0 for cells as full as others, else the binary order of what is above."""
    ddl = "part INT, cells BINARY"
    counted = texts.select("text").mapInArrow(_count_cells(size), ddl).withColumn("salt", F.spark_partition_id() % SALTS)
    some = counted.repartition("part", "salt").select("part", "cells").mapInArrow(_sum_cells, ddl)
    parts = some.repartition("part").mapInArrow(_sum_cells, ddl).collect()  # CELLS counters in all
    total = np.zeros((PARTS, CELLS // PARTS), np.float64)
    for row in parts:
        total[row["part"]] = np.frombuffer(row["cells"], np.uint64)
    mean = total.mean()
    over = (total.ravel() - mean) / (8 * np.sqrt(mean) + 32)
    return np.where(over > 1, 1 + np.log2(np.maximum(over, 1)), 0).astype(np.uint8).tobytes()


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n + (-percent * n) // 100 + 1


def _sign(cell_levels, size: int, percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of = np.frombuffer(cell_levels.value, np.uint8)
        for batch in batches:
            rows: list[tuple] = []
            meta = [batch.column(c).to_pylist() for c in ("doc_id", "k", "nb")]
            for row, end, data, offsets in text_blocks(batch.column("text")):
                hashes, at = shingles(data, offsets, size)
                for doc in range(row, end):
                    h = np.unique(hashes[at[doc - row] : at[doc - row + 1]])
                    own = [m[doc] for m in meta]
                    if not len(h):
                        rows.append((*own, None, 0, None, None, None, None))
                        continue
                    level = level_of[(h & np.uint64(CELLS - 1)).astype(np.int64)]
                    share = int(1000 * np.count_nonzero(level) // len(h))
                    p = prefix_length(len(h), percent)
                    one, two = (h[np.lexsort((mix(h ^ np.uint64(order)), level))[:p]] for order in ORDERS)
                    first = [int(h[np.argmin(mix(h ^ np.uint64(seed)))].view(np.int64)) for seed in SEEDS]
                    cid = xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63)
                    rows.append((*own, cid, len(h), share, first, one.view(np.int64), (two >> np.uint64(32)).astype(np.uint32).view(np.int32)))
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SIGNATURES, strict=True)], schema=SIGNATURES)

    return run


def _verify(size: int, percent: int):
    def sets(column: pa.Array) -> Iterator[np.ndarray]:
        for row, end, data, offsets in text_blocks(column):
            hashes, at = shingles(data, offsets, size)
            for doc in range(end - row):
                yield np.unique(hashes[at[doc] : at[doc + 1]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):  # few sets at a time in memory
                part = batch.slice(begin, 256)
                linked = []
                for a, b in zip(sets(part.column("tu")), sets(part.column("tv")), strict=True):
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    linked.append(100 * common >= percent * (len(a) + len(b) - common))
                yield part.select(["u", "v"]).filter(pa.array(linked, pa.bool_()))

    return run


def _links(pairs: DataFrame, names: DataFrame, texts: DataFrame, size: int, percent: int, purpose: str) -> DataFrame:
    """The pairs (u, v) of classes whose texts link. names: cid, k, nb of a text of each class."""
    pairs = settled(pairs, f"{purpose}-pairs")
    asked = pairs.select(F.col("u").alias("cid")).union(pairs.select("v")).distinct()
    wanted = names.join(asked, "cid").select("cid", "k", "nb")
    wanted = texts.join(wanted, ["k", "nb"]).select("cid", "text").dropDuplicates(["cid"])
    wanted = settled(wanted, f"{purpose}-texts", FEW_ROWS)
    u, v = (wanted.select(F.col("cid").alias(x), F.col("text").alias(f"t{x}")) for x in ("u", "v"))
    links = settled(pairs.join(u, "u").join(v, "v").mapInArrow(_verify(size, percent), "u BIGINT, v BIGINT"), f"{purpose}-links", FEW_ROWS)
    for read in (pairs, wanted):
        dropped(read)
    return links


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, k, nb (the text's name), n_shingles, root (names the component; null without shingles), component_id."""
    docs = docs.withColumn("doc_id", docs["doc_id"].cast("long"))
    texts = named(docs, "doc_id")
    cell_levels = docs.sparkSession.sparkContext.broadcast(levels(texts, size))
    signed = settled(texts.mapInArrow(_sign(cell_levels, size, percent), SIGNATURES_DDL), "signatures", FEW_ROWS)
    members = settled(signed.select("doc_id", "k", "nb", "n", "cid"), "members")
    filled = signed.where("n > 0")
    # members of a class have equal columns, but for their names, of which the least is taken
    names = settled(filled.groupBy("cid").agg(F.min(F.struct("k", "nb")).alias("name")).select("cid", "name.*"), "names")

    seeds = filled.select("cid", "share", F.posexplode("first").alias("order", "token"))
    leaders = seeds.groupBy("order", "token").agg(F.max(F.struct("share", "cid")).getField("cid").alias("v"))
    seeds = seeds.join(leaders, ["order", "token"]).where("cid <> v").select(F.col("cid").alias("u"), "v").distinct()
    tied = _links(seeds, names, texts, size, percent, "seed")
    roots = components(tied).withColumnRenamed("node", "cid")

    own = filled.dropDuplicates(["cid"]).select("cid", "n", "one", "two")
    own = own.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    own = settled(own, "classes")
    dropped(signed)
    tokens = own.select("cid", "n", "root", F.posexplode("one").alias("at", "token"))
    mixed = tokens.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
    mixed = settled(mixed, "mixed-tokens")
    shared = settled(tokens.join(mixed, "token", "left_semi"), "shared-tokens")
    dropped(mixed)
    x, y = (shared.select("token", *[F.col(c).alias(f"{c}_{s}") for c in ("cid", "n", "root", "at")]) for s in "xy")
    both = x.join(y, "token").where("root_x < root_y")
    need = F.ceil(F.expr(f"{percent} * (n_x + n_y) / {100 + percent}"))
    both = both.where(f"100 * least(n_x, n_y) >= {percent} * greatest(n_x, n_y)")
    both = both.where(F.least(F.col("n_x") - F.col("at_x"), F.col("n_y") - F.col("at_y")) >= need)
    pairs = settled(both.select(F.col("cid_x").alias("u"), F.col("cid_y").alias("v")).distinct(), "one-order")
    dropped(shared)
    second = own.select("cid", "two")
    u, v = (second.select(F.col("cid").alias(c), F.col("two").alias(f"two_{c}")) for c in "uv")
    both = pairs.join(u, "u").join(v, "v").where(F.arrays_overlap("two_u", "two_v")).select("u", "v")
    more = _links(both, names, texts, size, percent, "join")
    for read in (pairs, own):
        dropped(read)

    roots = components(tied.unionByName(more)).withColumnRenamed("node", "cid")
    rows = members.select("doc_id", "k", "nb", F.col("n").cast("long").alias("n_shingles"), "cid").join(roots, "cid", "left")
    rows = settled(rows.withColumn("root", F.coalesce("root", "cid")), "roots")
    dropped(members)
    lowest = rows.where("root IS NOT NULL").groupBy(F.col("root").alias("of")).agg(F.min("doc_id").alias("lowest"))
    rows = rows.join(lowest, F.col("root") == F.col("of"), "left")
    return rows.select("doc_id", "k", "nb", "n_shingles", "root", F.coalesce("lowest", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents, with all their columns, one of each component: that with the least doc_id; all wordless rows."""
    found = near_duplicates(docs, size, percent)
    member = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "k", "nb")
    alone = F.when(F.col("root").isNull(), F.struct("doc_id", "k", "nb"))
    stay = found.groupBy("root", alone.alias("alone")).agg(F.min(member).alias("stay"))
    stay = stay.select(F.col("stay.doc_id").alias("of"), F.col("stay.k").alias("k_of"), F.col("stay.nb").alias("nb_of"))
    whole = F.struct("*").alias("doc")
    rows = named(docs.withColumn("doc", whole), "doc")
    own = F.when(~F.col("text").cast("string").rlike(WORD), F.monotonically_increasing_id())  # a wordless row is a component
    rows = rows.select("doc", "k", "nb", F.col("doc.doc_id").cast("long").alias("id"), own.alias("own"))
    same = (F.col("k") == F.col("k_of")) & (F.col("nb") == F.col("nb_of")) & F.col("id").eqNullSafe(F.col("of"))
    return rows.join(stay, same, "left_semi").dropDuplicates(["id", "k", "nb", "own"]).select("doc.*")
