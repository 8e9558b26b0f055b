"""Which windows of `win` units (words or bytes) of a corpus start at two places or more.

1. Anchors. Of the `gram`-unit runs in a window the one with the least rolling hash is its
   anchor (rightmost of equals), so equal windows have equal anchors at equal distance, and
   consecutive starts share one. An occurrence is an anchor with the run of starts it serves;
   its context reaches from the first start to the end of the last window.
2. Contexts that occur twice or more repeat at all their starts. Counting them is an
   aggregation with map-side sums, so large groups of copies do not meet in one task.
3. Different contexts of one anchor are extended both ways: sorted by what follows the anchor
   and, again, by what precedes it (read backwards), a context has its longest match on either
   side beside it. A neighbour that agrees on l units to the left and r to the right proves the
   starts with at most l units before the anchor and at most r from it on. The longest matches
   to either side bound what can repeat at all. Where proof and bound differ, the windows of
   that anchor's contexts are counted one by one.

The sorts are range-partitioned, so one anchor may spread over many tasks; neighbours across
a partition border are compared on the driver, two rows per partition.

Texts are named by a 64-bit hash and their length in bytes; equal texts share a name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearspan.llm.common import settled, text_of
from wearspan.llm.hashing import Prefix, Words, mix, text_blocks

#: Units of a block, their offsets by document, and bytes of a unit in a context.
Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]

#: Sampled sort keys reach the driver whole, some hundred bytes each; a range needs no more than these.
FEWER_SAMPLES = {"spark.sql.execution.rangeExchange.sampleSizePerPartition": "20"}

OCCURRENCES = "a BIGINT, e BIGINT, k BIGINT, nb INT, s INT, shape INT"
ENTRIES = "a BIGINT, e BIGINT, c BIGINT, shape INT, left BINARY, right BINARY"
NEIGHBOURS = "a BIGINT, e BIGINT, reach INT, lo INT, hi INT, part INT, edge INT, c BIGINT, shape INT, left BINARY, right BINARY"


def byte_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data, offsets


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = Words(data, offsets)
    return (words.hashes() if len(words) else np.zeros(0, np.uint64)), words.offsets


def _schema(ddl: str) -> pa.Schema:
    kinds = {"BIGINT": pa.int64(), "INT": pa.int32(), "BINARY": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in ddl.split(", "))])


def _batch(ddl: str, columns: list) -> pa.RecordBatch:
    schema = _schema(ddl)
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def named(docs: DataFrame, *keep: str) -> DataFrame:
    """k, nb (the text's name), text (bytes), and columns to keep."""
    text = text_of(docs)
    return docs.select(*keep, F.xxhash64(text).alias("k"), F.octet_length(text).alias("nb"), text.cast("binary").alias("text"))


def anchor_runs(units: np.ndarray, offsets: np.ndarray, win: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, first start, starts, anchor's place after the first start, anchor hash, context hash) per occurrence."""
    n = len(units) - win + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    prefix = Prefix(units)
    grams = prefix.grams(gram)
    low = np.uint64(0xFFFFFFFF)
    keys = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
    span, least, size = 1, keys, win - gram + 1
    while span * 2 <= size:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < size:
        least = np.minimum(least[: len(least) - (size - span)], least[size - span :])
    at = (low - (least & low)).astype(np.int64)
    valid = np.ones(n + 1, bool)
    valid[n] = False
    for end in offsets[1:]:
        valid[max(0, end - win + 1) : min(n, end)] = False
    valid = valid[:n]
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(at[1:], at[:-1], out=change[1:])
    change[1:] |= ~valid[:-1]
    first = np.flatnonzero(change & valid)
    stop = np.append(change[1:], True)
    stop[:-1] |= ~valid[1:]
    last = np.flatnonzero(stop & valid)
    place = at[first] - first
    context = mix(prefix.hash(first, last + win) + place.astype(np.uint64))
    doc = np.searchsorted(offsets, first, "right") - 1
    return doc, first, last - first + 1, place, grams[at[first]], context


def _occurrences(units: Units, win: int, gram: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, nb = batch.column("k").to_numpy(), batch.column("nb").to_numpy()
            for row, _, data, offsets in text_blocks(batch.column("text")):
                u, o = units(data, offsets)
                doc, first, n, place, a, e = anchor_runs(u, o, win, gram)
                at = doc + row
                shape = (n << 16 | place).astype(np.int32)
                yield _batch(OCCURRENCES, [a.view(np.int64), e.view(np.int64), k[at], nb[at], (first - o[doc]).astype(np.int32), shape])

    return run


def _contexts(units: Units):
    """Entries of a text: the units before its anchor, nearest first, and from the anchor on."""

    def run(win: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            lists = batch.column("found").to_pylist()
            for row, end, data, offsets in text_blocks(batch.column("text")):
                u, o = units(data, offsets)
                for doc in range(row, end):
                    at = o[doc - row]
                    for f in lists[doc]:
                        n, place = f["shape"] >> 16, f["shape"] & 0xFFFF
                        s = at + f["s"]
                        q = s + place
                        out.append((f["a"], f["e"], f["c"], f["shape"], u[s:q][::-1].tobytes(), u[q : s + n - 1 + win].tobytes()))
            if out:
                yield _batch(ENTRIES, list(zip(*out, strict=True)))

    return run


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Binary values as rows of bytes, padded; and their lengths."""
    rows = column.to_pylist()
    joined = b"".join(r.ljust(width, b"\0") for r in rows)
    return np.frombuffer(joined, np.uint8).reshape(len(rows), width), np.array([len(r) for r in rows])


def _common(matrix: np.ndarray, lengths: np.ndarray, unit: int) -> np.ndarray:
    """Units that each row and the next agree on from the start."""
    differ = matrix[:-1] != matrix[1:]
    first = np.where(differ.any(1), differ.argmax(1), matrix.shape[1])
    return np.minimum(np.minimum(lengths[:-1], lengths[1:]), first) // unit


def _compare(rows: list[dict], win: int, unit: int, side: str) -> list[tuple]:
    """What neighbours in order prove: per pair (reach on the side sorted by, first and last distance to the anchor)."""
    a = np.array([r["a"] for r in rows])
    common = {}
    for name in ("left", "right"):
        column = pa.array([r[name] for r in rows], pa.binary())
        width = max(1, max(len(r[name]) for r in rows))
        common[name] = np.where(a[:-1] == a[1:], _common(*_matrix(column, width), unit), 0)
    lo = win - common["right"]
    hi = np.where(a[:-1] == a[1:], common["left"], -1)
    return list(zip(common[side].tolist(), lo.tolist(), hi.tolist(), strict=True))


def _neighbours(win: int, unit: int, side: str):
    """One row per context and neighbour; the first and last of a partition once more, whole, with `edge` set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, first = TaskContext.get().partitionId(), None, None
        for batch in batches:
            rows = batch.to_pylist()
            if not rows:
                continue
            first = first or rows[0]
            rows = [held, *rows] if held else rows
            held, out = rows[-1], []
            if len(rows) > 1:
                for (reach, lo, hi), x, y in zip(_compare(rows, win, unit, side), rows[:-1], rows[1:], strict=True):
                    if hi >= 0:
                        out += [(r["a"], r["e"], reach, lo, hi, part, 0, None, None, None, None) for r in (x, y)]
            if out:
                yield _batch(NEIGHBOURS, list(zip(*out, strict=True)))
        edges = [(r["a"], r["e"], None, None, None, part, n, r["c"], r["shape"], r["left"], r["right"]) for n, r in ((1, first), (2, held)) if r]
        if edges:
            yield _batch(NEIGHBOURS, list(zip(*edges, strict=True)))

    return run


def _sorted_matches(entries: DataFrame, win: int, unit: int, side: str) -> DataFrame:
    """a, e, reach, lo, hi for the neighbours of every context in the order of one side."""
    other = "left" if side == "right" else "right"
    order = ["a", side, other, "e"]
    ordered = entries.repartitionByRange(*order).sortWithinPartitions(*order)
    found = settled(ordered.mapInArrow(_neighbours(win, unit, side), NEIGHBOURS), f"order-{side}", FEWER_SAMPLES)
    ends = [r.asDict() for r in found.where("edge > 0").orderBy("part", "edge").collect()]  # two rows per partition
    across = []
    for x, y in zip(ends[:-1], ends[1:], strict=True):
        if x["edge"] == 2 and y["edge"] == 1 and x["a"] == y["a"]:
            ((reach, lo, hi),) = _compare([x, y], win, unit, side)
            across += [(r["a"], r["e"], reach, lo, hi) for r in (x, y)]
    found = found.where("edge = 0").select("a", "e", "reach", "lo", "hi")
    if across:
        found = found.unionByName(entries.sparkSession.createDataFrame(across, "a bigint, e bigint, reach int, lo int, hi int"))
    return found


def _windows(win: int, unit: int):
    """Every window of a context: its distance to the anchor and its hash."""
    ddl = "a BIGINT, e BIGINT, c BIGINT, x INT, h BIGINT"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for r in batch.to_pylist():
                n, place = r["shape"] >> 16, r["shape"] & 0xFFFF
                kind = np.uint8 if unit == 1 else np.uint64
                units = np.concatenate([np.frombuffer(r["left"], kind)[::-1], np.frombuffer(r["right"], kind)])
                starts = np.arange(n)
                h = mix(Prefix(units).hash(starts, starts + win) ^ mix(Prefix(units, 1).hash(starts, starts + win)))
                for column, value in zip(out, ([r["a"]] * n, [r["e"]] * n, [r["c"]] * n, (place - starts).tolist(), h.view(np.int64).tolist()), strict=True):
                    column.extend(value)
            yield _batch(ddl, out)

    return run, ddl


def repeated_starts(docs: DataFrame, units: Units, unit: int, win: int, gram: int) -> DataFrame:
    """k, nb, spans: per named text the runs (s, n) of window starts whose window occurs elsewhere.

    Runs may overlap; a text without any has no row. unit: bytes of a unit in memory (1 or 8).
    """
    texts = named(docs)
    found = texts.mapInArrow(_occurrences(units, win, gram), OCCURRENCES)
    one = F.min(F.struct("k", "nb", "s", "shape")).alias("one")
    contexts = found.groupBy("a", "e").agg(F.count("*").alias("c"), one)
    variants = contexts.groupBy("a").agg(F.count("*").alias("v")).where("v > 1").select(F.col("a").alias("va"))
    known = contexts.join(variants, F.col("a") == F.col("va"), "left")
    known = known.withColumn("many", F.col("va").isNotNull()).where("c > 1 OR many")
    known = settled(known.select("a", "e", "c", "many", "one.*"), "contexts")

    twice = known.where("c > 1").select("a", "e")
    whole = found.join(twice, ["a", "e"], "left_semi").select("k", "nb", F.struct("s", F.shiftright("shape", 16).alias("n")).alias("run"))
    whole = settled(whole.groupBy("k", "nb").agg(F.collect_set("run").alias("runs")), "whole-runs")

    varied = known.where("many")
    asked = varied.groupBy("k", "nb").agg(F.collect_list(F.struct("a", "e", "c", "s", "shape")).alias("found"))
    cut = _contexts(units)
    entries = texts.join(asked, ["k", "nb"]).dropDuplicates(["k", "nb"]).select("text", "found")
    entries = settled(entries.mapInArrow(lambda it: cut(win, it), ENTRIES), "entries")
    right, left = (_sorted_matches(entries, win, unit, side) for side in ("right", "left"))
    none = F.lit(0)
    matches = right.select("a", "e", F.col("reach").alias("r"), none.alias("l"), "lo", "hi").unionByName(
        left.select("a", "e", none.alias("r"), F.col("reach").alias("l"), "lo", "hi")
    )
    matches = matches.groupBy("a", "e").agg(F.max("r").alias("r"), F.max("l").alias("l"), F.collect_set(F.struct("lo", "hi")).alias("proofs"))
    single = varied.where("c = 1").join(matches, ["a", "e"])
    # distances x to the anchor: those the starts have, and those that the longest matches allow
    single = single.withColumns({"n": F.shiftright("shape", 16), "place": F.col("shape").bitwiseAND(0xFFFF)})
    single = single.withColumns(
        {
            "from": F.greatest(win - F.col("r"), F.col("place") - F.col("n") + 1),
            "to": F.least("l", "place"),
        }
    )
    reach = F.aggregate(
        F.array_sort("proofs"), F.col("from") - 1, lambda at, p: F.when(p["lo"] <= at + 1, F.greatest(at, p["hi"])).otherwise(at)
    )
    single = settled(single.where("from <= to").withColumn("proven", reach >= F.col("to")), "single")
    clear = single.select("k", "nb", F.explode("proofs").alias("p"), "s", "n", "place")
    clear = clear.withColumns({"lo": F.greatest("p.lo", F.col("place") - F.col("n") + 1), "hi": F.least("p.hi", "place")}).where("lo <= hi")
    clear = clear.select("k", "nb", (F.col("s") + F.col("place") - F.col("hi")).alias("s"), (F.col("hi") - F.col("lo") + 1).alias("n"))

    windows, ddl = _windows(win, unit)
    unclear = entries.join(single.where("NOT proven").select("a").distinct(), "a", "left_semi").mapInArrow(windows, ddl)
    equal = unclear.groupBy("a", "x", "h").agg(F.count("*").alias("times")).where("times > 1").drop("times")
    one_by_one = unclear.where("c = 1").join(equal, ["a", "x", "h"], "left_semi").join(varied.select("a", "e", "k", "nb", "s", "shape"), ["a", "e"])
    place = F.col("shape").bitwiseAND(0xFFFF)
    one_by_one = one_by_one.select("k", "nb", (F.col("s") + place - F.col("x")).alias("s"), F.lit(1).alias("n"))

    runs = clear.unionByName(one_by_one).select("k", "nb", F.struct("s", "n").alias("run"))
    runs = runs.groupBy("k", "nb").agg(F.collect_set("run").alias("runs"))
    both = whole.unionByName(runs).groupBy("k", "nb").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    return settled(both, "runs")


def covered(runs: list[dict] | None, win: int) -> list[tuple[int, int]]:
    """Maximal runs [begin, end) of units covered by windows starting in the given runs."""
    spans: list[list[int]] = []
    for s, n in sorted((r["s"], r["n"]) for r in runs or ()):
        end = s + n - 1 + win
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([s, end])
    return [(s, e) for s, e in spans]
