"""Phrase collocations: frequent phrases per language whose words occur together more than apart.

Texts are lower-cased (A to Z), cut into pieces at punctuation and line ends, and pieces into words.

1. Tasks gather the words of their documents into shards of about SHARD_BYTES and write an
   FM-index of each (``fm``), over word ids of the shard's own vocabulary.
2. Bidirectional extension lists a shard's words and pairs with their counts. They are added up
   across shards by 64-bit hash, in parts of numpy arrays. A hash below the least count holds
   no frequent phrase; the places of the others go back to their shards. This only saves work.
3. Shards list what is left of words and pairs, and extend pairs to longer phrases through pairs
   that are left. These rows, with the number of words beside them, are summed by the phrase itself.

A phrase's score is its count squared over the counts of its two parts, for the worst cut.

Defined cases: a null or empty text has no words; a null language is ``und``, together with texts
so marked; repeated rows count again; a text of any length is cut into shards between pieces
(a piece stays whole); ties go to the higher count and then to the smaller phrase by bytes, and
among cuts to the first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearspan.llm.common import dropped, settled, settled_buckets, text_of
from wearspan.llm.fm import FmIndex, last_symbols

MAX_WORDS = 3
LEAST = 10
TOP = 2000
#: A longer phrase swallows those inside it that it accounts for to this part of a hundred.
SWALLOW = 50
MILLION = 1_000_000
#: A language's phrases are ranked in so many parts first.
PARTS = 64
SHARD_BYTES = 3 << 20
#: Words and pairs in one part of the counts by hash.
PART_ENTRIES = 1 << 20
SHARDS = "shard bigint, langs array<string>, words array<bigint>, vocabulary binary, symbol_lang binary, last binary, reverse_last binary"
#: Shards are rows of some megabytes: one at a time goes to Python.
ONE_ROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
PACKED = {"spark.sql.parquet.compression.codec": "zstd"}

_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_ENDS + b"\t", b"\n" * len(_ENDS) + b" ")


# --- shards -------------------------------------------------------------------


def normalised(text: bytes) -> bytes:
    """Lower case, every end of a piece a line feed, every gap of words a space."""
    return text.lower().translate(_TABLE)


def stretches(text: bytes, most: int) -> Iterator[bytes]:
    """A normalised text in stretches of whole pieces, of at most so many bytes where pieces allow it."""
    at = 0
    while len(text) - at > most:
        cut = text.rfind(b"\n", at, at + most)
        cut = text.find(b"\n", at + most) if cut < at else cut
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:]


def symbols_of(text: bytes) -> tuple[np.ndarray, pa.Array]:
    """Word ids from 1, a 0 after each piece, and the words."""
    letters = np.frombuffer(text, np.uint8)
    ends = letters == 10
    edges = np.diff((~(ends | (letters == 32))).view(np.int8), prepend=0, append=0)
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.zeros(0, np.int32), pa.array([], pa.string())
    # words and gaps alternate
    offsets = np.stack([starts, stops], axis=1).astype(np.int32).ravel()
    runs = pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(text)])
    coded = runs.take(pa.array(np.arange(0, len(offsets) - 1, 2))).dictionary_encode()
    ids = coded.indices.to_numpy()
    piece = np.cumsum(ends)[starts]
    cuts = np.concatenate([[0], np.cumsum(piece[1:] != piece[:-1])])
    out = np.zeros(len(ids) + cuts[-1] + 1, np.int32)
    out[np.arange(len(ids)) + cuts] = ids + 1
    return out, coded.dictionary


def shard_row(number: int, texts: dict[str, list[bytes]], depth: int) -> dict:
    parts, vocabulary, symbol_lang, langs, words = [], [], [], sorted(texts), []
    base = 0
    for place, lang in enumerate(langs):
        ids, found = symbols_of(b"\n".join(texts[lang]) + b"\n")
        parts.append(np.where(ids > 0, ids + base, 0))
        words.append(int((ids > 0).sum()))
        vocabulary += found.cast(pa.binary()).to_pylist()
        symbol_lang.append(np.full(len(found), place, np.int32))
        base += len(found)
    symbols = np.concatenate(parts)
    return {
        "shard": number,
        "langs": langs,
        "words": words,
        "vocabulary": b" ".join(vocabulary),
        "symbol_lang": np.concatenate(symbol_lang).tobytes(),
        "last": last_symbols(symbols, depth).tobytes(),
        "reverse_last": last_symbols(symbols[::-1], depth).tobytes(),
    }


_SHARD_TYPE = pa.schema(
    [("shard", pa.int64()), ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.int64()))]
    + [(name, pa.binary()) for name in ("vocabulary", "symbol_lang", "last", "reverse_last")]
)


def _gather(depth: int, shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, texts = TaskContext.get().partitionId() << 32, 0, {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                for part in stretches(normalised(text), shard_bytes):
                    if held and held + len(part) > shard_bytes:
                        yield pa.RecordBatch.from_pylist([shard_row(number, texts, depth)], schema=_SHARD_TYPE)
                        number, held, texts = number + 1, 0, {}
                    texts.setdefault(lang, []).append(part)
                    held += len(part)
        if texts:
            yield pa.RecordBatch.from_pylist([shard_row(number, texts, depth)], schema=_SHARD_TYPE)

    return run


def shards(docs: DataFrame, depth: int = MAX_WORDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One FM-index a row, written to the shared folder: later steps name places in them."""
    d = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), text_of(docs).alias("text"))
    return settled_buckets(d.mapInArrow(_gather(depth, shard_bytes), SHARDS), "fm-index", "shard", PACKED)


class Shard:
    """An index row, opened: words and pairs in a fixed order of places."""

    def __init__(self, row: dict):
        self.langs = row["langs"]
        self.words = pa.array(row["vocabulary"].split(b" ") if row["vocabulary"] else [], pa.binary())
        self.lang_of = np.frombuffer(row["symbol_lang"], np.int32)
        self.index = FmIndex(*[np.frombuffer(row[c], np.int32) for c in ("last", "reverse_last")])
        self.singles = self.index.single_words()
        self.pairs = self.index.extended(self.singles)

    def hashes(self) -> np.ndarray:
        word = pd.util.hash_array(np.array([b"", *self.words.to_pylist()], dtype=object), categorize=False)
        lang = pd.util.hash_array(np.array(self.langs, dtype=object), categorize=False)
        word[1:] ^= lang[self.lang_of] * np.uint64(0x9E3779B97F4A7C15)
        first, second = (word[w] for w in self.pairs.words)
        first = (first ^ (first >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return np.concatenate([word[self.singles.words[0]], first + second])


# --- counts by hash -------------------------------------------------------------


def _entries(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                if not len(shard.singles):
                    continue
                hashes = shard.hashes()
                counts = np.concatenate([shard.singles.count, shard.pairs.count]).astype(np.int32)
                part = ((hashes >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cuts = np.flatnonzero(np.diff(part[order])) + 1
                rows = []
                for at in np.split(order, cuts):
                    rows.append({"part": int(part[at[0]]), "shard": row["shard"], "at": at.astype(np.int32).tobytes(), "h": hashes[at].tobytes(), "n": counts[at].tobytes()})
                yield pa.RecordBatch.from_pylist(rows, schema=_ENTRY_TYPE)

    return run


_ENTRY_TYPE = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("at", pa.binary()), ("h", pa.binary()), ("n", pa.binary())])
_KEPT_TYPE = pa.schema([("shard", pa.int64()), ("at", pa.binary())])


def _frequent(least: int):
    """Of one part, the places in each shard whose hash adds up to the least count."""

    def run(table: pa.Table) -> pa.Table:
        columns = {name: table.column(name).to_pylist() for name in ("shard", "at", "h", "n")}
        hashes = np.frombuffer(b"".join(columns["h"]), np.uint64)
        order = np.argsort(hashes, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], np.diff(hashes[order]) != 0]))
        totals = np.add.reduceat(np.frombuffer(b"".join(columns["n"]), np.int32)[order].astype(np.int64), heads)
        kept = np.empty(len(hashes), bool)
        kept[order] = np.repeat(totals >= least, np.diff(np.append(heads, len(hashes))))
        rows, begin = [], 0
        for shard, at in zip(columns["shard"], columns["at"]):
            places = np.frombuffer(at, np.int32)
            mine = places[kept[begin : begin + len(places)]]
            begin += len(places)
            if len(mine):
                rows.append({"shard": shard, "at": mine.tobytes()})
        return pa.Table.from_pylist(rows, schema=_KEPT_TYPE)

    return run


# --- phrases --------------------------------------------------------------------


def _listed(max_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row)
                places = np.sort(np.frombuffer(b"".join(row["kept"]), np.int32))
                n = len(shard.singles)
                grams = shard.pairs.at(places[places >= n] - n)
                known = np.sort(shard.index.keys(*grams.words))
                words = shard.words.cast(pa.string())
                langs = pa.array(shard.langs, pa.string()).take(pa.array(shard.lang_of))
                size = 1
                for grams in _longer(shard, shard.singles.at(places[places < n]), grams, known, max_words):
                    parts = [words.take(pa.array(w - 1)) for w in grams.words]
                    phrase = pc.binary_join_element_wise(*parts, " ") if size > 1 else parts[0]
                    numbers = [pa.array(x.astype(np.int64)) for x in (grams.count, grams.left, grams.right)]
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(pa.array(grams.words[0] - 1)), phrase, pa.array(np.full(len(grams), size, np.int32)), *numbers],
                        ["lang", "phrase", "size", "a", "before", "behind"],
                    )
                    size += 1

    return run


def _longer(shard: Shard, singles, pairs, known: np.ndarray, max_words: int):
    """Levels of phrases: a longer one must begin with a known pair, and end in a phrase of the level before."""
    yield singles
    grams = pairs
    for _ in range(2, max_words + 1):
        yield grams
        grams = shard.index.extended(grams)
        keys = shard.index.keys(*grams.words[:2])
        near = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
        grams = grams.at(np.flatnonzero(known[near] == keys) if len(known) else np.zeros(0, np.int64))


def phrases(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, n: its words) and (lang, phrase, size, a, before, behind): words and phrases that occur least times or more.

    before and behind count the occurrences with another word of the piece on that side.
    """
    index = shards(docs, max_words, shard_bytes)
    sizes = index.select(F.explode(F.arrays_zip("langs", "words")).alias("x")).groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.words").alias("n"))
    sizes = settled(sizes, "words")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    entries = index.mapInArrow(_entries(max(1, 2 * total // PART_ENTRIES)), "part bigint, shard bigint, at binary, h binary, n binary")
    kept = entries.groupBy("part").applyInArrow(_frequent(least), "shard bigint, at binary")
    kept = settled(kept, "frequent", ONE_ROW)
    # the index stays in its buckets, only the places are shuffled
    wanted = index.hint("merge").join(kept.groupBy("shard").agg(F.collect_list("at").alias("kept")), "shard")
    listed = wanted.mapInArrow(_listed(max_words), "lang string, phrase string, size int, a bigint, before bigint, behind bigint")
    summed = listed.groupBy("lang", "phrase", "size").agg(*[F.sum(c).alias(c) for c in ("a", "before", "behind")])
    out = settled(summed.where(F.col("a") >= least), "phrases", ONE_ROW)
    dropped(index)
    return sizes, out


def scored(found: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """lang, phrase, size, a and l, r, score of the lowest-scoring cut of each phrase of two words or more."""
    words = F.split("phrase", " ")
    cuts = found.where("size > 1").select("lang", "phrase", "size", "a", words.alias("w"), F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "size", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    known = found.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("a").alias("f"))
    for name, count in (("first", "l"), ("rest", "r")):
        side = known.select("of", "part", F.col("f").alias(count))
        cuts = cuts.join(side, (F.col("lang") == F.col("of")) & (F.col(name) == F.col("part"))).drop("of", "part")
    wide = cuts.withColumns({f"d{c}": F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r")})
    cuts = wide.withColumn("score", F.expr(f"(da * da * {MILLION}) div (dl * dr)"))
    worst = F.min(F.struct("score", "k", "l", "r")).alias("worst")
    return cuts.groupBy("lang", "phrase", "size", "a").agg(worst).select("lang", "phrase", "size", "a", "worst.l", "worst.r", "worst.score")


def swallowed(found: DataFrame, percent: int = SWALLOW) -> DataFrame:
    """lang, phrase of those that a longer one accounts for: parts of each phrase, by the largest count that holds them."""
    words = F.split("phrase", " ")
    spans = F.expr("flatten(transform(sequence(2, size - 1), n -> transform(sequence(1, size - n + 1), i -> array_join(slice(w, i, n), ' '))))")
    parts = found.where("size > 2").select("lang", "size", F.col("a").alias("longer"), words.alias("w"))
    parts = parts.select("lang", "longer", F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return found.join(parts, ["lang", "phrase"]).where(f"100 * longer >= {percent} * a").select("lang", "phrase")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, top: int = TOP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language."""
    sizes, found = phrases(docs, max_words, least, shard_bytes)
    left = scored(found).join(swallowed(found), ["lang", "phrase"], "left_anti")
    best = left.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    for by in (["lang", "part"], ["lang"]):  # a language's last ranking then meets at most PARTS * top rows
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
