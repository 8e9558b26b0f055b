"""Bounded-space online packing of token sequences.

Each partition reads its documents once and keeps at most OPEN windows of ``size`` tokens.
Whole windows of a long document go out at once. The rest of a document is placed in the
open window that it fills best; when none fits and all windows are in use, the fullest is
topped up with the document's head and emitted, and what is left of the document is placed
again. At the end of a partition the open windows are merged into each other, so one unfull
window per partition is left over. Leftovers carry their ids and are merged in rounds of
FAN partitions; the very last window is cut at powers of two, which need no padding.

Tokens are looked up per word: the tokenizer never joins characters over white space, so a
text's ids are those of its words one after the other. Only the distinct words of a block of
texts become Python strings. A worker keeps a bounded cache; words that it lacks are cut into
Latin letters and what follows, and all new letters are encoded in one call.

Defined cases: a null or empty text is one end token; a null doc_id is kept; repeated rows
are packed each; an empty table gives no rows; other columns are ignored. A document's ids
are held in memory at once.
"""

from __future__ import annotations

import os
import string
import sys
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearspan.llm.common import settled, text_of

SIZE = 4096
OPEN = 32
FAN = 64
END_ID = 2
CACHE_WORDS = 1_000_000
BLOCK_BYTES = 1 << 20
#: What may follow letters in a word without changing how the tokenizer cuts them off.
SYMBOLS = string.punctuation

PIECES = "doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, sequence_id BIGINT, offset BIGINT, part BIGINT, ids BINARY"
SCHEMA = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in (c.split()[0] for c in PIECES.split(", "))])


class WordEncoder:
    """Ids (little-endian unsigned 32-bit, as bytes) of the words of a text, with a bounded cache."""

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._limit = limit
        self._words: dict[str, bytes] = {}
        self._letters: dict[str, bytes] = {"": b""}
        self._rests: dict[str, bytes] = {"": b""}
        # lower-case letters need neither normalising nor cutting; an id that ends a word tells them apart
        suffix = getattr(self._tokenizer.model, "end_of_word_suffix", None)
        self._plain = None
        if suffix:
            vocabulary = self._tokenizer.get_vocab()
            self._ending = np.zeros(max(vocabulary.values()) + 1, bool)
            self._ending[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
            self._plain = Tokenizer.from_file(path)
            self._plain.normalizer = None
            self._plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        for cache in (self._words, self._letters, self._rests):
            if len(cache) > self._limit:
                cache.clear()
                cache[""] = b""
        words = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = self._words
        self._learn([w for w in distinct if w not in known])
        ids = np.empty(len(distinct), object)
        ids[:] = list(map(known.__getitem__, distinct))
        in_order = ids[coded.indices.to_numpy()]
        return [b"".join(in_order[a:b].tolist()) for a, b in pairwise(words.offsets.to_pylist())]

    def _learn(self, words: list[str]) -> None:
        parted = list(map(self._parted, words))
        letters, rests = self._letters, self._rests
        new = list({base for base, _ in parted}.difference(letters))
        letters.update(zip(new, self._letter_ids(new), strict=True))
        new = list({rest for _, rest in parted}.difference(rests))
        rests.update(zip(new, self._whole_ids(new), strict=True))
        self._words.update(zip(words, [letters[base] + rests[rest] for base, rest in parted], strict=True))

    def _whole_ids(self, parts: list[str]) -> list[bytes]:
        return [_little_endian(e.ids) for e in self._tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _letter_ids(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case words of letters, in one call where the vocabulary marks the ends of words."""
        if self._plain is None or not words:
            return self._whole_ids(words)
        ids = self._plain.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0].ids
        ends = (4 * (np.flatnonzero(self._ending[ids]) + 1)).tolist()
        if len(ends) != len(words):  # a word ends in a token that the vocabulary lacks
            return self._whole_ids(words)
        raw = _little_endian(ids)
        return [raw[a:b] for a, b in pairwise([0, *ends])]

    @staticmethod
    def _parted(word: str) -> tuple[str, str]:
        """Latin letters, lower-cased, and the symbols after them are separate for the tokenizer; other words stay whole."""
        base = word.rstrip(SYMBOLS)
        if base.isalpha():
            if base.isascii():
                return base.lower(), word[len(base) :]
            if max(base) < "ɐ" and base.lower().isalpha():
                return base.lower(), word[len(base) :]
        return "", word


def _little_endian(ids: list[int]) -> bytes:
    """Ids as unsigned 32-bit numbers."""
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


_encoders: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, cache_words: int = CACHE_WORDS) -> WordEncoder:
    """One encoder per worker process; its cache lives on from task to task."""
    if (path, cache_words) not in _encoders:
        _encoders[path, cache_words] = WordEncoder(path, cache_words)
    return _encoders[path, cache_words]


class Piece:
    """Tokens [start, start + length) of a document; ids holds just these."""

    __slots__ = ("doc_id", "start", "ids", "doc_tokens")

    def __init__(self, doc_id: int | None, start: int, ids: memoryview, doc_tokens: int):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def __len__(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.ids[: 4 * n], self.doc_tokens),
            Piece(self.doc_id, self.start + n, self.ids[4 * n :], self.doc_tokens),
        )


class Packer:
    """The open windows of one task; sequence ids count up from ``first_id``."""

    def __init__(self, first_id: int, size: int = SIZE, open_windows: int = OPEN):
        self.size, self.limit, self.next_id = size, open_windows, first_id
        self.open: list[list[Piece]] = []
        self.used: list[int] = []
        self.done: list[tuple] = []

    def add(self, piece: Piece) -> None:
        while len(piece) >= self.size:
            whole, piece = piece.cut(self.size)
            self.emit([whole])
        while len(piece):
            fitting = [w for w, used in enumerate(self.used) if used + len(piece) <= self.size]
            if fitting:
                self._put(max(fitting, key=self.used.__getitem__), piece)
                return
            if len(self.open) < self.limit:
                self.open.append([piece])
                self.used.append(len(piece))
                return
            fullest = max(range(len(self.open)), key=self.used.__getitem__)
            head, piece = piece.cut(self.size - self.used[fullest])
            self._put(fullest, head)

    def _put(self, window: int, piece: Piece) -> None:
        self.open[window].append(piece)
        self.used[window] += len(piece)
        if self.used[window] == self.size:
            self.emit(self.open.pop(window))
            self.used.pop(window)

    def emit(self, pieces: list[Piece], left_over: bool = False, part: int = 0) -> None:
        at = 0
        for p in pieces:
            ids = bytes(p.ids) if left_over else None
            self.done.append((p.doc_id, p.start, len(p), zlib.crc32(p.ids), p.doc_tokens, self.next_id, at, part, ids))
            at += len(p)
        self.next_id += 1

    def merge_open(self) -> list[Piece]:
        """Pour the emptiest windows into the fullest; the pieces of the one unfull window at the end."""
        windows = [w for _, w in sorted(zip(self.used, self.open, strict=True), key=lambda x: -x[0])]
        self.open, self.used, self.limit = [], [], 1
        for pieces in windows:
            for piece in pieces:
                self.add(piece)
        return self.open[0] if self.open else []

    def close(self, pieces: list[Piece]) -> None:
        """The last window of all, cut at powers of two."""
        left = sum(map(len, pieces))
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            window = []
            while room:
                head, rest = pieces[0].cut(min(room, len(pieces[0])))
                window.append(head)
                room -= len(head)
                pieces = [rest, *pieces[1:]] if len(rest) else pieces[1:]
            self.emit(window)

    def flush(self) -> pa.RecordBatch:
        columns = list(zip(*self.done, strict=True)) if self.done else [[] for _ in SCHEMA]
        self.done = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    for batch in batches:
        ids, texts, held = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            ids.append(doc_id)
            texts.append(raw)
            held += len(raw)
            if held >= BLOCK_BYTES:
                yield ids, texts
                ids, texts, held = [], [], 0
        if ids:
            yield ids, texts


def _pack_partition(tokenizer: str, size: int, open_windows: int, cache_words: int):
    end = END_ID.to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer, encode = Packer(part << 32, size, open_windows), encoder(tokenizer, cache_words).encode
        for doc_ids, texts in _blocks(batches):
            for doc_id, ids in zip(doc_ids, encode(texts), strict=True):
                ids += end
                packer.add(Piece(doc_id, 0, memoryview(ids), len(ids) // 4))
            yield packer.flush()
        packer.emit(packer.merge_open(), left_over=True, part=part)
        yield packer.flush()

    return run


def _merge(level: int, last: bool, size: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        packer = Packer((level << 56) + (group << 32), size, 1)
        for r in sorted(table.to_pylist(), key=lambda r: (r["part"], r["offset"])):
            packer.add(Piece(r["doc_id"], r["start"], memoryview(r["ids"]), r["doc_tokens"]))
        left = packer.open[0] if packer.open else []
        if last:
            packer.close(left)
        else:
            packer.emit(left, left_over=True, part=group)
        return pa.Table.from_batches([packer.flush()])

    return run


def pack(docs: DataFrame, tokenizer: str, size: int = SIZE, open_windows: int = OPEN, cache_words: int = CACHE_WORDS) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. tokenizer: the vocabulary file.

    A worker remembers the ids of cache_words words, some 300 bytes each; the result doesn't depend on it.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).cast("binary").alias("text"))
    packed = settled(rows.mapInArrow(_pack_partition(tokenizer, size, open_windows, cache_words), PIECES), "packed")
    whole, left, level = packed.where("ids IS NULL"), packed.where("ids IS NOT NULL"), 1
    parts = (left.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        last = parts <= FAN
        merge = _merge(level, last, size)
        groups = left.withColumn("part_group", F.expr(f"part div {FAN}")).groupBy("part_group")
        merged = groups.applyInArrow(merge, PIECES)
        merged = settled(merged, "merged")
        whole = whole.unionByName(merged.where("ids IS NULL"))
        if last:
            return whole.drop("part", "ids")
        left, parts, level = merged.where("ids IS NOT NULL"), -(-parts // FAN), level + 1
