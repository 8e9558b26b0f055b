"""The tokenizer sees each run of letters once, whatever its case and the symbols after it."""

from __future__ import annotations

import random
import struct

import pytest

from wearspan.llm import packing
from wearspan.llm.queries import vocabulary

TEXTS = [
    "taue taue*** TAUE&&& Taue., taue!? Éau éau### ÉAU",
    "x'' dogs' don't 's a's 't' <|endoftext|> <|ENDOFTEXT|> end<|endoftext|>, <| |>",
    "İstanbul İ!! ß ẞ. ǅ ŉ' Ⱥb ⱥb ĳ ª º ſt Σας σας. café café! H̱ ẖ Å ﬁ 日本語 日本語*** naïve²",
    "  lead\x0btab\tand\x0cend \n\r\x1c\x1d\x85 x y ",
    "",
    " ",
    "12 3rd a1 1a!! _a_ a_ -- --- a--b a-- \x00 a\x00 a\x00!",
]


def expected(texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary())
    ids = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    return [struct.pack(f"<{len(i)}I", *i) for i in ids]


def test_odd_words_get_the_tokenizers_ids():
    assert packing.WordEncoder(vocabulary()).encode([t.encode() for t in TEXTS]) == expected(TEXTS)
    assert packing.WordEncoder(vocabulary()).encode([]) == []


def test_ids_stay_right_when_the_cache_is_cleared():
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("abÄäé1.,*'") for _ in range(rng.randrange(1, 8))) for _ in range(50)) for _ in range(20)]
    encoder, found = packing.WordEncoder(vocabulary(), 30), []
    for text in texts:
        found += encoder.encode([text.encode()])
    assert found == expected(texts)


class Recorder:
    def __init__(self, tokenizer, seen):
        self.tokenizer, self.seen = tokenizer, seen

    def encode_batch_fast(self, parts, **settings):
        self.seen += parts[0] if settings.get("is_pretokenized") else parts
        return self.tokenizer.encode_batch_fast(parts, **settings)


def test_each_run_of_letters_is_encoded_once():
    encoder, seen = packing.WordEncoder(vocabulary()), []
    for name in ("_tokenizer", "_plain"):
        if hasattr(encoder, name):
            setattr(encoder, name, Recorder(getattr(encoder, name), seen))
    encoder.encode([TEXTS[0].encode()])
    assert sorted(seen) == sorted(["taue", "éau", "***", "&&&", ".,", "!?", "###"])


def test_a_vocabulary_without_word_ends_is_read_word_by_word(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    ids = {c: i for i, c in enumerate("abc")}
    small = Tokenizer(models.BPE(ids, []))
    small.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    small.save(str(tmp_path / "v.json"))
    assert packing.WordEncoder(str(tmp_path / "v.json")).encode([b"ab c"]) == [struct.pack("<3I", 0, 1, 2)]


@pytest.mark.parametrize("n", [1, 5000])
def test_many_texts_in_one_call(n):
    assert packing.WordEncoder(vocabulary()).encode([b"one two", b"", b"two"] * n) == expected(["one two", "", "two"]) * n
