"""Secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings.

The patterns give the base spans. Further candidates are unbroken runs of token characters;
a window of WINDOW characters slides over each and carries the count of every character it
holds: a step lowers the count of the character that goes out, raises that of the one that
comes in, and changes the sum of c*log2(c) by those two terms. A candidate is a secret if its
largest entropy reaches the limit of its character class (hexadecimal, letters and digits,
base 64) and no allow-list pattern covers it. Patterns of whole strings are held against the
candidate; a repeated character or the token with a placeholder in it is cut out, and only
windows of what is left count. Beside base spans each stretch left of a run is a candidate.

All terms are integers (millionths), so the verdict does not depend on summation order.

Defined cases: a null or empty text has no spans; overlapping base spans of different kinds
all stay, and of spans that begin together the kind listed first comes first; repeated rows
are scanned each; texts and runs of any length are scanned whole, in time that grows with
their length (and with the product of a text's base spans and its blocks of BLOCK candidates);
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearspan.llm.common import text_of
from wearspan.llm.matches import BLOCK, with_matches

#: Base patterns by kind, in their listed order, and the least length of what must be that long.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": (ASSIGN, 1, 6), "access": ("AKIA[A-Z0-9]+", 0, 20), "hex": ("[0-9a-f]+", 0, 24)}
#: What matches the pattern and is long enough; for these two kinds the short runs need not be listed.
LONG = {"access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Least entropy, in millionths of a bit per character, of the best window, by character class.
LIMITS = {"hex": 3_000_000, "alnum": 3_600_000, "base64": 3_800_000}
#: Strings that look random and are none: no digit or no letter, repeated character, alphabets, placeholders, paths, words.
ALLOWED = (
    r"^[^0-9]*$",
    r"^[^A-Za-z]*$",
    r"(.)\1{5}",
    r"(?i)(0123456789|123456789|abcdefghij|example|placeholder|changeme|xxxx)",
    r"^[A-Za-z]+([-_/][A-Za-z]+)*[-_/]?[0-9]{0,4}$",
)
#: What the patterns of parts in ALLOWED cut out of a candidate: letters and digits around a placeholder, and repeated characters.
CUT = r"(?<![A-Za-z0-9])[A-Za-z0-9]*(?:" + ALLOWED[3] + r")[A-Za-z0-9]*|(.)\2{5,}"
#: c * log2(c) in millionths for c = 0 to WINDOW, a fixed table by this rule.
PLOGP = [0, *(round(c * math.log2(c) * 1e6) for c in range(1, WINDOW + 1))]


#: The characters of CANDIDATE; their counts are kept SLOTS to a long, BITS each.
LETTERS = string.ascii_letters + string.digits + "+/_=-"
BITS, SLOTS = 5, 12
SPAN = "array<struct<start:int,rank:int,stop:int,kind:string,found:string>>"


def _none() -> Column:
    return F.array().cast(SPAN)


def _bound(value: Column, use) -> Column:
    """use(value), with the value computed once for all places that read it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _plogp(count: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in PLOGP]), count + 1)


def best_entropy(found: Column) -> Column:
    """Largest entropy of a window of the string (characters of LETTERS), in millionths of a bit per character."""
    place = {ord(c): i for i, c in enumerate(LETTERS)}
    table = F.array(*[F.lit(place.get(i, 0)) for i in range(128)])
    letters = F.transform(F.filter(F.split(found, ""), lambda c: c != ""), lambda c: F.element_at(table, F.ascii(c) + 1))

    def count(counts: Column, letter: Column) -> Column:
        word = F.get(counts, F.floor(letter / SLOTS).cast("int"))
        return F.call_function("shiftright", word, letter % SLOTS * BITS).bitwiseAND(2**BITS - 1).cast("int")

    def one(letter: Column, word: Column) -> Column:
        unit = F.call_function("shiftleft", F.lit(1).cast("long"), letter % SLOTS * BITS)
        return F.when(F.floor(letter / SLOTS) == word, unit).otherwise(F.lit(0).cast("long"))

    def step(state: Column, move: Column) -> Column:
        come, gone, counts = move["come"], move["gone"], state["counts"]
        more, less = count(counts, come), count(counts, gone)
        plus = _plogp(more + 1) - _plogp(more)
        minus = _plogp(less) - _plogp(less - 1)
        change = F.when(gone < 0, plus).when(gone == come, F.lit(0).cast("long")).otherwise(plus - minus)
        moved = F.when(gone == come, counts).otherwise(
            F.transform(counts, lambda v, k: v + one(come, k) - F.when(gone < 0, F.lit(0).cast("long")).otherwise(one(gone, k)))
        )
        total = state["sum"] + change
        least = F.when(move["full"], F.least(state["least"], total)).otherwise(state["least"])
        return F.struct(moved.alias("counts"), total.alias("sum"), least.alias("least"))

    def largest(codes: Column) -> Column:
        def move(come: Column, i: Column) -> Column:
            gone = F.when(i >= WINDOW, F.get(codes, i - WINDOW)).otherwise(F.lit(-1))
            return F.struct(come.alias("come"), gone.alias("gone"), (i >= WINDOW - 1).alias("full"))

        none = F.array_repeat(F.lit(0).cast("long"), -(-len(LETTERS) // SLOTS))
        start = F.struct(none.alias("counts"), F.lit(0).cast("long").alias("sum"), F.lit(PLOGP[-1]).cast("long").alias("least"))
        least = F.aggregate(F.transform(codes, move), start, step, lambda s: s["least"])
        # H = log2(W) - sum(c log2 c) / W
        return F.lit(round(math.log2(WINDOW) * 1e6)).cast("long") - F.floor(least / WINDOW).cast("long")

    return _bound(letters, largest)


def _random_looking(found: Column) -> Column:
    limit = F.when(found.rlike("^[0-9a-fA-F]+$"), LIMITS["hex"]).when(found.rlike("^[A-Za-z0-9]+$"), LIMITS["alnum"]).otherwise(LIMITS["base64"])
    allowed = F.lit(False)
    for pattern in ALLOWED:
        if pattern.startswith("^"):
            # possessive, with the same matches: a group that may be given back costs Java a call a repetition
            allowed = allowed | found.rlike(pattern.replace(")*", ")*+"))
    parts = F.filter(F.split(found, CUT, -1), lambda p: F.char_length(p) >= WINDOW)
    return F.when(allowed, False).otherwise(F.exists(parts, lambda p: best_entropy(p) >= limit))


def _beside(span: Column, base: Column) -> Column:
    """The stretches of WINDOW characters or more of a span that no base span holds; base is sorted."""

    def piece(begin: Column, end: Column) -> Column:
        found = F.substr(span["found"], begin - span["start"] + 1, end - begin)
        p = F.struct(begin.alias("start"), span["rank"].alias("rank"), end.alias("stop"), span["kind"].alias("kind"), found.alias("found"))
        return F.when(end - begin >= WINDOW, F.array(p)).otherwise(_none())

    touching = F.filter(base, lambda b: (b["start"] < span["stop"]) & (span["start"] < b["stop"]))
    first = F.struct(span["start"].alias("at"), _none().alias("pieces"))

    def step(state: Column, b: Column) -> Column:
        return F.struct(F.greatest(state["at"], b["stop"]).alias("at"), F.concat(state["pieces"], piece(state["at"], b["start"])).alias("pieces"))

    return F.aggregate(touching, first, step, lambda s: F.concat(s["pieces"], piece(s["at"], span["stop"])))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _outside(spans: Column, base: Column) -> Column:
    """What base spans leave of the spans, a block of spans at a time; both are sorted."""

    def pieces(block: Column) -> Column:
        begin, end = F.element_at(block, 1)["start"], F.element_at(block, -1)["stop"]
        near = F.filter(base, lambda b: (b["start"] < end) & (begin < b["stop"]))
        return _bound(near, lambda near: F.flatten(F.transform(block, lambda s: _beside(s, near))))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / BLOCK).cast("int")), lambda b: F.slice(spans, b * BLOCK + 1, F.lit(BLOCK)))
    touched = (F.size(base) > 0) & (F.size(spans) > 0)
    return F.when(touched, F.flatten(F.transform(blocks, pieces))).otherwise(spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (all spans as kind:start:end, by start, then kind)."""
    d = docs.select("doc_id", text_of(docs).alias("t"))
    patterns = {kind: (LONG.get(kind, pattern), F.lit(True)) for kind, (pattern, _, _) in BASE.items()}
    d = with_matches(d, "t", patterns | {"other": (CANDIDATE, F.lit(True))})

    def ranked(name: str, rank: int, kind: str) -> Column:
        return F.transform(name, lambda s: F.struct(s["start"], F.lit(rank).alias("rank"), s["stop"], F.lit(kind).alias("kind"), s["found"]))

    def long_enough(kind: str, pattern: str, group: int, least: int) -> Column:
        return F.filter(kind, lambda s: F.char_length(F.regexp_extract(s["found"], pattern, group)) >= least)

    d = d.select("doc_id", "other", *[long_enough(kind, *rule).alias(kind) for kind, rule in BASE.items()])
    d = d.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
        F.array_sort(F.concat(*[ranked(k, i, k) for i, k in enumerate(BASE)])).alias("base"),
        ranked("other", len(BASE), "entropy").alias("other"),
    )
    d = d.withColumn("other", _outside(F.col("other"), F.col("base")))
    d = d.withColumn("other", F.filter("other", lambda s: _random_looking(s["found"])))
    return d.select(
        "doc_id",
        *[f"n_{k}" for k in BASE],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "other"))).alias("spans"),
    )
