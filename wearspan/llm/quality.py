"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each document is measured by built-in functions alone. A sketch counts, per language,
source and rate, the documents by value kept to seven significant bits, so its buckets are
exact integers, sketches merge by adding counts, and a quantile is right within 1/64.
Symbols, repeated lines and repeated words are bounded above by a quantile of their language and
source (RATES): a multiple of it, and a tolerance above it. That of symbols is low, as junk may be a
tenth of a source; those of repeats are high, as most texts have none. The length of words stays
within a number of interquartile ranges. A quantile is read only where enough documents lie beyond it
(MIN_GROUP for quartiles, TEN times that for the 99th percentile); smaller groups take the merged
sketch of the language, then of all.
A document stays if the base rules pass it and no rate is outside its group's thresholds.

Defined cases: a null text has no words and fails the base rules; a null language or source
is a group; repeated rows are measured each; texts of any length are measured whole; a value equal
to its threshold stays; an empty table gives no rows; other columns
are kept by ``accepted`` and ignored by ``verdicts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearspan.llm.common import WORD, settled, text_of, without_spaces

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # percent of words
MIN_GROUP = 100
TEN = 10
#: Rate -> (percent of the quantile, multiple of it that is the threshold, least distance above it). Rates are per mille.
RATES = {"symbols": (75, 3, 50), "lines": (99, 3, 100), "repeats": (99, 3, 50), "length": (75, None, 250)}
#: Interquartile ranges, each of the rate's least distance or more, that the length of words may lie outside the quartiles.
RANGES = 8
#: The rates for which low values are rejected as well.
TWO_SIDED = ("length",)


def measures(text: Column) -> list[Column]:
    """Struct column `m`'s parts in two steps, so that words and windows are computed once."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return [
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        F.char_length(without_spaces(text)).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
    ]


def _repeated_words(windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more; windows: hashes by position."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rest = F.slice(placed, F.lit(2), F.size(windows))
    pairs = F.zip_with(placed, rest, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    at = F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
    gaps = F.zip_with(at, F.slice(at, F.lit(2), F.size(windows)), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap).cast("long")


def measured(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """keep and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    d = docs.select(*keep, *measures(text_of(docs)))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    d = d.withColumns({"n_words": F.size("words").cast("long"), "hashes": hashes}).drop("words")
    d = d.withColumns(
        {"windows": F.when(F.col("n_words") >= WINDOW, F.transform(starts_of("n_words"), lambda i: F.xxhash64(F.slice(F.col("hashes"), i, WINDOW))))}
    ).drop("hashes")
    d = d.withColumn("distinct_windows", F.size(F.array_distinct("windows")))
    repeated = F.when(F.col("distinct_windows") < F.size("windows"), _repeated_words(F.col("windows"))).otherwise(F.lit(0).cast("long"))
    return d.withColumn("n_repeat_words", repeated).drop("windows", "distinct_windows")


def starts_of(n: str) -> Column:
    return F.sequence(F.lit(1), F.col(n).cast("int") - (WINDOW - 1))


def with_rates(d: DataFrame) -> DataFrame:
    return d.withColumns(
        {
            "base_failed": F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words"),
            "symbols": F.expr("n_symbols * 1000 div greatest(n_words, 1)"),
            "lines": F.expr("n_dup_lines * 1000 div greatest(n_lines, 1)"),
            "repeats": F.expr("n_repeat_words * 1000 div greatest(n_words, 1)"),
            "length": F.expr("word_chars * 1000 div greatest(n_words, 1)"),
        }
    )


def sketch(d: DataFrame) -> DataFrame:
    """Mergeable sketch: number of documents by lang, source, rate and value (to seven significant bits)."""
    rates = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), F.col(r).alias("value")) for r in RATES]))
    v = d.select("lang", "source", rates.alias("x")).select("lang", "source", "x.rate", "x.value")
    low = "greatest(length(bin(value)) - 7, 0)"
    v = v.withColumn("value", F.expr(f"shiftleft(shiftright(value, {low}), {low})"))
    return v.groupBy("lang", "source", "rate", "value").agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, *by: str) -> DataFrame:
    return sketches.groupBy(*by, "rate", "value").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, *by: str) -> DataFrame:
    """by, rate, docs, q25, q75, q99: the least values that this percentage of the documents doesn't exceed."""
    group = Window.partitionBy(*by, "rate")
    run = F.sum("n").over(group.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    s = sketches.withColumns({"run": run, "docs": F.sum("n").over(group)})
    at = lambda part: F.min(F.when(F.col("run") * 100 >= F.col("docs") * part, F.col("value"))).alias(f"q{part}")
    return s.groupBy(*by, "rate").agg(F.max("docs").alias("docs"), at(25), at(75), at(99))


def least_docs(rate: str, min_group: int) -> int:
    """Documents that a group needs for the rate's quantile."""
    return min_group * (TEN if RATES[rate][0] == 99 else 1)


def thresholds(sketches: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """lang, source and per rate <rate>_low, <rate>_high; sketches are small, one row per bucket."""
    parts = F.struct("q25", "q75", "q99")
    need = F.coalesce(*[F.when(F.col("rate") == r, least_docs(r, min_group)) for r in RATES])
    large = F.when(F.col("docs") >= need, parts)
    own = quantiles(sketches, "lang", "source").select("lang", "source", "rate", large.alias("of_own"))
    lang = quantiles(merged(sketches, "lang"), "lang").select(F.col("lang").alias("l"), "rate", large.alias("of_lang")).withColumnRenamed("rate", "r")
    whole = quantiles(merged(sketches)).select(F.col("rate").alias("ra"), parts.alias("of_all"))
    q = own.join(lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("rate") == F.col("r"))).join(whole, F.col("rate") == F.col("ra"))
    q = q.withColumn("q", F.coalesce("of_own", "of_lang", "of_all"))
    columns = []
    for rate, (part, times, least) in RATES.items():
        mine = F.col("rate") == rate
        if times is None:
            reach = F.greatest(F.col("q.q75") - F.col("q.q25"), F.lit(least)) * RANGES
            columns.append(F.max(F.when(mine, F.col("q.q75") + reach)).alias(f"{rate}_high"))
            columns.append(F.max(F.when(mine, F.col("q.q25") - reach)).alias(f"{rate}_low"))
        else:
            at = F.col(f"q.q{part}")
            columns.append(F.max(F.when(mine, F.greatest(at * times, at + least))).alias(f"{rate}_high"))
    return q.groupBy("lang", "source").agg(*columns)


def judged(d: DataFrame, limits: DataFrame) -> DataFrame:
    """Adds kept. The table of limits is joined by language and source; Spark broadcasts it if it is small."""
    limits = limits.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    j = d.join(limits, d["lang"].eqNullSafe(F.col("of_lang")) & d["source"].eqNullSafe(F.col("of_source")))
    inside = ~F.col("base_failed")
    for rate in RATES:
        inside = inside & (F.col(rate) <= F.col(f"{rate}_high"))
        if rate in TWO_SIDED:
            inside = inside & (F.col(rate) >= F.col(f"{rate}_low"))
    return j.withColumn("kept", inside)


def verdicts(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """doc_id, lang, source, the measures, base_failed, kept."""
    d = with_rates(settled(measured(docs, [docs["doc_id"], docs["lang"], docs["source"]]), "measures"))
    limits = settled(thresholds(settled(sketch(d), "sketch"), min_group), "limits")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged(d, limits).select("doc_id", "lang", "source", *names)


def accepted(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """The documents, with all their columns, that the rules keep.

    A verdict follows from text, language and source, so it is joined by these, the text by its
    64-bit hash and length. A filter on the measures themselves would be pushed below them and
    compute them again for each of its terms.
    """
    text = text_of(docs)
    name = [docs["lang"].alias("lang"), docs["source"].alias("source"), F.xxhash64(text).alias("k"), F.octet_length(text).alias("nb")]
    d = with_rates(settled(measured(docs, name), "measured"))
    limits = settled(thresholds(settled(sketch(d), "sketch"), min_group), "limits")
    stay = judged(d, limits).where("kept").select("k", "nb", "lang", "source").distinct()
    stay = stay.select(*[F.col(c).alias(f"of_{c}") for c in stay.columns])
    same = (F.col("k") == F.col("of_k")) & (F.col("nb") == F.col("of_nb"))
    same = same & F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    return docs.select(F.struct("*").alias("doc"), *name).join(stay, same, "left_semi").select("doc.*")
