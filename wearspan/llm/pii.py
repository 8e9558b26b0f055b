"""Personal data by weak supervision: labelers vote on candidate spans, and a classifier learns from their votes.

Base spans are those that a pattern and a check find: e-mail and IP addresses, card and phone numbers.
Looser patterns give more candidates: written-out e-mail addresses, IPv6 addresses, numbers of 13 to 19
digits that are no base card, phone numbers without a plus, names after a title or a common given name.

Three labelers vote for, against or not at all on every candidate, base or looser: its shape (regular
expression or check digit), a gazetteer (endings, issuers, country and area codes, given names) and
the words before it. Expectation-maximisation estimates, per kind, how many candidates are
personal and how often each labeler casts each vote on personal and on other ones. Its posteriors
are soft labels for the final span classifier, naive Bayes over the votes and over length, share of digits and the
characters on both sides. Looser candidates that it takes for personal join the base spans.

A candidate enters the estimates only as its pattern of kind, votes and features, of which there
are at most PATTERNS; so estimates and verdicts are tables of that size whatever the corpus, and
the patterns taken for personal come to the driver as a list. What the shape labeler votes against
(a number whose check digit is wrong) trains the estimates but is never added. Everything is DataFrame expressions.

Defined cases: a null or empty text has no spans; base spans of different kinds may overlap and all
stay; a looser candidate that touches a base span is dropped; equal odds count as other; repeated
rows are scanned and counted each; texts of any length take time in proportion to it (and to the
product of a text's accepted looser spans and its base spans); an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearspan.llm.common import settled, text_of
from wearspan.llm.matches import with_matches

KINDS = ("email", "ip", "card", "phone", "name")
BASE_KINDS = KINDS[:4]

#: The base patterns as the contract writes them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: The same matches without backtracking: a run is tried at its start, or where the last match ended.
#: Cards: only runs of 13 digits or more, which are matched whole like shorter ones.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": PLAIN["phone"],
}
#: Titles and common given names that may begin a name.
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Madame Monsieur Señor Señora"
NAMES = (
    "James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica Thomas Sarah "
    "Charles Karen Daniel Nancy Matthew Lisa Anthony Anna Peter Maria Paul Laura Hans Klaus Jürgen Ursula Monika Petra Stefan Sabine "
    "Jean Pierre Michel Marie Nathalie Isabelle Jacques Philippe José Juan Carmen Antonio Manuel Francisco Luis Pilar Javier Ana"
)
LOOSE = {
    "email": r"[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:[(\[]dot[)\]]|\.)\x20?[A-Za-z0-9-]{1,63}){1,8}",
    "ip": r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}",
    "phone": r"\(?[0-9]{3}\)?[\x20.-]\x20?[0-9]{3}[\x20.-][0-9]{4}",
    "name": rf"(?=[A-Z])(?:{'|'.join(TITLES.split())}|{'|'.join(NAMES.split())})\.?\x20[A-Z][a-z]{{1,20}}(?:\x20[A-Z][a-z]{{1,20}})?",
}
#: Every number that a pattern above matches holds this: a digit and six more characters.
NUMBERS = r"[0-9][0-9.()\x20-]{6}"
IP_PARTS = r"^(0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"

#: Labelers by kind: what makes them vote against, and what for; the first that applies counts.
#: Shape and gazetteer read the span. The shape of a card is its check digit.
SHAPE = {
    "email": (r"[0-9]$|\.\.", r"[A-Za-z]{2,8}$"),
    "ip": (r"^0+\.|^([0-9A-Fa-f]{2}:){7}[0-9A-Fa-f]{2}$", r"^[0-9.]+$|[0-9A-Fa-f]{3}"),
    "phone": (r"^0|\x20\x20|\.-|-\.", r"^\+|^\([0-9]{3}\)|^[0-9]{3}([.-])[0-9]{3}[.-]"),
    "name": (r"\x20(The|And|For|With|This|That|Der|Die|Das|Les|Los|Las)$", r"\x20[A-Z][a-z]+\x20[A-Z][a-z]+$"),
}
GAZETTEER = {
    "email": (r"[^A-Za-z](invalid|localhost|test)$", r"[^A-Za-z](com|org|net|edu|gov|info|io|eu|de|fr|es|uk|it|nl|ch|at|us|ca|mx|br)$"),
    "ip": (r"^(0|10|127|255)\.|^192\.168\.|^(0{1,4}|[fF][eE][89a-fA-F][0-9a-fA-F]):", r"^[0-9]|^[23][0-9a-fA-F]{3}:"),
    "card": (r"^[0179]", r"^(4|5[1-5]|2[2-7]|3[47]|6011|65|62)"),
    "phone": (r"^\(?[01][0-9]{2}", r"^\+(1|33|34|44|49|39|31|41|43|52|55|61|81|86|91)|^\(?[2-9][0-9]{2}"),
    "name": (r"^$", rf"^({'|'.join(NAMES.split())})\x20"),
}
AGAINST_CUES = r"(token|hash|key|version|isbn|order|sku|serial|build|invoice|part no)[^\n]{0,12}$"
CUES = {
    "email": r"(mail|contact|write|reach)[^\n]{0,12}$",
    "ip": r"(\bip|host|server|addr|client|login)[^\n]{0,12}$",
    "card": r"(card|visa|master|credit|debit|payment)[^\n]{0,12}$",
    "phone": r"(phone|call|tel|mobil|fax|dial)[^\n]{0,12}$",
    "name": r"(name|dear|contact|sign|regards|by|von|from)[^\n]{0,12}$",
}

AGAINST, ABSTAIN, FOR = 0, 1, 2
LABELERS = ("shape", "gazetteer", "context")
#: Feature -> number of values.
FEATURES = {"length": 4, "digits": 4, "left_side": 3, "right_side": 3}
PATTERNS = len(KINDS) * 3 ** len(LABELERS) * 4 * 4 * 3 * 3
ROUNDS = 12
#: First belief that a candidate is personal: a half, and so much more or less per vote.
LEAN = 0.15


# --- candidates -----------------------------------------------------------------


def luhn(found: Column) -> Column:
    """Check digit of a number of at most 19 digits; longer ones fail."""
    digits = F.regexp_replace(found, "[^0-9]", "")
    n = F.char_length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.when(n <= 19, F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0).otherwise(False)


def n_digits(found: Column) -> Column:
    return F.char_length(F.regexp_replace(found, "[^0-9]", ""))


def passes(kind: str, found: Column) -> Column:
    """The check that a base match must pass."""
    if kind == "ip":
        return found.rlike(IP_PARTS)
    if kind == "card":
        return n_digits(found).between(16, 19) & luhn(found)
    if kind == "phone":
        return n_digits(found).between(8, 15)
    return F.lit(True)


def _vote(text: Column, against: str, in_favour: str) -> Column:
    return F.when(text.rlike(against), AGAINST).when(text.rlike(in_favour), FOR).otherwise(ABSTAIN)


def votes(kind: str, s: Column) -> list[Column]:
    shape = F.when(luhn(s["found"]), FOR).otherwise(AGAINST) if kind == "card" else _vote(s["found"], *SHAPE[kind])
    return [shape, _vote(s["found"], *GAZETTEER[kind]), _vote(F.lower(s["before"]), AGAINST_CUES, CUES[kind])]


def _side(character: Column) -> Column:
    return F.when(character.rlike("[A-Za-z0-9]"), 2).when(character.rlike(r"[^\x20\x09-\x0D]"), 1).otherwise(0)


def features(s: Column) -> list[Column]:
    n = F.char_length(s["found"])
    return [F.least(F.lit(3), F.floor(n / 8)).cast("int"), F.floor(n_digits(s["found"]) * 4 / (n + 1)).cast("int"), _side(F.right(s["before"], F.lit(1))), _side(s["after"])]


def pattern_of(kind: str, s: Column) -> Column:
    """The number of a candidate's pattern: kind, votes and features as digits."""
    key = F.lit(KINDS.index(kind))
    for value, base in zip([*votes(kind, s), *features(s)], [3] * len(LABELERS) + list(FEATURES.values())):
        key = key * base + value
    return key.cast("int")


def parts_of(key: str = "key") -> dict[str, Column]:
    """Kind number, votes and features of a pattern."""
    out, rest = {}, F.col(key)
    for name, base in [*reversed(FEATURES.items()), *[(v, 3) for v in reversed(LABELERS)]]:
        out[name] = rest % base
        rest = F.floor(rest / base)
    out["kind"] = rest.cast("int")
    return out


def candidates(docs: DataFrame) -> DataFrame:
    """Written once, a row per document: doc_id, base (rank, start, stop), n_<kind>, loose (rank, start, stop, key), keys of all candidates."""
    d = docs.select("doc_id", text_of(docs).alias("t"))
    t = F.col("t")
    d = d.withColumn("numbers", t.rlike(NUMBERS))
    may = {"email": F.contains(t, F.lit("@")), "ip": F.col("numbers"), "card": F.col("numbers"), "phone": F.col("numbers") & F.contains(t, F.lit("+"))}
    may_loose = {"email": t.rlike(r"[(\[]at[)\]]"), "ip": F.contains(t, F.lit(":")), "phone": F.col("numbers"), "name": F.lit(True)}
    d = with_matches(d, "t", {k: (p, may[k]) for k, p in BASE.items()} | {f"loose_{k}": (p, may_loose[k]) for k, p in LOOSE.items()}).drop("t")
    spans = "array<struct<rank:int,start:int,stop:int,key:int,base:boolean>>"

    def listed(kind: str, column: str, base: Column | None) -> Column:
        def one(s: Column) -> Column:
            rank = F.lit(KINDS.index(kind))
            return F.struct(rank.alias("rank"), s["start"].alias("start"), s["stop"].alias("stop"), pattern_of(kind, s).alias("key"), (F.lit(False) if base is None else passes(kind, s["found"])).alias("base"))

        return F.transform(column, one).cast(spans)

    d = d.withColumn("card", F.filter("card", lambda s: n_digits(s["found"]) <= 19))
    d = d.withColumns({f"all_{k}": listed(k, k, F.lit(True)) for k in BASE_KINDS} | {f"all_loose_{k}": listed(k, f"loose_{k}", None) for k in LOOSE})
    base = {k: F.filter(f"all_{k}", lambda s: s["base"]) for k in BASE_KINDS}
    d = d.withColumns({f"base_{k}": v for k, v in base.items()})
    d = d.withColumn("base", F.concat(*[f"base_{k}" for k in BASE_KINDS]))
    loose = F.concat(*[f"all_loose_{k}" for k in LOOSE], F.filter("all_card", lambda s: ~s["base"]))
    d = d.withColumn("loose", F.filter(loose, lambda s: ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))))
    keys = F.transform(F.concat("base", "loose"), lambda s: s["key"])
    return settled(d.select("doc_id", "base", "loose", keys.alias("keys"), *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in BASE_KINDS]), "candidates")


# --- estimates: tables of at most PATTERNS rows ------------------------------------


def patterns(found: DataFrame) -> DataFrame:
    """key, its kind, votes and features, and n: how many candidates have it."""
    counted = found.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    return settled(counted.select("key", "n", *[c.cast("int").alias(name) for name, c in parts_of().items()]), "patterns")


def _likelihood(table: Column, vote_list: Column) -> Column:
    return reduce(lambda a, b: a * b, [table[j][vote_list[j]] for j in range(len(LABELERS))])


def posterior(state: Column, vote_list: Column) -> Column:
    yes = state["prior"] * _likelihood(state["yes"], vote_list)
    no = (1 - state["prior"]) * _likelihood(state["no"], vote_list)
    return yes / (yes + no)


def _maximised(rows: Column, belief) -> Column:
    """The parameters that suit the beliefs best, each count raised by one."""
    total = lambda weight: F.aggregate(rows, F.lit(0.0), lambda s, r: s + weight(r))

    def table(part) -> Column:
        share = lambda j, v: (total(lambda r: F.when(r["votes"][j] == v, part(r)).otherwise(0.0)) + 1) / (total(part) + 3)
        return F.array(*[F.array(*[share(j, v) for v in range(3)]) for j in range(len(LABELERS))])

    personal, other = (lambda r: r["n"] * belief(r)), (lambda r: r["n"] * (1 - belief(r)))
    prior = (total(personal) + 1) / (total(lambda r: r["n"]) + 2)
    return F.struct(prior.alias("prior"), table(personal).alias("yes"), table(other).alias("no"))


def reliabilities(table: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """kind and state (prior, yes and no: per labeler the chances of each vote), by expectation-maximisation."""
    by_votes = table.groupBy("kind", *LABELERS).agg(F.sum("n").cast("double").alias("n"))
    rows = by_votes.groupBy("kind").agg(F.array_sort(F.collect_list(F.struct(F.array(*LABELERS).alias("votes"), "n"))).alias("rows"))
    first = _maximised(F.col("rows"), lambda r: 0.5 + LEAN * (r["votes"][0] + r["votes"][1] + r["votes"][2] - 3))
    rows = rows.withColumn("first", first)
    step = lambda state, _: _maximised(F.col("rows"), lambda r: posterior(state, r["votes"]))
    return rows.select("kind", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.col("first"), step).alias("state"))


def weights(table: DataFrame, estimates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The classifier: (kind, prior) and (kind, feature, value, weight), log odds from the posteriors as soft labels."""
    beliefs = table.join(estimates, "kind").withColumn("p", posterior(F.col("state"), F.array(*LABELERS)))
    sums = [F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no")]
    of_kind = beliefs.groupBy("kind").agg(*sums)
    sizes = {**dict.fromkeys(LABELERS, 3), **FEATURES}
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(k).alias("values"), F.col(f).alias("value")) for f, k in sizes.items()]))
    by_value = beliefs.select("kind", "n", "p", cells.alias("x")).groupBy("kind", "x.feature", "x.values", "x.value").agg(*sums)
    whole = of_kind.select("kind", F.col("yes").alias("all_yes"), F.col("no").alias("all_no"))
    weight = F.expr("ln((yes + 1) / (all_yes + values)) - ln((no + 1) / (all_no + values))")
    return of_kind.select("kind", F.expr("ln((yes + 1) / (no + 1))").alias("prior")), by_value.join(whole, "kind").select("kind", "feature", "value", weight.alias("weight"))


def accepted(table: DataFrame, priors: DataFrame, of_values: DataFrame) -> DataFrame:
    """key and odds (log odds) of the patterns that the classifier takes for personal."""
    sizes = {**dict.fromkeys(LABELERS, 3), **FEATURES}
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in sizes]))
    odds = table.select("kind", "key", cells.alias("x")).select("kind", "key", "x.*").join(of_values, ["kind", "feature", "value"])
    odds = odds.groupBy("kind", "key").agg(F.sum("weight").alias("odds")).join(priors, "kind")
    odds = odds.join(table.where(F.col("shape") != AGAINST).select("key"), "key")
    return odds.select("key", F.round(F.col("odds") + F.col("prior"), 6).alias("odds")).where("odds > 0")


def _joined(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name[s["rank"]], s["start"], s["stop"])), ",")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (all spans as kind:start:end, by kind, then start)."""
    found = candidates(docs)
    table = patterns(found)
    priors, of_values = weights(table, reliabilities(table))
    taken = [r["key"] for r in accepted(table, priors, of_values).select("key").collect()]  # at most PATTERNS
    loose = F.filter("loose", lambda s: s["key"].isin(taken)) if taken else F.filter("loose", lambda s: F.lit(False))
    return found.select(
        "doc_id",
        *[f"n_{k}" for k in BASE_KINDS],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", loose))).alias("spans"),
    )
