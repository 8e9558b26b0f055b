"""DuckDB SQL for the rows of the corpus queries that SQL can state."""

from __future__ import annotations

from wearspan.llm import clustering, collocations, jaccard, mixing, parsing, quality, rollups, secrets, substring

W = r"[^\x20\x09-\x0D]+"

MIX = rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{W}')) AS BIGINT) AS size,
         md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS h
  FROM documents),
s AS MATERIALIZED (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS k
  FROM d GROUP BY source),
w AS MATERIALIZED (
  SELECT source, source_size, CASE k % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         source_size * {mixing.CAP} AS most, sum(source_size) OVER () AS goal
  FROM s),
f AS MATERIALIZED (
  SELECT *, coalesce(sum(most) OVER before, 0) AS filled,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS rest_weight
  FROM w
  WINDOW before AS (ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS MATERIALIZED (
  SELECT *, CAST(most AS HUGEINT) * rest_weight <= CAST(weight AS HUGEINT) * (goal - filled) AS is_full FROM f),
t AS MATERIALIZED (
  SELECT source, source_size,
         CASE WHEN is_full THEN CAST(most AS DOUBLE)
              ELSE CAST((goal - coalesce(sum(CASE WHEN is_full THEN most END) OVER (), 0)) * weight AS DOUBLE)
                   / sum(CASE WHEN NOT is_full THEN weight END) OVER () END AS target
  FROM g),
b AS MATERIALIZED (
  SELECT *, CAST(round(target) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM t),
r AS MATERIALIZED (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.whole, b.budget - b.whole * b.source_size AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS got
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(whole * size + CASE WHEN got + size <= rest THEN size ELSE greatest(0, rest - got) END AS BIGINT) AS taken
FROM r
"""

EXACT = r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
k AS MATERIALIZED (
  SELECT *, first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS place,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d WINDOW best AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id ASC NULLS LAST
                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM k
"""


def _token_counts() -> str:
    parts = [
        rf"SELECT source, lang, '{k}' AS tokenizer, CAST(count(*) AS BIGINT) AS docs, "
        rf"CAST(sum(len(regexp_extract_all(coalesce(text, ''), '{p}'))) AS BIGINT) AS tokens FROM documents GROUP BY source, lang"
        for k, p in rollups.TOKENIZERS.items()
    ]
    return "\nUNION ALL\n".join(parts)


TOKEN_COUNTS = _token_counts()


def _quality() -> str:
    n = quality.WINDOW
    unpivot = "\n  UNION ALL ".join(f"SELECT doc_id, lang, source, '{r}' AS rate, {r} AS value FROM rates" for r in quality.RATES)
    limits, inside = [], ["NOT base_failed"]
    for r, (part, times, least) in quality.RATES.items():
        reach = f"{quality.RANGES} * greatest(q75 - q25, {least})"
        high = f"q75 + {reach}" if times is None else f"greatest({times} * q{part}, q{part} + {least})"
        limits.append(f"max(CASE WHEN rate = '{r}' THEN {high} END) AS {r}_high")
        inside.append(f"{r} <= {r}_high")
        if r in quality.TWO_SIDED:
            limits.append(f"max(CASE WHEN rate = '{r}' THEN q25 - {reach} END) AS {r}_low")
            inside.append(f"{r} >= {r}_low")
    need = "CASE rate " + " ".join(f"WHEN '{r}' THEN {quality.least_docs(r, quality.MIN_GROUP)}" for r in quality.RATES) + " END"

    def quantiles(name: str, by: str) -> str:
        """Quantiles by counting values; least says whether the group is large enough."""
        cells = ", ".join(f"min(value) FILTER (run * 100 >= docs * {p}) AS q{p}" for p in (25, 75, 99))
        return f"""
{name} AS MATERIALIZED (
  SELECT {by}rate, {cells}, max(docs) >= {need} AS large
  FROM (SELECT *, sum(n) OVER (PARTITION BY {by}rate ORDER BY value) AS run, sum(n) OVER (PARTITION BY {by}rate) AS docs
        FROM (SELECT {by}rate, value, count(*) AS n FROM v GROUP BY ALL))
  GROUP BY {by}rate)"""

    pick = ", ".join(f"CASE WHEN o.large THEN o.q{p} WHEN l.large THEN l.q{p} ELSE a.q{p} END AS q{p}" for p in (25, 75, 99))
    return rf"""
WITH d AS MATERIALIZED (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{W}') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{W}')) AS lines
  FROM documents),
p AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(words[i:i + {n - 1}], ' ') AS w
  FROM d, unnest(range(1, len(words) - {n - 2})) AS u(i) WHERE len(words) >= {n}),
twice AS MATERIALIZED (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS c FROM p) WHERE c > 1),
covered AS MATERIALIZED (
  SELECT doc_id, CAST(sum(least({n}, coalesce(nxt - i, {n}))) AS BIGINT) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM twice) GROUP BY doc_id),
m AS MATERIALIZED (
  SELECT d.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '{quality.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id)),
rates AS MATERIALIZED (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words AS base_failed,
         n_symbols * 1000 // greatest(n_words, 1) AS symbols, n_dup_lines * 1000 // greatest(n_lines, 1) AS lines,
         n_repeat_words * 1000 // greatest(n_words, 1) AS repeats, word_chars * 1000 // greatest(n_words, 1) AS length
  FROM m),
v AS MATERIALIZED (
  SELECT lang, source, rate, (value >> greatest(length(bin(value)) - 7, 0)) << greatest(length(bin(value)) - 7, 0) AS value
  FROM ({unpivot})),{quantiles("q_own", "lang, source, ")},{quantiles("q_lang", "lang, ")},{quantiles("q_all", "")},
q AS MATERIALIZED (
  SELECT o.lang, o.source, o.rate, {pick}
  FROM q_own o JOIN q_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.rate = l.rate JOIN q_all a ON o.rate = a.rate),
x AS MATERIALIZED (SELECT lang, source, {", ".join(limits)} FROM q GROUP BY lang, source)
SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, {" AND ".join(inside)} AS kept
FROM rates r JOIN x ON r.lang IS NOT DISTINCT FROM x.lang AND r.source IS NOT DISTINCT FROM x.source
"""


QUALITY = _quality()


def _secrets() -> str:
    """Spans by walking over the pieces between matches; the entropy of every window from its letters."""

    def spans(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
        p = pattern.replace("'", "''")
        return f"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, found, inn,
         CAST(sum(length(gap)) OVER w + coalesce(sum(length(found)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s
  FROM (SELECT doc_id, generate_subscripts(founds, 1) AS i, unnest(founds) AS found, unnest(inns) AS inn, unnest(gaps[1:len(founds)]) AS gap
        FROM (SELECT doc_id, regexp_extract_all(t, '({p})', 1) AS founds, regexp_extract_all(t, '{p}', {group}) AS inns,
                     string_split_regex(t, '{p.replace("([A-Za-z0-9+/_.=-]+)", "[A-Za-z0-9+/_.=-]+")}') AS gaps
              FROM d WHERE regexp_matches(t, '{p}')))
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)"""

    parts = [spans(k, r, secrets.LONG.get(k, p), g, n) for r, (k, (p, g, n)) in enumerate(secrets.BASE.items())]
    other = spans("entropy", len(secrets.BASE), secrets.CANDIDATE, 0, 0)
    n = secrets.WINDOW
    allowed = " OR ".join(f"regexp_matches(found, '{p}')" for p in secrets.ALLOWED if p.startswith("^"))
    same = "|".join(f"[{c}]{{6,}}" for c in secrets.LETTERS)
    plogp = "[" + ", ".join(map(str, secrets.PLOGP)) + "]"
    import math

    top = round(math.log2(n) * 1e6)
    lim = secrets.LIMITS
    return rf"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t FROM documents),
base AS MATERIALIZED (
  SELECT doc_id, rank, kind, s, s + length(found) AS e FROM ({" UNION ALL ".join(parts)})
  WHERE length(inn) >= CASE kind WHEN 'assign' THEN 6 WHEN 'access' THEN 20 ELSE 24 END),
run AS MATERIALIZED (SELECT doc_id, rank, kind, s, s + length(found) AS e, found FROM ({other})),
touched AS MATERIALIZED (SELECT * FROM run o WHERE EXISTS (SELECT 1 FROM base b WHERE b.doc_id = o.doc_id AND b.s < o.e AND o.s < b.e)),
beside AS MATERIALIZED (
  SELECT doc_id, s, i - row_number() OVER (PARTITION BY doc_id, s ORDER BY i) AS island, i
  FROM (SELECT doc_id, s, unnest(range(s, e)) AS i FROM touched) p
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = p.doc_id AND b.s <= p.i AND p.i < b.e)),
open AS MATERIALIZED (
  SELECT * FROM (
    SELECT * FROM run ANTI JOIN touched USING (doc_id, s)
    UNION ALL
    SELECT doc_id, rank, kind, lo AS s, hi AS e, found[lo - s + 1:hi - s] AS found
    FROM (SELECT doc_id, s, min(i) AS lo, max(i) + 1 AS hi FROM beside GROUP BY doc_id, s, island) JOIN touched USING (doc_id, s))
  WHERE length(found) >= {n} AND NOT ({allowed})),
part AS MATERIALIZED (
  SELECT doc_id, s, generate_subscripts(parts, 1) AS j, unnest(parts) AS part
  FROM (SELECT doc_id, s, list_filter(string_split(array_to_string(list_transform(
          regexp_extract_all(found, '[A-Za-z0-9]+|[^A-Za-z0-9]+'),
          lambda x: CASE WHEN regexp_matches(x, '{secrets.ALLOWED[3]}') THEN chr(1) ELSE regexp_replace(x, '{same}', chr(1), 'g') END), ''), chr(1)),
        lambda x: length(x) >= {n}) AS parts FROM open)),
best AS MATERIALIZED (
  SELECT doc_id, s, min(x) AS least
  FROM (SELECT doc_id, s, j, i, sum({plogp}[c + 1]) AS x
        FROM (SELECT doc_id, s, j, i, ch, count(*) AS c
              FROM (SELECT doc_id, s, j, i, unnest(string_split(part[i:i + {n - 1}], '')) AS ch
                    FROM part, unnest(range(1, length(part) - {n - 2})) AS u(i)) GROUP BY ALL) GROUP BY doc_id, s, j, i)
  GROUP BY doc_id, s),
secret AS MATERIALIZED (
  SELECT o.doc_id, rank, kind, o.s, e FROM open o JOIN best b ON o.doc_id = b.doc_id AND o.s = b.s
  WHERE {top} - CAST(floor(least / {n}) AS BIGINT) >= CASE WHEN regexp_matches(found, '^[0-9a-fA-F]+$') THEN {lim["hex"]}
        WHEN regexp_matches(found, '^[A-Za-z0-9]+$') THEN {lim["alnum"]} ELSE {lim["base64"]} END),
spans AS MATERIALIZED (SELECT * FROM base UNION ALL SELECT * FROM secret),
by_doc AS MATERIALIZED (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (kind <> 'entropy') AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN by_doc ON d.doc_id = by_doc.doc_id
"""


SECRETS = _secrets()


SUBSTRING = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{W}') AS words FROM documents),
p AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(words[i:i + {substring.MIN_WORDS - 1}], ' ')) AS h
  FROM d, unnest(range(1, len(words) - {substring.MIN_WORDS - 2})) AS u(i) WHERE len(words) >= {substring.MIN_WORDS}),
r AS MATERIALIZED (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS c FROM p) WHERE c > 1),
w AS MATERIALIZED (SELECT doc_id, generate_subscripts(words, 1) AS j, unnest(words) AS word FROM d),
m AS MATERIALIZED (
  SELECT w.doc_id, j, word,
         coalesce(max(r.i) OVER (PARTITION BY w.doc_id ORDER BY j) > j - {substring.MIN_WORDS}, false) AS gone
  FROM w LEFT JOIN r ON w.doc_id = r.doc_id AND w.j = r.i),
k AS MATERIALIZED (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (NOT gone) AS kept
  FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

# Bytes as pairs of hexadecimal digits.
PARSING = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n_bytes FROM documents),
b AS MATERIALIZED (  -- stretches of 200 starts, as slicing takes time in proportion to the string
  SELECT doc_id, n_bytes, b, x[2 * b + 1:2 * b + {2 * (200 + parsing.MIN_BYTES)}] AS x
  FROM d, unnest(range(0, n_bytes - {parsing.MIN_BYTES - 1}, 200)) AS u(b) WHERE n_bytes >= {parsing.MIN_BYTES}),
p AS MATERIALIZED (
  SELECT doc_id, i, md5(x[2 * (i - b) + 1:2 * (i - b) + {2 * parsing.MIN_BYTES}]) AS h
  FROM b, unnest(range(b, least(b + 200, n_bytes - {parsing.MIN_BYTES - 1}))) AS u(i)),
r AS MATERIALIZED (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS c FROM p) WHERE c > 1),
g AS MATERIALIZED (
  SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > {parsing.MIN_BYTES}, true) AS opens FROM r),
s AS MATERIALIZED (
  SELECT doc_id, run, min(i) AS b, max(i) + {parsing.MIN_BYTES} AS e
  FROM (SELECT doc_id, i, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g) GROUP BY doc_id, run),
k AS MATERIALIZED (
  SELECT d.doc_id, count(*) AS n_spans, CAST(sum(e - b) AS BIGINT) AS n_removed,
         string_agg(d.x[2 * before + 1:2 * b], '' ORDER BY run) || any_value(d.x)[2 * max(e) + 1:] AS kept
  FROM (SELECT *, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY run), 0) AS before FROM s) s JOIN d ON d.doc_id = s.doc_id
  GROUP BY d.doc_id)
SELECT d.doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, x))) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""

JACCARD = rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{W}') AS words
  FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS sh
  FROM d, unnest(range(1, greatest(len(words) - 2, 2))) AS u(i) WHERE len(words) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (
  SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id
  WHERE 100 * common >= {jaccard.PERCENT} * (nx.n + ny.n - common)),
e AS MATERIALIZED (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.other = e.x),
c AS MATERIALIZED (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM c LEFT JOIN n ON c.doc_id = n.doc_id
"""


def _clusters() -> str:
    """Each round is three tables: distances decide, cells are summed, empty centroids stay."""
    n, parts = clustering.DIMENSIONS, []
    for r in range(clustering.ROUNDS + 1):
        parts.append(f"""
a{r} AS MATERIALIZED (
  SELECT rid, min({{'d': CAST(vv - 2 * list_inner_product(v, c) + list_inner_product(c, c) AS BIGINT), 'k': k}}) AS best
  FROM v, c{r} GROUP BY rid)""")
        if r < clustering.ROUNDS:
            parts.append(f"""
m{r} AS MATERIALIZED (
  SELECT k, list(CAST(cell AS DOUBLE) ORDER BY i) AS c
  FROM (SELECT best.k AS k, i, floor(sum(v[i]) / count(*)) AS cell FROM a{r} JOIN v USING (rid), range(1, {n + 1}) AS u(i) GROUP BY ALL)
  GROUP BY k),
c{r + 1} AS MATERIALIZED (SELECT c{r}.k, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} ON c{r}.k = m{r}.k)""")
    last = clustering.ROUNDS
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, v, list_inner_product(v, v) AS vv
  FROM (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
        WHERE len(embedding) = {n} AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))))),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h ASC NULLS LAST, v) - 1 AS k, v AS c
  FROM (SELECT sha256('{clustering.SEED}:' || CAST(vec_id AS VARCHAR)) AS h, v FROM v ORDER BY h ASC NULLS LAST, v LIMIT {clustering.CENTROIDS})),
{",".join(parts)}
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, best.d AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{last} JOIN v USING (rid) JOIN c{last} ON best.k = c{last}.k
"""


CLUSTERS = _clusters()

COLLOCATIONS = rf"""
WITH p AS MATERIALIZED (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
t AS MATERIALIZED (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, size, phrase, count(*) AS a
  FROM (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
        FROM p, unnest(range(1, {collocations.MAX_WORDS + 1})) AS s(size), unnest(range(1, len(w) - size + 2)) AS u(i))
  GROUP BY ALL),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= {collocations.LEAST}),
k AS MATERIALIZED (
  SELECT c.lang, c.phrase, c.size, c.a, min({{'score': CAST(CAST(c.a AS HUGEINT) * c.a * {collocations.MILLION} // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT),
                                              'k': k, 'l': x.a, 'r': y.a}}) AS worst
  FROM c, unnest(range(1, size)) AS u(k)
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
  GROUP BY ALL),
s AS MATERIALIZED (
  SELECT DISTINCT c.lang, array_to_string(c.w[i:i + n - 1], ' ') AS phrase, c.a AS longer
  FROM c, unnest(range(2, size)) AS v(n), unnest(range(1, size - n + 2)) AS u(i)),
o AS MATERIALIZED (SELECT * FROM k WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.lang = k.lang AND s.phrase = k.phrase AND 100 * longer >= {collocations.SWALLOW} * k.a)),
r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY worst.score DESC, a DESC, phrase) AS rank FROM o)
SELECT r.lang, rank, phrase, a, worst.l AS l, worst.r AS r, n, worst.score AS score FROM r JOIN t ON r.lang = t.lang WHERE rank <= {collocations.TOP}
"""
