"""DuckDB SQL of the corpus queries that SQL can express.

Each statement is written from the query's definition (plain windows over
unnested words), not from the Spark plan."""

from __future__ import annotations

WORDS_1 = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP1 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce({WORDS_1}, []) AS w FROM documents),
i AS (SELECT item_id, coalesce({WORDS_1}, []) AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)),
spots AS (
  SELECT r, s, k, array_to_string(w[s:s + k - 1], ' ') AS gram
  FROM (SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS s
        FROM d, (SELECT DISTINCT k FROM grams) WHERE len(w) >= k)),
hits AS (SELECT r, s, spots.k, item_id FROM spots JOIN grams ON spots.k = grams.k AND spots.gram = grams.gram),
covered AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + k - 1)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN items USING (r)
"""

# separators: blank and the characters 9 to 13
_SEP = r"[\x20\x09-\x0D]"


def _op5() -> str:
    from clientlens.llm.quality import (COVERAGE_PCT, LINE_CHARS_PCT, SHORT_COVERAGE_PCT, SHORT_LINE_CHARS_PCT, SHORT_WORDS,
                                        SYMBOLS_PCT)
    most = lambda pct, short: f"CASE WHEN len(w) < {SHORT_WORDS} THEN {short} ELSE {pct} END"
    grams = "\nUNION ALL\n".join(
        f"SELECT {n} AS n, r, s, array_to_string(w[s:s + {n - 1}], ' ') AS gram FROM "
        f"(SELECT r, w, unnest(generate_series(1, len(w) - {n - 1})) AS s FROM d WHERE len(w) >= {n})"
        for n in COVERAGE_PCT)
    over = " OR ".join(f"coalesce(c{n}, 0) * 100 > ({most(pct, SHORT_COVERAGE_PCT[n])}) * word_chars" for n, pct in COVERAGE_PCT.items())
    sums = ", ".join(f"sum(chars) FILTER (n = {n}) AS c{n}" for n in COVERAGE_PCT)
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, text,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS ({grams}),
twice AS (SELECT n, r, s FROM (SELECT n, r, s, count(*) OVER (PARTITION BY n, r, gram) AS c FROM g) WHERE c > 1),
inside AS (SELECT DISTINCT n, r, unnest(generate_series(s, s + n - 1)) AS p FROM twice),
cover AS (SELECT r, count(*) FILTER (n = 5) AS n_repeat_words, {sums}
          FROM (SELECT inside.n, inside.r, len(d.w[p]) AS chars FROM inside JOIN d USING (r)) GROUP BY r),
lines AS (SELECT r, line, k, row_number() OVER (PARTITION BY r, line ORDER BY k) AS nth,
                 list_sum([len(x) for x in regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')]) AS chars
          FROM (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d)),
dup AS (SELECT r, count(*) AS n_dup_lines, sum(chars) AS line_chars FROM lines WHERE nth > 1 AND chars > 0 GROUP BY r),
f AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum([len(x) for x in w]), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         ({over} OR coalesce(line_chars, 0) * 100 > ({most(LINE_CHARS_PCT, SHORT_LINE_CHARS_PCT)}) * word_chars) AS over_coverage
  FROM d LEFT JOIN cover USING (r) LEFT JOIN dup USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR over_coverage
            OR 100 * n_symbols > {SYMBOLS_PCT} * n_words) AS kept
FROM f
"""


_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def _op2() -> str:
    from clientlens.llm.urlgraph import LINK, RULES
    # plain rounds until the rest of the walk is below 1e-7 of its mass, and the blocking margin
    damping, last, margin = 0.85, 100, 1.01
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rules = ", ".join(f"({quote(r.host)}, {quote(r.path)}, {quote(r.verdict)})" for r in RULES)
    rounds = "".join(f"""
r{i + 1} AS MATERIALIZED (
  SELECT host, sum(t) AS t, sum(d) AS d FROM (
    SELECT target AS host, {damping} * r.t * links / all_out AS t, 0.0::DOUBLE AS d
    FROM edges JOIN outs USING (source) JOIN r{i} r ON r.host = source
    UNION ALL
    SELECT source, 0.0, {damping} * r.d * links / all_in FROM edges JOIN ins USING (target) JOIN r{i} r ON r.host = target
    UNION ALL SELECT * FROM r0) GROUP BY host),""" for i in range(last))
    return f"""
WITH p AS (
  SELECT page_id, row_number() OVER () AS n, html,
         translate(coalesce(regexp_extract(url, '{_URL}', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '{_URL}', 2), '') AS path FROM pages),
rules(rh, rp, verdict) AS (VALUES {rules}),
fit AS (
  SELECT n, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict
  FROM p JOIN rules ON (host = rh OR suffix(host, '.' || rh)) AND starts_with(path, rp) GROUP BY n),
links AS (
  SELECT host AS source, translate(unnest(regexp_extract_all(html, {quote(LINK)}, 1)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target FROM p),
far AS (SELECT source, target, count(*) AS links FROM links WHERE source != '' AND source != target GROUP BY ALL),
hosts AS (SELECT host FROM p UNION SELECT target FROM far),
up AS (SELECT host AS source, regexp_extract(host, '^[^.]+\\.([^.]+\\..+)$', 1) AS target FROM hosts),
family AS (SELECT * FROM up WHERE target != '' UNION SELECT target, source FROM up WHERE target != ''),
edges AS MATERIALIZED (
  SELECT source, target, sum(links) AS links
  FROM (SELECT * FROM far UNION ALL SELECT source, target, 1 FROM family) GROUP BY ALL),
outs AS (SELECT source, sum(links) AS all_out FROM edges GROUP BY source),
ins AS (SELECT target, sum(links) AS all_in FROM edges GROUP BY target),
c AS (SELECT host, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS b
      FROM p JOIN fit USING (n) GROUP BY host),
r0 AS MATERIALIZED (
  SELECT host, {1 - damping} * coalesce(a / nullif(sum(a) OVER (), 0), 0) AS t,
         {1 - damping} * coalesce(b / nullif(sum(b) OVER (), 0), 0) AS d FROM c),{rounds}
last AS (SELECT host, t * {margin} AS t, d FROM r{last})
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN coalesce(d, 0) > coalesce(t, 0) THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fit USING (n) LEFT JOIN last USING (host)
"""


def _op6() -> str:
    from clientlens.llm.licenses import RULES, SENTENCES, TAG, VAGUE
    names = ", ".join(f"'{s}': '{name}'" for name, s in SENTENCES.items())
    fits = ", ".join(f"CASE WHEN contains(l, ',{','.join(rule)},') THEN '{name}' END" for name, rule in RULES)
    cut = (r"list_filter(list_transform(string_split(regexp_replace({0}, '([.!?])([ \t\r\n])', '\1' || chr(10), 'g'), chr(10)), "
           r"lambda s: trim(regexp_replace(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^0-9a-z\x{{80}}-\x{{10FFFF}}]+', ' ', 'g'))), lambda s: s != '')")
    parts = (f"list_transform(string_split_regex(replace(substr(s, {len(TAG) + 1}), ' or later', ' or_later'), ' (?:or|and|with) '), "
             f"lambda n: '{TAG}' || replace(n, 'or_later', 'or later'))")
    tagged = f"flatten(list_transform({{0}}, lambda s: CASE WHEN starts_with(s, '{TAG}') THEN {parts} ELSE [s] END))"
    ids = f"list_filter(list_transform({tagged}, lambda s: k[s]), lambda x: x IS NOT NULL)"
    precise = "all_found"
    for name, better in VAGUE.items():
        some = ", ".join(f"'{b}'" for b in better)
        precise = f"CASE WHEN list_has_any(all_found, [{some}]) THEN list_filter({precise}, lambda x: x != '{name}') ELSE {precise} END"
    return f"""
WITH names AS (SELECT MAP {{{names}}} AS k),
s AS (SELECT doc_id, {cut.format("coalesce(text, '')")} AS a,
             {cut.format("regexp_replace(coalesce(text, ''), '([^\\n])\\n([^\\n])', '\\1 \\2', 'g')")} AS b FROM documents),
i AS (SELECT doc_id, len(a) AS n_sentences, {ids.format("a")} AS a, {ids.format("b")} AS b FROM s, names),
f AS (SELECT doc_id, n_sentences, a, ',' || array_to_string(a, ',') || ',' AS l, ',' || array_to_string(b, ',') || ',' AS m FROM i)
SELECT doc_id, n_sentences::BIGINT AS n_sentences, len(a)::BIGINT AS n_known, coalesce(array_to_string(a, ','), '') AS sentence_ids,
       coalesce(array_to_string(list_sort({precise}), ','), '') AS licenses
FROM (SELECT *, list_distinct(list_filter(list_concat([{fits}], [{fits.replace('contains(l,', 'contains(m,')}]),
                                          lambda x: x IS NOT NULL)) AS all_found FROM f)
"""


# base32 of a SHA-1: five hex digits are twenty bits, four base32 digits
_BASE32 = "||".join(
    "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"(('0x' || substr(sha1(html), {5 * g + 1}, 5))::BIGINT // {32 ** (3 - j)}) % 32 + 1, 1)" for g in range(8) for j in range(4))

OP7 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id != first THEN first END AS refers_to
FROM f
"""


# the score of every document that shares a term with an item, and the first ten
OP13 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {WORDS_1} AS w FROM documents WHERE text IS NOT NULL),
q AS (SELECT item_id, row_number() OVER () AS q, {WORDS_1} AS w FROM benchmark WHERE text IS NOT NULL),
size AS (SELECT count(*) FILTER (len(w) > 0) AS docs, sum(len(w)) AS words FROM d),
damp AS (SELECT r, doc_id, 25 + ((75 * len(w) * docs) // words)::BIGINT AS m FROM d, size WHERE len(w) > 0),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
asked AS (SELECT q, term, count(*) AS times FROM (SELECT q, unnest(w) AS term FROM q) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
           FROM tf, size GROUP BY term, docs),
scored AS (SELECT q, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
           FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN damp USING (r) GROUP BY q, r),
ranked AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
           FROM scored JOIN damp USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN q USING (q) WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_benchmark_decontamination": OP1, "op2_url_filters": _op2(), "op5_quality_rules": _op5(),
            "op6_license_scans": _op6(), "op7_warc": OP7, "op13_lexical_search": OP13}
