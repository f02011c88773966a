"""SQL twins of the registered queries, for DuckDB."""

from __future__ import annotations

from tidewire.llm import licenses, quality, raking, url_filters

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

TOP_K = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
      FROM scored)
WHERE rank <= 5
"""

_PLAIN = "replace(replace(lower(text), '.', ''), ',', '')"
_COUNTS = {
    "lower": r"length(text) - length(no_lower)",
    "space": r"length(no_lower) - length(rest)",
    "upper": r"len(regexp_extract_all(rest, '\p{Lu}'))",
    "digit": r"len(regexp_extract_all(rest, '\p{N}'))",
    "letter": r"len(regexp_extract_all(rest, '[\p{Lo}\p{Lt}\p{Lm}\p{M}]'))",
    "stop": r"len(regexp_extract_all(rest, '[.,]'))",
}
_KINDS = ", ".join(f"'{name}'" for name in quality.CLASSES)


def _part(p: str, q: str) -> str:
    return f"CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END"


QUALITY = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
based AS (
  SELECT *, {WORDS.format('text')} AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         regexp_replace(text, '\p{{Ll}}+', '', 'g') AS no_lower
  FROM docs),
windows AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM based)),
covered AS (
  SELECT rid, count(DISTINCT i + step) AS n
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM windows), range(0, 3) t(step)
  WHERE c > 1 GROUP BY rid),
resting AS (SELECT *, regexp_replace(no_lower, '[\x20\x09-\x0D]+', '', 'g') AS rest FROM based),
counted AS (
  SELECT *, length(rest) - c_upper - c_digit - c_letter - c_stop AS c_other
  FROM (SELECT rid, lang, {', '.join(f"{sql} AS c_{name}" for name, sql in _COUNTS.items())}, rest
        FROM resting)),
kinds AS (
  SELECT rid, lang, unnest([{_KINDS}]) AS kind,
         unnest([{', '.join(f'c_{name}' for name in quality.CLASSES)}]) AS n
  FROM counted),
tokens AS (SELECT rid, lang, unnest({WORDS.format(_PLAIN)}) AS word FROM docs),
languages AS (
  SELECT lang, count(*) AS words FROM tokens WHERE lang IS NOT NULL
  GROUP BY lang HAVING count(*) >= {quality.REFERENCE_WORDS}),
common AS (
  SELECT lang, word, count(*) / any_value(words) AS q
  FROM tokens JOIN languages USING (lang) GROUP BY lang, word
  HAVING count(*) >= {quality.COMMON_SHARE} * any_value(words)),
class_refs AS (
  SELECT lang AS ref, kind, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q
  FROM kinds WHERE lang IN (SELECT lang FROM languages) GROUP BY lang, kind),
class_distances AS (
  SELECT rid, min(d) AS class_distance
  FROM (SELECT rid, ref, sqrt(greatest(sum({_part('p', 'q')} + {_part('q', 'p')}) / 2, 0)) AS d
        FROM (SELECT rid, kind, n / greatest(sum(n) OVER (PARTITION BY rid), 1) AS p FROM kinds)
        JOIN class_refs USING (kind) GROUP BY rid, ref)
  GROUP BY rid),
sizes AS (SELECT rid, greatest(len({WORDS.format(_PLAIN)}), 1) AS size FROM docs),
seen AS (
  SELECT rid, common.lang AS ref, count(*) / any_value(size) AS p, any_value(q) AS q
  FROM tokens JOIN common USING (word) JOIN sizes USING (rid) GROUP BY rid, common.lang, word),
matched AS (
  SELECT rid, ref, sum({_part('p', 'q')} + {_part('q', 'p')}) AS d, sum(p) AS p, sum(q) AS q
  FROM seen GROUP BY rid, ref),
ref_totals AS (SELECT lang AS ref, sum(q) AS total FROM common GROUP BY lang),
rests AS (
  SELECT rid, ref, coalesce(d, 0) AS d, total - coalesce(q, 0) AS missing, 1 - coalesce(p, 0) AS p, 1 - total AS q
  FROM docs JOIN ref_totals ON true LEFT JOIN matched USING (rid, ref)),
near_words AS (
  SELECT rid, ref, sqrt(greatest((d + missing + {_part('p', 'q')} + {_part('q', 'p')}) / 2, 0)) AS d FROM rests),
word_distances AS (
  SELECT rid, coalesce(max(CASE WHEN ref = lang AND d <= max_distance THEN d END), min(d)) AS word_distance
  FROM near_words JOIN (
    SELECT rid, lang, {quality.MAX_WORD_DISTANCE} + {quality.WORD_DISTANCE_SLACK} / sqrt(greatest(len(words), 1))
      AS max_distance
    FROM based) USING (rid)
  GROUP BY rid),
features AS (
  SELECT doc_id, lang, len(words) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words, class_distance, word_distance
  FROM based LEFT JOIN covered USING (rid) LEFT JOIN class_distances USING (rid)
       LEFT JOIN word_distances USING (rid)),
judged AS (
  SELECT *, n_words < {quality.MIN_WORDS}
            OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM features)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance, base_failed,
       NOT base_failed AND (
         (SELECT count(*) = 0 FROM languages)
         OR coalesce(lang NOT IN (SELECT lang FROM languages), false)
         OR (class_distance <= {quality.MAX_CLASS_DISTANCE}
             AND word_distance <= {quality.MAX_WORD_DISTANCE}
                 + {quality.WORD_DISTANCE_SLACK} / sqrt(greatest(n_words, 1)))) AS kept
FROM judged
"""

_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://"
URL_KEYS = rf"""parsed AS (
  SELECT page_id, url, fetched_at, labels, parts, array_to_string(labels, '.') AS host
  FROM (SELECT *, string_split(regexp_replace(lower(regexp_extract(url, '{_URL}(?:[^/?#@]*@)?([^/?#:]+)', 1)),
                                              '^www\.|\.+$', '', 'g'), '.') AS labels,
               list_filter(string_split(regexp_extract(url, '{_URL}[^/?#]*([^?#]*)', 1), '/'),
                           lambda x: x <> '') AS parts
        FROM captures)),
keyed AS (
  SELECT DISTINCT page_id, url, fetched_at, unnest(
           list_transform(range(1, greatest(len(labels) - 1, 1) + 1),
                          lambda i: array_to_string(labels[i:], '.'))
           || list_transform(range(1, least(len(parts), {url_filters.PATH_DEPTH}) + 1),
                             lambda i: host || '/' || array_to_string(parts[:i], '/'))) AS rule
  FROM parsed WHERE host <> '')"""

URL_FILTER = rf"""
WITH captures AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01' + to_seconds((page_id * 7919) % 2592000) AS fetched_at
  FROM pages),
{URL_KEYS},
drawn AS (
  SELECT rule, CAST('0x' || substr(md5(rule), 1, 4) AS BIGINT) AS a,
         CAST('0x' || substr(md5(rule), 5, 4) AS BIGINT) AS b,
         CAST('0x' || substr(md5(rule), 9, 4) AS BIGINT) AS c
  FROM (SELECT DISTINCT rule FROM keyed)),
entries AS (
  SELECT rule, ['gambling', 'malware', 'spam', 'allow'][c % 4 + 1] AS category,
         unnest(['add', 'remove', 'add']) AS action,
         TIMESTAMP '2024-01-01' + to_days(CAST(unnest([a % 28, a % 28 + 1 + b % 7, a % 28 + 9 + c % 7]) AS INTEGER))
           AS dated
  FROM drawn),
states AS (SELECT rule, category, dated, max(action) AS action FROM entries GROUP BY ALL),
changes AS (
  SELECT * FROM (SELECT *, lag(action) OVER (PARTITION BY rule, category ORDER BY dated) AS before FROM states)
  WHERE action IS DISTINCT FROM before),
intervals AS (
  SELECT * FROM (SELECT *, lead(dated) OVER (PARTITION BY rule, category ORDER BY dated) AS valid_to FROM changes)
  WHERE action = 'add'),
verdicts AS (
  SELECT url, fetched_at, count(*) AS n_active,
         array_to_string(list_sort(list_distinct(list(category))), ',') AS categories,
         max(CASE WHEN category = 'allow' THEN length(rule) END) AS allow,
         max(CASE WHEN category <> 'allow' THEN length(rule) END) AS block
  FROM (SELECT DISTINCT url, fetched_at, rule FROM keyed) JOIN intervals USING (rule)
  WHERE fetched_at >= dated AND (valid_to IS NULL OR fetched_at < valid_to)
  GROUP BY url, fetched_at)
SELECT page_id, url, fetched_at, coalesce(n_active, 0) AS n_active, coalesce(categories, '') AS categories,
       coalesce(block > coalesce(allow, -1), false) AS blocked
FROM captures LEFT JOIN verdicts USING (url, fetched_at)
"""

MIXING = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(source, '{raking.NONE}') AS source, coalesce(lang, '{raking.NONE}') AS lang,
         CASE WHEN regexp_matches(coalesce(text, ''), '[Ll]icen[sc]ed under|[Rr]eleased under the') THEN 'legal'
              WHEN regexp_matches(coalesce(text, ''), '\|[\x20\x09-\x0D]+[^|]*\|') THEN 'tabular'
              WHEN regexp_matches(coalesce(text, ''), '[0-9]{{3}}') THEN 'figures'
              WHEN regexp_matches(coalesce(text, ''), '\n[^\n]*\n') THEN 'prose' ELSE 'note' END AS topic,
         coalesce(len({WORDS.format('text')}), 0) AS n_tokens,
         CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT)
           / 4294967296.0::DOUBLE AS draw
  FROM documents),
cells AS MATERIALIZED (
  SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM docs GROUP BY ALL),
margins AS MATERIALIZED (
  SELECT *, pow(there, {raking.FLATNESS}) AS w,
         {raking.KEPT_SHARE} * (SELECT sum(tokens) FROM cells) AS budget
  FROM (SELECT 'source' AS dim, source AS v, sum(tokens) AS there FROM cells GROUP BY ALL
        UNION ALL SELECT 'lang', lang, sum(tokens) FROM cells GROUP BY ALL
        UNION ALL SELECT 'topic', topic, sum(tokens) FROM cells GROUP BY ALL)
  WHERE there > 0),
levels AS (
  SELECT 0 AS k, dim, v, there, w, budget, 0::DOUBLE AS level FROM margins
  UNION ALL
  SELECT k + 1, dim, v, there, w, budget, greatest(level, coalesce((budget
           - sum(CASE WHEN there <= level * w THEN there ELSE 0 END) OVER (PARTITION BY dim))
           / nullif(sum(CASE WHEN there <= level * w THEN 0 ELSE w END) OVER (PARTITION BY dim), 0), level))
  FROM levels WHERE k < 30),
goals AS MATERIALIZED (SELECT dim, v, least(there, level * w) AS goal FROM levels WHERE k = 30),
sweeps AS (
  SELECT 0 AS k, source, lang, topic, tokens, s.goal AS s_goal, l.goal AS l_goal, t.goal AS t_goal,
         CASE WHEN s.goal IS NULL OR l.goal IS NULL OR t.goal IS NULL THEN 0::DOUBLE
              ELSE {raking.KEPT_SHARE}::DOUBLE END AS factor
  FROM cells LEFT JOIN goals s ON s.dim = 'source' AND s.v = source
       LEFT JOIN goals l ON l.dim = 'lang' AND l.v = lang
       LEFT JOIN goals t ON t.dim = 'topic' AND t.v = topic
  UNION ALL
  SELECT k + 1, source, lang, topic, tokens, s_goal, l_goal, t_goal,
         least(factor * CASE WHEN given > 0 THEN goal / given ELSE 1 END, {raking.MOST})
  FROM (SELECT *, CASE k % 3 WHEN 0 THEN s_goal WHEN 1 THEN l_goal ELSE t_goal END AS goal,
               sum(tokens * least(1, factor)) OVER (
                 PARTITION BY CASE k % 3 WHEN 0 THEN source WHEN 1 THEN lang ELSE topic END) AS given
        FROM sweeps)
  WHERE k < {3 * raking.MAX_SWEEPS}),
shares AS MATERIALIZED (
  SELECT source, lang, topic, least(1, factor) AS share FROM sweeps WHERE k = {3 * raking.MAX_SWEEPS})
SELECT doc_id, source, lang, topic, n_tokens, round(share, 5) AS share, draw < share AS kept
FROM docs JOIN shares USING (source, lang, topic)
"""


def _licence_sql() -> str:
    numbers = {name: i for i, (name, _) in enumerate(licenses.SENTENCES, 1)}

    def marked(patterns: tuple[tuple[str, str], ...]) -> str:
        x = "x"
        for name, pattern in patterns:
            x = f"regexp_replace({x}, '{pattern}', ' #{numbers[name]}# ', 'g')"
        return f"regexp_extract_all({x}, '{licenses.MARK}', 1)"

    names = ", ".join(f"'{name}'" for name in numbers)
    found = (
        f"CASE WHEN starts_with(x, '{licenses.SPDX}') THEN {marked(licenses.SPDX_NAMES)}"
        f" ELSE {marked(licenses.SENTENCES)} END"
    )
    steps = []
    for i, (name, sequence) in enumerate(licenses.RULES):
        part = f" {sequence.replace(' ', '  ')} "
        steps.append(
            f"s{i + 1} AS MATERIALIZED (SELECT rid, replace(rest, '{part}', ' + ') AS rest,"
            f" CASE WHEN contains(rest, '{part}') THEN list_append(names, '{name}') ELSE names END AS names FROM s{i})"
        )
    chain = ",\n".join(steps)
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
sentences AS MATERIALIZED (
  SELECT rid, i, x
  FROM (SELECT rid, unnest(range(len(parts))) AS i, unnest(parts) AS x
        FROM (SELECT rid, list_transform(regexp_split_to_array(regexp_replace(regexp_replace(regexp_replace(
                     text, '{licenses.NOTICE}', E'\n\n\\1', 'g'), '{licenses.SPDX_TAG}', '{licenses.SPDX} ', 'g'),
                     '{licenses.VERSION_STOP}', 'v \1', 'g'),
                     '{licenses.SENTENCE_END}'),
                     lambda x: trim(regexp_replace(lower(x), '{licenses.NOT_A_WORD}', ' ', 'g'))) AS parts
              FROM docs))
  WHERE regexp_matches(x, '{licenses.LICENCE_WORDS}')),
known AS (
  SELECT rid, i, list_transform({found}, lambda n: [{names}][CAST(n AS INTEGER)]) AS found FROM sentences),
ids AS MATERIALIZED (
  SELECT rid, doc_id, coalesce(ids, []) AS ids
  FROM docs LEFT JOIN (
    SELECT rid, flatten(list(CASE WHEN len(found) > 0 THEN found ELSE ['{licenses.UNKNOWN}'] END ORDER BY i)) AS ids
    FROM known GROUP BY rid) USING (rid)),
s0 AS MATERIALIZED (
  SELECT rid, ' ' || array_to_string(ids, '  ') || ' ' AS rest, CAST([] AS VARCHAR[]) AS names
  FROM ids WHERE len(ids) > 0),
{chain}
SELECT doc_id, array_to_string(ids, ',') AS sentences,
       coalesce(array_to_string(list_filter(names, lambda x, i: list_position(names, x) = i), ','), '') AS licenses,
       CAST(len(list_filter(ids, lambda x: x = '{licenses.UNKNOWN}')) AS BIGINT) AS n_unknown
FROM ids LEFT JOIN s{len(licenses.RULES)} USING (rid)
"""


LICENSES = _licence_sql()

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
grams AS (
  SELECT lang, k, words[i:i + k - 1] AS words
  FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM worded, range(1, 6) t(k))),
counted AS (
  SELECT lang, k, words, array_to_string(words, ' ') AS phrase, count(*) AS f
  FROM grams GROUP BY lang, k, words),
totals AS (SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM counted WHERE k >= 2 AND f >= 100),
cuts AS (
  SELECT lang, k, words, phrase, f AS a, unnest(range(1, k)) AS cut FROM candidates),
cut_scores AS (
  SELECT c.lang, c.phrase, a, cut, l.f AS l, r.f AS r, n,
         CAST(CAST(1000 AS HUGEINT) * a * n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts c
  JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[:cut], ' ') AND l.f >= 100
  JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[cut + 1:], ' ') AND r.f >= 100
  JOIN totals t ON t.lang = c.lang),
weakest AS (
  SELECT * FROM cut_scores
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
  SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(f) AS longest
  FROM (SELECT lang, words, f, m, unnest(range(1, k - m + 2)) AS i
        FROM candidates, range(2, 5) t(m) WHERE m < k)
  GROUP BY ALL)
SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank,
       w.phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM weakest w LEFT JOIN inside i ON i.lang = w.lang AND i.phrase = w.phrase
WHERE longest IS NULL OR 100 * longest < 100 * a
QUALIFY rank <= 2000
"""
