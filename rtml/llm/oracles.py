"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

from rtml.llm.secrets import RULES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = f"regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+')"
_PLAIN = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_REACH = """both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT id AS a, id AS b FROM nodes
          UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a),
component AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""

VECTORS = f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings),
good AS (SELECT * FROM nodes WHERE e IS NOT NULL AND len(e) > 0 AND
         len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND
         len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT x.id AS a, y.id AS b FROM good x JOIN good y
          ON x.id < y.id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.95),
{_REACH},
degree AS (SELECT a AS id, count(*) AS n FROM both_ways GROUP BY a)
SELECT nodes.id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id,
       component_id = nodes.id AS kept
FROM nodes JOIN component USING (id) LEFT JOIN degree USING (id)"""

JACCARD = f"""
WITH RECURSIVE listed AS (SELECT doc_id AS id, {_SPACED} AS w FROM documents),
nodes AS (SELECT id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
          ELSE list_distinct(list_transform(range(1, len(w) - 2),
                                            lambda i: array_to_string(w[i:i + 3], ' '))) END AS g FROM listed),
each AS (SELECT id, len(g) AS n, unnest(g) AS g FROM nodes),
shared AS (SELECT x.id AS a, y.id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS c
           FROM each x JOIN each y ON x.g = y.g AND x.id < y.id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared WHERE 100 * c >= 85 * (na + nb - c)),
{_REACH}
SELECT nodes.id AS doc_id, len(g)::BIGINT AS n_shingles, component_id
FROM nodes JOIN component USING (id)"""


def _escaped(c: str, role: bool = False) -> str:
    out = f"replace(replace(replace({c}, '\\', '\\s'), '### ', '\\h'), '</turn>', '\\t')"
    return f"replace({out}, ': ', '\\c')" if role else out


_CLASH = "({0} LIKE '%### %' OR {0} LIKE '%</turn>%' OR regexp_matches({0}, '\\\\[shtc]'))"
CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, r, '\\### Assistant: </turn> ok'
  FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(i, r)),
sized AS (SELECT *, CASE WHEN {_CLASH.format('text')} OR {_CLASH.format('role')} OR role LIKE '%: %'
  THEN length({_escaped('text')}) + length({_escaped('role', True)})
  ELSE length(text) + length(role) END + 14 AS n FROM turns)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id"""

MIXING = """
WITH RECURSIVE counted AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n
  FROM documents),
src AS (SELECT source, sum(n)::DOUBLE AS t FROM counted GROUP BY source),
shares AS (SELECT source, t, t / max(t) OVER () AS s FROM src WHERE t > 0),
bisect AS (
  SELECT 0 AS i, 0::DOUBLE AS lo, 1::DOUBLE AS hi
  UNION ALL
  SELECT i + 1, CASE WHEN r > 1.5 THEN (lo + hi) / 2 ELSE lo END,
         CASE WHEN r > 1.5 THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT i, lo, hi, max(power(s, (lo + hi) / 2) / t) / min(power(s, (lo + hi) / 2) / t) AS r
        FROM bisect, shares WHERE i < 60 GROUP BY i, lo, hi)),
alpha AS (SELECT max(hi) AS a FROM bisect WHERE i = 60),
weighted AS (SELECT source, t, power(s, a) / sum(power(s, a)) OVER () AS w FROM shares, alpha),
budget AS (SELECT source, t::BIGINT AS t,
                  floor(round(w * max(t / w) OVER (), 3) + 0.5)::BIGINT AS b FROM weighted),
placed AS (SELECT doc_id, source, n, md5('mix' || doc_id) AS place,
                  CAST('0x' || substr(md5('mix' || doc_id), 1, 8) AS BIGINT) % 1024 AS block
           FROM counted),
walked AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY source ORDER BY
             md5('mix-block' || block), block, place
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM placed)
SELECT doc_id, source, n::BIGINT AS n_tokens,
       (b // t + CASE WHEN before < b % t THEN 1 ELSE 0 END)::BIGINT AS copies
FROM walked JOIN budget USING (source)"""

CONTAMINATION = f"""
WITH items AS (SELECT item_id::VARCHAR AS item, {_PLAIN} AS w FROM benchmark),
listed AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
item_windows AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT item, w, least(10, len(w)) AS k,
               unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT k FROM item_windows),
doc_windows AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM listed, lengths
        WHERE len(w) >= k)),
hits AS (SELECT doc_id, k, i, item FROM doc_windows JOIN item_windows USING (k, g)),
covered AS (SELECT doc_id, count(*) AS n FROM (
  SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS m, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit,
       coalesce(m, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n, 0) > 0 AS contaminated
FROM listed LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""


def _found(rank: int, rule) -> str:
    p = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, s AS start, s + length(h) AS stop FROM (
    SELECT doc_id, unnest(h) AS h, unnest(z) AS z, unnest(list_transform(range(1, len(h) + 1), lambda i:
      list_sum(list_transform(g[1:i], lambda x: length(x))) +
      coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0)))::BIGINT AS s
    FROM (SELECT doc_id, string_split_regex(text, '{p}') AS g, regexp_extract_all(text, '{p}') AS h,
                 regexp_extract_all(text, '{p}', {rule.group}) AS z
          FROM documents WHERE regexp_matches(text, '{p}')))
  WHERE length(z) >= {rule.least}"""


_BASE = "FILTER (rank < 3)"
SECRETS = f"""
WITH found AS ({' UNION ALL '.join(_found(i, r) for i, r in enumerate(RULES))}),
per_doc AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS a, count(*) FILTER (rank = 1) AS k,
    count(*) FILTER (rank = 2) AS h,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) {_BASE} AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access,
  coalesce(h, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM (SELECT doc_id FROM documents) LEFT JOIN per_doc USING (doc_id)"""

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM listed, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, g, count(*) AS c FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w)) AS n FROM listed GROUP BY lang),
cuts AS (
  SELECT lang, g, m, a, cut, array_to_string(string_split(g, ' ')[1:cut], ' ') AS head,
         array_to_string(string_split(g, ' ')[cut + 1:m], ' ') AS rest
  FROM (SELECT lang, g, k AS m, c AS a, unnest(range(1, k)) AS cut FROM f WHERE k >= 2)),
scored AS (
  SELECT cuts.lang, cuts.g, m, a, cut, x.c AS l, y.c AS r, n,
         (1000::HUGEINT * a * n) // (x.c::HUGEINT * y.c) AS score
  FROM cuts JOIN totals USING (lang)
  JOIN f x ON x.lang = cuts.lang AND x.g = head AND x.k = cut
  JOIN f y ON y.lang = cuts.lang AND y.g = rest AND y.k = m - cut),
lowest AS (SELECT * FROM scored
           QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
free AS (SELECT * FROM lowest WHERE NOT EXISTS (
  SELECT 1 FROM f WHERE f.lang = lowest.lang AND f.k > lowest.m AND 100 * f.c >= 100 * lowest.a
  AND contains(' ' || f.g || ' ', ' ' || lowest.g || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank,
       g AS phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM free QUALIFY rank <= 2000"""

LLM_ORACLES = {"op2_embedding_near_dedup": VECTORS, "op5_jaccard_join": JACCARD,
               "op6_chat_formatting": CHAT, "op7_mixing": MIXING,
               "op8_decontamination": CONTAMINATION, "op10_secret_scans": SECRETS,
               "op13_collocations": COLLOCATIONS}
