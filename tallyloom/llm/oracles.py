"""SQL for DuckDB that gives the rows of the queries it can express."""

from __future__ import annotations

_MIXING = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(len(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce('+' || text, '-')) AS key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS place
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         3.0::DOUBLE * source_size AS most, sum(source_size) OVER () AS budget FROM s
), l AS (
  SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), t AS (
  SELECT source, source_size, place, budget, least(most, max(level) OVER () * weight) AS target FROM l
), q AS (
  SELECT doc_id, d.size, key, place, source_size, target, budget, row_number() OVER () AS row_id,
         sum(d.size) OVER (PARTITION BY place ORDER BY key ROWS UNBOUNDED PRECEDING) AS reach
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (
  SELECT row_id, size, budget,
         sum(size) OVER (ORDER BY (turn * source_size + reach) / target, place, key, turn ROWS UNBOUNDED PRECEDING) AS until
  FROM q, (SELECT unnest([0, 1, 2]) AS turn) WHERE size > 0
), k AS (SELECT row_id, count(*) AS turns FROM c WHERE until <= budget GROUP BY row_id)
SELECT doc_id, size, source_size, target, (coalesce(turns, 0) * size)::BIGINT AS taken
FROM q LEFT JOIN k USING (row_id)
"""

_EXACT = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vector FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vector, c.vector)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

#: The base patterns, as the contract states them.
_KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_DIGITS = "regexp_replace(v, '[^0-9]', '', 'g')"
_VALID = {
    "email": "true",
    "ip": "len(list_filter(string_split(v, '.'), lambda x: x::HUGEINT > 255)) = 0",
    "card": f"""CASE WHEN len({_DIGITS}) BETWEEN 13 AND 19 THEN list_sum(list_transform(range(1, len({_DIGITS}) + 1),
      lambda i: CASE WHEN i % 2 = 1 THEN {_DIGITS}[len({_DIGITS}) - i + 1]::INT
                WHEN {_DIGITS}[len({_DIGITS}) - i + 1]::INT > 4 THEN {_DIGITS}[len({_DIGITS}) - i + 1]::INT * 2 - 9
                ELSE {_DIGITS}[len({_DIGITS}) - i + 1]::INT * 2 END)) % 10 = 0 ELSE false END""",
    "phone": f"len({_DIGITS}) BETWEEN 9 AND 15",
}
_NAME = {"email": "'email:' || lower(v)", "ip": "'ip:' || v", "card": f"'card:' || {_DIGITS}", "phone": f"'phone:' || {_DIGITS}"}


def _found(kind: str) -> str:
    """All valid matches of a kind: document row, place and name of the entity."""
    pattern = _KINDS[kind]
    return f"""
  SELECT row_id, '{kind}' AS kind, first, first + len(v) AS last, {_NAME[kind]} AS entity
  FROM (SELECT row_id, m[i] AS v,
               list_sum(list_transform(p[:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: len(x))), 0) AS first
        FROM (SELECT row_id, m, p, unnest(range(1, len(m) + 1)) AS i
              FROM (SELECT row_id, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS p FROM d)))
  WHERE {_VALID[kind]}"""


_PII = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row_id FROM documents),
base AS MATERIALIZED ({" UNION ALL ".join(_found(k) for k in _KINDS)}
), said AS (
  SELECT row_id, said_id, term FROM (
    SELECT row_id, md5(text) AS said_id, unnest(list_distinct(string_split_regex(lower(text), '[^\\p{{L}}]+'))) AS term
    FROM d WHERE row_id IN (SELECT row_id FROM base)
  ) WHERE len(term) > 1
), pairs AS (
  SELECT entity, term, count(*) AS n_both FROM (SELECT DISTINCT row_id, entity FROM base) JOIN said USING (row_id)
  GROUP BY entity, term HAVING count(DISTINCT said_id) >= 4
), entities AS (SELECT entity, count(DISTINCT row_id) AS n_entity FROM base GROUP BY entity
), terms AS (
  SELECT term, count(*) AS n_term
  FROM (SELECT unnest(list_distinct(string_split_regex(lower(text), '[^\\p{{L}}]+'))) AS term FROM d)
  WHERE len(term) > 1 GROUP BY term
), total AS (SELECT count(*)::DOUBLE AS n FROM d
), telling AS (
  SELECT entity, term FROM pairs JOIN entities USING (entity) JOIN terms USING (term), total
  WHERE n > n_entity AND round(log2(n * n_both / (n_entity * n_term)) / log2(n / n_entity), 9) >= 0.8
), told AS (SELECT DISTINCT row_id, term FROM base JOIN telling USING (entity)
), tokens AS (
  SELECT row_id, m[i] AS v, i,
         list_sum(list_transform(p[:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: len(x))), 0) AS first
  FROM (SELECT row_id, m, p, unnest(range(1, len(m) + 1)) AS i
        FROM (SELECT row_id, regexp_extract_all(text, '\\p{{L}}+') AS m, string_split_regex(text, '\\p{{L}}+') AS p
              FROM d WHERE row_id IN (SELECT row_id FROM told)))
), words AS (
  SELECT t.row_id, 'term' AS kind, t.first, t.first + len(v) AS last FROM tokens t JOIN told ON told.row_id = t.row_id AND term = lower(v)
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.row_id = t.row_id AND b.first < t.first + len(v) AND t.first < b.last)
), spans AS (SELECT row_id, kind, first, last FROM base UNION ALL SELECT * FROM words
), shown AS (
  SELECT row_id,
         string_agg(kind || ':' || first::BIGINT || ':' || last::BIGINT, ',' ORDER BY place, first) AS spans,
         string_agg(kind || ':' || first::BIGINT || ':' || last::BIGINT, ',' ORDER BY place, first) FILTER (place < 5) AS base,
         {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in _KINDS)}
  FROM (SELECT *, CASE kind {" ".join(f"WHEN '{k}' THEN {i + 1}" for i, k in enumerate(_KINDS))} ELSE 5 END AS place FROM spans)
  GROUP BY row_id
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in _KINDS)}, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN shown USING (row_id)
"""

#: The rules of `quality_rules` as SQL conditions that a kept text meets.
_STOPS = """the and of to in is that it for was with as be on this by are or from at an
der die und das ist den von zu mit sich auf ein eine nicht dem des
le la les et des un une que pour dans est sur de du el los las en y por con para una del se"""

_RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), starts AS (
  SELECT row_id, i, array_to_string(w[i:i + 4], ' ') AS said
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT row_id, i, lead(i) OVER (PARTITION BY row_id ORDER BY i) AS next
  FROM (SELECT *, count(*) OVER (PARTITION BY row_id, said) AS n FROM starts) WHERE n > 1
), r AS (SELECT row_id, sum(least(coalesce(next - i, 5), 5))::BIGINT AS n FROM twice GROUP BY row_id
), c AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: len(x))), 0)::BIGINT AS word_chars,
         (len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         len(text) - len(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
         len(list_filter(w, lambda x: list_contains(string_split_regex('{_STOPS}', '\s+'), x))) AS n_stop_words,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_cut_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_listed_lines
  FROM d LEFT JOIN r USING (row_id)
), b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars::DOUBLE / n_words BETWEEN 2 AND 14 AND n_symbols::DOUBLE / n_words <= 0.1::DOUBLE
       AND n_capitals::DOUBLE / word_chars <= 0.4::DOUBLE AND (n_words < 50 OR n_stop_words::DOUBLE / n_words >= 0.02::DOUBLE)
       AND n_dup_lines::DOUBLE / n_lines <= 0.3::DOUBLE AND n_cut_lines::DOUBLE / n_lines <= 0.3::DOUBLE
       AND n_listed_lines::DOUBLE / n_lines <= 0.9::DOUBLE AS kept
FROM b
"""

#: crc32 by a table of 256 steps; letters of the runs take one byte or two.
_SPELLING = r"""
WITH RECURSIVE steps AS (
  SELECT i, i::BIGINT AS v, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM steps WHERE k < 8
), crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM steps WHERE k = 8
), runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]{7,}')) AS run FROM documents)
  GROUP BY ALL
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
      string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM runs, crc
), v AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN run[:(h % len(run))] || run[(h % len(run)) + 2:] ELSE run END AS word FROM hashed)
  WHERE len(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS MATERIALIZED (
  SELECT word, n, i, word[:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM v)
), pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word
), best AS MATERIALIZED (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form,
         CASE WHEN near_n >= 10 * n THEN near_n END AS form_n FROM v LEFT JOIN best USING (word)
), way AS (
  SELECT word, word AS root, 0 AS step FROM formed
  UNION ALL SELECT way.word, form, step + 1 FROM way JOIN formed ON formed.word = root WHERE form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, arg_max(root, step) AS root FROM way GROUP BY word) USING (word)
"""

_DIVERGENCE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), t AS MATERIALIZED (
  SELECT row_id, lang, source, term, count(*) AS n
  FROM (SELECT row_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d) GROUP BY ALL
), kept AS MATERIALIZED (SELECT lang, term, sum(n)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(*) >= 30
), langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang
), groups AS (SELECT DISTINCT lang, source FROM d
), own AS MATERIALIZED (SELECT lang, source, term, sum(t.n)::HUGEINT AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL
), sums AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM own GROUP BY ALL
), cells AS MATERIALIZED (
  SELECT lang, source, term, coalesce(own.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(own.n, 0) + 5)) // (coalesce(sums.total, 0) + 5 * v) AS p,
         1 + (1000000000::HUGEINT * (kept.n + 5)) // (langs.total + 5 * v) AS q
  FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN sums USING (lang, source) LEFT JOIN own USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  ) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM cells WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

ORACLES = {
    "op1_pii": _PII,
    "op8_exact_top_k": _EXACT,
    "op10_mixing": _MIXING,
    "op11_quality_rules": _RULES,
    "op12_spelling": _SPELLING,
    "op13_divergence": _DIVERGENCE,
}
