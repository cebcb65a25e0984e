"""The queries of ``queries`` in SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

_WORD = r"'[^\x20\x09-\x0D]+'"


def all_sql() -> dict[str, str]:
    return {
        "op5_mixing": _MIXING,
        "op6_quality_rules": _QUALITY,
        "op7_decontamination": _DECONTAMINATION,
        "op10_chat": _CHAT,
        "op11_source_divergence": _DIVERGENCE,
        "op12_vector_codes": _vector_codes(),
    }


def _vector_codes() -> str:
    """Lloyd's rounds one after another; components in long form, a codebook per round."""
    steps = []
    for i in range(5):
        # The distance of each part to each entry, and the nearest; whole numbers in floating point are exact here.
        steps.append(f"""near{i} AS (
  SELECT vec_id, part, arg_min(entry, (far, entry)) AS entry, min(far) AS far FROM (
    SELECT p.vec_id, p.part, b.entry, list_sum(list_transform(list_zip(p.xs, b.xs), lambda z: (z[1] - z[2]) ** 2)) AS far
    FROM p JOIN book{i} b USING (part)
  ) GROUP BY ALL
)""")
        if i < 4:
            steps.append(f"""book{i + 1} AS (
  SELECT b.part, b.entry, coalesce(n.xs, b.xs) AS xs FROM book{i} b LEFT JOIN (
    SELECT part, entry, list(floor(total / n)::BIGINT ORDER BY pos) AS xs FROM (
      SELECT part, entry, pos, sum(x) AS total, count(*) AS n FROM (
        SELECT part, entry, unnest(xs) AS x, unnest(range(len(xs))) AS pos FROM near{i} JOIN p USING (vec_id, part)
      ) GROUP BY ALL
    ) GROUP BY ALL
  ) n USING (part, entry)
)""")
    return f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS xs FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT vec_id, label, part, xs[part * len(xs) // 4 + 1 : (part + 1) * len(xs) // 4] AS xs FROM v, (SELECT unnest([0, 1, 2, 3]) AS part)
), book0 AS (
  SELECT part, entry - 1 AS entry, xs FROM (SELECT *, row_number() OVER (PARTITION BY part ORDER BY vec_id) AS entry FROM p) WHERE entry <= 256
), {", ".join(steps)}, c AS (
  SELECT vec_id, label, string_agg(lower(printf('%02x', n.entry)), '' ORDER BY n.part) AS code, sum(far)::BIGINT AS error
  FROM near4 n JOIN v USING (vec_id) GROUP BY ALL
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(xs, ','), ',' ORDER BY part, entry)) FROM book4) AS codebooks_sha256
FROM c
"""


_MIXING = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORD}))::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s
), c AS (
  SELECT *, (3 * source_size)::DOUBLE * (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE
    <= weight::DOUBLE * (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0))::DOUBLE AS capped
  FROM w WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT *, CASE WHEN capped THEN (3 * source_size)::DOUBLE ELSE
    (weight * (sum(source_size) OVER () - 3 * sum(CASE WHEN capped THEN source_size ELSE 0 END) OVER ()))::DOUBLE
      / (sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ())::DOUBLE END AS target
  FROM c
), p AS (
  SELECT doc_id, d.source, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS ratio,
    ('0x' || substr(md5('mix:' || CASE WHEN d.source IS NULL THEN '-' ELSE '+' || d.source END), 1, 4))::BIGINT::DOUBLE / 65536 AS u,
    (row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS FIRST))::DOUBLE AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (floor(u + ratio * place) - floor(u + ratio * (place - 1)))::BIGINT * size AS taken
FROM p
"""

_QUALITY = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, {_WORD}) AS ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {_WORD})) AS ls FROM d
), g AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), h AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1
), n AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM h, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), m AS (
  SELECT doc_id, text, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
    length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
    length(regexp_replace(text, '[^!]', '', 'g')) AS n_bangs, len(list_distinct(ws)) AS n_distinct
  FROM w LEFT JOIN n USING (r)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 5 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
    OR NOT word_chars BETWEEN 2 * n_words AND 12 * n_words OR 2 * n_upper > n_letters
    OR 2 * n_bangs > n_words OR 20 * n_distinct < n_words) AS kept
FROM b
"""

# Marks that get a backslash: each backslash, each # of three or more, each end mark, in roles each colon.
_ESCAPES = r"(length({0}) - length(replace({0}, '\', '')) + length(array_to_string(regexp_extract_all({0}, '#{{3,}}'), '')) + length(array_to_string(regexp_extract_all({0}, '</turn>'), '')) // 7)"
_CHAT = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), l AS (
  SELECT *, length('### ' || role || ': ' || text || '</turn>') + 1 + {_ESCAPES.format("text")} + {_ESCAPES.format("role")}
    + length(role) - length(replace(role, ':', '')) AS chars FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM l GROUP BY conv_id
"""

_SMALL = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DECONTAMINATION = f"""
WITH i AS (
  SELECT row_number() OVER () AS item, item_id, regexp_extract_all({_SMALL.format("text")}, {_WORD}) AS ws FROM benchmark
), s AS (
  SELECT DISTINCT item, item_id, n, array_to_string(ws[k : k + n - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS k FROM (SELECT *, least(5, len(ws)) AS n FROM i WHERE len(ws) > 0))
), z AS (
  SELECT item, count(*) AS n_shingles FROM s GROUP BY 1
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_SMALL.format("text")}, {_WORD}) AS ws FROM documents
), x AS (
  SELECT DISTINCT r, doc_id, n, array_to_string(ws[k : k + n - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM s) WHERE len(ws) >= n)
), m AS (
  SELECT r, doc_id, item, item_id, count(*) AS n_shared FROM x JOIN s USING (n, run) GROUP BY ALL
)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared::DOUBLE / n_shingles AS containment
FROM m JOIN z USING (item) WHERE n_shared >= 0.8 * n_shingles - 1e-9
"""

_P = "1 + 1000000000::HUGEINT * ({0} + 2) // ({1} + 2 * v)"
_DIVERGENCE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents
), w AS (
  SELECT r, lang, source, unnest(ws) AS term FROM d
), k AS (
  SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 10
), c AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, total
  FROM (SELECT DISTINCT lang, source FROM d) JOIN k USING (lang)
    LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL) USING (lang, source, term)
), s AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source) AS size, sum(total) OVER (PARTITION BY lang, source) AS lang_size,
    count(*) OVER (PARTITION BY lang, source) AS v FROM c
), p AS (
  SELECT lang, source, term, n, ({_P.format("n", "size")})::BIGINT AS p, ({_P.format("total", "lang_size")})::BIGINT AS q FROM s
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
  FROM (SELECT DISTINCT lang, source FROM d) a
    JOIN (SELECT DISTINCT lang, source FROM d) b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
), term AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM p WHERE n > 0 AND p > q
), b AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair UNION ALL SELECT lang, source, 'term', item, value FROM term
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM b QUALIFY part = 'pair' OR rank <= 10
"""
