"""DuckDB SQL of the queries that SQL can express, written on its own: no patterns or thresholds
are imported from the operators."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || CASE WHEN role IN ('user', 'assistant', 'system') THEN role
                            ELSE '~' || replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ': ', '\: ') END
      || ': ' || replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')
      || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""

QUALITY = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents
),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
windows AS (
  SELECT r, i, lead(word, 4) OVER p IS NOT NULL AS whole, word = lag(word) OVER p AS doubled,
    [word, lead(word, 1) OVER p, lead(word, 2) OVER p, lead(word, 3) OVER p, lead(word, 4) OVER p] AS g
  FROM words WINDOW p AS (PARTITION BY r ORDER BY i)
),
found AS (SELECT *, count(*) FILTER (whole) OVER (PARTITION BY r, g) > 1 AND whole AS twice FROM windows),
covered AS (
  SELECT r, doubled, max(CASE WHEN twice THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c
  FROM found
),
repeats AS (SELECT r, sum(c)::BIGINT AS n_repeat_words, count(*) FILTER (doubled) AS n_doubled FROM covered GROUP BY r),
lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
    length(text) - length(regexp_replace(text, '[a-z]', '', 'g')) AS n_lower,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_doubled, 0) AS n_doubled
  FROM texts LEFT JOIN repeats USING (r) LEFT JOIN lines USING (r)
),
bits AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN n_upper > n_lower THEN 8 ELSE 0 END
    + CASE WHEN 100 * n_doubled > 30 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 32 ELSE 0 END)::BIGINT AS fail_bits
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM bits
"""

# Kind, pattern, and the test that a match must pass.
_SECRETS = [
    (
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        r"""length(regexp_extract(m, '^(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 6""",
    ),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 20"),
    ("hex", "[0-9a-f]+", "length(m) >= 24"),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "true"),
    ("github", "gh[pousr]_[A-Za-z0-9]+", "length(m) >= 40"),
    ("slack", "xox[abprs]-[A-Za-z0-9-]+", "length(m) >= 15"),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "length(m) >= 40"),
]


def _secret_spans(number: int, kind: str, pattern: str, test: str) -> str:
    """Matches with their places: what stands before the n-th match is n pieces and n - 1 matches."""
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT r, {number} AS k, '{kind}' AS kind, s, s + length(m) AS e FROM (
    SELECT r, m, sum(length(piece) + length(coalesce(before, ''))) OVER (PARTITION BY r ORDER BY i)::BIGINT AS s FROM (
      SELECT r, i, m, piece, lag(m) OVER (PARTITION BY r ORDER BY i) AS before FROM (
        SELECT r, unnest(regexp_extract_all(text, '{quoted}')) AS m,
          generate_subscripts(regexp_extract_all(text, '{quoted}'), 1) AS i,
          unnest(regexp_split_to_array(text, '{quoted}')[1:len(regexp_extract_all(text, '{quoted}'))]) AS piece
        FROM texts WHERE regexp_matches(text, '{quoted}')
      )
    )
  ) WHERE {test}"""


SECRETS = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(_secret_spans(i, *x) for i, x in enumerate(_SECRETS))}),
found AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN found USING (r)
"""

# A term: ASCII letters and digits and all characters past ASCII; only A-Z become lower case.
_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')"""

SEARCH = f"""
WITH wanted AS (
  SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term
),
texts AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
totals AS (SELECT count(*) FILTER (len(t) > 0)::BIGINT AS nn, sum(len(t))::BIGINT AS ll FROM texts),
held AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM texts)
  WHERE term IN (SELECT term FROM wanted) GROUP BY r, term
),
weights AS (
  SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, totals GROUP BY term, nn
),
parts AS (
  SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(t)::BIGINT * nn) // ll))) AS part
  FROM held JOIN texts USING (r) JOIN weights USING (term), totals
),
scores AS (SELECT item_id, r, sum(q * part)::BIGINT AS score FROM wanted JOIN parts USING (term) GROUP BY item_id, r),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scores JOIN texts USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

SQL: dict[str, str] = {
    "op3_chat_formatting": CHAT,
    "op8_quality_rules": QUALITY,
    "op10_secret_scans": SECRETS,
    "op12_ranked_search": SEARCH,
}
