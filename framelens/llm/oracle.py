"""DuckDB statements for the corpus queries that SQL can express.

The others (hashes, tokenizers, entropy windows, fitted models) are tested against brute-force versions.
"""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (SELECT DISTINCT r, i + k AS p FROM win JOIN least USING (s), unnest(range(0, 13)) AS o(k) WHERE m < doc_id),
each_word AS (SELECT r, p, w[p] AS word FROM d, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM each_word ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s FROM d, unnest(range(1, len(w) - 3)) AS t(i)),
again AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
spans AS (SELECT DISTINCT r, i + k AS p FROM again, unnest(range(0, 5)) AS o(k)),
covered AS (SELECT r, count(*) AS n, sum(length(w[p])) AS c FROM spans JOIN d USING (r) GROUP BY r),
long_win AS (SELECT r, array_to_string(w[i:i + 40], ' ') AS s FROM d, unnest(range(1, len(w) - 39)) AS t(i)),
long_again AS (SELECT DISTINCT r FROM (SELECT r, s FROM long_win GROUP BY r, s HAVING count(*) > 1)),
line AS (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d),
line_counts AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM line WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r),
base AS (
  SELECT r, doc_id, len(w)::BIGINT AS n_words, list_sum(list_transform(w, lambda x: length(x))) AS wc,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(line_counts.n, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(c, 0)::BIGINT AS covered_chars, long_again.r IS NOT NULL AS long_one
  FROM d LEFT JOIN covered USING (r) LEFT JOIN line_counts USING (r) LEFT JOIN long_again USING (r)
)
SELECT doc_id, n_words, coalesce(wc, 0)::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_chars,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND covered_chars <= 0.3 * coalesce(wc, 0) AND NOT long_one AS kept
FROM base
"""

ORACLE_SQL: dict[str, str] = {"op8_substring_dedup": OP8, "op10_repetition": OP10}
