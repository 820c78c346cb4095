"""SQL counterparts for DuckDB, where SQL can express an operator."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op2_url_filter"] = r"""
WITH captures AS (
  SELECT page_id, url, CAST((page_id * 37) % 730 AS INTEGER) AS day,
    regexp_replace(lower(regexp_replace(
      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '^.*@', '')), '\.?(:[0-9]*)?$', '') AS host,
    [x FOR x IN string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') IF x <> ''] AS steps
  FROM pages
), keyed AS (
  SELECT DISTINCT page_id, url, day, array_to_string(string_split(host, '.')[i:], '.') AS pattern
  FROM captures, LATERAL (SELECT unnest(generate_series(1, len(string_split(host, '.')))) AS i) WHERE host <> ''
  UNION
  SELECT page_id, url, day, host || '/' || array_to_string(steps[:i], '/')
  FROM captures, LATERAL (SELECT unnest(generate_series(1, len(steps))) AS i) WHERE host <> ''
), numbered AS (
  SELECT pattern, n, n % 400 AS day
  FROM (SELECT DISTINCT pattern, CAST('0x' || substr(md5(pattern), 1, 6) AS BIGINT) AS n FROM keyed) WHERE n % 3 = 0
), entries AS (
  SELECT pattern, day, true AS listed FROM numbered
  UNION SELECT pattern, day + 30 + n % 200, false FROM numbered
  UNION SELECT pattern, day + 300, true FROM numbered WHERE n % 5 = 0
), spans AS (
  SELECT pattern, day AS since, listed, lead(day) OVER (PARTITION BY pattern ORDER BY day, listed DESC) AS until
  FROM entries
), met AS (
  SELECT k.page_id, k.url, k.day, count(*) AS n_entries,
    first(k.pattern ORDER BY length(k.pattern) DESC, k.pattern) AS pattern
  FROM keyed k JOIN spans s ON k.pattern = s.pattern AND s.listed AND k.day >= s.since
    AND k.day < coalesce(s.until, 1000000)
  GROUP BY ALL
)
SELECT c.page_id, c.day, coalesce(n_entries, 0) AS n_entries, pattern, n_entries IS NOT NULL AS blocked
FROM captures c LEFT JOIN met m ON c.page_id IS NOT DISTINCT FROM m.page_id
  AND c.url IS NOT DISTINCT FROM m.url AND c.day IS NOT DISTINCT FROM m.day
"""

ORACLE["op11_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), lists AS (
  SELECT lang, [x FOR x IN string_split_regex(piece, '[\x20\x09]+') IF x <> ''] AS w FROM pieces
), sizes AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lists GROUP BY lang
), counts AS (
  SELECT lang, p, count(*) AS f FROM (
    SELECT lang, w[i:i + k - 1] AS p
    FROM lists, (SELECT unnest([1, 2, 3, 4]) AS k) t, LATERAL (SELECT unnest(generate_series(1, len(w) - k + 1)) AS i) s
  ) GROUP BY lang, p HAVING count(*) >= 30
), inside AS (
  SELECT lang, p, max(f) AS most FROM (
    SELECT lang, p[:len(p) - 1] AS p, f FROM counts WHERE len(p) > 2
    UNION ALL SELECT lang, p[2:], f FROM counts WHERE len(p) > 2
  ) GROUP BY lang, p
), kept AS (
  SELECT c.lang, c.p, c.f AS a FROM counts c LEFT JOIN inside i ON c.lang = i.lang AND c.p = i.p
  WHERE len(c.p) > 1 AND NOT coalesce(100 * i.most::HUGEINT >= 80 * c.f::HUGEINT, false)
), cuts AS (
  SELECT k.lang, k.p, k.a, x.f AS l, y.f AS r,
    CAST((2000000 * k.a::HUGEINT) // (x.f + y.f) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY k.lang, k.p ORDER BY (2000000 * k.a::HUGEINT) // (x.f + y.f), len(x.p)) AS cut
  FROM (SELECT *, unnest(generate_series(1, len(p) - 1)) AS k FROM kept) k
  JOIN counts x ON x.lang = k.lang AND x.p = k.p[:k.k]
  JOIN counts y ON y.lang = k.lang AND y.p = k.p[k.k + 1:]
), ranked AS (
  SELECT *, array_to_string(p, ' ') AS phrase,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank
  FROM cuts WHERE cut = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
