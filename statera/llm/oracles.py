"""SQL that the queries must equal, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES["op3_mix_sources"] = rf"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS}) AS size FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM totals
), filling AS (
  SELECT *,
    row_number() OVER (ORDER BY source_size::DOUBLE / w, source NULLS LAST) AS place,
    coalesce(sum(source_size) OVER earlier, 0) AS full_before,
    coalesce(sum(w) OVER earlier, 0) AS w_before
  FROM weighed
  WINDOW earlier AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *,
    ((SELECT sum(source_size) FROM totals) - 3 * full_before)::DOUBLE
      / ((SELECT sum(w) FROM weighed) - w_before)::DOUBLE AS level
  FROM filling
), chosen AS (
  SELECT arg_min(level, place) AS level
  FROM levels WHERE level * w <= source_size * 3
), targets AS (
  SELECT source, source_size,
    least((3 * source_size)::DOUBLE,
          coalesce((SELECT level FROM chosen) * w, (3 * source_size)::DOUBLE)) AS target
  FROM weighed
), placed AS (
  SELECT doc_id, size, source_size, target,
    target / source_size AS r,
    ('0x' || substr(md5('mix:' || coalesce(s.source, chr(0))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u,
    row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id NULLS FIRST) - 1 AS pos
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size > 0
    THEN CAST(floor((pos + 1) * r + u) - floor(pos * r + u) AS BIGINT) * size ELSE 0 END AS taken
FROM placed
"""

_LINES = "list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]'))"
_PHRASES = (
    "all rights reserved",
    "this work is",
    "licensed under",
    "general public license",
    "apache license",
    "creative commons",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "click here",
    "enable javascript",
)
_LOWERED = "translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_STOCK = " + ".join(
    f"(length(l) - length(replace({_LOWERED}, '{p}', ''))) // {len(p)} * {len(p.split())}" for p in _PHRASES
)

ORACLES["op1_quality_rules"] = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w, {_LINES} AS own FROM documents
), marked AS (
  SELECT *,
    list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: array_to_string(w[i:i+4], ' ')) AS win,
    list_transform(own, lambda l: {{
      'l': l,
      'n': len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')),
      'bars': length(regexp_replace(l, '[^|]+', '', 'g')),
      'loud': length(regexp_replace(l, '[^#*$%&<>!?]+', '', 'g')),
      'chars': length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g')),
      'stock': {_STOCK}
    }}) AS li
  FROM split
), windows AS (
  SELECT doc_id, unnest(win) AS k, unnest(range(len(win))) AS pos FROM marked
), twice AS (
  SELECT doc_id, pos FROM (
    SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT pos + step) AS n
  FROM twice, (SELECT unnest(range(5)) AS step) GROUP BY doc_id
), judged AS (
  SELECT m.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(own) - len(list_distinct(own)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words,
    list_filter(li, lambda x: x.loud * 10 >= x.n * 3 + 10 OR x.bars >= 2
                         OR (x.bars > 0 AND x.bars * 5 >= x.n)
                         OR (x.stock > 0 AND 100 * x.stock >= 30 * x.n)) AS bad
  FROM marked m LEFT JOIN covered c ON c.doc_id = m.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND coalesce(list_sum(list_transform(bad, lambda x: x.chars)), 0) <= 0.3 * word_chars AS kept,
  len(bad) AS n_bad_lines,
  CAST(coalesce(list_sum(list_transform(bad, lambda x: x.chars)), 0) AS BIGINT) AS lost_chars
FROM judged
"""

ORACLES["op9_url_filter"] = r"""
WITH parts AS (
  SELECT page_id,
    regexp_extract(CASE WHEN contains(url, '://') THEN regexp_replace(url, '^(?s:.*?)://', '') ELSE '' END,
                   '^[^?#]*') AS rest
  FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_replace(rest, '^[^/]*', '') AS path
  FROM parts
), ruled AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/')
      THEN 'www.example.com/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/'
  END AS rule, '.' || bare || path AS whole, '.' || bare AS h
  FROM (SELECT *, regexp_replace(regexp_replace(host, '^(?s:.*)@', ''), '[.]?(:(80|443)?)?$', '') AS bare
    FROM split)
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN contains(whole, 'spam') OR contains(h, 'cheap-pills') OR contains(h, 'casino')
      OR contains(h, 'viagra') OR contains(h, 'xxx')
      OR regexp_matches(whole, '^[^/]*[.]ads[.]')
      OR contains(whole, '/wp-login') OR ends_with(whole, '.exe') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

ORACLES["op10_near_dedup"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s
  FROM split
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)
), ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.a, w.b FROM reach r JOIN ways w ON r.b = w.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""

ORACLES["op13_fill_in_middle"] = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || doc_id) AS h
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n,
    ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS one,
    ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS two,
    CASE
      WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
      WHEN ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm'
      ELSE 'psm' END AS form
  FROM units
), parts AS (
  SELECT *,
    array_to_string(u[1:least(one, two)], '') AS prefix,
    array_to_string(u[least(one, two) + 1:greatest(one, two)], '') AS middle,
    array_to_string(u[greatest(one, two) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form
    WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
