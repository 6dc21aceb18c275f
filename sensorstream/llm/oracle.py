"""DuckDB statements of the registered queries that SQL can express."""

OP11_MERKLE = """
WITH RECURSIVE
written AS (
  SELECT doc_id, lang, n_chars,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END AS d,
    CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END AS s,
    CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END AS l,
    CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS c,
    CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS t,
    -- crc32 of the decimal id, bit by bit
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                                                    lambda ch: ascii(ch)::BIGINT)),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 7 = 0 AS marked
  FROM documents),
hashed AS (
  SELECT doc_id, lang, sha256(d || s || l || c || t) AS leaf,
    CASE WHEN marked AND n_chars IS NOT NULL
         THEN sha256(d || s || l || strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1) || t) END AS changed
  FROM written),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
nodes(lang, lvl, pos, hash, n) AS (
  SELECT lang, 0, pos, leaf, n FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY lang, lvl, pos // 2, n),
subroots AS (
  SELECT lang, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
tops(lvl, pos, hash, n) AS (
  SELECT 0, pos, subroot, n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2
  FROM tops WHERE n > 1 GROUP BY lvl, pos // 2, n),
low AS (
  SELECT a.lang, a.pos, list(CASE WHEN (a.pos >> v.lvl) & 1 = 1 THEN 'L' || b.hash
                                  WHEN b.hash IS NULL THEN '-' ELSE 'R' || b.hash END ORDER BY v.lvl) AS steps
  FROM leaves a
  JOIN (SELECT DISTINCT lang, lvl FROM nodes WHERE n > 1) v ON a.lang IS NOT DISTINCT FROM v.lang
  LEFT JOIN nodes b ON b.lang IS NOT DISTINCT FROM a.lang AND b.lvl = v.lvl AND b.pos = xor(a.pos >> v.lvl, 1)
  GROUP BY a.lang, a.pos),
high AS (
  SELECT a.pos, list(CASE WHEN (a.pos >> v.lvl) & 1 = 1 THEN 'L' || b.hash
                          WHEN b.hash IS NULL THEN '-' ELSE 'R' || b.hash END ORDER BY v.lvl) AS steps
  FROM subroots a
  CROSS JOIN (SELECT DISTINCT lvl FROM tops WHERE n > 1) v
  LEFT JOIN tops b ON b.lvl = v.lvl AND b.pos = xor(a.pos >> v.lvl, 1)
  GROUP BY a.pos),
whole AS (
  SELECT a.doc_id, a.leaf, a.changed, r.subroot, (SELECT hash FROM tops WHERE n = 1) AS root,
         list_concat(coalesce(low.steps, []), coalesce(high.steps, [])) AS steps
  FROM leaves a
  JOIN subroots r ON r.lang IS NOT DISTINCT FROM a.lang
  LEFT JOIN low ON low.lang IS NOT DISTINCT FROM a.lang AND low.pos = a.pos
  LEFT JOIN high ON high.pos = r.pos),
folded AS (
  SELECT *, list_reduce(list_prepend(coalesce(changed, leaf), steps),
    lambda h, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || h ELSE h || s[2:] END)) AS folded_root
  FROM whole)
SELECT doc_id, leaf, subroot, root,
       sha256(coalesce(array_to_string(list_transform(steps, lambda s: s[2:]), ''), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded
"""

OP12_EXACT_DEDUP = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP13_FILL_IN_MIDDLE = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM cut),
parts AS (
  SELECT *, coalesce(array_to_string(units[1:least(x, y)], ''), '') AS prefix,
         coalesce(array_to_string(units[least(x, y) + 1:greatest(x, y)], ''), '') AS middle,
         coalesce(array_to_string(units[greatest(x, y) + 1:], ''), '') AS suffix
  FROM drawn)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
