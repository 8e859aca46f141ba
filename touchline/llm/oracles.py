"""DuckDB SQL that gives the rows of a registered query, for those that SQL can express."""

from __future__ import annotations

from touchline.llm import quality, secret_scan

#: What ``Kind.keep`` says, in DuckDB's words.
KEEP = {
    "assign": "length(v) >= 8", "access": "length(v) >= 16", "hex": "length(v) >= 32", "login": "length(v) >= 8",
    "opaque": "regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[0-9]')",
}


def matches_sql(kind: secret_scan.Kind, place: int) -> str:
    pattern = kind.pattern.replace("'", "''")
    return f"""
      SELECT r, owner, repository, {place} AS place, '{kind.name}' AS kind, stop - length(m) AS start, stop,
             regexp_extract(m, '{pattern}', {kind.group}) AS v
      FROM (SELECT r, owner, repository, m, sum(length(gap) + length(m)) OVER (PARTITION BY r ORDER BY n) AS stop
            FROM (SELECT r, owner, repository, unnest(found) AS m, unnest(gaps[:len(found)]) AS gap, unnest(range(len(found))) AS n
                  FROM (SELECT r, owner, repository, regexp_extract_all(body, '{pattern}') AS found,
                               regexp_split_to_array(body, '{pattern}') AS gaps FROM d)))
      WHERE {KEEP[kind.name]}"""


SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('s' || source, '') AS owner, coalesce(CAST(doc_id AS VARCHAR), '') AS repository, coalesce(text, '') AS body FROM documents),
every AS ({' UNION ALL '.join(matches_sql(k, i) for i, k in enumerate(secret_scan.KINDS))}),
base AS (SELECT * FROM every WHERE place < {len(secret_scan.BASE)}),
found AS (SELECT * FROM every e WHERE place < {len(secret_scan.BASE)}
          OR NOT EXISTS (SELECT 1 FROM base b WHERE b.r = e.r AND b.start <= e.start AND e.stop <= b.stop)),
owned AS (SELECT v, count(DISTINCT owner) <= 2 AND count(DISTINCT repository) <= 10 AS live FROM found GROUP BY v),
told AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (place < {len(secret_scan.BASE)}) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (place < {len(secret_scan.BASE)} OR live) AS spans,
         count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
  FROM found JOIN owned USING (v) GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN told USING (r)
"""

QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
w AS (SELECT r, doc_id, body, list_filter(regexp_split_to_array(body, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
windows AS (SELECT r, unnest(range(1, len(words) - 1)) AS i, unnest(list_transform(range(1, len(words) - 1), lambda k: [words[k], words[k + 1], words[k + 2]])) AS win
            FROM w WHERE len(words) >= 3),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(3) AS t(k) GROUP BY r),
m AS (SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(body) - length(translate(body, '#*$%&|<>', '')) AS n_symbols, len(lines) AS n_lines,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             length(body) - length(regexp_replace(body, '[A-Z]', '', 'g')) AS n_capitals
      FROM w LEFT JOIN repeated USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {' OR '.join(f'({r.fails})' for r in quality.BASE)} AS base_failed, NOT ({' OR '.join(f'({r.fails})' for r in quality.RULES)}) AS kept
FROM m
"""

WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT payload_digest, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest),
j AS (SELECT p.*, CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to FROM p LEFT JOIN m USING (payload_digest))
SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM j
"""

DECONTAMINATION = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS words FROM documents),
b AS (SELECT min(item_id) AS item_id, words FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS words FROM benchmark)
      WHERE len(words) > 0 GROUP BY words),
i AS (SELECT row_number() OVER () AS k, item_id, len(words) AS size, CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' '))
                                                    ELSE [array_to_string(words, ' ')] END AS wanted FROM b),
ig AS (SELECT DISTINCT k, size, len(wanted) AS n, unnest(wanted) AS gram FROM i),
dg AS (SELECT r, unnest(grams) AS gram, unnest(range(len(grams))) AS place FROM (
         SELECT r, CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda k: array_to_string(words[k:k + 4], ' '))
                        WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS grams FROM d)),
w AS (SELECT DISTINCT r, k, size, unnest(range(greatest(0, place - n + 1), place + 1)) AS start FROM dg JOIN ig USING (gram)),
t AS (SELECT r, doc_id, size, start, words[start + 1:start + size] AS part FROM (SELECT DISTINCT r, size, start FROM w) JOIN d USING (r)),
s AS (SELECT r, doc_id, size, start, CASE WHEN len(part) >= 5 THEN list_transform(range(1, len(part) - 3), lambda k: array_to_string(part[k:k + 4], ' '))
                                        ELSE [array_to_string(part, ' ')] END AS shingles FROM t),
c AS (SELECT r, doc_id, k, item_id, size, start, len(shingles) + len(wanted) AS total,
             list_sum(list_transform(list_distinct(list_intersect(shingles, wanted)), lambda k: least(len(list_filter(shingles, lambda x: x = k)), len(list_filter(wanted, lambda x: x = k))))) AS common
      FROM s JOIN w USING (r, size, start) JOIN i USING (k, size)),
h AS (SELECT *, common / (total - common) AS similarity FROM c WHERE 100 * common >= 80 * (total - common)),
best AS (SELECT *, row_number() OVER (PARTITION BY r, k ORDER BY similarity DESC, start) AS n FROM h)
SELECT doc_id, item_id, similarity, start, size AS n_words FROM best WHERE n = 1
"""


EXACT = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

TRIE = r"""
WITH RECURSIVE crc(c, s, i, v) AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR), CAST(0 AS BIGINT), CAST(4294967295 AS BIGINT) FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL
  SELECT c, s, i + 1, CASE WHEN t & 1 = 1 THEN xor(t >> 1, CAST(3988292384 AS BIGINT)) ELSE t >> 1 END
  FROM (SELECT c, s, i, CASE WHEN i % 8 = 0 THEN xor(v, CAST(ascii(substr(s, i // 8 + 1, 1)) AS BIGINT)) ELSE v END AS t FROM crc WHERE i < 8 * length(s))),
convs AS (SELECT c, xor(v, CAST(4294967295 AS BIGINT)) % 4 AS h, c - c % 20 AS f FROM crc WHERE i = 8 * length(s)),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '') || chr(10) || coalesce(text, ''))) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
parts AS (
  SELECT k.c, 0 AS own, t.n, t.role, t.text FROM convs k JOIN turns t ON t.c = k.f AND t.n <= k.h
  UNION ALL SELECT k.c, 1, t.n, t.role, t.text FROM convs k JOIN turns t ON t.c = k.c AND t.n > k.h),
steps AS (
  SELECT c, row_number() OVER w AS d, string_agg(md5(length(role) || ':' || role || text), '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path,
         length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM parts WINDOW w AS (PARTITION BY c ORDER BY own, n)),
passed AS (SELECT c, 0 AS d, '' AS path, 0 AS words FROM convs UNION ALL SELECT c, d, path, words FROM steps),
nodes AS (SELECT path, min(d) AS d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(words) AS saved FROM passed GROUP BY path),
ends AS (SELECT path, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS sha FROM (SELECT c, arg_max(path, d) AS path FROM passed GROUP BY c) GROUP BY path),
childs AS (SELECT left(path, length(path) - 32) AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
below AS (SELECT left(path, CAST(32 * a AS INT)) AS path, leaf, saved FROM (
  SELECT n.path, unnest(range(0, n.d + 1)) AS a, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS leaf, saved FROM nodes n LEFT JOIN childs k USING (path))),
figures AS (SELECT path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM below GROUP BY path)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       CAST(f.n_leaves AS BIGINT) AS n_leaves, CAST(f.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
FROM nodes n LEFT JOIN nodes p ON n.d > 0 AND p.path = left(n.path, length(n.path) - 32) LEFT JOIN childs k ON k.path = n.path
JOIN figures f ON f.path = n.path LEFT JOIN ends e ON e.path = n.path
"""
