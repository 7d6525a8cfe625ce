"""DuckDB SQL of the queries that SQL can express, over the same tables."""

# CRC32 of short texts: the table of the polynomial 0xEDB88320 by its rule, folded
# over the bytes.
_CRC = """crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END,
           n::BIGINT)) AS tbl)"""


def _crc32(text: str) -> str:
    return (f"xor(list_reduce(list_transform(range(octet_length(encode({text}))), "
            f"lambda i: ('0x' || substring(hex(encode({text})), 2 * i + 1, 2))::INT), "
            f"lambda acc, x: xor(crc.tbl[(xor(acc, x) & 255) + 1], acc >> 8), "
            f"4294967295::BIGINT), 4294967295)")


PREFIX_TRIE = f"""
WITH {_CRC},
own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}}
                       ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (
  SELECT conv_id, turns, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM own, crc),
rebuilt AS (
  SELECT a.conv_id, list_concat(CASE WHEN b.turns IS NULL THEN [] ELSE b.turns[1:a.h] END,
                                a.turns[a.h + 1:]) AS path
  FROM headed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
prefix AS (
  SELECT conv_id, len(path) AS n, CAST(u.d AS BIGINT) AS depth, path[1:u.d] AS p
  FROM rebuilt, unnest(range(len(path) + 1)) u(d)),
node AS (
  SELECT depth, p, min(conv_id) AS conv_id, count(*) AS n_convs,
         list(conv_id ORDER BY conv_id) FILTER (n = depth) AS ends
  FROM prefix GROUP BY depth, p),
child AS (
  SELECT depth - 1 AS depth, p[1:depth - 1] AS p, count(*) AS n_children
  FROM node WHERE depth > 0 GROUP BY ALL),
valued AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(p[depth].x) END AS saved
  FROM node LEFT JOIN child USING (depth, p)),
subtree AS (
  SELECT CAST(u.d AS BIGINT) AS depth, p[1:u.d] AS p,
         count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM valued, unnest(range(depth + 1)) u(d) GROUP BY ALL)
SELECT v.conv_id, v.depth, q.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(array_to_string(list_transform(v.ends, lambda x: CAST(x AS VARCHAR)), ','), ''))
         AS ends_sha256
FROM valued v JOIN subtree s USING (depth, p)
LEFT JOIN node q ON q.depth = v.depth - 1 AND q.p = v.p[1:v.depth - 1]
"""

COLLOCATIONS = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM worded, unnest(range(1, len(ws) + 1)) a(i), unnest(range(1, 6)) b(k)
  WHERE i + k - 1 <= len(ws)),
counts AS (SELECT lang, k AS m, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE m = 1 GROUP BY lang),
candidates AS (SELECT * FROM counts WHERE m > 1 AND f >= 100),
cuts AS (
  SELECT c.lang, c.phrase, c.m, c.f AS a, x.k, string_split(c.phrase, ' ') AS ws
  FROM candidates c, unnest(range(1, 5)) x(k) WHERE x.k < c.m),
scores AS (
  SELECT u.lang, u.phrase, u.a, u.k, l.f AS l, r.f AS r, n,
         (1000::HUGEINT * u.a * n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts u JOIN totals USING (lang)
  JOIN counts l ON l.lang = u.lang AND l.phrase = array_to_string(u.ws[1:u.k], ' ')
  JOIN counts r ON r.lang = u.lang AND r.phrase = array_to_string(u.ws[u.k + 1:], ' ')),
lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT c.lang, array_to_string(string_split(c.phrase, ' ')[i:i + k - 1], ' ') AS phrase, max(c.f) AS f
  FROM candidates c, unnest(range(1, 6)) s(i), unnest(range(2, 5)) t(k)
  WHERE k < c.m AND i + k - 1 <= c.m GROUP BY ALL),
kept AS (
  SELECT w.* FROM lowest w LEFT JOIN inside i ON i.lang = w.lang AND i.phrase = w.phrase
  WHERE i.f IS NULL OR 100 * i.f < 100 * w.a)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank,
       phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000
"""
