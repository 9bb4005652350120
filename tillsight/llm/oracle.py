"""The same results as plain DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from tillsight.llm.host_rules import HostRules
from tillsight.llm.secret_scan import MIN_VALUE, PATTERNS, Ownership

_RULES, _OWNER = HostRules(), Ownership()
WORD = r"[^\x20\x09-\x0D]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _base32(hex_column: str) -> str:
    """40 hex digits as 32 base32 digits, five at a time."""
    part = f"CAST('0x' || substr({hex_column}, 5 * k + 1, 5) AS INTEGER)"
    digits = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({part} >> {s}) & 31) + 1, 1)" for s in (15, 10, 5, 0))
    return f"array_to_string(list_transform(range(0, 8), lambda k: {digits}), '')"


WARC = f"""
  WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS digest FROM pages),
  f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM p)
  SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
         {_base32("digest")} AS payload_digest,
         CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
         CASE WHEN page_id <> first THEN first END AS refers_to
  FROM f"""

# Counts of each text, then failures by host, the prior of all hosts, and the verdict.
HOSTS = f"""
  WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
  w AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS words FROM d)),
  t AS (SELECT doc_id, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w
        WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
  again AS (SELECT doc_id, i FROM t WHERE w3 IS NOT NULL
            QUALIFY count(*) OVER (PARTITION BY doc_id, w, w2, w3) > 1),
  marked AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
             FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
  sizes AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY doc_id),
  lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
            WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id),
  c AS (SELECT doc_id, source, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
               CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
               CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
               coalesce(n_lines, 0) AS n_lines
        FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN marked USING (doc_id)),
  b AS (SELECT *, n_words < {_RULES.min_words} OR 100 * n_repeat_words > {_RULES.max_repeat_pct} * n_words AS base_failed
        FROM c),
  r AS (SELECT *, base_failed OR n_symbols > {_RULES.max_symbols_per_word} * n_words
                  OR n_dup_lines > {_RULES.max_dup_line_rate} * n_lines
                  OR word_chars < {_RULES.min_mean_word} * n_words
                  OR word_chars > {_RULES.max_mean_word} * n_words AS failed FROM b),
  h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE failed) AS k FROM r GROUP BY source),
  m AS (SELECT avg(k / n) AS m, var_pop(k / n) AS v, avg(1 / n) AS per_row FROM h),
  p AS (SELECT m, greatest(coalesce(least(CASE WHEN v > m * (1 - m) * per_row
                 THEN m * (1 - m) / (v - m * (1 - m) * per_row) - 1 END, {_RULES.max_prior_rows}),
                 {_RULES.max_prior_rows}), 1.0) AS s FROM m),
  j AS (SELECT source, (k + m * s) / (n + s) AS rate FROM h, p)
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
         NOT failed AND rate <= {_RULES.max_host_rate} AS kept, round(rate, 6) AS shrunk_rate
  FROM r JOIN j USING (source)"""


def _kind(order: int, kind: str, pattern: str) -> str:
    p = quoted(pattern)
    return f"""
    SELECT doc_id, source, {order} AS o, '{kind}' AS kind, unnest(hits) AS hit,
           unnest(list_transform(range(1, len(hits) + 1), lambda i:
             list_sum(list_transform(gaps[1:i], lambda g: length(g)))
             + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0))) AS s
    FROM (SELECT doc_id, source, regexp_extract_all(text, {p}) AS hits, regexp_split_to_array(text, {p}) AS gaps FROM d)"""


SECRETS = f"""
  WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
  m AS ({" UNION ALL ".join(_kind(i, k, PATTERNS[k]) for i, k in enumerate(PATTERNS))}),
  v AS (SELECT *, CAST(s + length(hit) AS BIGINT) AS e,
               CASE WHEN kind = 'assign' THEN regexp_extract(hit, {quoted(PATTERNS["assign"])}, 2) ELSE hit END AS value FROM m),
  c AS (SELECT * FROM v WHERE kind <> 'assign' OR length(value) >= {MIN_VALUE}),
  own AS (SELECT value, count(DISTINCT source) AS owners, count(DISTINCT doc_id) AS repos,
                 owners >= {_OWNER.example_owners} OR repos >= {_OWNER.example_repos} AS example FROM c GROUP BY value),
  b AS (SELECT doc_id, CAST(s AS BIGINT) AS s, o, kind, e, example, owners, repos,
               NOT example AND length(value) >= {_OWNER.live_length} AND regexp_matches(value, '[0-9]')
               AND regexp_matches(value, '[A-Za-z]')
               AND len(list_distinct(string_split(value, ''))) >= {_OWNER.live_distinct} AS live, length(value) AS n
        FROM c JOIN own USING (value)),
  a AS (SELECT doc_id, s, o, kind, e, true AS base, example, owners, repos FROM b
        UNION ALL SELECT DISTINCT doc_id, CAST(e - n AS BIGINT), 3, 'owned', e, false, false, owners, repos FROM b WHERE live),
  g AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign,
               count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
               max(owners) AS max_owners, max(repos) AS max_repos, count(*) FILTER (WHERE NOT base) AS n_owned, count(*) FILTER (WHERE base AND example) AS n_copied,
               string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (WHERE base) AS base_spans,
               string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans FROM a GROUP BY doc_id)
  SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
         coalesce(n_owned, 0) AS n_owned, coalesce(n_copied, 0) AS n_copied,
         coalesce(max_owners, 0) AS max_owners, coalesce(max_repos, 0) AS max_repos,
         sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
  FROM d LEFT JOIN g USING (doc_id)"""

CLASSES = f"""
  WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
          THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM w),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (shingle)
           WHERE a.doc_id <> b.doc_id GROUP BY ALL),
  links AS (SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
            WHERE 100 * k >= 80 * (a.n + b.n - k)),
  reach AS (SELECT doc_id AS x, doc_id AS y FROM n
            UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
  least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
  SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
  FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least ON x = doc_id"""

INNER = """
  WITH v AS (SELECT vec_id, row_number() OVER () AS place,
                    list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
             FROM embeddings
             WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT q.place, q.vec_id AS query_id, c.vec_id, c.place AS other,
               CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
        FROM v q JOIN v c ON q.place <> c.place AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
  r AS (SELECT *, CAST(row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id, other) AS INTEGER) AS rank FROM s)
  SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""

PHRASES = r"""
  WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
  p AS (SELECT lang, unnest(regexp_extract_all(text, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM d),
  q AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
  w AS (SELECT lang, piece, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM q),
  t AS (SELECT lang, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY piece ORDER BY i)),
  f AS (SELECT lang, 1 AS k, w AS phrase, count(*) AS f FROM t GROUP BY ALL
        UNION ALL SELECT lang, 2, w || ' ' || w2, count(*) FROM t WHERE w2 IS NOT NULL GROUP BY ALL
        UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3, count(*) FROM t WHERE w3 IS NOT NULL GROUP BY ALL),
  n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
  c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
  u AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
  e AS MATERIALIZED (SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS rest FROM u),
  x AS MATERIALIZED (SELECT e.*, f.f AS l FROM e JOIN f ON f.lang = e.lang AND f.phrase = e.head),
  y AS MATERIALIZED (SELECT x.*, f.f AS r FROM x JOIN f ON f.lang = x.lang AND f.phrase = x.rest),
  s AS (SELECT lang, phrase, a, l, r, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score
        FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
  b AS (SELECT lang, phrase, max(a) AS longer
        FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM c WHERE k = 3)
        GROUP BY ALL)
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM s LEFT JOIN b USING (lang, phrase) JOIN n USING (lang)
  WHERE longer IS NULL OR 100 * longer < 50 * a
  QUALIFY rank <= 2000"""

# CRC-32 by its bits: -1 stands for a shift, another number for a byte.
_CRC = """xor(4294967295, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
      lambda d: [CAST(ascii(d) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END))"""

TRIE = f"""
  WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
             FROM conversations WHERE conv_id IS NOT NULL),
  v AS (SELECT c, max(pos) AS n FROM t GROUP BY c),
  p AS (SELECT v.*, c - c % 5 AS base, {_CRC} % 9 AS h FROM v),
  k AS (SELECT p.*, least(h, coalesce(b.n, 0)) AS taken, least(h, coalesce(b.n, 0)) + greatest(p.n - h, 0) AS size
        FROM p LEFT JOIN v b ON b.c = p.base),
  r AS (SELECT k.c, size, taken + pos - h AS depth, role, text FROM k JOIN t USING (c) WHERE pos > h
        UNION ALL SELECT k.c, size, pos, role, text FROM k JOIN t ON t.c = k.base WHERE pos <= h),
  x AS (SELECT c, size, depth, octet_length(encode(text)) AS bytes,
               sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY c ORDER BY depth)) AS node FROM r),
  a AS (SELECT *, coalesce(lag(node) OVER (PARTITION BY c ORDER BY depth), 'root') AS up FROM x
        UNION ALL SELECT c, size, 0, 0, 'root', NULL FROM k),
  g AS (SELECT depth, node, min(c) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes, min(up) AS up,
               string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE depth = size) AS ends FROM a GROUP BY depth, node),
  m AS (SELECT depth - 1 AS depth, up AS node, count(*) AS n_children FROM g GROUP BY ALL),
  s AS (SELECT g.*, coalesce(n_children, 0) AS n_children, CAST(n_children IS NULL AS INTEGER) AS leaf
        FROM g LEFT JOIN m ON m.depth = g.depth AND m.node = g.node),
  u AS (SELECT a.depth, a.node, sum(s.leaf) AS n_leaves, sum((s.n_convs - 1) * s.bytes) AS saved
        FROM s JOIN a ON a.c = s.conv_id AND a.depth <= s.depth GROUP BY a.depth, a.node)
  SELECT s.conv_id, CAST(s.depth AS BIGINT) AS depth, o.conv_id AS parent_conv_id, s.n_convs, s.n_children,
         CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(s.ends, '')) AS ends_sha256
  FROM s JOIN u ON u.depth = s.depth AND u.node = s.node
  LEFT JOIN g o ON o.depth = s.depth - 1 AND o.node = s.up"""

ORACLE = {
    "op1_warc": WARC,
    "op2_host_rules": HOSTS,
    "op4_secret_scan": SECRETS,
    "op9_jaccard_join": CLASSES,
    "op11_prefix_trie": TRIE,
    "op12_collocations": PHRASES,
    "op13_bit_slices": INNER,
}
