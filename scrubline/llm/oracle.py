"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from .quality_rules import BIT, DEFAULT_POLICY, POLICIES, Limits

_L = Limits()

OP9 = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
wins AS (
  SELECT doc_id, p, list_aggregate(w[p:p + 7], 'string_agg', ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM base WHERE len(w) >= 8)),
hit AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, win) AS c FROM wins)
  WHERE c >= 2),
rep AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - p, 8))) AS n
  FROM (SELECT doc_id, p, lead(p) OVER (PARTITION BY doc_id ORDER BY p) AS nxt FROM hit)
  GROUP BY doc_id),
m AS (
  SELECT b.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(ls)::BIGINT AS n_lines,
         (length(t) - length(regexp_replace(t, '[A-Z]+', '', 'g')))::BIGINT AS n_upper
  FROM base b LEFT JOIN rep USING (doc_id)),
f AS (
  SELECT *,
    (CASE WHEN n_words < {_L.min_words} THEN {BIT['few_words']} ELSE 0 END
     + CASE WHEN 100 * n_repeat_words > {_L.max_repeat_pct} * n_words
            THEN {BIT['repeated_words']} ELSE 0 END
     + CASE WHEN 100 * n_symbols > {_L.max_symbol_pct} * n_words THEN {BIT['symbols']} ELSE 0 END
     + CASE WHEN 100 * n_dup_lines > {_L.max_dup_line_pct} * n_lines
            THEN {BIT['duplicate_lines']} ELSE 0 END
     + CASE WHEN 100 * n_upper > {_L.max_upper_pct} * word_chars
            THEN {BIT['upper_case']} ELSE 0 END
     + CASE WHEN word_chars < {_L.min_word_chars} * n_words
              OR word_chars > {_L.max_word_chars} * n_words
            THEN {BIT['word_length']} ELSE 0 END)::BIGINT AS failed_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed_bits & {POLICIES['base']}) <> 0 AS base_failed,
       (failed_bits & {POLICIES[DEFAULT_POLICY]}) = 0 AS kept, n_lines, n_upper, failed_bits
FROM f
"""

#: The vectors that take part, as whole numbers.
_VECTORS = """
v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(
    embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),"""

OP2 = "WITH" + _VECTORS.format(scale=1024) + """
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10"""

OP6 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 2 THEN w ELSE list_transform(
    range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) END) AS s
  FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS seen FROM documents
  UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.seen)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(seen) AS component_id,
       doc_id = min(seen) AS kept
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""

OP11 = "WITH" + _VECTORS.format(scale=256) + """
l AS (
  SELECT vec_id, q, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM v WHERE label IS NOT NULL),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS own,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM l a JOIN l b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k
    FROM s WHERE own) WHERE k <= 5),
n AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT own AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM n WHERE rank <= 10"""

OP12 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d
  FROM pages),
r AS (
  SELECT *, max(page_id) OVER (PARTITION BY n, d) AS keeper FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM r"""

#: CRC-32 from its table, a byte after the other.
OP13 = r"""
WITH tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i))),
texts AS (
  SELECT 0 AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT 1, item_id, text FROM benchmark),
words AS (
  SELECT side, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
feats AS (
  SELECT side, id, unnest(w) AS f FROM words
  UNION ALL
  SELECT side, id, unnest(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]))
  FROM words WHERE len(w) > 1),
hexes AS (SELECT DISTINCT f, hex(encode(f)) AS h FROM feats),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(
      range(0, len(h) // 2), lambda k: (instr('0123456789ABCDEF', h[2 * k + 1]) - 1) * 16
                                       + instr('0123456789ABCDEF', h[2 * k + 2]) - 1)),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM hexes, tab),
placed AS (SELECT side, id, bucket FROM feats JOIN hashed USING (f)),
counts AS (
  SELECT b AS bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t
  FROM (SELECT unnest(range(10000)) AS b) LEFT JOIN placed ON bucket = b GROUP BY b),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
                                 / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS g
  FROM counts),
weights AS (
  SELECT id, count(*) AS n, floor(sum(g) / count(*))::BIGINT AS weight
  FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY id),
scored AS (
  SELECT d.id AS doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         len(w) AS n_words,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || d.id), 1, 8))::BIGINT
           + 0.5) / 4294967296)))::BIGINT AS score
  FROM words d LEFT JOIN weights USING (id) WHERE d.side = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS r,
         count(*) FILTER (n_words >= 20) OVER () AS able
  FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND r <= 25 * able // 100 THEN r END AS rank
FROM ranked
"""

ORACLE_SQL = {"op2_topk_search": OP2, "op6_minhash_dedup": OP6, "op9_quality_rules": OP9,
              "op11_hard_negatives": OP11, "op12_warc": OP12, "op13_importance_resampling": OP13}
