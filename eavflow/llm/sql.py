"""DuckDB SQL of the operators that SQL can express, written out independently."""

OP1 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS w
      FROM d GROUP BY source),
c AS (SELECT *, CAST(source_size * 3 AS DOUBLE) / CAST(w AS DOUBLE) AS ratio FROM s),
l AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER before, 0) AS DOUBLE)
              / CAST(sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS level
      FROM c WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size,
             least(CAST(source_size * 3 AS DOUBLE), max(level) OVER () * CAST(w AS DOUBLE)) AS target FROM l),
h AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
             list_sum([(instr('0123456789abcdef', substr(md5('mix-1' || coalesce(source, '')), CAST(i AS INT), 1)) - 1)
                       * power(16, 8 - i) for i in range(1, 9)]) / 4294967296.0 AS u FROM t),
r AS (SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS LAST) - 1 AS k FROM d)
SELECT r.doc_id, r.size, h.source_size, h.target,
       CAST((floor(h.rate * (r.k + 1) + h.u) - floor(h.rate * r.k + h.u)) AS BIGINT) * r.size AS taken
FROM r JOIN h ON r.source IS NOT DISTINCT FROM h.source
"""

OP2 = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM n
"""

OP8 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len([c for c in e if c IS NULL OR NOT isfinite(c)]) = 0
         AND len([c for c in e if c <> 0]) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a, ok b
          WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec_id, node) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON l.a = r.node),
comp AS (SELECT vec_id, min(node) AS component_id FROM reach GROUP BY vec_id)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id) AS n_links, c.component_id,
       v.vec_id = c.component_id AS kept
FROM v JOIN comp c USING (vec_id)
"""

OP11 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 11)) AS i)),
lo AS (SELECT k, min(doc_id) AS first FROM win GROUP BY k),
gone AS (SELECT DISTINCT win.doc_id, i + j AS p FROM win JOIN lo USING (k), range(0, 13) t(j) WHERE first < win.doc_id),
kept AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS text, count(*) AS n
         FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w) x
         ANTI JOIN gone g ON g.doc_id = x.doc_id AND g.p = x.p GROUP BY x.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP12 = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest([ws[i:i + k - 1] for i in range(1, len(ws) - k + 2)]) AS ws FROM w, range(1, 6) t(k) WHERE len(ws) >= k),
f AS (SELECT lang, k, ws, count(*) AS a FROM g GROUP BY ALL),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 100),
inner_ AS (SELECT DISTINCT c.lang, c.ws[i:i + m - 1] AS ws, c.a
           FROM c, range(2, 5) s(m), LATERAL (SELECT unnest(range(1, c.k - m + 2)) AS i) WHERE m < c.k),
dropped AS (SELECT DISTINCT c.lang, c.ws FROM c JOIN inner_ i ON i.lang = c.lang AND i.ws = c.ws AND 100 * i.a >= 100 * c.a),
cuts AS (SELECT c.lang, c.ws, c.a, m, x.a AS l, y.a AS r, n.n,
                (CAST(1000 AS HUGEINT) * c.a * n.n) // (CAST(x.a AS HUGEINT) * y.a) AS score
         FROM c ANTI JOIN dropped o ON o.lang = c.lang AND o.ws = c.ws JOIN n ON n.lang = c.lang JOIN range(1, 5) t(m) ON m < c.k
         JOIN f x ON x.lang = c.lang AND x.ws = c.ws[1:m] JOIN f y ON y.lang = c.lang AND y.ws = c.ws[m + 1:]),
best AS (SELECT *, array_to_string(ws, ' ') AS phrase FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, m) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM best QUALIFY rank <= 2000
"""

OP13 = r"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             CAST(list_sum([a.q[i] * b.q[i] for i in range(1, len(a.q) + 1)]) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""

SQL = {
    "op1_mix_sources": OP1,
    "op2_exact_dedup": OP2,
    "op8_embedding_dedup": OP8,
    "op11_substring_dedup": OP11,
    "op12_collocations": OP12,
    "op13_hard_negatives": OP13,
}
