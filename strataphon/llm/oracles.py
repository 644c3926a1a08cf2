"""DuckDB SQL of the operators that SQL can express: plain definitions, quadratic or worse, for small tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "list_filter(string_split_regex({}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

OP1 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
   ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))) END AS s FROM d),
 x AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM s),
 c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common, any_value(a.n) AS na, any_value(b.n) AS nb FROM x a JOIN x b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 l AS (SELECT a, b FROM c WHERE 100 * common >= 85 * (na + nb - common)),
 r(id, top) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.top FROM r JOIN l ON l.a = r.id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, (SELECT min(top) FROM r WHERE r.id = s.doc_id) AS component_id, (SELECT count(*) FROM l WHERE l.a = s.doc_id) AS n_links FROM s
"""

_VECTORS = """v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0)"""

OP6 = f"""
WITH RECURSIVE {_VECTORS},
 l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
   WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
 r(id, top) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.top FROM r JOIN l ON l.a = r.id),
 g AS (SELECT id, min(top) AS component_id FROM r GROUP BY id)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN g ON id = vec_id
"""

OP7 = f"""
WITH {_VECTORS},
 s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM
 (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""

_RUNS = """m{0} AS (SELECT {1}.doc_id, i, max(i + {2}) OVER (PARTITION BY {1}.doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
   FROM {1} JOIN (SELECT h FROM {1} GROUP BY h HAVING count(*) > 1) USING (h)),
 g{0} AS (SELECT doc_id, i, sum((reach IS NULL OR i > reach)::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM m{0}),
 runs{0} AS (SELECT doc_id, run, min(i) AS a, max(i) + {2} AS b FROM g{0} GROUP BY ALL)"""

OP8 = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
 p AS (SELECT doc_id, i, hash(substring(x, 2 * i + 1, 800)) AS h FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 399)) AS i FROM d)),
 {_RUNS.format("", "p", 400)},
 q AS (SELECT doc_id, i, hash(array_to_string(w[i + 1 : i + 51], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(0, len(w) - 50)) AS i FROM d)),
 {_RUNS.format("w", "q", 51)},
 cuts AS (SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM runs UNION ALL SELECT doc_id, 0, min(a) FROM runs GROUP BY 1),
 kept AS (SELECT doc_id, string_agg(substring(x, 2 * a + 1, 2 * (coalesce(b, len(x) // 2) - a)), '' ORDER BY a) AS x FROM cuts JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, (len(d.x) // 2)::BIGINT AS n_bytes, ((len(d.x) - len(coalesce(k.x, d.x))) // 2)::BIGINT AS n_removed,
 (SELECT count(*) FROM runs WHERE runs.doc_id = d.doc_id) AS n_spans, sha256(unhex(coalesce(k.x, d.x))) AS kept_sha256,
 (len(coalesce(k.x, d.x)) // 2)::BIGINT AS n_kept, (SELECT count(*) FROM runsw WHERE runsw.doc_id = d.doc_id) AS n_passages
FROM d LEFT JOIN kept k USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": OP1,
    "op6_embedding_near_dedup": OP6,
    "op7_block_matrix_neighbours": OP7,
    "op8_radix_suffix_dedup": OP8,
}
