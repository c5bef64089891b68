"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

#: A-Z in lower case, everything else as it is.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP6_NGRAM_JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id,
         CASE WHEN len(w) = 0 THEN []
              WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
              ELSE list_distinct([array_to_string(w[i:i + 3], ' ')
                                  FOR i IN range(1, len(w) - 2)]) END AS s
  FROM words
),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets),
met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS inter
  FROM tokens AS a JOIN tokens AS b ON a.token = b.token AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
),
links AS (SELECT a, b FROM met WHERE 100 * inter >= 85 * (n + m - inter)),
steps AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(node, goal) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reached.node, steps.b FROM reached JOIN steps ON reached.goal = steps.a
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, r.least AS component_id
FROM sets AS s
JOIN (SELECT node, min(goal) AS least FROM reached GROUP BY node) AS r ON r.node = s.doc_id
"""

OP7_DECONTAMINATION = rf"""
WITH pattern AS (SELECT '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS p),
docs AS (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), p) AS w FROM documents, pattern
),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(coalesce({_LOWER}, ''), p) AS w
  FROM benchmark, pattern
),
phrases AS (
  SELECT item_id, least(len(w), 13) AS size,
         unnest([array_to_string(w[i:i + least(len(w), 13) - 1], ' ')
                 FOR i IN range(1, greatest(len(w) - 11, 2))]) AS phrase
  FROM items WHERE len(w) > 0
),
sizes AS (SELECT DISTINCT size FROM phrases),
grams AS (
  SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS pos,
         unnest([array_to_string(w[i:i + size - 1], ' ')
                 FOR i IN range(1, len(w) - size + 2)]) AS phrase
  FROM docs, sizes WHERE len(w) >= size
),
found AS (
  SELECT DISTINCT g.doc_id, p.item_id, g.pos, g.size
  FROM grams AS g JOIN phrases AS p ON p.phrase = g.phrase AND p.size = g.size
),
hits AS (
  SELECT doc_id, count(DISTINCT hit) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS hit FROM found) AS s GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM found) AS s GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(n.n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(n.items, '')) AS items_sha256,
       coalesce(h.n_hit > 0 AND 20 * h.n_hit >= len(d.w), false) AS contaminated
FROM docs AS d LEFT JOIN hits AS h USING (doc_id) LEFT JOIN named AS n USING (doc_id)
"""

OP9_LINE_DEDUP = r"""
WITH blanks AS (SELECT ' ' || chr(9) || chr(13) || chr(11) || chr(12) AS chars),
lines AS (
  SELECT doc_id, source, text, u.line AS line, trim(u.line, chars) AS key, u.pos AS pos
  FROM documents, blanks,
       LATERAL (SELECT unnest(string_split(text, chr(10))) AS line,
                       generate_subscripts(string_split(text, chr(10)), 1) AS pos) AS u
  WHERE text IS NOT NULL
),
totals AS (
  SELECT source, count(DISTINCT text) AS total FROM documents WHERE text <> '' GROUP BY source
),
boilerplate AS (
  SELECT l.source, l.key
  FROM (SELECT source, key, count(DISTINCT text) AS pages FROM lines WHERE key <> ''
        GROUP BY source, key) AS l
  JOIN totals AS t ON l.source IS NOT DISTINCT FROM t.source
  WHERE pages >= 2
    AND pages > 0.1::DOUBLE * least(1::DOUBLE, 32::DOUBLE / length(l.key)) * total
),
judged AS (
  SELECT l.doc_id, l.line, l.pos, l.key <> '' AS worded, b.key IS NOT NULL AS dropped
  FROM lines AS l
  LEFT JOIN boilerplate AS b ON l.source IS NOT DISTINCT FROM b.source AND l.key = b.key
)
SELECT d.doc_id,
       coalesce(j.n_lines, 0)::BIGINT AS n_lines,
       coalesce(j.n_dropped, 0)::BIGINT AS n_dropped,
       sha256(coalesce(j.kept, '')) AS text_sha256
FROM documents AS d
LEFT JOIN (
  SELECT doc_id, count(*) FILTER (worded) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
         string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped) AS kept
  FROM judged GROUP BY doc_id
) AS j USING (doc_id)
"""


def _centroids_sql(k: int = 8, rounds: int = 10, dimensions: int = 64) -> str:
    """One step per round: vectors to their nearest centroid, then floors of the means."""

    def assigned(i: int) -> str:
        return f"""
a{i} AS MATERIALIZED (
  SELECT id, v, min({{'d': d, 'c': c}}) AS best FROM (
    SELECT id, v, c, list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM vectors, c{i}) AS s
  GROUP BY id, v)"""

    def next_centroids(i: int) -> str:
        return f"""
m{i} AS (
  SELECT c, pos, sum(x) AS s, count(*) AS n
  FROM (SELECT best.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{i}) AS s GROUP BY c, pos),
c{i + 1} AS MATERIALIZED (
  SELECT c{i}.c AS c, coalesce(m.w, c{i}.w) AS w FROM c{i} LEFT JOIN (
    SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY pos)::BIGINT[] AS w FROM m{i} GROUP BY c) AS m USING (c))"""

    steps = ",".join(assigned(i) + "," + next_centroids(i) for i in range(rounds))
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT vec_id AS id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = {dimensions}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions}),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h) - 1)::INTEGER AS c, v AS w
  FROM (SELECT sha256('3:' || id) AS h, v FROM vectors ORDER BY h LIMIT {k}) AS s),
{steps},
{assigned(rounds)}
SELECT a.id AS vec_id, a.best.c AS cluster, a.best.d AS distance,
       (sum(a.best.d) OVER (PARTITION BY a.best.c))::BIGINT AS cluster_inertia,
       (sum(a.best.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c{rounds}.w, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} ON c{rounds}.c = a.best.c
"""


OP11_CENTROIDS = _centroids_sql()

OP12_TOPK = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM vectors AS q JOIN vectors AS c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 50 = 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
"""

#: CRC-32 of a word: its bytes through the table of the reversed polynomial 0xEDB88320.
OP13_RESAMPLING = rf"""
WITH RECURSIVE pattern AS (SELECT '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS p),
bits(b, i, c) AS (
  SELECT range::UBIGINT, 0, range::UBIGINT FROM range(256)
  UNION ALL
  SELECT b, i + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END
  FROM bits WHERE i < 8
),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE i = 8),
docs AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), p) AS w FROM documents, pattern
),
items AS (SELECT regexp_extract_all(coalesce({_LOWER}, ''), p) AS w FROM benchmark, pattern),
doc_words AS MATERIALIZED (
  SELECT doc_id, word, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word FROM docs) AS s GROUP BY doc_id, word
),
item_words AS MATERIALIZED (
  SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM items) AS s GROUP BY word
),
words AS (
  SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM doc_words UNION SELECT word FROM item_words) AS s
),
steps(word, h, i, c) AS (
  SELECT word, h, 0, 4294967295::UBIGINT FROM words
  UNION ALL
  SELECT word, h, i + 1,
         xor(c >> 8, t[(xor(c & 255, ('0x' || h[2 * i + 1:2 * i + 2])::UBIGINT) + 1)::BIGINT])
  FROM steps, crc_table WHERE 2 * i < len(h)
),
buckets AS MATERIALIZED (
  SELECT word, (xor(c, 4294967295::UBIGINT) % 10000)::INTEGER AS bucket FROM steps WHERE 2 * i = len(h)
),
source AS (SELECT bucket, sum(n) AS s FROM doc_words JOIN buckets USING (word) GROUP BY bucket),
target AS (SELECT bucket, sum(n) AS t FROM item_words JOIN buckets USING (word) GROUP BY bucket),
totals AS (
  SELECT (SELECT coalesce(sum(s), 0) FROM source) AS big_s, (SELECT coalesce(sum(t), 0) FROM target) AS big_t
),
gains AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (big_s + 10000))::DOUBLE
                                 / ((coalesce(s, 0) + 1) * (big_t + 10000))::DOUBLE))::BIGINT AS gain
  FROM (SELECT DISTINCT bucket FROM buckets) AS b
  LEFT JOIN source USING (bucket) LEFT JOIN target USING (bucket), totals
),
weights AS (
  SELECT doc_id, sum(n * gain)::BIGINT AS weight
  FROM doc_words JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY doc_id
),
scored AS (
  SELECT d.doc_id, len(d.w)::BIGINT AS n_features, coalesce(w.weight, 0)::BIGINT AS weight,
         (coalesce(w.weight, 0) + floor(-1000 * ln(-ln(
            (('0x' || sha256('2024:' || d.doc_id)[1:8])::BIGINT + 0.5)::DOUBLE / 4294967296::DOUBLE))))::BIGINT AS score
  FROM docs AS d LEFT JOIN weights AS w USING (doc_id)
),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_features >= 20
)
SELECT s.doc_id, s.n_features, s.weight, s.score,
       CASE WHEN p.rank <= 10 * p.n // 100 THEN p.rank END AS rank
FROM scored AS s LEFT JOIN placed AS p USING (doc_id)
"""

ORACLES: dict[str, str] = {
    "op6_ngram_jaccard": OP6_NGRAM_JACCARD,
    "op7_decontamination": OP7_DECONTAMINATION,
    "op9_line_dedup": OP9_LINE_DEDUP,
    "op11_centroids": OP11_CENTROIDS,
    "op12_topk": OP12_TOPK,
    "op13_resampling": OP13_RESAMPLING,
}
