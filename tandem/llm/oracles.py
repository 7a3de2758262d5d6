"""DuckDB SQL of the queries that SQL can express whole; numpy-free second forms, not shared with the operators."""

SOURCE_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
tokens AS (SELECT doc, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term FROM tokens GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
vocab AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN vocab USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source) USING (lang, source)),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
         1 + (1000000000 * (coalesce(n, 0)::HUGEINT + 2)) // (g.total::HUGEINT + 2 * g.v) AS p
  FROM groups g JOIN kept k ON g.lang = k.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
average AS (
  SELECT c.lang, c.term,
         1 + (1000000000 * (sum(c.n)::HUGEINT + 2)) // (any_value(t.total)::HUGEINT + 2 * any_value(v)) AS q
  FROM counts c JOIN vocab USING (lang)
  JOIN (SELECT lang, sum(total) AS total FROM groups GROUP BY lang) t ON t.lang = c.lang
  GROUP BY c.lang, c.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
found AS (
  SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value
  FROM pairs LEFT JOIN distances USING (lang, source, item)
  UNION ALL
  SELECT s.lang, s.source, 'term', s.term, (((p - q) * (p - q)) // (p + q))::BIGINT
  FROM shares s JOIN average USING (lang, term) WHERE s.n > 0 AND p > q)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= 10
"""

EXACT_TOPK = """
WITH rows AS (
  SELECT row_number() OVER () AS at, vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)
SELECT q.vec_id AS query_id,
       row_number() OVER (PARTITION BY q.at ORDER BY list_inner_product(q.x, c.x) DESC, c.vec_id)::INTEGER AS rank,
       c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
FROM rows q JOIN rows c ON q.at <> c.at
WHERE q.vec_id % 100 = 0
QUALIFY rank <= 10
"""

LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leads(n: int) -> str:
    """The word of a row and the ``n - 1`` after it as a list (nulls past the end)."""
    return "[" + ", ".join(["word"] + [f"lead(word, {k}) OVER w" for k in range(1, n)]) + "]"


NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all({LOWER_SQL}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
tokens AS (SELECT uid, len(words) AS n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs),
runs AS (SELECT uid, n, i, {_leads(5)} AS g FROM tokens WINDOW w AS (PARTITION BY uid ORDER BY i)),
shingles AS (SELECT DISTINCT uid, array_to_string(g, ' ') AS s FROM runs WHERE i = 1 OR i <= n - 4),
sizes AS (SELECT uid, count(*) AS size FROM shingles GROUP BY uid),
common AS (SELECT a.uid AS a, b.uid AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.uid <> b.uid GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.uid = a JOIN sizes y ON y.uid = b
  WHERE 100 * common.n >= 75 * (x.size + y.size - common.n)
  UNION SELECT x.uid, y.uid FROM docs x JOIN docs y ON x.doc_id = y.doc_id AND x.uid <> y.uid),
reach(uid, comp) AS (
  SELECT uid, doc_id FROM docs UNION SELECT links.b, reach.comp FROM reach JOIN links ON links.a = reach.uid)
SELECT doc_id, coalesce(size, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs JOIN (SELECT uid, min(comp) AS component_id FROM reach GROUP BY uid) USING (uid) LEFT JOIN sizes USING (uid)
"""

CONTAMINATION = f"""
WITH docs AS (
  SELECT row_number() OVER () AS uid, doc_id,
         regexp_extract_all({LOWER_SQL}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
items AS (
  SELECT row_number() OVER () AS row, item_id::VARCHAR AS item,
         regexp_extract_all({LOWER_SQL}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
item_tokens AS (SELECT row, item, len(words) AS total, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM items),
item_runs AS (
  SELECT item, total, i, {_leads(13)} AS g FROM item_tokens WINDOW w AS (PARTITION BY row ORDER BY i)),
windows AS (
  SELECT DISTINCT item, least(total, 13) AS n, array_to_string(g, ' ') AS win FROM item_runs WHERE i = 1 OR i <= total - 12),
tokens AS (SELECT uid, len(words) AS total, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs),
runs AS (SELECT uid, total, i, {_leads(13)} AS g FROM tokens WINDOW w AS (PARTITION BY uid ORDER BY i)),
places AS (
  SELECT uid, i, n, array_to_string(g[1:n], ' ') AS win FROM runs JOIN (SELECT DISTINCT n FROM windows) ON i + n - 1 <= total),
found AS (SELECT uid, i, windows.n AS n, item FROM places JOIN windows USING (n, win)),
hits AS (SELECT uid, count(DISTINCT place) AS n_hit FROM (SELECT uid, unnest(range(i, i + n)) AS place FROM found) GROUP BY uid),
listed AS (
  SELECT uid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT uid, item FROM found WHERE item IS NOT NULL) GROUP BY uid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(words) AS contaminated
FROM docs LEFT JOIN hits USING (uid) LEFT JOIN listed USING (uid)
"""

MIXING = r"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS o FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM docs GROUP BY source),
weighted AS (SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[rank % 3 + 1] AS weight, 3 * source_size::DOUBLE AS cap FROM sums),
levels AS (
  SELECT *, cap / weight AS fill,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted WINDOW o AS (ORDER BY cap / weight, rank)),
targets AS (
  SELECT source, rank, source_size, least(cap, weight * coalesce(
         (SELECT level FROM levels WHERE level <= fill ORDER BY fill, rank LIMIT 1), 0)) AS target FROM levels),
queued AS (
  SELECT row_number() OVER () AS uid, doc_id, o, size, rank, source_size, target,
         sum(size) OVER (PARTITION BY rank ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) AS done
  FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source),
offered AS (
  SELECT uid, size, sum(size) OVER (ORDER BY (turn * source_size + done) / target, rank, o, doc_id, turn
                                    ROWS UNBOUNDED PRECEDING) AS upto
  FROM queued, (SELECT unnest([0, 1, 2]) AS turn) WHERE size > 0 AND target > 0),
taken AS (SELECT uid, sum(size)::BIGINT AS taken FROM offered WHERE upto <= (SELECT sum(size) FROM docs) GROUP BY uid)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM queued LEFT JOIN taken USING (uid)
"""
