"""DuckDB SQL for the operators that SQL can express, over whole tables."""

# The white space that separates words.
_SPACE = "[\\x20\\x09-\\x0D]+"

EXACT_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       first_value(doc_id) OVER w = doc_id AS kept,
       sha256(norm) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST)
"""

TOP_K = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

MIXING = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> ''))::BIGINT AS size
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source IS NULL, source COLLATE "binary") - 1 AS i
  FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][(i % 3 + 1)::INTEGER] AS weight, 2 * source_size AS cap FROM src),
o AS (
  SELECT *, (1.5 * (SELECT sum(source_size) FROM src)
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY cap / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
lv AS (SELECT level FROM o WHERE level * weight < cap ORDER BY cap / weight, i LIMIT 1),
t AS (SELECT source, source_size, least(coalesce((SELECT level FROM lv) * weight, cap), cap)::DOUBLE AS target FROM o),
q AS (
  SELECT d.doc_id, d.source, d.size, md5('11:' || coalesce(d.doc_id::VARCHAR, '')) AS k, t.source_size, t.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('11:' || coalesce(d.doc_id::VARCHAR, '')), d.doc_id, d.size
                           ROWS UNBOUNDED PRECEDING)::BIGINT AS cum
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT q.*, e.epoch, (e.epoch * source_size + cum)::DOUBLE / target AS finish
  FROM q, (SELECT unnest([0, 1]) AS epoch) e WHERE target > 0),
g AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source IS NULL, source COLLATE "binary", epoch, k, doc_id, size ROWS UNBOUNDED PRECEDING) AS total FROM p),
n AS (SELECT doc_id, source, count(*) AS copies FROM g WHERE total <= (SELECT sum(target) FROM t) GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, (coalesce(n.copies, 0) * q.size)::BIGINT AS taken
FROM q LEFT JOIN n ON q.doc_id IS NOT DISTINCT FROM n.doc_id AND q.source IS NOT DISTINCT FROM n.source
"""

SUBSTRING_DEDUP = rf"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') AS w FROM documents),
win AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)),
own AS (SELECT k, min(doc_id) AS first FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT DISTINCT doc_id, p FROM win JOIN own USING (k) WHERE first < doc_id),
gone AS (SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(range(p, p + 50)) AS j FROM hit) GROUP BY doc_id),
k AS (
  SELECT d.doc_id, d.w, coalesce(g.js, []) AS js,
         CASE WHEN g.js IS NULL THEN d.w
              ELSE [d.w[i] FOR i IN list_filter(range(1, len(d.w) + 1), lambda i: NOT list_contains(g.js, i))] END AS kept
  FROM d LEFT JOIN gone g USING (doc_id))
SELECT doc_id, len(w)::BIGINT AS n_words, len(js)::BIGINT AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM k
"""

MINHASH_DEDUP = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '{_SPACE}'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[p:p + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM pair JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * n_both >= 75 * (a.n + b.n - n_both)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (
  SELECT doc_id AS root, doc_id AS node FROM d
  UNION
  SELECT root, y FROM reach JOIN edge ON x = node),
c AS (SELECT root, min(node) AS component_id FROM reach GROUP BY root)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.root = d.doc_id
"""

WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, {_ASCII_LOWER} AS t FROM documents),
piece AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece),
g AS (
  SELECT lang, w[i:i + k - 1] AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, g, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE len(g) = 1 GROUP BY lang),
c AS (SELECT lang, g, f AS a FROM f WHERE f >= 30 AND len(g) > 1),
cut AS (
  SELECT c.lang, c.g, c.a, k, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.a) // (l.f::HUGEINT + r.f)) AS score
  FROM (SELECT *, unnest(range(1, len(g))) AS k FROM c) c
  JOIN f l ON l.lang = c.lang AND l.g = c.g[1:k] JOIN f r ON r.lang = c.lang AND r.g = c.g[k + 1:]),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, g[i:i + k - 1] AS g, max(a) AS longer
  FROM (SELECT *, unnest(range(1, len(g) - k + 2)) AS i FROM (SELECT *, unnest(range(2, len(g))) AS k FROM c WHERE len(g) > 2))
  GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN inner_ i ON i.lang = b.lang AND i.g = b.g WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * b.a),
o AS (
  SELECT *, array_to_string(g, ' ') AS phrase,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ') COLLATE "binary") AS rank
  FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""

# crc32 by its byte table (polynomial 0xEDB88320), folded over the bytes of a string
SPELLING = rf"""
WITH RECURSIVE bits AS (
  SELECT i AS b, i::BIGINT AS v, 0 AS s FROM (SELECT unnest(range(256)) AS i)
  UNION ALL
  SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, s + 1 FROM bits WHERE s < 8),
tbl AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE s = 8),
run AS (
  SELECT doc_id, r, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all({_ASCII_LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents)
  GROUP BY ALL),
hx AS (SELECT r, c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || r)) AS x FROM run),
h AS (
  SELECT r, c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || x[i:i + 1])::BIGINT)),
                               lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) AS h
  FROM hx, tbl),
edited AS (
  SELECT CASE WHEN h % 97 = 0 THEN r[1:(h % length(r))::BIGINT] || r[(h % length(r))::BIGINT + 2:] ELSE r END AS word, c FROM h),
v AS (SELECT word, sum(c)::BIGINT AS n FROM edited WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cutv AS (SELECT DISTINCT word, n, word[1:i - 1] || word[i + 1:] AS cut, i FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v)),
pair AS (
  SELECT a.word AS a, b.word AS b, b.n AS bn FROM cutv a JOIN cutv b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cutv a JOIN v b ON a.cut = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cutv a JOIN v b ON a.cut = b.word),
near AS (SELECT a AS word, count(*) AS n_near, max(bn) AS m FROM pair GROUP BY a),
best AS (SELECT p.a AS word, min(p.b COLLATE "binary") AS b, any_value(p.bn) AS bn FROM pair p JOIN near ON near.word = p.a AND near.m = p.bn GROUP BY p.a),
form AS (
  SELECT v.word, v.n, coalesce(near.n_near, 0)::BIGINT AS n_near, CASE WHEN bn >= 2 * v.n THEN b END AS form, CASE WHEN bn >= 2 * v.n THEN bn END AS form_n
  FROM v LEFT JOIN near USING (word) LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at FROM form
  UNION ALL
  SELECT walk.word, form.form FROM walk JOIN form ON form.word = walk.at WHERE form.form IS NOT NULL),
ends AS (SELECT walk.word, walk.at AS root FROM walk JOIN form ON form.word = walk.at WHERE form.form IS NULL)
SELECT form.word, form, root, n, n_near, form_n FROM form JOIN ends USING (word)
"""
