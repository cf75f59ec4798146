"""The same results as SQL, where SQL can say it in reasonable time."""

from __future__ import annotations

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11 = rf"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), item_starts AS (
  SELECT item_id, ws, least(10, len(ws)) AS length, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS pos FROM item_words WHERE len(ws) > 0
), item_windows AS (
  SELECT DISTINCT item_id, length, array_to_string(ws[pos : pos + length - 1], ' ') AS words FROM item_starts
), lengths AS (SELECT DISTINCT length FROM item_windows),
doc_starts AS (
  SELECT doc_id, ws, length, unnest(range(1, len(ws) - length + 2)) AS pos FROM doc_words, lengths WHERE len(ws) >= length
), doc_windows AS (
  SELECT doc_id, length, pos, array_to_string(ws[pos : pos + length - 1], ' ') AS words FROM doc_starts
), hits AS (
  SELECT DISTINCT doc_id, d.length, pos, item_id FROM doc_windows d JOIN item_windows i ON d.length = i.length AND d.words = i.words
), places AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + length)) AS place FROM hits
), covered AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# The CRC-32 is taken bit by bit: bits of each byte, lowest first, shifted through the polynomial.
OP12 = rf"""
WITH runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents
), counted AS (
  SELECT run, hex(encode(doc_id || ':' || run)) AS bytes, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run
), summed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(0, 4 * length(bytes)),
      lambda i: ((instr('0123456789ABCDEF', substr(bytes, CAST((i // 8) * 2 + CASE WHEN i % 8 < 4 THEN 2 ELSE 1 END AS BIGINT), 1)) - 1) >> CAST(i % 4 AS INTEGER)) & 1)),
    lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384))) AS h FROM counted
), changed AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM summed
), vocabulary AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), gaps AS (
  SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM vocabulary)
), near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM gaps a JOIN vocabulary b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM gaps a JOIN vocabulary b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, encode(near))) AS form, max(near_n) AS form_n FROM near GROUP BY word
), told AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
  FROM vocabulary LEFT JOIN best USING (word)
), chain AS (
  WITH RECURSIVE steps(word, pos, depth) AS (
    SELECT word, word, 0 FROM told
    UNION ALL SELECT s.word, t.form, s.depth + 1 FROM steps s JOIN told t ON s.pos = t.word WHERE t.form IS NOT NULL
  ) SELECT word, arg_max(pos, depth) AS root FROM steps GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM told JOIN chain USING (word)
"""

OP13 = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_FOLD.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), sizes AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM split GROUP BY lang),
places AS (
  SELECT lang, ws, length, unnest(range(1, len(ws) - length + 2)) AS pos FROM split, (SELECT unnest([1, 2, 3]) AS length) WHERE len(ws) >= length
), f AS (
  SELECT lang, length, array_to_string(ws[pos : pos + length - 1], ' ') AS phrase, count(*) AS a FROM places GROUP BY ALL HAVING count(*) >= 10
), candidates AS (
  SELECT lang, phrase, a, length, string_split(phrase, ' ') AS w FROM f WHERE length >= 2
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.a AS l, r.a AS r, (1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a) AS score
  FROM (SELECT *, unnest(range(1, length)) AS k FROM candidates) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1 : k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1 : c.length], ' ')
), scored AS (
  SELECT lang, phrase, a, arg_min(l, (score, k)) AS l, arg_min(r, (score, k)) AS r, min(score) AS score FROM cuts GROUP BY lang, phrase, a
), inside AS (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM candidates WHERE length = 3
  UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM candidates WHERE length = 3
), holders AS (SELECT lang, phrase, max(a) AS longer FROM inside GROUP BY lang, phrase),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
  FROM scored LEFT JOIN holders USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""

# Components: the smallest id reachable, spread along the links until nothing changes.
_ROOTS = """
reached(id, root) AS (
  SELECT id, id FROM nodes
  UNION SELECT l.b, r.root FROM reached r JOIN links l ON r.id = l.a WHERE r.root < l.b
), rooted AS (SELECT id, min(root) AS component_id FROM reached GROUP BY id)
"""

OP3 = f"""
WITH RECURSIVE given AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (
  SELECT vec_id, v FROM given WHERE v IS NOT NULL AND list_bool_and(list_transform(v, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(v, lambda x: x <> 0))
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON len(x.v) = len(y.v) AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.v, y.v) >= 0.95
), nodes AS (SELECT vec_id AS id FROM given),
{_ROOTS}, counts AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept FROM rooted LEFT JOIN counts USING (id)
"""

# Sets that are alike share one of their rarest shingles; only such pairs are compared in full.
OP5 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS s
  FROM words
), sized AS (
  SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id) AS size, count(*) OVER (PARTITION BY s) AS docs FROM shingles
), ranked AS (
  SELECT doc_id, s, size, row_number() OVER (PARTITION BY doc_id ORDER BY docs, s) AS place FROM sized
), rare AS (SELECT doc_id, s, size FROM ranked WHERE place <= size - (80 * size + 99) // 100 + 1),
pairs AS (
  SELECT DISTINCT x.doc_id AS a, y.doc_id AS b, x.size AS m, y.size AS n FROM rare x JOIN rare y ON x.s = y.s AND x.doc_id < y.doc_id
  WHERE 100 * least(x.size, y.size) >= 80 * greatest(x.size, y.size)
), compared AS (
  SELECT a, b, m, n, count(*) AS common FROM pairs JOIN shingles x ON x.doc_id = a JOIN shingles y ON y.doc_id = b AND x.s = y.s GROUP BY ALL
), alike AS (SELECT a, b FROM compared WHERE 100 * common >= 80 * (m + n - common)),
links AS (SELECT a, b FROM alike UNION ALL SELECT b, a FROM alike),
nodes AS (SELECT doc_id AS id FROM documents),
{_ROOTS}, sizes AS (SELECT doc_id AS id, count(*) AS n FROM shingles GROUP BY doc_id)
SELECT id AS doc_id, coalesce(n, 0) AS n_shingles, component_id, id = component_id AS kept FROM rooted LEFT JOIN sizes USING (id)
"""

OP6 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), starts AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS pos FROM words WHERE len(ws) >= 20
), windows AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY array_to_string(ws[pos : pos + 19], ' ') ORDER BY doc_id, pos) AS nth FROM starts
), gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM windows WHERE nth > 1),
single AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS pos FROM words),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n FROM single ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op3_hnsw": OP3,
    "op5_near_text": OP5,
    "op6_passages": OP6,
    "op11_winnowing": OP11,
    "op12_spelling": OP12,
    "op13_phrases": OP13,
}
