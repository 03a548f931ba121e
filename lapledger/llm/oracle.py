"""The same results as plain SQL, where SQL can say them on small tables.

Texts are compared whole and every pair is looked at: this is what the operators must equal, not how they work.
"""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array({LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY 1),
runs AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_slice(w, i, i + k - 1))) AS p
  FROM worded, (VALUES (1), (2), (3), (4), (5)) lengths(k) WHERE len(w) >= k),
f AS (SELECT lang, k, p, CAST(count(*) AS BIGINT) AS f FROM runs GROUP BY ALL HAVING count(*) >= 100),
inner_ AS (
  SELECT lang, k, p, f, list_slice(p, 1, k - 1) AS first, list_slice(p, 2, k) AS rest FROM f WHERE k > 2),
dropped AS (
  SELECT DISTINCT s.lang, s.p FROM f s JOIN inner_ g ON s.lang = g.lang AND s.f = g.f AND (s.p = g.first OR s.p = g.rest)),
own AS (SELECT f.* FROM f LEFT JOIN dropped d ON f.lang = d.lang AND f.p = d.p WHERE d.p IS NULL AND f.k > 1),
cuts AS (
  SELECT o.lang, o.p, o.f AS a, a.f AS l, b.f AS r, t.n, c.c,
         CAST((CAST(1000 AS HUGEINT) * o.f * t.n) // (CAST(a.f AS HUGEINT) * b.f) AS BIGINT) AS score
  FROM own o JOIN (VALUES (1), (2), (3), (4)) c(c) ON c.c < o.k JOIN totals t ON t.lang = o.lang
  JOIN f a ON a.lang = o.lang AND a.p = list_slice(o.p, 1, c.c)
  JOIN f b ON b.lang = o.lang AND b.p = list_slice(o.p, c.c + 1, o.k)),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
  FROM scored)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000"""

TERMS = "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'"

RANKED = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, {TERMS}) AS t FROM documents),
sizes AS (SELECT doc_id, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0),
total AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
asked AS (
  SELECT item_id, term, CAST(count(*) AS BIGINT) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all({LOWER}, {TERMS})) AS term FROM benchmark) GROUP BY ALL),
tf AS (
  SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT doc_id, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY 1),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN sizes USING (doc_id), total GROUP BY 1, 2),
ranked AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""

CHAT = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) own(t, r)),
told AS (
  SELECT *, 2 * length(text) - length(replace(text, '\\', '')) + (length(text) - length(replace(text, '<|', ''))) // 2 AS escaped
  FROM said)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
       CAST(sum(12 + length(role) + 1 + escaped + 10 + 1) AS BIGINT) AS formatted_chars
FROM told GROUP BY 1"""

VECTORS = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
own AS (SELECT a, min(b) AS low FROM reached GROUP BY 1),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, CAST(least(vec_id, coalesce(low, vec_id)) AS BIGINT) AS component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN own ON own.a = vec_id LEFT JOIN counted ON counted.a = vec_id"""

WORDS = "'[^\\x20\\x09-\\x0D]+'"

NGRAMS = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, {WORDS}) AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
    ELSE list_transform(range(1, len(w) - 2), lambda i: list_slice(w, i, i + 3)) END) AS s FROM d),
sized AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
single AS (SELECT doc_id, md5(CAST(unnest(s) AS VARCHAR)) AS t FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM single a JOIN single b USING (t) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
own AS (SELECT a, min(b) AS low FROM reached GROUP BY 1)
SELECT doc_id, n AS n_shingles, CAST(least(doc_id, coalesce(low, doc_id)) AS BIGINT) AS component_id
FROM sized LEFT JOIN own ON own.a = doc_id"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d),
named AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 19), ' ')) AS run FROM starts),
windows AS (SELECT doc_id, i, row_number() OVER (PARTITION BY run ORDER BY doc_id, i) AS place FROM named),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM windows WHERE place > 1),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
stays AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM each ANTI JOIN covered USING (doc_id, i) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN stays USING (doc_id)"""

SQL = {
    "op2_ngram_join": NGRAMS,
    "op3_chat_formatting": CHAT,
    "op4_embedding_near_dedup": VECTORS,
    "op10_substring_dedup": SUBSTRINGS,
    "op12_collocations": COLLOCATIONS,
    "op13_ranked_search": RANKED,
}
