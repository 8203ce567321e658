"""DuckDB SQL for the queries of this package that SQL can express, written from the
definitions (row by row, all pairs) and not from the distributed plans."""

from __future__ import annotations

from . import langid, mixing

ORACLE: dict[str, str] = {}

ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def crc32(text: str) -> str:
    """crc32 of an ASCII text: bytes and, after each, eight shifts are folded over the register."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda ch: [ord(ch), -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform({steps}, lambda v: CAST(v AS BIGINT))), lambda c, v: "
            "CASE WHEN v >= 0 THEN xor(c, v) WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS BIGINT)) ELSE c // 2 END), "
            "CAST(4294967295 AS BIGINT))")


# --- op3: profiles, ranks and distances as relations
ORACLE["op3_language_id"] = f"""
WITH d AS (
  SELECT doc_id, lang, {crc32('CAST(doc_id AS VARCHAR)')} % 4 = 2 AS held_out,
         regexp_extract_all(lower(text), '\\p{{L}}+') AS words
  FROM documents),
w AS (SELECT doc_id, ' ' || word || ' ' AS p, n FROM (
  SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM d) GROUP BY doc_id, word)),
g AS (
  SELECT doc_id, substr(p, CAST(i AS INTEGER), CAST(k AS INTEGER)) AS gram, n
  FROM w, range(1, 4) ks(k), LATERAL (SELECT unnest(range(1, length(p) - k + 2)) AS i)
  WHERE substr(p, CAST(i AS INTEGER), CAST(k AS INTEGER)) <> ' '),
dg AS (SELECT doc_id, gram, sum(n) AS n FROM g GROUP BY doc_id, gram),
coded AS (
  SELECT doc_id, n, list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(gram, ''), lambda c: CAST(ord(c) AS BIGINT))),
                                lambda a, b: a * 2097152 + b) AS code FROM dg),
own AS (
  SELECT doc_id, code, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, code) - 1 AS r FROM coded
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, code) <= {langid.PROFILE}),
learned AS (
  SELECT lang, code, sum(n) AS n FROM coded JOIN d USING (doc_id) WHERE NOT held_out AND lang IS NOT NULL GROUP BY lang, code),
profile AS (
  SELECT lang, code, row_number() OVER (PARTITION BY lang ORDER BY n DESC, code) - 1 AS r FROM learned
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, code) <= {langid.PROFILE}),
langs AS (SELECT DISTINCT lang FROM profile),
dist AS (
  SELECT own.doc_id, langs.lang,
         CAST(sum(coalesce(abs(own.r - profile.r), {langid.PROFILE})) AS DOUBLE) / ({langid.PROFILE} * count(*)) AS x
  FROM own CROSS JOIN langs LEFT JOIN profile ON profile.lang = langs.lang AND profile.code = own.code
  GROUP BY own.doc_id, langs.lang),
best AS (
  SELECT doc_id, lang, x, lead(x) OVER (PARTITION BY doc_id ORDER BY x, lang) AS second,
         row_number() OVER (PARTITION BY doc_id ORDER BY x, lang) AS k FROM dist)
SELECT d.doc_id, d.held_out, coalesce(best.lang, 'und') AS lang_pred,
       CASE WHEN best.lang IS NULL THEN 0.0 WHEN second IS NULL THEN 1 - x WHEN second = 0 THEN 0.0
            ELSE 1 - x / second END AS score
FROM d LEFT JOIN best ON best.doc_id = d.doc_id AND best.k = 1"""

# --- op6: highest quotients listed outright, blocks taken one by one
_B, _P, _SEED = mixing.BLOCK_WORDS, mixing.SHARD_ROWS, mixing.SEED


def _hex8(x: str) -> str:
    return f"CAST('0x' || substr(md5({x}), 1, 8) AS BIGINT)"


ORACLE["op6_mixing"] = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5('{_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS okey,
         {_hex8(f"'{_SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')")} % greatest(1, CAST(ceil((SELECT count(*) FROM documents) / {_P}.0) AS BIGINT)) AS shard
  FROM documents),
src AS (
  SELECT skey, sum(size) AS source_size, (row_number() OVER (ORDER BY encode(skey)) - 1) % 3 + 1 AS weight FROM doc GROUP BY skey),
-- share the words, cap, share the excess of the capped again, until none is above
share(step, skey, weight, cap, fixed) AS (
  SELECT 0, skey, weight, 3.0::DOUBLE * source_size, false FROM src
  UNION ALL
  SELECT step + 1, skey, weight, cap, fixed OR weight * ((total - sum(CASE WHEN fixed THEN cap ELSE 0 END) OVER ()) /
         nullif(sum(CASE WHEN fixed THEN 0 ELSE weight END) OVER (), 0)) > cap
  FROM share, (SELECT CAST(sum(source_size) AS DOUBLE) AS total FROM src) WHERE step < (SELECT count(*) FROM src)),
target AS (
  SELECT skey, CASE WHEN fixed THEN cap ELSE weight * (((SELECT CAST(sum(source_size) AS DOUBLE) FROM src) - sum(CASE WHEN fixed THEN cap ELSE 0 END) OVER ()) /
         nullif(sum(CASE WHEN fixed THEN 0 ELSE weight END) OVER (), 0)) END AS target
  FROM share WHERE step = (SELECT max(step) FROM share)),
t AS (SELECT skey, CAST(source_size AS BIGINT) AS source_size, target FROM src JOIN target USING (skey)),
seats AS (SELECT CAST(round(sum(source_size) / {_B}.0) AS BIGINT) AS n FROM t),
quota AS (
  SELECT skey, count(*) AS q FROM (
    SELECT skey, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, skey, k) AS r
    FROM t, LATERAL (SELECT unnest(range(0, CAST(target / {_B} AS BIGINT) + 3)) AS k) WHERE target > 0) WHERE r <= (SELECT n FROM seats)
  GROUP BY skey),
shard AS (SELECT skey, shard, CAST(sum(size) AS BIGINT) AS z FROM doc GROUP BY skey, shard),
squota AS (
  SELECT skey, shard, count(*) AS q FROM (
    SELECT shard.skey, shard, q, row_number() OVER (PARTITION BY shard.skey ORDER BY CAST(z AS DOUBLE) / (2 * k + 1) DESC, shard, k) AS r
    FROM shard JOIN quota USING (skey), LATERAL (SELECT unnest(range(0, CAST(q + 1 AS BIGINT))) AS k) WHERE z > 0) WHERE r <= q
  GROUP BY skey, shard),
plan AS (
  SELECT shard.skey, shard.shard, nb, least(coalesce(q, 0), 3 * nb) AS q,
         {_hex8(f"'{_SEED}:' || shard.skey || '/' || CAST(shard.shard AS VARCHAR)")} % greatest(nb, 1) AS phase
  FROM (SELECT *, CAST(ceil(z / {_B}.0) AS BIGINT) AS nb FROM shard) shard LEFT JOIN squota USING (skey, shard)),
line AS (
  SELECT doc_id, skey, shard, size, CAST(sum(size) OVER (PARTITION BY skey, shard ORDER BY okey, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM doc),
laid AS (
  SELECT line.*, stop - size AS start, nb, CASE WHEN nb > 0 THEN q // nb ELSE 0 END AS passes, CASE WHEN nb > 0 THEN q % nb ELSE 0 END AS extra, phase
  FROM line JOIN plan USING (skey, shard))
SELECT doc_id, size, source_size, target,
       CAST(passes * size + coalesce(list_sum(list_transform(
         CASE WHEN size > 0 AND extra > 0 THEN list_filter(range(start // {_B}, (stop - 1) // {_B} + 1), lambda i: (i * extra + phase) % nb >= nb - extra) ELSE [] END,
         lambda i: least((i + 1) * {_B}, stop) - greatest(i * {_B}, start))), 0) AS BIGINT) AS taken
FROM laid JOIN t USING (skey)"""

# --- op9: every query against every row
ORACLE["op9_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""

# --- op10: all pairs that share a shingle, and reachability over the links
ORACLE["op10_ngram_join"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, text, regexp_extract_all(lower(text), '[^\\s]+') AS w FROM documents),
c AS (
  SELECT min(doc_id) AS rep, text, count(*) AS n_copies, first(w) AS w FROM d WHERE len(w) > 0 GROUP BY text),
sh AS (
  SELECT DISTINCT rep, array_to_string(w[CAST(i AS INTEGER):CAST(i + 4 AS INTEGER)], ' ') AS s
  FROM c, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 2))) AS i)),
n AS (SELECT rep, count(*) AS n FROM sh GROUP BY rep),
pairs AS (
  SELECT x.rep AS a, y.rep AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.rep <> y.rep GROUP BY x.rep, y.rep),
link AS (
  SELECT a, b FROM pairs JOIN n na ON na.rep = a JOIN n nb ON nb.rep = b WHERE k >= 0.8 * (na.n + nb.n - k)),
reach(a, b) AS (SELECT rep, rep FROM c UNION SELECT r.a, link.b FROM reach r JOIN link ON link.a = r.b),
root AS (SELECT a AS rep, min(b) AS class_id FROM reach GROUP BY a),
nl AS (SELECT a AS rep, count(*) AS n_links FROM link GROUP BY a)
SELECT d.doc_id, coalesce(root.class_id, d.doc_id) AS class_id, coalesce(c.rep, d.doc_id) AS text_id,
       CAST(coalesce(c.n_copies, 1) AS BIGINT) AS n_copies, CAST(coalesce(nl.n_links, 0) AS BIGINT) AS n_links
FROM d LEFT JOIN c ON c.text = d.text LEFT JOIN root ON root.rep = c.rep LEFT JOIN nl ON nl.rep = c.rep"""

# --- op11: every pair of documents over its common shingles
ORACLE["op11_minhash"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({ASCII_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w)-4, 1)+1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS c FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM both_ JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * both_.c >= 85 * (a.c + b.c - both_.c)),
r AS (SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.id WHERE r.root < e.y),
m AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT documents.doc_id, coalesce(n.c, 0)::BIGINT AS n_shingles, m.root AS component_id, documents.doc_id = m.root AS kept
FROM documents JOIN m ON m.id = documents.doc_id LEFT JOIN n ON n.doc_id = documents.doc_id"""


# --- op12: all phrases of 1 to 4 words, every cut, every part of a longer phrase
ORACLE["op12_collocations"] = rf"""
WITH pieces AS (
  SELECT coalesce(lang,'und') AS lang, row_number() OVER () AS did,
         unnest(regexp_split_to_array({ASCII_LOWER.format("coalesce(text, '')")}, '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents),
ws AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces),
ng AS (SELECT lang, k, array_to_string(w[i:i+k-1], ' ') AS phrase
       FROM (SELECT lang, w, k, unnest(range(1, len(w)-k+2)) AS i FROM ws, (SELECT unnest([1,2,3,4]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM ng GROUP BY ALL),
tot AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase,' ') AS w FROM f WHERE k >= 2 AND a >= 30),
cuts AS (SELECT c.lang, c.k, c.phrase, c.a, c.w, j, fl.a AS l, fr.a AS r, (2000000::HUGEINT * c.a) // (fl.a + fr.a) AS score
         FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
         JOIN f fl ON fl.lang = c.lang AND fl.phrase = array_to_string(c.w[1:c.j], ' ')
         JOIN f fr ON fr.lang = c.lang AND fr.phrase = array_to_string(c.w[c.j+1:c.k], ' ')),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS x FROM cuts) WHERE x = 1),
cov AS (SELECT lang, sub, max(a) AS f FROM (
          SELECT lang, a, array_to_string(w[i:i+m-1],' ') AS sub FROM (
            SELECT lang, a, w, k, m, unnest(range(1, k-m+2)) AS i FROM c, (SELECT unnest([2,3]) AS m) WHERE m < k)) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN cov ON cov.lang = best.lang AND cov.sub = best.phrase
         WHERE cov.f IS NULL OR 100 * cov.f < 80 * best.a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM (
  SELECT kept.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN tot USING (lang) WHERE rank <= 2000"""


# --- op13: every item against every document
ORACLE["op13_lexical_search"] = rf"""
WITH t AS (
  SELECT row_number() OVER () AS did, doc_id, regexp_extract_all({ASCII_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
d AS (SELECT did, doc_id, w, len(w)::BIGINT AS n FROM t WHERE len(w) > 0),
s AS (SELECT count(*)::BIGINT AS cn, sum(n)::BIGINT AS cl FROM d),
tf AS (SELECT did, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT did, doc_id, n, unnest(w) AS term FROM d) GROUP BY ALL),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({ASCII_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (SELECT term, floor(1000 * ln((2 * cn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY term, cn),
sc AS (SELECT item_id, did, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * cn) // cl))))::BIGINT AS score
       FROM q JOIN tf USING (term) JOIN w USING (term), s GROUP BY item_id, did, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0) WHERE rank <= 10"""
