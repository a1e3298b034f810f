"""DuckDB statements for the queries that SQL can express, read off the definitions of their rows."""

from __future__ import annotations

_SPACED = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERED = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS keep FROM p WHERE octet_length(encode(h)) >= 1000 GROUP BY h)
SELECT page_id, octet_length(encode(p.h))::BIGINT AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN keep IS NOT NULL AND page_id IS DISTINCT FROM keep THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keep THEN keep END AS refers_to
FROM p LEFT JOIN g ON p.h = g.h
"""

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_LETTERED.format("text")} AS w FROM documents),
b AS (SELECT cast(item_id AS VARCHAR) AS item, {_LETTERED.format("text")} AS w FROM benchmark),
sized AS (SELECT item, w, least(10, len(w)) AS m FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS s
            FROM (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM sized)),
lengths AS (SELECT DISTINCT m FROM windows),
places AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
           FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lengths)),
hits AS (SELECT doc_id, i, m, item FROM places JOIN windows USING (m, s)),
words AS (SELECT doc_id, count(DISTINCT k) AS n
          FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, words.n IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SUFFIXES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS s
            FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM d)),
again AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
hits AS (SELECT doc_id, i, i - lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) > 200 AS new FROM windows SEMI JOIN again USING (s)),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b
         FROM (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hits) GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM runs),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head,
                max(b) AS stop, sum(b - a)::BIGINT AS removed, count(*) AS spans
         FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(stop, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED.format(_LOWER.format("text"))} AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
             FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
          FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
          WHERE 100 * o >= 85 * (x.n + y.n - o)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least_id AS component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS least_id FROM reach GROUP BY a) USING (doc_id)
"""

SUBSTRINGS = f"""
WITH d AS (SELECT doc_id, {_SPACED.format("text")} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
again AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS k FROM windows SEMI JOIN again USING (s)),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

SHARD = """
WITH crc_table AS (
    SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                ORDER BY n) AS t FROM range(256) r(n)),
d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
sized AS (
    SELECT doc_id, octet_length(b)::BIGINT + 1 AS size, xor(list_reduce(
               list_prepend(4294967295, list_transform(regexp_extract_all(hex(b), '..'), lambda x: ('0x' || x)::BIGINT)),
               lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
    FROM d, crc_table),
scores AS (
    SELECT doc_id, shard, -1 / ln((('0x' || substr(md5(doc_id || '#' || shard), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656) AS score
    FROM (SELECT DISTINCT doc_id FROM d), range(17) r(shard)),
best AS (
    SELECT doc_id, (arg_max(shard, score) FILTER (WHERE shard < 16))::INT AS shard, arg_max(shard, score)::INT AS grown_shard
    FROM scores GROUP BY doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, size, text_crc32) - 1 AS slot
FROM sized JOIN best USING (doc_id)
"""

# CRC-32 of the decimal digits of a number, byte by byte over a table of 256 remainders.
_CRC_TABLE = """
crc_table AS (
    SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                ORDER BY n) AS t FROM range(256) r(n))"""
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
               lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)"""

# Equal words at each distance of up to a quarter of the text; places on end without a gap are one stretch.
SQUARES = f"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, {_SPACED.format("text")} AS w, {_CRC.format("doc_id")} AS h FROM documents, crc_table),
planted AS (SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS again, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS k FROM d),
words AS (SELECT doc_id, n, CASE WHEN again THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // k) END]) ELSE w END AS w
          FROM planted),
placed AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(0, n)) AS i FROM words),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM placed x JOIN placed y
          ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
numbered AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch FROM pairs),
stretches AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM numbered GROUP BY doc_id, q, stretch
              HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS r FROM runs),
listed AS (SELECT doc_id, count(*) AS n, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS s FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS s FROM placed ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(listed.n, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length, best.period::BIGINT AS period,
       (1000 * best.length // best.period)::BIGINT AS exponent_milli, sha256(coalesce(listed.s, '')) AS runs_sha256, sha256(coalesce(kept.s, '')) AS collapsed_sha256
FROM d LEFT JOIN listed USING (doc_id) LEFT JOIN (SELECT * FROM best WHERE r = 1) best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

# Every prefix of every conversation by its text; a subtree is what names the node among its own prefixes.
PREFIX_TRIE = f"""
WITH {_CRC_TABLE},
own AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS w
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT conv_id, w, {_CRC.format("conv_id")} % 9 AS h FROM own, crc_table),
c AS (SELECT heads.conv_id, list_concat(coalesce(own.w[1:h], []), heads.w[h + 1:]) AS w
      FROM heads LEFT JOIN own ON own.conv_id = heads.conv_id - heads.conv_id % 5),
prefixes AS (SELECT conv_id, len(w) AS n, d, w[1:d] AS w, sha256(to_json(w[1:d])::VARCHAR) AS k, CASE WHEN d > 0 THEN sha256(to_json(w[1:d - 1])::VARCHAR) END AS up
             FROM (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS d FROM c)),
nodes AS (SELECT k, any_value(up) AS up, any_value(d) AS d, any_value(w) AS w, min(conv_id) AS conv_id, count(*) AS n_convs,
                 coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '') AS ends
          FROM prefixes GROUP BY k),
children AS (SELECT up AS k, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
below AS (SELECT sha256(to_json(w[1:j])::VARCHAR) AS k, n IS NULL AS leaf, CASE WHEN d > 0 THEN (n_convs - 1) * octet_length(encode(w[d].text)) ELSE 0 END AS saved
          FROM (SELECT w, d, n_convs, children.n, unnest(range(0, d + 1)) AS j FROM nodes LEFT JOIN children USING (k))),
sums AS (SELECT k, sum(leaf::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM below GROUP BY k)
SELECT nodes.conv_id, nodes.d::BIGINT AS depth, parents.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0)::BIGINT AS n_children,
       n_leaves, saved_tokens, sha256(nodes.ends) AS ends_sha256
FROM nodes LEFT JOIN nodes parents ON nodes.up = parents.k LEFT JOIN children ON children.k = nodes.k JOIN sums ON sums.k = nodes.k
"""
