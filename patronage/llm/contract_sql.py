"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

#: unsigned CRC-32 of an ASCII text: per byte one step that takes it in, and eight that shift
CRC = """list_reduce(list_concat([4294967295], flatten(list_transform(range(1, length({0}) + 1),
    lambda i: [ascii({0}[i]), 0, 0, 0, 0, 0, 0, 0]))), lambda c, x: (xor(c, x) // 2).xor(3988292384 * (xor(c, x) & 1))).xor(4294967295)"""

_VALUE = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_VALUE.format(c) for c in ("doc_id", "source", "lang", "{0}", "text")) + ")"

MERKLE = f"""
WITH RECURSIVE rows_ AS (
    SELECT doc_id, coalesce('1' || lang, '0') AS g, {_LEAF.format("n_chars")} AS leaf,
           CASE WHEN {CRC.format("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_LEAF.format("(n_chars + 1)")} ELSE {_LEAF.format("n_chars")} END AS other
    FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY g) AS n FROM rows_),
inner_ AS (
    SELECT 0 AS lvl, g, place, n, leaf AS h FROM leaves
    UNION ALL
    SELECT lvl + 1, g, place // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM inner_ WHERE n > 1 GROUP BY lvl, g, place // 2, n),
subroots AS (SELECT g, h, lvl, row_number() OVER (ORDER BY g) - 1 AS place, count(*) OVER () AS n FROM inner_ WHERE n = 1),
outer_ AS (
    SELECT 0 AS lvl, place, n, h FROM subroots
    UNION ALL
    SELECT lvl + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM outer_ WHERE n > 1 GROUP BY lvl, place // 2, n),
nodes AS (
    SELECT lvl, g, place, h FROM inner_
    UNION ALL SELECT s.lvl + o.lvl, s.g, o.place, o.h FROM subroots s, outer_ o WHERE o.n > 1),
heights AS (SELECT s.g, s.lvl AS inner_height, s.lvl + (SELECT max(lvl) FROM outer_) AS height, s.place, s.h FROM subroots s),
steps AS (
    SELECT l.g, l.place AS leaf_place, t.lvl, ((CASE WHEN t.lvl < h.inner_height THEN l.place // (1 << t.lvl) ELSE h.place // (1 << (t.lvl - h.inner_height)) END)) AS at
    FROM leaves l JOIN heights h USING (g), LATERAL (SELECT unnest(range(0, h.height)) AS lvl) t),
siblings AS (
    SELECT s.g, s.leaf_place, s.lvl, s.at, n.h FROM steps s
    LEFT JOIN (SELECT n.* FROM nodes n JOIN heights h USING (g) WHERE n.lvl <> h.inner_height OR h.inner_height = h.height
               UNION ALL SELECT h.inner_height, h.g, o.place, o.h FROM heights h, outer_ o WHERE o.lvl = 0 AND h.inner_height < h.height) n
    ON n.g = s.g AND n.lvl = s.lvl AND n.place = xor(s.at, 1)),
proofs AS (SELECT g, leaf_place, sha256(coalesce(string_agg(h, '' ORDER BY lvl), '')) AS proof FROM siblings GROUP BY g, leaf_place),
fold AS (
    SELECT g, place, 0 AS lvl, other AS h FROM leaves
    UNION ALL
    SELECT f.g, f.place, f.lvl + 1, sha256(CASE WHEN s.at % 2 = 0 THEN f.h || coalesce(s.h, '') ELSE coalesce(s.h, '') || f.h END)
    FROM fold f JOIN siblings s ON s.g = f.g AND s.leaf_place = f.place AND s.lvl = f.lvl),
root AS (SELECT h AS root FROM outer_ WHERE n = 1)
SELECT l.doc_id, l.leaf, t.h AS subroot, r.root, coalesce(p.proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = r.root AS verified
FROM leaves l JOIN heights t USING (g) JOIN fold f ON f.g = l.g AND f.place = l.place AND f.lvl = t.height CROSS JOIN root r
LEFT JOIN proofs p ON p.g = l.g AND p.leaf_place = l.place
"""

WARC = """
SELECT page_id, payload_bytes, payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN revisit THEN least_page END AS refers_to
FROM (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest,
             min(page_id) OVER (PARTITION BY body) AS least_page,
             strlen(body) >= 100 AND page_id <> min(page_id) OVER (PARTITION BY body) AS revisit
      FROM (SELECT page_id, coalesce(html, '') AS body FROM pages))
"""

ODD_SKETCHES = """
WITH RECURSIVE texts AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
shingles AS (
    SELECT doc_id, unnest(list_distinct(CASE len(w) WHEN 0 THEN [] WHEN 1 THEN w
                                        ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS s
    FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
                      GROUP BY a.doc_id, b.doc_id)
    JOIN sizes m ON m.doc_id = x JOIN sizes o ON o.doc_id = y WHERE 100 * shared >= 80 * (m.n + o.n - shared)),
reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT r.doc_id, l.y FROM reached r JOIN links l ON l.x = r.other),
components AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN components USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

_FILLED = {"-": "u", "s": "u", "u": "a", "a": "u"}
_KEPT = {("-", "s"): "s", ("-", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
#: edits that use up a row: state, initial, whether the row must go, letter, state after, cost, whether truncation adds to it
_MOVES = ", ".join(f"('{q}', '{c}', {gone}, '{letter}', '{after}', {cost}, {adds})" for q in _FILLED for c in "suao" for gone in ("TRUE", "FALSE")
                   for letter, after, cost, adds in (("D", q, 3, 0), ("K", _KEPT.get((q, c)), 0, 1), ("R", _FILLED[q], 2, 1))
                   if after and (letter == "D" or gone == "FALSE"))
_INSERTS = ", ".join(f"('{q}', '{after}', '{'I' * n}', {2 * n})" for q in _FILLED
                     for n, after in enumerate((q, _FILLED[q], _FILLED[_FILLED[q]])))
_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

CONVERSATION_REPAIR = f"""
WITH RECURSIVE moves(q, c, gone, letter, after, cost, adds) AS (VALUES {_MOVES}), inserts(q, after, letters, cost) AS (VALUES {_INSERTS}),
faults AS (
    SELECT *, {CRC.format("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS f FROM conversations),
damaged AS (
    SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
           CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
           unnest(CASE WHEN f = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM faults WHERE f <> 0),
marked AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substr(sha256(text), 1, 32), copy) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
           rtrim(text, {_SPACES}) AS body, CASE WHEN substr(role, 1, 1) IN ('s', 'u', 'a') THEN substr(role, 1, 1) ELSE 'o' END AS c
    FROM damaged),
rows_ AS (
    SELECT *, body = '' AS blank, body <> '' AND nth > 1 AS duplicate, body = '' OR nth > 1 AS gone,
           CASE WHEN right(body, 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS cut, lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS pair
    FROM marked),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
           count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE NOT gone AND cut = 1) AS truncated,
           count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS last
    FROM rows_ GROUP BY conv_id),
best AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, n.after AS q, printf('%012d', n.cost) || n.letters AS v FROM counts JOIN inserts n ON n.q = '-'
    UNION ALL
    SELECT conv_id, i, q, min(v) FROM (
        SELECT b.conv_id, r.i, n.after AS q,
               printf('%012d', CAST(substr(b.v, 1, 12) AS BIGINT) + m.cost + m.adds * r.cut + n.cost) || substr(b.v, 13) || m.letter || n.letters AS v
        FROM best b JOIN rows_ r ON r.conv_id = b.conv_id AND r.i = b.i + 1 JOIN moves m ON m.q = b.q AND m.c = r.c AND m.gone = r.gone
        JOIN inserts n ON n.q = m.after) GROUP BY conv_id, i, q),
cheapest AS (
    SELECT b.conv_id, CAST(substr(min(v), 1, 12) AS BIGINT) AS cost, substr(min(v), 13) AS audit
    FROM best b JOIN counts c ON c.conv_id = b.conv_id AND c.last = b.i WHERE q IN ('-', 'a') GROUP BY b.conv_id),
letters AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM cheapest),
edits AS (
    SELECT conv_id, audit[p] AS letter, length(replace(audit[1:p], 'I', '')) AS i, length(replace(audit[1:p], 'D', '')) AS place FROM letters),
kept AS (
    SELECT e.conv_id, e.letter, e.place, r.role, r.text, r.c,
           max(CASE WHEN e.place = 1 AND e.letter = 'K' AND r.c = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS ahead
    FROM edits e LEFT JOIN rows_ r ON r.conv_id = e.conv_id AND r.i = e.i AND e.letter <> 'I' WHERE e.letter <> 'D'),
digests AS (
    SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - ahead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
                                      || coalesce(text, ''), chr(10) ORDER BY place)) AS digest
    FROM kept GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counts USING (conv_id) LEFT JOIN cheapest USING (conv_id) LEFT JOIN digests USING (conv_id)
"""
