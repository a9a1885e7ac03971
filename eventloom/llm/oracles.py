"""DuckDB SQL of the operators that SQL can express on whole tables: the definitions, without the operators' candidate search."""

from __future__ import annotations

from . import decontam, license_scan, line_dedup

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "list_filter(regexp_split_to_array({0}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

JACCARD = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
p AS (SELECT a, b FROM o JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a AS x, b AS y FROM p UNION ALL SELECT b, a FROM p),
reach(v, r) AS (SELECT x, x FROM e UNION SELECT reach.v, e.y FROM reach JOIN e ON reach.r = e.x),
c AS (SELECT v, min(r) AS component_id FROM reach GROUP BY 1), k AS (SELECT x AS v, count(*) AS n_links FROM e GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id, coalesce(n_links, 0) AS n_links FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON w.doc_id = c.v LEFT JOIN k ON w.doc_id = k.v"""

# a line lies in a repeated run if it lies in a shortest one that begins at a line or ends at one
LINES = f"""WITH l AS (SELECT doc_id, i - 1 AS li, ls[i] AS line, trim(translate(ls[i], chr(9) || chr(13) || chr(12) || chr(11), '    ')) AS bare FROM (SELECT doc_id, string_split(text, chr(10)) AS ls, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)),
q AS (SELECT doc_id, li, line, len(regexp_split_to_array(bare, '[\\x20\\x09-\\x0D]+')) AS nw, row_number() OVER (PARTITION BY doc_id ORDER BY li) AS seq FROM l WHERE bare <> ''),
u AS (SELECT *, sum(nw) OVER (PARTITION BY doc_id ORDER BY seq) AS upto FROM q),
f AS (SELECT a.doc_id, a.seq AS lo, min(b.seq) AS hi FROM u a JOIN u b ON a.doc_id = b.doc_id AND b.seq >= a.seq AND b.upto - a.upto + a.nw >= {line_dedup.MIN_WORDS} GROUP BY 1, 2),
t AS (SELECT b.doc_id, max(a.seq) AS lo, b.seq AS hi FROM u a JOIN u b ON a.doc_id = b.doc_id AND b.seq >= a.seq AND b.upto - a.upto + a.nw >= {line_dedup.MIN_WORDS} GROUP BY 1, 3),
p AS (SELECT * FROM f UNION SELECT * FROM t),
k AS (SELECT p.doc_id, lo, hi, string_agg(line, chr(10) ORDER BY seq) AS key FROM p JOIN u ON p.doc_id = u.doc_id AND seq BETWEEN lo AND hi GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id, lo) AS rn FROM k),
g AS (SELECT DISTINCT u.doc_id, seq, li FROM r JOIN u ON r.doc_id = u.doc_id AND seq BETWEEN lo AND hi WHERE rn > 1),
h AS (SELECT doc_id, list(li ORDER BY li) AS removed FROM g GROUP BY 1),
i AS (SELECT doc_id, min(li) AS first, count(*) AS lines FROM (SELECT *, seq - row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS island FROM g) GROUP BY doc_id, island),
j AS (SELECT doc_id, string_agg(first || '+' || lines, ' ' ORDER BY first) AS runs FROM i GROUP BY 1)
SELECT d.doc_id, CASE WHEN removed IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(len(string_split(text, chr(10)))), lambda x: NOT list_contains(removed, x)), lambda x: string_split(text, chr(10))[x + 1]), chr(10)) END AS text,
  coalesce(len(removed), 0) AS n_removed, array_to_string(removed, ' ') AS removed, runs FROM documents d LEFT JOIN h USING (doc_id) LEFT JOIN j USING (doc_id)"""


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def licenses() -> str:
    """Containment of every notice's shingles in every window of its class."""
    words = "list_filter(list_transform(regexp_split_to_array(lower({0}), '\\s+'), lambda x: regexp_replace(x, '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g')), lambda x: x <> '')"
    grams = "list_distinct(list_transform(range(1, greatest(len({0}) - {1} + 1, 1) + 1), lambda i: array_to_string({0}[i : i + {1} - 1], ' ')))"
    rows = ", ".join(f"({_quoted(k)}, {_quoted(t)})" for k, t in dict.fromkeys(license_scan.NOTICES))
    spans, span = [], license_scan.SMALLEST_SPAN
    while len(spans) < 12:
        spans.append(span)
        span = -int(-span * license_scan.GROWTH // 1)
    of = "CASE " + " ".join(f"WHEN n <= {s} THEN {s}" for s in spans) + " END"
    return f"""WITH t AS (SELECT *, {of} AS span, least(n, {license_scan.SHINGLE}) AS size FROM (SELECT license_id, ws, len(ws) AS n FROM (SELECT license_id, {words.format('notice')} AS ws FROM (VALUES {rows}) v(license_id, notice)))),
g AS (SELECT license_id, span, size, {grams.format('ws', 'size')} AS ts FROM t),
d AS (SELECT doc_id, {words.format('text')} AS ws FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, span, ws, unnest(range(greatest(CAST(ceil(len(ws) / span) AS BIGINT) - 1, 1))) * span AS first_word FROM d CROSS JOIN (SELECT DISTINCT span FROM t) WHERE len(ws) > 0),
w AS (SELECT doc_id, span, first_word, ws[first_word + 1 : first_word + 2 * span] AS ww FROM c),
x AS (SELECT doc_id, span, first_word, size, {grams.format('ww', 'size')} AS sh FROM w JOIN (SELECT DISTINCT span, size FROM t) USING (span)),
y AS (SELECT doc_id, license_id, span, first_word, len(list_intersect(ts, sh)) / len(ts) AS containment FROM x JOIN g USING (span, size)),
z AS (SELECT * FROM y WHERE containment >= {license_scan.CONTAINED}),
n AS (SELECT doc_id, license_id, count(DISTINCT (span, first_word)) AS n_windows FROM z GROUP BY 1, 2)
SELECT doc_id, license_id, containment, first_word, n_windows FROM z JOIN n USING (doc_id, license_id) QUALIFY row_number() OVER (PARTITION BY doc_id, license_id ORDER BY containment DESC, first_word) = 1"""


def leaks() -> str:
    """The best span of every item in every document that shares a shingle with it, by weighted Jaccard."""
    words = "list_filter(string_split(regexp_replace(lower({0}), '[\\x00-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7f]+', ' ', 'g'), ' '), lambda x: x <> '')"
    k = decontam.SHINGLE
    return f"""WITH i0 AS (SELECT item_id, {words.format('text')} AS ws FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL), i1 AS (SELECT DISTINCT item_id, ws, len(ws) AS n, least(len(ws), {k}) AS k FROM i0 WHERE len(ws) > 0),
ig AS (SELECT item_id, n, k, g, count(*) AS m FROM (SELECT item_id, n, k, array_to_string(ws[i : i + k - 1], ' ') AS g FROM (SELECT *, unnest(range(1, n - k + 2)) AS i FROM i1)) GROUP BY ALL),
d0 AS (SELECT doc_id, {words.format('text')} AS ws FROM documents WHERE text IS NOT NULL), d1 AS (SELECT doc_id, k, i - 1 AS pos, array_to_string(ws[i : i + k - 1], ' ') AS g, len(ws) AS size FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d0 CROSS JOIN (SELECT DISTINCT k FROM i1) WHERE len(ws) >= k)),
h AS (SELECT doc_id, item_id, n, k, m, size, pos, g FROM d1 JOIN ig USING (k, g)),
st AS (SELECT DISTINCT doc_id, item_id, n, k, size, unnest(range(pos - n + k, pos + 1)) AS s FROM h),
b AS (SELECT st.doc_id, st.item_id, st.n, st.k, st.size, s, h.g, least(count(*), any_value(h.m)) AS hit FROM st JOIN h ON st.doc_id = h.doc_id AND st.item_id = h.item_id AND h.pos >= greatest(s, 0) AND h.pos <= least(s + st.n, st.size) - st.k GROUP BY ALL),
c AS (SELECT doc_id, item_id, n, s, sum(hit) AS hit, (n - k + 1) + greatest(0, least(s + n, size) - k + 1 - greatest(s, 0)) - sum(hit) AS total FROM b GROUP BY doc_id, item_id, n, k, size, s)
SELECT doc_id, item_id, hit / total AS similarity, greatest(s, 0) AS start_word, n AS n_words FROM c WHERE hit / total >= {decontam.THRESHOLD} QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY hit / total DESC, greatest(s, 0)) = 1"""


#: Unsigned crc32 of a decimal number's text, bit by bit.
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295)"

_LEAF = "sha256(" + " || ".join(f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "{0}", "text")) + ")"

# all levels of each group's tree and of the tree over the groups; then every leaf climbs with its siblings
MERKLE = f"""WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {_LEAF.format('n_chars')} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND {_CRC.format('coalesce(doc_id, 0)')} % 7 = 0 THEN {_LEAF.format('(n_chars + 1)')} ELSE {_LEAF.format('n_chars')} END AS now FROM documents),
e AS (SELECT *, row_number() OVER () AS rid, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
nodes(g, l, pos, h, n) AS (SELECT g, 0, pos, leaf, n FROM e UNION ALL SELECT g, l + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM nodes WHERE n > 1 GROUP BY g, l, pos // 2, n),
roots AS (SELECT g, h AS subroot, l AS high, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(l, pos, h, n) AS (SELECT 0, pos, subroot, n FROM roots UNION ALL SELECT l + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM tops WHERE n > 1 GROUP BY l, pos // 2, n),
root AS (SELECT h AS root, l AS high FROM tops WHERE n = 1),
f(rid, l, h, proof) AS (SELECT rid, 0, now, '' FROM e UNION ALL
  SELECT f.rid, f.l + 1, sha256(CASE WHEN coalesce(a.h, b.h) IS NULL THEN f.h WHEN ((CASE WHEN f.l < r.high THEN e.pos >> f.l ELSE r.pos >> (f.l - r.high) END) & 1) = 1 THEN coalesce(a.h, b.h) || f.h ELSE f.h || coalesce(a.h, b.h) END),
    f.proof || coalesce(a.h, b.h, '')
  FROM f JOIN e ON f.rid = e.rid JOIN roots r ON e.g = r.g CROSS JOIN root
  LEFT JOIN nodes a ON f.l < r.high AND a.g = e.g AND a.l = f.l AND a.pos = xor(e.pos >> f.l, 1)
  LEFT JOIN tops b ON f.l >= r.high AND b.l = f.l - r.high AND b.pos = xor(r.pos >> greatest(f.l - r.high, 0), 1)
  WHERE f.l < r.high + root.high)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM e JOIN roots r ON e.g = r.g CROSS JOIN root JOIN f ON f.rid = e.rid AND f.l = r.high + root.high"""


# every place of every rebuilt conversation is named by its digests so far; totals are sums over pairs of node and ancestor
TRIE = f"""WITH RECURSIVE t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
cs AS (SELECT c, n, c - c % 5 AS first, {_CRC.format('c')} % 9 AS h FROM (SELECT c, count(*) AS n FROM t GROUP BY 1)),
rb AS (SELECT cs.c, pos + 1 AS depth, role, text FROM cs JOIN t ON t.c = cs.first AND pos < h UNION ALL
  SELECT cs.c, least(cs.h, coalesce(f.n, 0)) + pos - cs.h + 1, role, text FROM cs JOIN t ON t.c = cs.c AND pos >= cs.h LEFT JOIN cs f ON f.c = cs.first),
pl AS (SELECT c, depth, octet_length(encode(text)) AS size, string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY c ORDER BY depth ROWS UNBOUNDED PRECEDING) AS nm FROM rb
  UNION ALL SELECT c, 0, 0, '' FROM cs),
w AS (SELECT *, lag(nm) OVER (PARTITION BY c ORDER BY depth) AS up, max(depth) OVER (PARTITION BY c) AS length FROM pl),
n AS (SELECT nm, depth, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (depth = length), '') AS ends FROM w GROUP BY 1, 2),
k AS (SELECT up, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.up = n.nm),
anc(nm, top) AS (SELECT nm, nm FROM n UNION ALL SELECT anc.nm, n.up FROM anc JOIN n ON n.nm = anc.top WHERE n.up IS NOT NULL),
s AS (SELECT top, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * size) AS saved_tokens FROM anc JOIN m USING (nm) GROUP BY 1)
SELECT m.conv_id, m.depth, p.conv_id AS parent_conv_id, m.n_convs, m.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN s ON s.top = m.nm LEFT JOIN n p ON p.nm = m.up"""


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {"op1_decontaminate": leaks(), "op4_license_scan": licenses(), "op5_ngram_jaccard": JACCARD, "op8_line_dedup": LINES, "op12_merkle_manifest": MERKLE, "op13_prefix_trie": TRIE}
