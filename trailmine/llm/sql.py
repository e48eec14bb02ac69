"""The corpus queries in SQL, where SQL can express them."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_BLANK_WORDS} AS ws FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) >= 2 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])
        ELSE ws END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
m AS (SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.y, w.doc_id)) AS component_id,
       w.doc_id <= coalesce(m.y, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.x = w.doc_id"""

OP3 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id, ws, least(10, len(ws)) AS size FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
p AS (SELECT DISTINCT item_id, size, array_to_string(ws[k:k + size - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS k FROM b)),
z AS (SELECT DISTINCT size FROM p),
v AS (SELECT doc_id, size, k, array_to_string(ws[k:k + size - 1], ' ') AS win
      FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS k FROM d CROSS JOIN z WHERE len(ws) >= size)),
h AS (SELECT doc_id, size, k, item_id FROM v JOIN p USING (size, win)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS place FROM h) GROUP BY doc_id),
its AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM h GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""

OP6 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, min(v) AS q FROM v WHERE vec_id % 20 = 0 GROUP BY vec_id),
s AS (SELECT query_id, vec_id, list_sum(list_transform(range(1, least(len(v), len(q)) + 1), lambda i: v[i] * q[i]))::BIGINT AS score
      FROM q JOIN v ON vec_id <> query_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20"""

_SIGNS = r"^((?:[ \t]?>)+)"
_NORMAL = r"trim(regexp_replace(lower({}), '[ \t\r\n\f]+', ' ', 'g'), ' ')"
OP7 = rf"""
WITH RECURSIVE m AS (SELECT row_number() OVER () AS id, * FROM conversations),
t AS (SELECT id, conv_id, turn, unnest(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10))) AS line,
             generate_subscripts(string_split(regexp_replace(text, '\r\n?', chr(10), 'g'), chr(10)), 1) AS k FROM m),
l AS (SELECT id, conv_id, turn, k, len(regexp_replace(regexp_extract(line, '{_SIGNS}', 1), '[^>]', '', 'g')) AS level,
             regexp_replace(line, '{_SIGNS}[ ]?', '') AS line,
             regexp_matches(line, '^[ \t]*(On|Am|Le|El)\b.*(wrote|schrieb|écrit|escribió)[ \t]*:[ \t]*$') AS said FROM t),
f AS (SELECT *, said AND level = 0 AND coalesce(lead(level) OVER (PARTITION BY id ORDER BY k), 0) > 0 AS gone FROM l),
g AS (SELECT *, CASE WHEN level IS DISTINCT FROM lag(level) OVER (PARTITION BY id ORDER BY k) THEN 1 ELSE 0 END AS starts FROM f WHERE NOT gone),
i AS (SELECT *, sum(starts) OVER (PARTITION BY id ORDER BY k) AS part FROM g),
p AS (SELECT id, conv_id, turn, part, level, string_agg(line, chr(10) ORDER BY k) AS body FROM i GROUP BY id, conv_id, turn, part, level),
own AS (SELECT id, count(*) FILTER (level > 0) AS n_quotes, coalesce(string_agg(body, chr(10) ORDER BY part) FILTER (level = 0), '') AS body FROM p GROUP BY id),
o AS (SELECT m.*, coalesce(n_quotes, 0) AS n_quotes,
             CASE WHEN n_quotes > 0 THEN regexp_replace(regexp_replace(body, '\n{{3,}}', chr(10) || chr(10), 'g'), '^\n+|\n+$', '', 'g') ELSE text END AS own
      FROM m LEFT JOIN own USING (id)),
u AS (SELECT id, conv_id, turn, level, 1 AS rank, body FROM p
      UNION ALL SELECT * FROM (SELECT id, conv_id, turn, level, 2 AS rank, unnest(string_split(body, chr(10))) AS body FROM p)
                WHERE len(string_split({_NORMAL.format('body')}, ' ')) >= 3
      UNION ALL SELECT id, conv_id, turn, 0, 1, own FROM o WHERE own IS NOT NULL),
d AS (SELECT *, sha256({_NORMAL.format('body')}) AS digest FROM u
      WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND {_NORMAL.format('body')} <> ''),
first AS (SELECT conv_id, digest, min(turn) AS said_at FROM d WHERE level = 0 GROUP BY conv_id, digest),
links AS (SELECT conv_id, turn, arg_max(said_at, said_at - 1000000000 * rank) AS parent_turn
          FROM d JOIN first USING (conv_id, digest) WHERE level = 1 AND said_at < turn GROUP BY conv_id, turn),
back AS (SELECT conv_id, turn, parent_turn AS root_turn, 1 AS depth FROM links
         UNION ALL SELECT b.conv_id, b.turn, l.parent_turn, b.depth + 1 FROM back b JOIN links l ON l.conv_id = b.conv_id AND l.turn = b.root_turn),
roots AS (SELECT conv_id, turn, min(root_turn) AS root_turn, max(depth) AS depth FROM back GROUP BY conv_id, turn)
SELECT o.conv_id, o.turn, o.role, o.own AS text, parent_turn, coalesce(root_turn, o.turn) AS root_turn, coalesce(depth, 0)::INTEGER AS depth,
       n_quotes::INTEGER AS n_quotes
FROM o LEFT JOIN links USING (conv_id, turn) LEFT JOIN roots USING (conv_id, turn)"""

_PLAIN = "trim(regexp_replace(lower({}), '\\s+', ' ', 'g'), ' ')"
_MARK = "chr(57344)"  # of the private use area; behind each unit
_LINE = "PARTITION BY doc_id, line ORDER BY k ROWS BETWEEN"
_FIRST = "CASE " + " ".join(f"WHEN list_sum({{0}}[1:{k + 1}]) >= 5 THEN {k}" for k in range(5)) + " END"
OP10 = f"""
WITH u AS (SELECT doc_id, string_split(regexp_replace(text, '\\n', chr(10) || {_MARK}, 'g'), {_MARK}) AS us FROM documents WHERE text IS NOT NULL),
ln AS (SELECT doc_id, unnest(us) AS body, generate_subscripts(us, 1) AS line FROM u),
sp AS (SELECT doc_id, line, string_split(regexp_replace(regexp_replace(body, '([.!?][ \\t]+)', '\\1' || {_MARK}, 'g'), {_MARK} || '\\n$', chr(10)), {_MARK}) AS ps
       FROM ln WHERE body <> ''),
pc AS (SELECT doc_id, line, unnest(ps) AS piece, generate_subscripts(ps, 1) AS j FROM sp),
p AS MATERIALIZED (SELECT *, {_PLAIN.format('piece')} AS plain, row_number() OVER (PARTITION BY doc_id ORDER BY line, j) AS k,
      coalesce(sum(len(piece)) OVER (PARTITION BY doc_id ORDER BY line, j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM pc WHERE piece <> ''),
n AS (SELECT *, CASE WHEN plain = '' THEN 0 ELSE len(string_split(plain, ' ')) END AS nw FROM p),
c AS (SELECT *, list(plain) OVER ({_LINE} CURRENT ROW AND 4 FOLLOWING) AS fp, list(nw) OVER ({_LINE} CURRENT ROW AND 4 FOLLOWING) AS fn,
      list_reverse(list(plain) OVER ({_LINE} 4 PRECEDING AND CURRENT ROW)) AS bp, list_reverse(list(nw) OVER ({_LINE} 4 PRECEDING AND CURRENT ROW)) AS bn,
      list_reverse(list(start) OVER ({_LINE} 4 PRECEDING AND CURRENT ROW)) AS bs FROM n),
e AS (SELECT *, {_FIRST.format('fn')} AS f, {_FIRST.format('bn')} AS b FROM c),
whole AS (SELECT doc_id, line, trim(regexp_replace(string_agg(plain, ' ' ORDER BY k), ' +', ' ', 'g'), ' ') AS plain, min(start) AS place FROM p GROUP BY doc_id, line),
h AS (SELECT doc_id, k, w.plain, place FROM p JOIN whole w USING (doc_id, line) WHERE w.plain <> ''
      UNION ALL SELECT doc_id, k, trim(array_to_string(fp[1:f + 1], ' '), ' '), start FROM e WHERE nw > 0 AND f IS NOT NULL
      UNION ALL SELECT doc_id, k, trim(array_to_string(list_reverse(bp[1:b + 1]), ' '), ' '), bs[b + 1] FROM e WHERE nw > 0 AND b IS NOT NULL),
o AS (SELECT plain, min(struct_pack(doc_id := doc_id, place := place)) AS first FROM h GROUP BY plain),
x AS (SELECT DISTINCT doc_id, k FROM h JOIN o USING (plain) WHERE struct_pack(doc_id := doc_id, place := place) <> first),
r AS (SELECT n.*, x.k IS NOT NULL AS gone FROM n LEFT JOIN x USING (doc_id, k)),
g AS (SELECT *, k - row_number() OVER (PARTITION BY doc_id, gone ORDER BY k) AS run FROM r),
w AS (SELECT doc_id, run, sum(nw)::BIGINT AS words, min(start) || '-' || max(start + len(piece)) AS span, min(start) AS start FROM g WHERE gone GROUP BY doc_id, run),
m AS (SELECT doc_id, max(words) AS longest, count(*) FILTER (words >= 25) AS passages, string_agg(span, ',' ORDER BY start) AS removed FROM w GROUP BY doc_id)
SELECT doc_id, count(piece) AS n_units, count(piece) FILTER (gone) AS n_removed,
       coalesce(any_value(longest), 0) AS longest_removed, coalesce(any_value(passages), 0) AS n_passages,
       coalesce(any_value(removed), '') AS removed,
       CASE WHEN any_value(text) IS NOT NULL THEN coalesce(string_agg(piece, '' ORDER BY k) FILTER (NOT gone), '') END AS text
FROM documents LEFT JOIN g USING (doc_id) LEFT JOIN m USING (doc_id) GROUP BY doc_id"""

_ASSIGN = """
e{r} AS MATERIALIZED (SELECT id, c.part, min(d * 256 + c.entry) AS best FROM (
    SELECT v.id, v.part, c.entry, sum((v.x - c.x) * (v.x - c.x))::HUGEINT AS d FROM v JOIN c{r} c USING (part, pos) GROUP BY ALL) c GROUP BY ALL)"""
_MOVE = """
c{n} AS MATERIALIZED (SELECT c.part, c.entry, c.pos, CASE WHEN s.n IS NULL THEN c.x ELSE ((s.t - ((s.t % s.n) + s.n) % s.n) // s.n)::BIGINT END AS x
    FROM c{r} c LEFT JOIN (SELECT v.part, (e.best % 256)::BIGINT AS entry, v.pos, sum(v.x) AS t, count(*) AS n
                           FROM v JOIN e{r} e USING (id, part) GROUP BY ALL) s USING (part, entry, pos))"""
OP11 = (
    """
WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS id, * FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT id, (i - 1) // (w // 4) AS part, (i - 1) % (w // 4) AS pos, floor(1024 * x::DOUBLE)::BIGINT AS x
    FROM (SELECT id, len(embedding) AS w, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM k)),
c0 AS MATERIALIZED (SELECT part, id AS entry, pos, x FROM v WHERE id < 256),"""
    + ",".join(_ASSIGN.format(r=r) + "," + _MOVE.format(r=r, n=r + 1) for r in range(4))
    + ","
    + _ASSIGN.format(r=4)
    + """,
o AS (SELECT id, string_agg(printf('%02x', (best % 256)::INTEGER), '' ORDER BY part) AS code, sum(best // 256)::BIGINT AS error FROM e4 GROUP BY id),
b AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM c4)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM o JOIN k USING (id), b"""
)

OP12 = """
WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS MATERIALIZED (SELECT id, doc_id, k, md5_number(substr(h, 2 * k + 1, 100)) AS win
     FROM (SELECT *, unnest(range(0, len(h) // 2 - 49)) AS k FROM d)),
f AS (SELECT win, min(doc_id) AS first FROM w GROUP BY win),
g AS (SELECT id, k, lag(k) OVER (PARTITION BY id ORDER BY k) AS before FROM w JOIN f USING (win) WHERE first < doc_id),
n AS (SELECT *, sum(CASE WHEN before IS NULL OR k > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY k) AS span FROM g),
s AS (SELECT id, span, min(k) AS start, max(k) + 50 AS stop FROM n GROUP BY id, span),
p AS (SELECT id, span, start, stop, coalesce(lag(stop) OVER (PARTITION BY id ORDER BY span), 0) AS before FROM s),
r AS (SELECT id, count(*) AS n_spans, sum(stop - start)::BIGINT AS n_removed, max(stop) AS tail,
             string_agg(substr(h, 2 * before + 1, 2 * (start - before)), '' ORDER BY span) AS kept FROM p JOIN d USING (id) GROUP BY id)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN r USING (id)"""

QUERIES = {
    "op2_minhash_near_dedup": OP2,
    "op3_decontamination": OP3,
    "op6_exact_search": OP6,
    "op7_quotations": OP7,
    "op10_substring_dedup": OP10,
    "op11_vector_codes": OP11,
    "op12_suffix_dedup": OP12,
}
