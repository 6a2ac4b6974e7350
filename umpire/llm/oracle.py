"""DuckDB SQL for the queries that SQL can express on whole tables."""

WORD = r"[^\x20\x09-\x0D]+"

#: The 256 checksums of single bytes: the reflected polynomial 0xEDB88320.
CRC = """SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END)) AS tab"""


def crc32(text: str) -> str:
    """Checksum of a string's UTF-8 bytes, with ``tab`` in scope."""
    byte = (f"list_transform(range(octet_length(encode({text}))), "
            f"lambda i: ('0x' || substr(hex(encode({text})), (2 * i + 1)::BIGINT, 2))::BIGINT)")
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {byte}), "
            f"lambda a, b: xor(a // 256, tab[xor(a % 256, b) + 1])), 4294967295::BIGINT)")


SQL = {
    "op1_minhash": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN w ELSE w[i:i+2] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, seen) AS (
  SELECT a, a FROM sides UNION SELECT r.doc_id, e.b FROM reach r JOIN sides e ON e.a = r.seen),
roots AS (SELECT doc_id, min(seen) AS root FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(r.root, d.doc_id) AS component_id,
       coalesce(r.root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN roots r USING (doc_id)""",
    "op8_lines": rf"""
WITH lines AS (
  SELECT doc_id, i, body[i] AS line, len(regexp_extract_all(body[i], '{WORD}')) AS words
  FROM (SELECT doc_id, body, unnest(range(1, len(body) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS body FROM documents WHERE text IS NOT NULL))),
pairs AS (
  SELECT a.doc_id AS da, b.doc_id AS db, a.i - b.i AS shift, b.i AS i, b.words,
         b.i - row_number() OVER (PARTITION BY a.doc_id, b.doc_id, a.i - b.i ORDER BY b.i) AS run
  FROM lines a JOIN lines b ON a.line = b.line AND (a.doc_id < b.doc_id OR (a.doc_id = b.doc_id AND a.i < b.i))),
runs AS (
  SELECT db, min(i) AS lo, max(i) AS hi FROM pairs GROUP BY da, db, shift, run HAVING sum(words) >= 50),
gone AS (SELECT DISTINCT db AS doc_id, unnest(range(lo, hi + 1)) AS i FROM runs),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS n_removed,
         string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL) AS text
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(k.text, '')) END AS kept_md5
FROM documents d LEFT JOIN kept k USING (doc_id)""",
    "op10_mix": rf"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
         2.0::DOUBLE * source_size AS full_ FROM sources),
levels AS (
  SELECT *, full_ / weight AS fills_at,
         row_number() OVER o AS turn,
         (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(full_) OVER b, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level_
  FROM weighed
  WINDOW o AS (ORDER BY full_ / weight, source NULLS LAST),
         b AS (ORDER BY full_ / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, coalesce(least(full_, (SELECT arg_min(level_, turn) FROM levels WHERE level_ <= fills_at) * weight), full_) AS target
  FROM levels),
placed AS (
  SELECT d.*, t.source_size, t.target, row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS place,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('42|' || coalesce('s' || d.source, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS start
  FROM docs d JOIN targets t ON t.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, size, source_size, target,
       (least(floor(rate * place + start) - floor(rate * (place - 1) + start), 2)::BIGINT * size)::BIGINT AS taken
FROM placed""",
    "op12_trie": f"""
WITH table_ AS ({CRC}),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t
  FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT conv_id, list(t ORDER BY place) AS l FROM turns GROUP BY conv_id),
convs AS (SELECT conv_id, l, {crc32("conv_id::VARCHAR")} % 6 AS h FROM lists, table_),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(d.l[1:c.h], []), c.l[c.h + 1:]) AS l
  FROM convs c LEFT JOIN lists d ON d.conv_id = c.conv_id - c.conv_id % 100),
steps AS (SELECT conv_id, len(l) AS size, unnest(range(0, len(l) + 1)) AS depth, l FROM rebuilt),
nodes AS (
  SELECT l[1:depth] AS p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM steps GROUP BY ALL),
kids AS (SELECT p[1:depth - 1] AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
own AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN n.depth > 0 THEN (n_convs - 1) * length(n.p[n.depth].text) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN kids k ON k.p = n.p),
sums AS (
  SELECT p[1:d] AS p, sum((n_children = 0)::BIGINT) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT p, n_children, saved, unnest(range(0, depth + 1)) AS d FROM own) GROUP BY ALL)
SELECT o.conv_id, o.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, o.n_convs, o.n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, o.ends_sha256
FROM own o JOIN sums s ON s.p = o.p LEFT JOIN nodes u ON o.depth > 0 AND u.p = o.p[1:o.depth - 1]""",
    "op13_spelling": rf"""
WITH RECURSIVE table_ AS ({CRC}),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS head, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
marked AS (SELECT run, n, {crc32("head || run")} AS h FROM runs, table_ WHERE length(run) >= 6),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT n, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM marked)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS part
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.part = b.part AND a.i = b.i AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.part = w.word
  UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.part = w.word),
best AS (SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word),
firsts AS (SELECT x.word, min(x.other) AS other FROM near x JOIN best b ON b.word = x.word AND b.m = x.m GROUP BY x.word),
found AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 5 * w.n THEN b.m END AS form_n,
         CASE WHEN b.m >= 5 * w.n THEN x.other END AS form
  FROM words w LEFT JOIN best b ON b.word = w.word LEFT JOIN firsts x ON x.word = w.word),
walk AS (
  SELECT word, word AS at, form AS further FROM found
  UNION ALL SELECT k.word, f.word, f.form FROM walk k JOIN found f ON f.word = k.further)
SELECT f.word, f.form, k.at AS root, f.n, f.n_near, f.form_n FROM found f JOIN walk k ON k.word = f.word AND k.further IS NULL""",
}
