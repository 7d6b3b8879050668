"""DuckDB SQL for the operators that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from reelhouse.llm import license_digest

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws FROM benchmark),
bench AS (
  SELECT DISTINCT item, m, array_to_string(ws[k : k + m - 1], ' ') AS win
  FROM (SELECT item, ws, least(13, len(ws)) AS m, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS k
        FROM item WHERE len(ws) > 0)),
doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws FROM documents),
wins AS (
  SELECT doc_id, m, k, array_to_string(ws[k : k + m - 1], ' ') AS win
  FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS k
        FROM doc CROSS JOIN (SELECT DISTINCT m FROM bench) WHERE len(ws) >= m)),
hits AS (SELECT doc_id, item, m, k FROM wins JOIN bench USING (m, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + m)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

EXACT = f"""
WITH n AS (SELECT doc_id, {_LOWER} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
"""

NGRAM_JOIN = f"""
WITH RECURSIVE doc AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, least(4, len(ws)) AS m, array_to_string(ws[k : k + 3], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 3) + 1)) AS k FROM doc WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.m = b.m AND a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM both_ JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.size + q.size - c)),
reach AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT link.y, reach.root FROM reach JOIN link ON link.x = reach.doc_id)
SELECT doc_id, coalesce(size, 0) AS n_shingles, min(root) AS component_id
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id, size
"""

MIXING = f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_SPACED}')) AS BIGINT) AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM s),
w AS (SELECT *, [5, 2, 1][rk % 3 + 1] AS w, [0.5, 0.0, -0.5][rk % 3 + 1]::DOUBLE AS slope, 3 * source_size AS cap FROM r),
l AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER seen, 0) AS DOUBLE)
                / CAST(sum(w) OVER () - coalesce(sum(w) OVER seen, 0) AS DOUBLE) AS level
      FROM w WINDOW seen AS (ORDER BY cap::DOUBLE / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, slope, least(CAST(cap AS DOUBLE), max(level) OVER () * w) AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.slope, CAST(floor(t.target + 0.5::DOUBLE) AS BIGINT) AS budget,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id ROWS UNBOUNDED PRECEDING) - d.size AS BIGINT) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, CASE WHEN source_size > 0 THEN (budget // source_size) * size
                  + greatest(0, least(size, budget % source_size - start)) ELSE 0 END AS taken,
             CAST(start AS DOUBLE) / target AS u, 1::DOUBLE - slope AS one FROM p)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0 THEN (2::DOUBLE * u) / (one + sqrt(one * one + (4::DOUBLE * slope) * u)) END AS position
FROM k
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    out = f"lower({column})"
    for pattern, to in license_digest.STEPS:
        to = to.replace("$", "\\")
        out = f"regexp_replace({out}, {_quoted(pattern)}, {_quoted(to)}, 'g')"
    return f"trim({out})"


def license_scan() -> str:
    known = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in license_digest.KNOWN)
    return f"""
WITH k AS (SELECT DISTINCT license, {_canonical('t')} AS form FROM (VALUES {known}) AS v(license, t)),
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
whole AS (SELECT doc_id, license FROM (SELECT doc_id, {_canonical('t')} AS form FROM d) JOIN k USING (form) WHERE form <> ''),
line AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS t FROM d),
hit AS (SELECT doc_id, license FROM (SELECT doc_id, {_canonical('t')} AS form FROM line) JOIN k USING (form) WHERE form <> ''),
lines AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names FROM hit GROUP BY doc_id)
SELECT d.doc_id, whole.license AS text_license, coalesce(n, 0) AS n_license_lines, coalesce(names, '') AS licenses
FROM d LEFT JOIN whole USING (doc_id) LEFT JOIN lines USING (doc_id)
"""


SPELLING = """
WITH RECURSIVE bit8 AS (
  -- the remainder of a byte, and of a byte followed by ever more zero bytes
  SELECT b, 8 AS k, b::BIGINT AS r FROM range(256) t(b)
  UNION ALL SELECT b, k - 1, xor(r >> 1, CASE WHEN r % 2 = 1 THEN 3988292384 ELSE 0 END) FROM bit8 WHERE k > 0),
byte0 AS MATERIALIZED (SELECT b, r FROM bit8 WHERE k = 0),
run AS MATERIALIZED (
  SELECT row_number() OVER () AS id, doc_id, run, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS h
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[a-zÀ-ÿ]+')) AS run FROM documents)),
longest AS (SELECT max(len(h)) // 2 AS top FROM run),
after AS (
  SELECT 0 AS back, b, r FROM byte0
  UNION ALL SELECT back + 1, after.b, xor(after.r >> 8, z.r) FROM after JOIN byte0 z ON z.b = after.r & 255 WHERE back + 1 < (SELECT top FROM longest)),
remain AS MATERIALIZED (SELECT back, printf('%02X', b) AS hh, r FROM after),
zeros AS (
  SELECT 0 AS n, 4294967295 AS r
  UNION ALL SELECT n + 1, xor(zeros.r >> 8, z.r) FROM zeros JOIN byte0 z ON z.b = zeros.r & 255 WHERE n < (SELECT top FROM longest)),
crc AS (
  SELECT id, xor(xor(any_value(zeros.r), bit_xor(remain.r)), 4294967295) AS c
  FROM (SELECT id, len(h) // 2 AS n, unnest(range(1, len(h) // 2 + 1)) AS i, h FROM run) s
  JOIN remain ON remain.hh = substr(s.h, 2 * s.i - 1, 2) AND remain.back = s.n - s.i JOIN zeros ON zeros.n = s.n GROUP BY id),
word AS (
  SELECT CASE WHEN c % 97 = 0 THEN substr(run, 1, c % len(run)) || substr(run, c % len(run) + 2) ELSE run END AS word
  FROM run JOIN crc USING (id)),
voc AS MATERIALIZED (SELECT word, count(*) AS n FROM word WHERE len(word) >= 5 GROUP BY word HAVING count(*) >= 3),
spot AS (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM voc),
gap AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z FROM spot),
near AS MATERIALIZED (
  SELECT x.word AS word, y.word AS other, y.n AS n FROM gap x JOIN gap y USING (i, a, z) WHERE x.word <> y.word
  UNION SELECT v.word, g.word, g.n FROM gap g JOIN voc v ON v.word = g.a || g.z
  UNION SELECT g.word, v.word, v.n FROM gap g JOIN voc v ON v.word = g.a || g.z),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS best_n FROM near GROUP BY word),
form AS MATERIALIZED (
  SELECT voc.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN other END AS form, CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
  FROM voc LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS root, form AS further FROM form
  UNION ALL SELECT walk.word, form.word, form.form FROM walk JOIN form ON form.word = walk.further)
SELECT form.word, form.form, walk.root, form.n, CAST(form.n_near AS BIGINT) AS n_near, CAST(form.form_n AS BIGINT) AS form_n
FROM form JOIN walk USING (word) WHERE walk.further IS NULL
"""


def clusters(k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, salt: str = "2") -> str:
    """Rounds of assignment and integer means, all in long form; rows are numbered, as vec_ids may repeat."""
    ctes = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda x: CAST(floor({scale}::DOUBLE * x::DOUBLE) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0)""",
            f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{salt}:' || coalesce(CAST(vec_id AS VARCHAR), '')), q, vec_id NULLS LAST) - 1 AS c, q
  FROM v QUALIFY c < {k})"""]
    for i in range(rounds + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (
  SELECT row_no, any_value(vec_id) AS vec_id, any_value(q) AS q, min({{'d': d, 'c': c}}) AS m
  FROM (SELECT v.row_no, v.vec_id, v.q, c, list_sum(list_transform(range(1, {size + 1}), lambda i: (v.q[i] - p.q[i]) * (v.q[i] - p.q[i]))) AS d
        FROM v CROSS JOIN c{i} p) GROUP BY row_no)""")
        if i < rounds:
            ctes.append(f"""s{i} AS (
  SELECT m.c AS c, i, sum(q[i]) AS s, count(*) AS n FROM a{i} CROSS JOIN range(1, {size + 1}) r(i) GROUP BY 1, 2),
n{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS q FROM s{i} GROUP BY c),
c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(n{i}.q, c{i}.q) AS q FROM c{i} LEFT JOIN n{i} USING (c))""")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance,
       CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(p.q, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} p ON p.c = m.c
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_decontamination": DECONTAMINATION,
        "op4_exact_dedup": EXACT,
        "op6_ngram_join": NGRAM_JOIN,
        "op8_mixing": MIXING,
        "op9_license_scan": license_scan(),
        "op12_spelling": SPELLING,
        "op13_clusters": clusters(),
    }
