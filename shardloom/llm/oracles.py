"""DuckDB SQL of the operators that SQL can express over whole tables.

The others (learned models, tokenizer libraries, coded files, page markup) are tested against
brute-force versions in tests/llm.
"""

ORACLE: dict[str, str] = {}


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a VARCHAR expression, four bits at a time, low half of a byte first.

    The table's entries follow from the reflected polynomial 0xEDB88320.
    """
    table = []
    for x in range(16):
        for _ in range(4):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        table.append(x)
    step = lambda c: f"xor({c} >> 4, list_extract({table}::BIGINT[], CAST(({c}) & 15 AS INTEGER) + 1))"
    nibbles = (f"list_transform(range(0, 2 * CAST(strlen({text}) AS BIGINT)), "
               f"lambda i: CAST(('0x' || substr(hex(encode({text})), CAST(i + 1 - 2 * (i % 2) + 1 AS BIGINT), 1)) AS BIGINT))")
    return f"xor(list_reduce({nibbles}, lambda c, b: {step('xor(c, b)')}, 4294967295::BIGINT), 4294967295::BIGINT)"

# Texts as hex, so that substr counts bytes; a window is 400 hex digits.
ORACLE["op2_suffix_dedup"] = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS m
      FROM (SELECT r, h, unnest(range(0, strlen(h) // 2 - 199)) AS i FROM d)),
hit AS (SELECT r, i FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
step AS (SELECT r, i, CASE WHEN i > lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 1 ELSE 0 END AS jump FROM hit),
isle AS (SELECT r, i, sum(jump) OVER (PARTITION BY r ORDER BY i) AS g FROM step),
span AS (SELECT r, min(i) AS s, max(i) + 200 AS e FROM isle GROUP BY r, g),
gap AS (SELECT r, s, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS p FROM span),
cut AS (SELECT gap.r, string_agg(substr(h, 2 * p + 1, 2 * (s - p)), '' ORDER BY s) AS head, max(e) AS tail,
               CAST(sum(e - s) AS BIGINT) AS n_removed, count(*) AS n_spans FROM gap JOIN d USING (r) GROUP BY gap.r)
SELECT doc_id, CAST(strlen(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head || substr(h, 2 * tail + 1), h))) AS kept_sha256
FROM d LEFT JOIN cut USING (r)
"""

ORACLE["op3_topk"] = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 20 = 0),
k AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 20
"""

ORACLE["op10_near_dup"] = """
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT r, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                     WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
c AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM g a JOIN g b ON a.s = b.s AND a.r < b.r GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE k >= 0.8 * (x.n + y.n - k)
      UNION SELECT a.r, b.r FROM d a JOIN d b ON a.t = b.t AND a.r < b.r),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT x.doc_id, min(y.doc_id) AS class_id, count(*) AS class_size
FROM reach JOIN d x ON x.r = reach.a JOIN d y ON y.r = reach.b GROUP BY x.r, x.doc_id
"""

# Near words have a word without one letter in common: the other word itself, or the same place left out of both.
ORACLE["op11_spelling"] = f"""
WITH RECURSIVE occ AS (SELECT k, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM
        (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k, unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS r FROM documents)
        WHERE length(r) >= 7),
seen AS (SELECT k || ':' || w AS t, w, count(*) AS n FROM occ GROUP BY k, w),
slip AS (SELECT w, n, {crc32_sql("t")} AS h FROM seen),
word AS (SELECT v AS w, CAST(sum(n) AS BIGINT) AS n FROM
         (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS v, n FROM slip)
         WHERE length(v) >= 7 GROUP BY v HAVING sum(n) >= 2),
gap AS (SELECT w, i, substr(w, 1, i) || substr(w, i + 2) AS x FROM (SELECT w, unnest(range(0, length(w))) AS i FROM word)),
one AS (SELECT DISTINCT gap.w AS a, word.w AS b FROM gap JOIN word ON gap.x = word.w),
near AS (SELECT a, b FROM one UNION ALL SELECT b, a FROM one UNION ALL SELECT x.w, y.w FROM gap x JOIN gap y ON x.x = y.x AND x.i = y.i AND x.w <> y.w),
best AS (SELECT a, count(*) AS n_near, arg_min(b, struct_pack(n := -n, b := b)) AS f, max(n) AS fn FROM near JOIN word ON b = w GROUP BY a),
form AS (SELECT w, n, coalesce(n_near, 0) AS n_near, CASE WHEN fn >= 10 * n THEN f END AS form, CASE WHEN fn >= 10 * n THEN fn END AS form_n
         FROM word LEFT JOIN best ON a = w),
walk AS (SELECT w, w AS t FROM form UNION ALL SELECT walk.w, form.form FROM walk JOIN form ON form.w = walk.t WHERE form.form IS NOT NULL)
SELECT form.w AS word, form, walk.t AS root, n, n_near, form_n
FROM form JOIN walk ON walk.w = form.w JOIN (SELECT w AS z FROM form WHERE form IS NULL) ON z = walk.t
"""

# Equal words at distance q side by side are one stretch; of the periods of one stretch the smallest is its period.
ORACLE["op12_periodic_runs"] = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
                  {crc32_sql("CAST(doc_id AS VARCHAR)")} AS h FROM documents),
a AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM t),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
word AS (SELECT r, i, CASE WHEN i >= a THEN w[a + (i - a) % p + 1] ELSE w[i + 1] END AS x FROM (SELECT *, unnest(range(0, n)) AS i FROM p)),
pair AS (SELECT x.r, y.i - x.i AS q, x.i FROM word x JOIN word y ON x.r = y.r AND x.x = y.x JOIN p ON p.r = x.r
         WHERE y.i > x.i AND 4 * (y.i - x.i) <= n),
isle AS (SELECT r, q, min(i) AS s, q + count(*) AS l FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM pair) GROUP BY r, q, k),
run AS (SELECT r, s, l, min(q) AS q FROM isle WHERE l >= greatest(6, 4 * q) GROUP BY r, s, l),
cut AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM run),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS c FROM word ANTI JOIN cut USING (r, i) GROUP BY r),
per AS (SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
               arg_min(struct_pack(s := s, l := l, q := q), struct_pack(l := -l, s := s, q := q)) AS b FROM run GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.l AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period,
       CAST(b.l * 1000 // b.q AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
FROM p LEFT JOIN per USING (r) LEFT JOIN kept USING (r)
"""
