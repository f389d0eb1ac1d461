"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from recflow.llm import near_dup, quality

WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"

MIXING = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS k
           FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
q AS (SELECT *, ([1, 2, 3])[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::BIGINT AS weight FROM p),
o AS (SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY (3 * source_size)::DOUBLE / weight, source IS NULL, source) AS r FROM q),
c AS (SELECT *, (sum(cap) OVER w - cap)::BIGINT AS caps, (sum(weight) OVER w - weight)::BIGINT AS weights,
             (sum(source_size) OVER ())::BIGINT AS total, (sum(weight) OVER ())::BIGINT AS all_weights
      FROM o WINDOW w AS (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
e AS (SELECT *, cap * (all_weights - weights) <= weight * (total - caps) AS capped FROM c),
f AS (SELECT *, coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0)::BIGINT AS used,
             coalesce(sum(CASE WHEN NOT capped THEN weight END) OVER (), 0)::BIGINT AS open_weight FROM e),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE
             ELSE (total - used)::DOUBLE * weight / open_weight END AS target FROM f),
s AS (SELECT d.*, (sum(size) OVER (PARTITION BY source ORDER BY k, doc_id NULLS FIRST, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start FROM d),
g AS (SELECT s.*, t.source_size, t.target, round(t.target)::BIGINT AS budget,
             CASE WHEN t.source_size > 0 THEN (round(t.target)::BIGINT // t.source_size)::BIGINT ELSE 0 END AS epochs
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
       (epochs * size + least(size, greatest(0, budget - epochs * source_size - start)))::BIGINT AS taken
FROM g
"""

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
e AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(8), lambda i: list_aggregate(list_transform([15, 10, 5, 0],
         lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                     ((('0x' || substr(h, (5 * i + 1)::INT, 5))::INT >> b) & 31) + 1, 1)), 'string_agg', '')), '') AS payload_digest
      FROM p),
f AS (SELECT *, row_number() OVER (PARTITION BY payload_digest, payload_bytes ORDER BY page_id NULLS LAST) AS r,
             min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM e)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN r = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN r > 1 THEN first END AS refers_to
FROM f
"""

NEAR_DUP = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS sh FROM d),
n AS (SELECT doc_id, len(sh)::BIGINT AS n_shingles, md5(array_to_string(list_sort(sh), chr(10))) AS k, sh FROM s),
reps AS (SELECT k, min(doc_id) AS rep, any_value(n_shingles) AS n, any_value(sh) AS sh FROM n WHERE n_shingles > 0 GROUP BY k),
u AS (SELECT rep, n, unnest(sh) AS x FROM reps),
links AS MATERIALIZED (SELECT a.rep AS a, b.rep AS b FROM u a JOIN u b ON a.x = b.x AND a.rep < b.rep
          AND 100 * least(a.n, b.n) >= PERCENT * greatest(a.n, b.n)
          GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= PERCENT * (a.n + b.n - count(*))),
edges AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT rep AS a, rep AS b FROM reps WHERE rep IN (SELECT a FROM edges)
          UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT n.doc_id, n.n_shingles, coalesce(c.component_id, r.rep, n.doc_id) AS component_id,
       n.doc_id = coalesce(c.component_id, r.rep, n.doc_id) AS kept
FROM n LEFT JOIN (SELECT k, rep FROM reps) r ON n.k = r.k AND n.n_shingles > 0 LEFT JOIN c ON r.rep = c.a
""".replace("PERCENT", str(near_dup.SIMILARITY_PERCENT))


def _rule(r: quality.Rule) -> str:
    parts = [f"{r.metric} >= {r.least}"] if r.least is not None else []
    parts += [f"{r.metric} <= {r.most}"] if r.most is not None else []
    return " AND ".join(parts)


QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, """ + WORDS + r""" AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
u AS (SELECT rid, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT rid, i, x, lead(x, 1) OVER p AS y, lead(x, 2) OVER p AS z FROM u WINDOW p AS (PARTITION BY rid ORDER BY i)),
k AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x, y, z) AS n FROM g WHERE z IS NOT NULL) WHERE n > 1),
r AS (SELECT rid, count(DISTINCT j)::BIGINT AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM k) GROUP BY rid),
c AS (SELECT rid, sum(length(x))::BIGINT AS chars, count(*) FILTER (WHERE lower(x) IN (STOPS))::BIGINT AS stops FROM u GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(chars, 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
             coalesce(stops, 0)::BIGINT AS n_stop_words
      FROM w LEFT JOIN r USING (rid) LEFT JOIN c USING (rid)),
s AS (SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0 END AS mean_word_chars,
             CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0 END AS symbols_per_word,
             CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0.0 END AS stop_word_share,
             CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END AS dup_line_share,
             CASE WHEN n_lines > 0 THEN word_chars / n_lines ELSE 0.0 END AS chars_per_line,
             n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND RULES AS kept
FROM s
""".replace("STOPS", ", ".join(f"'{w}'" for w in quality.STOP_WORDS)).replace(
    "RULES", " AND ".join(f"({_rule(r)})" for r in quality.RULES))



def _crc_table() -> list[int]:
    """The 256 remainders of CRC-32, by its rule."""
    out = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        out.append(value)
    return out


# near words: equal after deleting the same place of both, or one equal to the other with a place deleted
VARIANTS = r"""
WITH RECURSIVE crc AS (SELECT CAST(TABLE_ AS BIGINT[]) AS t),
r AS (SELECT DISTINCT coalesce(doc_id::VARCHAR, '') AS id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]{6,}')) AS run
      FROM documents WHERE text IS NOT NULL) GROUP BY ALL),
hx AS (SELECT *, hex(encode(id || ':' || run)) AS x FROM r),
hs AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, (len(x) // 2)::BIGINT),
        lambda i: ('0x' || substr(x, (2 * i + 1)::INT, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS h FROM hx CROSS JOIN crc),
o AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
             ELSE run END AS word, n FROM hs),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM o WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
d AS MATERIALIZED (SELECT word, i, substr(word, 1, (i - 1)::INT) || substr(word, (i + 1)::INT) AS cut
      FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (SELECT a.word, b.word AS near FROM d a JOIN d b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
         UNION SELECT d.word, w.word FROM d JOIN w ON w.word = d.cut
         UNION SELECT w.word, d.word FROM d JOIN w ON w.word = d.cut),
best AS (SELECT x.word, count(*) AS n_near, max(y.n) AS top, arg_min(x.near, (-y.n, x.near)) AS form
         FROM near x JOIN w y ON y.word = x.near GROUP BY x.word),
f AS MATERIALIZED (SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.top >= 5 * w.n THEN b.form END AS form,
             CASE WHEN b.top >= 5 * w.n THEN b.top END AS form_n FROM w LEFT JOIN best b ON b.word = w.word),
walk AS (SELECT word, word AS at_, 0 AS step FROM f
         UNION ALL SELECT walk.word, f.form, step + 1 FROM walk JOIN f ON f.word = walk.at_ WHERE f.form IS NOT NULL)
SELECT f.word, f.form, (SELECT arg_max(at_, step) FROM walk WHERE walk.word = f.word) AS root, f.n, f.n_near, f.form_n
FROM f
""".replace("TABLE_", str(_crc_table()))

SQL = {
    "op1_source_mixing": MIXING,
    "op3_arc_to_warc": WARC,
    "op7_near_duplicates": NEAR_DUP,
    "op10_quality_rules": QUALITY,
    "op12_spelling_variants": VARIANTS,
}
