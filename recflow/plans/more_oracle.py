"""DuckDB SQL for ``more_queries`` and for the queries on the full ranking data."""

from __future__ import annotations

from recflow.plans.oracle import (BEHAVIOR, CATALOG, CF_PRED, HARD, HISTORY_COUNTS, HOLDOUT, HYBRID_FEATURES, HYBRID_POOL,
                                  ITEM_STATS,
                                  PRICE_PROFILE, RAW_BEHAVIOR, RAW_PRODUCTS, SEEDS, SHARES, SQL, TRUNC_INTERACTIONS, VCAT, W,
                                  _describe, clean, label, price_text, with_)

SQL["catalog_rounded"] = W(f"""w3 AS (SELECT product_id, {clean('name')} AS title, {label('category')} AS category,
       {label('material')} AS material, {label('color')} AS color, {label('style')} AS style,
       round(price, 2) AS price, round(rating, 2) AS rating, {clean('description', '')} AS catalog_description FROM raw_products)""") + f"""
SELECT product_id, title, category, material, color, style, price, rating,
       style || ' ' || material || ' ' || category || ' in ' || color || ' color. Price: ' || {price_text('price')} || '.' AS description,
       catalog_description FROM w3"""

SQL["catalog_assembled"] = W(VCAT) + """
SELECT c.product_id, coalesce(upper(s.title), c.title) AS title,
       coalesce(CASE WHEN e.label <> 0 THEN lower(s.category) END, c.category) AS category,
       c.material, c.color, c.style, round(c.price, 6) AS price, round(c.rating, 6) AS rating, c.description, c.catalog_description
FROM catalog c LEFT JOIN vcat s ON s.product_id = c.product_id LEFT JOIN embeddings e ON e.vec_id = c.product_id"""

SQL["events_schema"] = W() + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {i} AS position, '{t}' AS dtype, count({c}) AS non_null FROM raw_behavior"
    for i, (c, t) in enumerate((("user_id", "bigint"), ("product_id", "bigint"), ("event_type", "string"), ("timestamp", "timestamp_ntz"))))

SQL["events_describe_all"] = W("""freq AS (SELECT event_type, count(*) AS n FROM behavior GROUP BY event_type)""") + f"""
SELECT *, NULL::DOUBLE AS "unique", NULL::DOUBLE AS freq, NULL::VARCHAR AS top FROM ({_describe('behavior', ['user_id', 'product_id'])})
UNION ALL BY NAME
SELECT 'event_type' AS column_name, sum(n)::BIGINT AS count, count(*)::DOUBLE AS "unique", max(n)::DOUBLE AS freq,
       (SELECT min(event_type) FROM freq WHERE n = (SELECT max(n) FROM freq)) AS top FROM freq"""

SQL["event_types"] = W() + "SELECT DISTINCT event_type FROM behavior"

SQL["first_events"] = W() + """SELECT user_id, product_id, event_type, timestamp FROM behavior
ORDER BY timestamp NULLS FIRST, user_id NULLS FIRST, product_id NULLS FIRST, event_type LIMIT 5"""

SQL["similar_products"] = W(VCAT, """pr AS (SELECT a.product_id AS q, b.product_id AS n, list_inner_product(a.vec, b.vec) AS s
                                            FROM vcat a JOIN vcat b ON a.product_id <> b.product_id)""") + """
SELECT q AS query_id, n AS product_id, rank, round(s, 6) AS score FROM (
  SELECT q, n, s, CAST(row_number() OVER (PARTITION BY q ORDER BY round(s, 9) DESC, n) AS BIGINT) AS rank FROM pr)
WHERE rank <= 5"""

SQL["sample_profiles"] = W("""g AS (SELECT category, count(*) AS n, list_sort(list(product_id))[1:2] AS ids FROM catalog
                                     GROUP BY category HAVING count(*) >= 2 ORDER BY n DESC, category LIMIT 3)""") + """
SELECT lower(category) || '_shopper' AS user_id, array_to_string(ids, ',') AS purchased_product_ids,
       category AS preferred_category FROM g"""

SQL["purchased_products"] = W() + """SELECT product_id, title, category FROM catalog
WHERE product_id IN (SELECT product_id FROM behavior WHERE event_type = 'purchase')"""

SQL["text_search"] = W(
    r"""dt AS (SELECT product_id, token, count(*) AS tf FROM (SELECT product_id, unnest(regexp_extract_all(lower(description), '\w+')) AS token
               FROM catalog) GROUP BY ALL)""",
    """idf AS (SELECT token, ln(((SELECT count(*) FROM catalog) + 1)::DOUBLE / (count(*) + 1)) AS v FROM dt GROUP BY token)""",
    """dw AS (SELECT product_id, dt.token, tf * v AS w FROM dt JOIN idf ON dt.token = idf.token WHERE v > 0)""",
    """dn AS (SELECT product_id, sqrt(sum(w * w)) AS n FROM dw GROUP BY product_id)""",
    """qs AS (SELECT title, min(product_id) AS query_id FROM catalog GROUP BY title)""",
    rf"""qt AS (SELECT query_id, token, count(*) AS tf FROM (SELECT query_id, unnest(regexp_extract_all(lower({clean('title', '')}), '\w+')) AS token
               FROM qs) GROUP BY ALL)""",
    """qw AS (SELECT query_id, qt.token, tf * v AS w FROM qt JOIN idf ON qt.token = idf.token WHERE v > 0)""",
    """qn AS (SELECT query_id, sqrt(sum(w * w)) AS n FROM qw GROUP BY query_id)""",
    """sc AS (SELECT qw.query_id, dw.product_id, sum((qw.w / qn.n) * (dw.w / dn.n)) AS s FROM qw JOIN dw ON qw.token = dw.token
              JOIN qn ON qn.query_id = qw.query_id JOIN dn ON dn.product_id = dw.product_id GROUP BY ALL)""") + """
SELECT query_id, product_id, rank, round(s, 6) AS score FROM (
  SELECT q.query_id, c.product_id, coalesce(sc.s, 0.0) AS s, CAST(row_number() OVER (
    PARTITION BY q.query_id ORDER BY round(coalesce(sc.s, 0.0), 9) DESC, c.product_id) AS BIGINT) AS rank
  FROM qs q CROSS JOIN catalog c LEFT JOIN sc ON sc.query_id = q.query_id AND sc.product_id = c.product_id)
WHERE rank <= 5"""

# --- the full ranking data: splits and random negatives ----------------------------

SPLIT = """tsplit AS (SELECT user_id, target_product_id, cutoff_timestamp,
  CASE WHEN pos <= floor(n * 0.70::DOUBLE) THEN 'train'
       WHEN pos <= floor(n * 0.70::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY md5('42:' || user_id), user_id) AS pos, count(*) OVER () AS n FROM targets))"""


def negatives(knocked: str, size: int = 25) -> str:
    """CTEs ``neg`` (user_id, product_id, rank) for users of ``targets`` without the pairs of ``knocked``."""
    return f"""nsize AS (SELECT count(*) AS n FROM vcat),
nprime AS (SELECT any_value(n) AS n, min(x) AS p FROM (SELECT n, unnest(range(n, 2 * n + 3)) AS x FROM nsize)
           WHERE x >= 2 AND len(list_filter(range(2, CAST(floor(sqrt(x)) AS BIGINT) + 1), lambda y: x % y = 0)) = 0),
nkn AS (SELECT DISTINCT user_id, product_id FROM ({knocked})),
nstep AS (SELECT t.user_id, n, p, ('0x' || substr(md5('42:a:' || t.user_id), 1, 15))::BIGINT % (p - 1) + 1 AS a,
                 ('0x' || substr(md5('42:b:' || t.user_id), 1, 15))::BIGINT % p AS b,
                 least(p, {size} + (SELECT count(*) FROM nkn WHERE nkn.user_id = t.user_id) + p - n) AS steps
          FROM targets t CROSS JOIN nprime),
nwalk AS (SELECT user_id, n, j, (a * j + b) % p AS g FROM (SELECT *, unnest(range(0, steps)) AS j FROM nstep)),
nrank AS (SELECT product_id, row_number() OVER (ORDER BY product_id) - 1 AS g FROM vcat),
neg AS (SELECT w.user_id, r.product_id, CAST(row_number() OVER (PARTITION BY w.user_id ORDER BY w.j) AS BIGINT) AS rank
        FROM nwalk w JOIN nrank r ON r.g = w.g ANTI JOIN nkn ON nkn.user_id = w.user_id AND nkn.product_id = r.product_id
        QUALIFY rank <= {size})"""


SQL["user_split"] = W(HOLDOUT, SPLIT) + "SELECT user_id, target_product_id, cutoff_timestamp, split FROM tsplit"

_RANKING = (RAW_PRODUCTS, CATALOG, RAW_BEHAVIOR, BEHAVIOR, HOLDOUT, SPLIT, TRUNC_INTERACTIONS)
SQL["random_negatives"] = with_(*_RANKING, VCAT, negatives(
    """SELECT user_id, product_id FROM interactions WHERE event_type = 'purchase'
       UNION ALL SELECT user_id, target_product_id FROM targets""")) + "SELECT user_id, product_id, rank FROM neg"

_FULL = (CF_PRED, ITEM_STATS, VCAT, SEEDS, PRICE_PROFILE, SHARES, HISTORY_COUNTS, HARD,
         negatives("SELECT user_id, product_id FROM tex UNION ALL SELECT user_id, product_id FROM hard"),
         """pool AS (SELECT user_id, product_id FROM hard UNION ALL SELECT user_id, product_id FROM neg)""")
_SV = """sv AS (SELECT s.user_id, v.vec FROM seeds s JOIN vcat v ON v.product_id = s.product_id)"""

SQL["hybrid_features"] = with_(*_RANKING, *_FULL, _SV, HYBRID_FEATURES) + """
SELECT hf.user_id, hf.product_id, t.split, CAST(hf.product_id = t.target_product_id AS INTEGER) AS label,
       round(cf_score, 6) AS cf_score, round(emb, 6) AS embedding_similarity,
       round(price - avg_price, 6) AS price_delta_from_user_avg, round(pm, 6) AS price_sensitivity_match,
       round(cat_s, 6) AS category_match_score, round(mat_s, 6) AS material_preference_score,
       round(sty_s, 6) AS style_affinity_score, round(ctr, 6) AS historical_ctr,
       coalesce(hc.purchase_history_count, 0) AS purchase_history_count,
       coalesce(hc.interaction_history_count, 0) AS interaction_history_count,
       round(hybrid, 6) AS hybrid_signal_score
FROM hf JOIN tsplit t ON t.user_id = hf.user_id LEFT JOIN history_counts hc ON hc.user_id = hf.user_id"""

_SWEEP = SQL["signal_sweep_hard"]
SQL["signal_sweep"] = with_(*_RANKING, *_FULL, _SV, HYBRID_FEATURES) .rstrip() + ",\n" + _SWEEP[_SWEEP.index("cfgs AS"):].replace(
    "FROM hf JOIN targets t ON t.user_id = hf.user_id CROSS JOIN cfgs c",
    "FROM hf JOIN tsplit t ON t.user_id = hf.user_id AND t.split = 'val' CROSS JOIN cfgs c")

SQL["group_sizes"] = with_(*_RANKING, *_FULL) + "SELECT user_id, count(*) AS candidates FROM pool GROUP BY user_id"

SQL["data_summary"] = with_(*_RANKING, *_FULL, """sizes AS (SELECT user_id, count(*) AS n FROM pool GROUP BY user_id)""") + """
SELECT 'eligible_users' AS metric, count(*)::DOUBLE AS value FROM targets
UNION ALL SELECT 'observed_interactions', count(*)::DOUBLE FROM interactions
UNION ALL SELECT 'ranking_rows', count(*)::DOUBLE FROM pool
UNION ALL SELECT 'products', count(*)::DOUBLE FROM vcat
UNION ALL SELECT 'candidate_pool_mean', round(avg(n), 2) FROM sizes
UNION ALL SELECT 'candidate_pool_min', min(n)::DOUBLE FROM sizes
UNION ALL SELECT 'candidate_pool_max', max(n)::DOUBLE FROM sizes
UNION ALL SELECT 'split_' || split || '_users', count(*)::DOUBLE FROM tsplit GROUP BY split"""


# --- hybrid with a query text -------------------------------------------------------

QUERY_TEXT = r"""dt AS (SELECT product_id, token, count(*) AS tf FROM (SELECT product_id, unnest(regexp_extract_all(lower(description), '\w+')) AS token
               FROM vcat) GROUP BY ALL),
idf AS (SELECT token, ln(((SELECT count(*) FROM vcat) + 1)::DOUBLE / (count(*) + 1)) AS v FROM dt GROUP BY token),
dw AS (SELECT product_id, dt.token, tf * v AS w FROM dt JOIN idf ON dt.token = idf.token WHERE v > 0),
dn AS (SELECT product_id, sqrt(sum(w * w)) AS n FROM dw GROUP BY product_id),
qs AS (SELECT i.user_id, arg_min(c.title, c.product_id) AS text FROM interactions i JOIN vcat c ON c.product_id = i.product_id GROUP BY i.user_id),
qt AS (SELECT user_id, token, count(*) AS tf FROM (SELECT user_id, unnest(regexp_extract_all(lower(text), '\w+')) AS token FROM qs) GROUP BY ALL),
qw AS (SELECT user_id, qt.token, tf * v AS w FROM qt JOIN idf ON qt.token = idf.token WHERE v > 0),
qn AS (SELECT user_id, sqrt(sum(w * w)) AS n FROM qw GROUP BY user_id),
qsim AS (SELECT qw.user_id, dw.product_id, sum((qw.w / qn.n) * (dw.w / dn.n)) AS s FROM qw JOIN dw ON qw.token = dw.token
         JOIN qn ON qn.user_id = qw.user_id JOIN dn ON dn.product_id = dw.product_id GROUP BY ALL),
qrec AS (SELECT q.user_id, c.product_id, row_number() OVER (PARTITION BY q.user_id ORDER BY round(coalesce(qsim.s, 0.0), 9) DESC, c.product_id) AS rank
         FROM qs q CROSS JOIN vcat c LEFT JOIN qsim ON qsim.user_id = q.user_id AND qsim.product_id = c.product_id
         ANTI JOIN (SELECT DISTINCT user_id, product_id FROM interactions WHERE event_type = 'purchase') hx
           ON hx.user_id = q.user_id AND hx.product_id = c.product_id QUALIFY rank <= 25)"""

_POOL = HYBRID_POOL.replace("UNION ALL SELECT user_id, product_id, 2, rank FROM strec",
                            "UNION ALL SELECT user_id, product_id, 2, rank FROM qrec UNION ALL SELECT user_id, product_id, 3, rank FROM strec")
_FEATURES = HYBRID_FEATURES.replace("greatest(coalesce(hh.hmax, 0.0), 0.0) AS emb", "greatest(coalesce(hh.hmax, 0.0), coalesce(qm.s, 0.0)) AS emb") \
    .replace("LEFT JOIN price_profile pp_", "LEFT JOIN qsim qm ON qm.user_id = pl.user_id AND qm.product_id = pl.product_id\n       LEFT JOIN price_profile pp_")
_TOPK = SQL["hybrid_topk"]
SQL["hybrid_query_topk"] = W(CF_PRED, ITEM_STATS, VCAT, SEEDS, PRICE_PROFILE, SHARES, QUERY_TEXT, _POOL, _FEATURES) + \
    _TOPK[_TOPK.rindex("SELECT user_id, rank, product_id, title"):]

SQL["vector_store_runs"] = W("""changed AS (SELECT product_id, description || CASE WHEN product_id % 10 = 0 THEN ' New.' ELSE '' END AS description
                                            FROM catalog)""",
                             """n AS (SELECT count(*) AS products FROM catalog)""") + """
SELECT 1 AS run, (SELECT count(DISTINCT description) FROM catalog) AS encoded, products, products AS vectors FROM n
UNION ALL SELECT 2, (SELECT count(DISTINCT description) FROM changed WHERE description NOT IN (SELECT description FROM catalog)),
                 products, products FROM n
UNION ALL SELECT 3, 0, products, products FROM n"""

SQL["embedding_report"] = f"""
SELECT 'pair_stats' AS section, pair_class AS key, metric, round(value, 6) AS value
FROM (UNPIVOT (SELECT * REPLACE (CAST(count AS DOUBLE) AS count) FROM ({SQL["pair_stats"]}))
      ON COLUMNS(* EXCLUDE (pair_class)) INTO NAME metric VALUE value)
UNION ALL SELECT 'retrieval', 'full', metric, round(value, 6) FROM ({SQL["retrieval_metrics"]})"""

SQL["catalog_vector_gaps"] = W() + """
SELECT c.category, count(*) AS ids, count(*) FILTER (WHERE e.vec_id IS NULL) AS without_vector,
       count(*) FILTER (WHERE c.product_id IS NULL) AS without_product
FROM catalog c FULL OUTER JOIN embeddings e ON e.vec_id = c.product_id GROUP BY c.category"""

SQL["cf_predictions"] = W(CF_PRED, """rng AS (SELECT min(p) AS lo, max(p) AS hi FROM pred WHERE NOT seen)""") + """
SELECT user_id, product_id, round(CASE WHEN hi <= lo THEN 0.0 ELSE (p - lo) / (hi - lo) END, 6) AS cf_score
FROM pred CROSS JOIN rng WHERE NOT seen AND p <> 0"""

SQL["attribute_search"] = W(VCAT, """fs AS (
  SELECT q.product_id AS qid, c.product_id, list_inner_product(q.vec, c.vec) AS sc
  FROM vcat q JOIN vcat c ON c.product_id <> q.product_id
  WHERE CASE q.product_id % 4
    WHEN 0 THEN lower(trim(c.style)) = lower(trim(q.style)) AND lower(trim(c.color)) = lower(trim(q.color))
                AND list_inner_product(q.vec, c.vec) >= 0.0
    WHEN 1 THEN lower(trim(c.material)) = lower(trim(q.material)) AND c.price >= q.price - 20
    WHEN 2 THEN list_inner_product(q.vec, c.vec) >= 0.2
    ELSE lower(trim(c.category)) = lower(trim(q.category)) AND lower(trim(c.style)) = lower(trim(q.style))
         AND lower(trim(c.material)) = lower(trim(q.material)) AND lower(trim(c.color)) = lower(trim(q.color))
         AND c.price <= q.price + 200 END)""",
    """fr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(sc, 9) DESC, product_id) AS rank FROM fs)""") + """
SELECT fr.qid AS query_id, CAST(fr.rank AS BIGINT) AS rank, round(fr.sc, 4) AS score, c.product_id, c.title, c.category,
       c.style, c.color, c.material, round(c.price, 6) AS price, round(c.rating, 6) AS rating, c.description,
       c.catalog_description
FROM fr JOIN catalog c ON c.product_id = fr.product_id WHERE fr.rank <= 5"""

SQL["user_content_recs_filtered"] = W(VCAT,
    """pur AS (SELECT b.user_id, b.product_id AS source_id, v.vec, v.category AS cat0,
                      row_number() OVER (PARTITION BY b.user_id ORDER BY b.timestamp, b.product_id) AS pos
               FROM behavior b JOIN vcat v ON v.product_id = b.product_id WHERE b.event_type = 'purchase')""",
    """um AS (SELECT user_id, count(*) AS m, min(cat0) FILTER (WHERE pos = 1) AS cat0 FROM pur GROUP BY user_id)""",
    """ncat AS (SELECT count(*) AS n FROM vcat)""",
    """sc AS (SELECT p.user_id, p.pos, p.source_id, c.product_id AS cand, list_inner_product(p.vec, c.vec) AS s, um.m
              FROM pur p JOIN um ON um.user_id = p.user_id JOIN vcat c
                ON (p.user_id % 2 <> 0 OR lower(trim(c.category)) = lower(trim(um.cat0)))
               AND (p.user_id % 3 <> 0 OR c.price >= 100)
               AND (p.user_id % 5 <> 0 OR list_inner_product(p.vec, c.vec) >= 0.05))""",
    """exs AS (SELECT a.* FROM sc a ANTI JOIN pur x ON x.user_id = a.user_id AND x.source_id = a.cand)""",
    """rk AS (SELECT *, row_number() OVER (PARTITION BY user_id, pos ORDER BY round(s, 9) DESC, cand) AS at_ FROM exs)""",
    """agg AS (SELECT user_id, cand, max(s) AS smax, count(*) AS cnt, sum(s) / count(*) AS mean,
                      string_agg(CAST(source_id AS VARCHAR), ',' ORDER BY pos) AS srcs
               FROM rk CROSS JOIN ncat WHERE at_ <= least(n, greatest(50, 5 + m)) GROUP BY user_id, cand)""",
    """fin AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY round(smax, 9) DESC, cnt DESC, round(mean, 9) DESC,
                      cand) AS rank FROM agg)""") + """
SELECT user_id, CAST(rank AS BIGINT) AS rank, cand AS product_id, round(smax, 4) AS score, round(mean, 4) AS mean_score,
       CAST(cnt AS BIGINT) AS support_count, srcs AS matched_from_product_ids
FROM fin WHERE rank <= 5"""

# --- inverted file: the same seeded start and rounds of k-means, probes by the nearest centroids ---

_ROUNDS = 3
_LLOYD = []
for _i in range(_ROUNDS):
    _LLOYD += [
        f"""a{_i} AS (SELECT v.product_id, v.vec, c.cell FROM vcat v CROSS JOIN c{_i} c
              QUALIFY row_number() OVER (PARTITION BY v.product_id ORDER BY list_inner_product(v.vec, c.vec) DESC, c.cell) = 1)""",
        f"""m{_i} AS (SELECT cell, list(s ORDER BY j) AS vec FROM (SELECT cell, j, avg(vec[j]) AS s FROM a{_i} CROSS JOIN
                (SELECT unnest(range(1, (SELECT max(len(vec)) + 1 FROM vcat))) AS j) GROUP BY cell, j) GROUP BY cell)""",
        f"""c{_i + 1} AS (SELECT c.cell, coalesce(list_transform(m.vec,
                lambda x: x / greatest(sqrt(list_inner_product(m.vec, m.vec)), 1e-12)), c.vec) AS vec
              FROM c{_i} c LEFT JOIN m{_i} m ON m.cell = c.cell)"""]
IVF = ("""ns AS (SELECT count(*) AS n, CAST(round(sqrt(count(*))) AS INT) AS k FROM vcat)""",
       """c0 AS (SELECT CAST(r - 1 AS INT) AS cell, vec FROM (SELECT vec, row_number() OVER (ORDER BY md5('42:' || product_id),
                 product_id) AS r FROM vcat) WHERE r <= (SELECT k FROM ns))""", *_LLOYD,
       f"""probed AS MATERIALIZED (SELECT v.product_id AS id, v.vec, c.cell, row_number() OVER (PARTITION BY v.product_id
                 ORDER BY list_inner_product(v.vec, c.vec) DESC, c.cell) - 1 AS pos FROM vcat v CROSS JOIN c{_ROUNDS} c)""",
       """home AS (SELECT id, vec, cell FROM probed WHERE pos = 0)""",
       """truth AS (SELECT q, n FROM (SELECT a.product_id AS q, b.product_id AS n, row_number() OVER (PARTITION BY a.product_id
                 ORDER BY round(list_inner_product(a.vec, b.vec), 9) DESC, b.product_id) AS r
                 FROM vcat a JOIN vcat b ON a.product_id <> b.product_id) WHERE r <= 10)""",
       """hits AS (SELECT t.q, p.pos FROM truth t JOIN home h ON h.id = t.n JOIN probed p ON p.id = t.q AND p.cell = h.cell)""",
       """settings AS (SELECT CAST(pow(2, i) AS BIGINT) AS probes FROM range(0, 40) r(i), ns WHERE pow(2, i) < k
                 UNION SELECT k FROM ns)""",
       """found AS (SELECT probes, round(avg(share), 4) AS recall FROM (SELECT s.probes, h.q,
                 count(*) FILTER (WHERE h.pos < s.probes) / count(*) AS share FROM settings s CROSS JOIN hits h GROUP BY ALL) GROUP BY ALL)""",
       """members AS (SELECT cell, count(*) AS m FROM home GROUP BY cell)""",
       """work AS (SELECT s.probes, sum(m) FILTER (WHERE p.pos < s.probes) - (SELECT n FROM ns) AS pairs
                 FROM settings s CROSS JOIN probed p JOIN members x ON x.cell = p.cell GROUP BY s.probes)""",
       """best AS (SELECT min(probes) AS probes FROM found WHERE recall >= 0.9)""")

SQL["ann_recall"] = W(VCAT, *IVF) + """
SELECT CAST(k AS BIGINT) AS cells, CAST(f.probes AS BIGINT) AS probes, recall, CAST(pairs AS BIGINT) AS candidate_pairs,
       round(pairs / (n * (n - 1)), 4) AS pair_share, coalesce(f.probes = best.probes, false) AS selected
FROM found f JOIN work USING (probes) CROSS JOIN ns CROSS JOIN best"""

SQL["ann_neighbours"] = W(VCAT, *IVF) + """
SELECT query_id, neighbor_id, rank, round(s, 6) AS score FROM (
  SELECT p.id AS query_id, h.id AS neighbor_id, list_inner_product(p.vec, h.vec) AS s,
         CAST(row_number() OVER (PARTITION BY p.id ORDER BY round(list_inner_product(p.vec, h.vec), 9) DESC, h.id) AS BIGINT) AS rank
  FROM probed p CROSS JOIN best b JOIN home h ON h.cell = p.cell AND h.id <> p.id
  WHERE p.id % 20 = 0 AND p.pos < b.probes) WHERE rank <= 10"""
