"""DuckDB SQL for each registered query (the correctness oracle).

Written independently of the Spark plans from the operator definitions; the
tables ``part events orders lineitem embeddings ...`` are pre-registered
views.  Floating outputs are rounded to 6 decimals like the Spark side.
"""

from __future__ import annotations


def clean(x: str, default: str = "Unknown") -> str:
    c = f"trim(regexp_replace(replace(CAST({x} AS VARCHAR), '_', ' '), '\\s+', ' ', 'g'))"
    return (f"(CASE WHEN {x} IS NULL OR {c} = '' OR lower({c}) IN ('nan', 'none', 'null') "
            f"THEN '{default}' ELSE {c} END)")


def title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '([A-Za-z]+|[^A-Za-z]+)'), "
            f"lambda r: upper(substr(r, 1, 1)) || lower(substr(r, 2))), '')")


def capitalize(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


def price_text(p: str) -> str:
    return f"(CASE WHEN {p} = floor({p}) THEN CAST(CAST({p} AS BIGINT) AS VARCHAR) ELSE printf('%.2f', {p}) END)"


def label(x: str) -> str:
    return title(clean(x))


RAW_PRODUCTS = """raw_products AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS name, p_type AS category, p_brand AS material,
         split_part(p_name, ' ', 1) AS color, split_part(p_name, ' ', 2) AS style,
         CAST(p_retailprice AS DOUBLE) AS price, 2.5 + CAST(p_size % 26 AS DOUBLE) / 10.0 AS rating,
         p_name AS description
  FROM part)"""

CATALOG = f"""catalog AS (
  SELECT product_id, {clean('name')} AS title,
         {label('category')} AS category, {label('material')} AS material,
         {label('color')} AS color, {label('style')} AS style,
         CASE WHEN isnan(price) THEN NULL ELSE price END AS price,
         CASE WHEN isnan(rating) THEN NULL ELSE rating END AS rating,
         {label('style')} || ' ' || {label('material')} || ' ' || {label('category')} || ' in ' ||
           {label('color')} || ' color. Price: ' || {price_text('price')} || '.' AS description,
         {clean('description')} AS catalog_description
  FROM raw_products)"""

RAW_BEHAVIOR = """raw_behavior AS (
  SELECT CAST(user_id AS BIGINT) AS user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         CASE event_type WHEN 'click' THEN 'wishlist' WHEN 'signup' THEN 'cart' ELSE event_type END AS event_type,
         ts AS timestamp
  FROM events)"""

BEHAVIOR = f"""behavior AS (
  SELECT user_id, product_id, lower({clean('event_type', 'view')}) AS event_type, timestamp FROM raw_behavior)"""

INTERACTIONS = """interactions AS (
  SELECT *, CASE event_type WHEN 'view' THEN 3.0 WHEN 'wishlist' THEN 5.0 WHEN 'cart' THEN 7.0
                            WHEN 'purchase' THEN 20.0 ELSE 0.0 END::DOUBLE AS score
  FROM behavior)"""

ORDER_PURCHASES = """order_purchases AS (
  SELECT CAST(o.o_custkey AS BIGINT) AS user_id, CAST(l.l_partkey AS BIGINT) AS product_id,
         'purchase' AS event_type, o.o_orderdate AS timestamp, CAST(l.l_extendedprice AS DOUBLE) AS price
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

BASE = [RAW_PRODUCTS, CATALOG, RAW_BEHAVIOR, BEHAVIOR, INTERACTIONS]


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def W(*extra: str) -> str:
    return with_(*BASE, *extra)


R6 = lambda x: f"round({x}, 6)"

SQL: dict[str, str] = {}

SQL["popularity_topk"] = W("""pop AS (SELECT product_id, CAST(sum(score) AS DOUBLE) AS popularity
                                 FROM interactions GROUP BY product_id)""") + """
SELECT CAST(row_number() OVER (ORDER BY popularity DESC, product_id) AS BIGINT) AS rank, product_id,
       round(popularity, 6) AS popularity
FROM pop ORDER BY popularity DESC, product_id LIMIT 10"""

SQL["event_scores"] = W() + "SELECT user_id, product_id, event_type, timestamp, round(score, 6) AS score FROM interactions"

SQL["product_descriptions"] = W() + """
SELECT product_id, title, category, material, color, style, round(price, 6) AS price, round(rating, 6) AS rating,
       description, catalog_description FROM catalog"""

_CLEAN_PRODUCTS = f"""cap AS (
  SELECT product_id, name, {capitalize('category')} AS category, {capitalize('material')} AS material,
         {capitalize('color')} AS color, {capitalize('style')} AS style,
         CASE WHEN isnan(price) THEN NULL ELSE price END AS price,
         CASE WHEN isnan(rating) THEN NULL ELSE rating END AS rating, description
  FROM raw_products),
fills AS (SELECT quantile_cont(price, 0.5) AS m, avg(rating) AS a FROM cap),
clean_products AS (
  SELECT DISTINCT product_id, name, category, material, color, style,
         coalesce(price, m) AS price, coalesce(rating, a) AS rating, description
  FROM cap CROSS JOIN fills)"""

SQL["clean_products"] = W(_CLEAN_PRODUCTS) + """
SELECT product_id, name, category, material, color, style, round(price, 6) AS price, round(rating, 6) AS rating,
       description FROM clean_products WHERE price > 0 AND rating <= 5"""

SQL["dedupe_events"] = W() + "SELECT DISTINCT user_id, product_id, event_type, timestamp FROM raw_behavior"

_P_COLS = [("product_id", False), ("name", False), ("category", False), ("material", False), ("color", False),
           ("style", False), ("price", True), ("rating", True), ("description", False)]
_B_COLS = [("user_id", False), ("product_id", False), ("event_type", False), ("timestamp", False)]


def _nulls(table: str, label_: str, cols) -> list[str]:
    out = []
    for c, is_double in cols:
        cond = f"{c} IS NULL OR isnan({c})" if is_double else f"{c} IS NULL"
        out.append(f"SELECT '{label_}' AS table_name, '{c}' AS column_name, "
                   f"CAST(count_if({cond}) AS BIGINT) AS null_count FROM {table}")
    return out


SQL["null_counts"] = W() + "\nUNION ALL\n".join(_nulls("raw_products", "products", _P_COLS)
                                                + _nulls("raw_behavior", "behavior", _B_COLS))


def _describe(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        v = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS column_name, CAST(count({v}) AS BIGINT) AS count, round(avg({v}), 6) AS mean,
       round(stddev_samp({v}), 6) AS std, round(min({v}), 6) AS min,
       round(quantile_cont({v}, 0.25), 6) AS p25, round(quantile_cont({v}, 0.5), 6) AS p50,
       round(quantile_cont({v}, 0.75), 6) AS p75, round(max({v}), 6) AS max FROM {table}""")
    return "\nUNION ALL\n".join(parts)


SQL["describe_price"] = W(_CLEAN_PRODUCTS, """cp AS (SELECT * FROM clean_products WHERE price > 0 AND rating <= 5)""") \
    + _describe("cp", ["product_id", "price", "rating"])

SQL["value_counts_event"] = W() + \
    "SELECT event_type, CAST(count(*) AS BIGINT) AS count FROM behavior GROUP BY event_type"

SQL["price_histogram"] = W("""b AS (SELECT min(price) AS lo, max(price) AS hi FROM raw_products
                                   WHERE price IS NOT NULL AND NOT isnan(price))""",
                           """c AS (SELECT CAST(CASE WHEN hi > lo THEN least(floor(50 * (price - lo) / (hi - lo)) + 1, 50)
                                                 ELSE 1 END AS BIGINT) AS bin, count(*) AS n
                                   FROM raw_products CROSS JOIN b WHERE price IS NOT NULL AND NOT isnan(price)
                                   GROUP BY 1)""",
                           """g AS (SELECT CAST(range + 1 AS BIGINT) AS bin FROM range(50))""") + """
SELECT g.bin, round(lo + (g.bin - 1) * ((hi - lo) / 50), 6) AS lower, round(lo + g.bin * ((hi - lo) / 50), 6) AS upper,
       CAST(coalesce(n, 0) AS BIGINT) AS count
FROM g CROSS JOIN b LEFT JOIN c ON g.bin = c.bin"""


def _rfm(source: str, ref: str) -> str:
    return f"""
SELECT user_id,
       CAST(coalesce(floor(date_diff('microsecond', last_p, TIMESTAMP '{ref} 00:00:00') / 86400000000.0), 999) AS BIGINT)
         AS recency,
       frequency, round(CAST(coalesce(monetary, 0.0) AS DOUBLE), 6) AS monetary
FROM (SELECT user_id, max(CASE WHEN event_type = 'purchase' THEN timestamp END) AS last_p,
             CAST(count_if(event_type = 'purchase') AS BIGINT) AS frequency,
             sum(CASE WHEN event_type = 'purchase' THEN price END) AS monetary
      FROM {source} GROUP BY user_id)"""


SQL["rfm_events"] = W("""j AS (SELECT b.user_id, b.event_type, b.timestamp, p.price
                              FROM behavior b LEFT JOIN raw_products p ON b.product_id = p.product_id)""") \
    + _rfm("j", "2024-01-31")
SQL["rfm_orders"] = with_(ORDER_PURCHASES) + _rfm("order_purchases", "2001-08-02")

ITEM_STATS = """istats_c AS (
  SELECT product_id,
         CAST(count_if(event_type = 'view') AS BIGINT) AS n_view,
         CAST(count_if(event_type = 'wishlist') AS BIGINT) AS n_wishlist,
         CAST(count_if(event_type = 'cart') AS BIGINT) AS n_cart,
         CAST(count_if(event_type = 'purchase') AS BIGINT) AS n_purchase,
         CAST(sum(score) AS DOUBLE) AS interaction_score
  FROM interactions GROUP BY product_id),
istats_s AS (
  SELECT *, CAST(n_wishlist + n_cart + n_purchase + 1 AS DOUBLE) / CAST(n_view + n_wishlist + n_cart + n_purchase + 2 AS DOUBLE)
              AS historical_ctr,
            CAST(n_purchase + 1 AS DOUBLE) / CAST(n_view + n_wishlist + n_cart + n_purchase + 2 AS DOUBLE) AS purchase_rate
  FROM istats_c),
istats_r AS (SELECT min(interaction_score) AS lo, max(interaction_score) AS hi FROM istats_s),
item_stats AS (
  SELECT s.*, CASE WHEN hi <= lo THEN 0.0 ELSE (interaction_score - lo) / (hi - lo) END AS popularity_score
  FROM istats_s s CROSS JOIN istats_r)"""

SQL["item_stats"] = W(ITEM_STATS) + """
SELECT product_id, n_view, n_wishlist, n_cart, n_purchase, round(historical_ctr, 6) AS historical_ctr,
       round(purchase_rate, 6) AS purchase_rate, round(interaction_score, 6) AS interaction_score,
       round(popularity_score, 6) AS popularity_score FROM item_stats"""

SQL["item_stats_rank"] = W(ITEM_STATS) + """
SELECT * FROM (
  SELECT CAST(row_number() OVER (ORDER BY historical_ctr DESC, purchase_rate DESC, interaction_score DESC, product_id)
              AS BIGINT) AS rank,
         product_id, round(historical_ctr, 6) AS historical_ctr, round(purchase_rate, 6) AS purchase_rate,
         round(interaction_score, 6) AS interaction_score
  FROM item_stats) WHERE rank <= 20"""

PRICE_PROFILE = """gavg AS (SELECT avg(price) AS g FROM catalog),
pj AS (SELECT i.user_id, i.score, c.price FROM interactions i LEFT JOIN catalog c ON i.product_id = c.product_id),
pa AS (SELECT user_id, sum(score) FILTER (WHERE price IS NOT NULL) AS sw,
              sum(score * price) FILTER (WHERE price IS NOT NULL) AS swp FROM pj GROUP BY user_id),
pm AS (SELECT user_id, sw, CASE WHEN sw IS NULL OR abs(sw) <= 1e-8 THEN NULL ELSE swp / sw END AS avgp FROM pa),
pv AS (SELECT pj.user_id, sum(pj.score * (pj.price - pm.avgp) * (pj.price - pm.avgp)) / max(pm.sw) AS var
       FROM pj JOIN pm ON pj.user_id = pm.user_id WHERE pj.price IS NOT NULL AND pm.avgp IS NOT NULL
       GROUP BY pj.user_id),
price_profile AS (
  SELECT pm.user_id, coalesce(pm.avgp, g) AS avg_price,
         CASE WHEN pm.avgp IS NULL THEN greatest(g * 0.15, 1.0)
              ELSE greatest(sqrt(greatest(pv.var, 0.0)), pm.avgp * 0.15, 1.0) END AS price_std
  FROM pm LEFT JOIN pv ON pm.user_id = pv.user_id CROSS JOIN gavg)"""

SQL["user_price_profile"] = W(PRICE_PROFILE) + \
    "SELECT user_id, round(avg_price, 6) AS avg_price, round(price_std, 6) AS price_std FROM price_profile"

SHARES = """aj AS (SELECT i.user_id, i.score, c.category, c.material, c.style
               FROM interactions i LEFT JOIN catalog c ON i.product_id = c.product_id),
al AS (SELECT user_id, 'category' AS attribute, category AS value, score FROM aj
       UNION ALL SELECT user_id, 'material', material, score FROM aj
       UNION ALL SELECT user_id, 'style', style, score FROM aj),
aper AS (SELECT user_id, attribute, value, CAST(sum(score) AS DOUBLE) AS s FROM al WHERE value IS NOT NULL
         GROUP BY user_id, attribute, value),
shares AS (SELECT user_id, attribute, value,
                  s / CASE WHEN sum(s) OVER (PARTITION BY user_id, attribute) = 0 THEN 1.0
                           ELSE sum(s) OVER (PARTITION BY user_id, attribute) END AS share FROM aper)"""

SQL["attribute_share"] = W(SHARES) + "SELECT user_id, attribute, value, round(share, 6) AS share FROM shares"

FIRST_SEEN = """fs AS (
  SELECT user_id, product_id, count_if(event_type = 'purchase') AS n_p,
         count_if(event_type IN ('purchase', 'cart', 'wishlist')) AS n_h,
         min(CASE WHEN event_type = 'purchase' THEN timestamp END) AS t_p,
         min(CASE WHEN event_type IN ('purchase', 'cart', 'wishlist') THEN timestamp END) AS t_h,
         min(timestamp) AS t_a
  FROM interactions GROUP BY user_id, product_id)"""

SEEDS = FIRST_SEEN + """,
lvl AS (SELECT user_id, CASE WHEN max(n_p) > 0 THEN 1 WHEN max(n_h) > 0 THEN 2 ELSE 3 END AS level
        FROM fs GROUP BY user_id),
seedc AS (SELECT fs.*, lvl.level, CASE lvl.level WHEN 1 THEN t_p WHEN 2 THEN t_h ELSE t_a END AS t
          FROM fs JOIN lvl ON fs.user_id = lvl.user_id
          WHERE (lvl.level = 1 AND n_p > 0) OR (lvl.level = 2 AND n_h > 0) OR lvl.level = 3),
seeds AS (SELECT user_id, product_id, level,
                 CAST(row_number() OVER (PARTITION BY user_id ORDER BY t DESC NULLS FIRST, product_id DESC) AS BIGINT)
                   AS recency_rank
          FROM seedc QUALIFY recency_rank <= 5)"""

SQL["seed_items"] = W(SEEDS) + "SELECT user_id, product_id, level, recency_rank FROM seeds"

HISTORY_COUNTS = """history_counts AS (
  SELECT user_id, CAST(count(DISTINCT product_id) FILTER (WHERE event_type = 'purchase') AS BIGINT)
                    AS purchase_history_count,
         CAST(count(DISTINCT product_id) AS BIGINT) AS interaction_history_count
  FROM interactions GROUP BY user_id)"""

SQL["history_counts"] = W(HISTORY_COUNTS) + "SELECT * FROM history_counts"

SQL["user_item_mean"] = W() + """
SELECT user_id, product_id, round(avg(score), 6) AS value FROM interactions GROUP BY user_id, product_id"""
SQL["user_item_sum"] = W() + """
SELECT user_id, product_id, round(sum(score), 6) AS value FROM interactions GROUP BY user_id, product_id"""
SQL["user_means"] = W("""m AS (SELECT user_id, product_id, avg(score) AS value FROM interactions GROUP BY ALL)""") + """
SELECT user_id, round(sum(value) / (SELECT count(DISTINCT product_id) FROM m), 6) AS mean_value
FROM m GROUP BY user_id"""

# --- collaborative filtering (direct user-user / item-item forms) -------------

SQL["user_cf"] = W("""m AS (SELECT user_id, product_id, avg(score) AS v FROM interactions GROUP BY ALL)""",
                   """nrm AS (SELECT user_id, sqrt(sum(v * v)) AS nr FROM m GROUP BY user_id)""",
                   """nm AS (SELECT m.user_id, product_id, CASE WHEN nr > 0 THEN v / nr ELSE 0.0 END AS n
                             FROM m JOIN nrm ON m.user_id = nrm.user_id)""",
                   """us AS (SELECT DISTINCT user_id FROM m)""",
                   """dots AS (SELECT a.user_id AS u, b.user_id AS w, sum(a.n * b.n) AS s
                               FROM nm a JOIN nm b ON a.product_id = b.product_id AND a.user_id <> b.user_id
                               GROUP BY ALL)""",
                   """sims AS (SELECT x.user_id AS u, y.user_id AS w, coalesce(d.s, 0.0) AS s
                               FROM us x JOIN us y ON x.user_id <> y.user_id
                               LEFT JOIN dots d ON d.u = x.user_id AND d.w = y.user_id)""",
                   """nb AS (SELECT u, w FROM sims
                             QUALIFY row_number() OVER (PARTITION BY u ORDER BY round(s, 9) DESC, w) <= 5)""",
                   """its AS (SELECT DISTINCT nb.u AS user_id, m.product_id FROM nb JOIN m ON m.user_id = nb.w
                              WHERE m.v > 0)""") + """
SELECT user_id, product_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY product_id) AS BIGINT) AS rank
FROM its QUALIFY rank <= 10"""

SQL["item_cf"] = W("""m AS (SELECT user_id, product_id, avg(score) AS v FROM interactions GROUP BY ALL)""",
                   """nrm AS (SELECT product_id, sqrt(sum(v * v)) AS nr FROM m GROUP BY product_id)""",
                   """its AS (SELECT DISTINCT product_id FROM m)""",
                   """dots AS (SELECT a.product_id AS a, b.product_id AS b, sum(a.v * b.v) AS s
                               FROM m a JOIN m b ON a.user_id = b.user_id AND a.product_id <> b.product_id
                               GROUP BY ALL)""",
                   """sims AS (SELECT x.product_id AS a, y.product_id AS b,
                                      coalesce(d.s / (na.nr * nb.nr), 0.0) AS s
                               FROM its x JOIN its y ON x.product_id <> y.product_id
                               LEFT JOIN dots d ON d.a = x.product_id AND d.b = y.product_id
                               LEFT JOIN nrm na ON na.product_id = x.product_id
                               LEFT JOIN nrm nb ON nb.product_id = y.product_id)""") + """
SELECT a AS product_id, b AS similar_product_id, CAST(rank AS BIGINT) AS rank, round(s, 6) AS similarity
FROM (SELECT a, b, s, row_number() OVER (PARTITION BY a ORDER BY CASE WHEN s > 0 THEN round(s, 9) ELSE 0 END DESC, b)
                   AS rank FROM sims)
WHERE rank <= 10"""

CF_PRED = """sm AS (SELECT user_id, product_id, sum(score) AS v FROM interactions GROUP BY ALL),
cnrm AS (SELECT user_id, sqrt(sum(v * v)) AS nr FROM sm GROUP BY user_id),
cnm AS (SELECT sm.user_id, product_id, CASE WHEN nr > 0 THEN v / nr ELSE 0.0 END AS n
        FROM sm JOIN cnrm ON sm.user_id = cnrm.user_id),
S AS (SELECT a.user_id AS u, b.user_id AS w, sum(a.n * b.n) AS s
      FROM cnm a JOIN cnm b ON a.product_id = b.product_id AND a.user_id <> b.user_id GROUP BY ALL),
den AS (SELECT u, sum(s) AS d FROM S GROUP BY u),
num AS (SELECT S.u, sm.product_id AS j, sum(S.s * sm.v) AS x FROM S JOIN sm ON sm.user_id = S.w GROUP BY ALL),
cu AS (SELECT DISTINCT user_id FROM sm),
ci AS (SELECT DISTINCT product_id FROM sm),
pred AS (SELECT g.user_id, g.product_id,
                coalesce(num.x, 0.0) / greatest(coalesce(den.d, 0.0), 1e-8) AS p,
                coalesce(sm.v, 0.0) > 0 AS seen
         FROM (SELECT cu.user_id, ci.product_id FROM cu CROSS JOIN ci) g
         LEFT JOIN sm ON sm.user_id = g.user_id AND sm.product_id = g.product_id
         LEFT JOIN num ON num.u = g.user_id AND num.j = g.product_id
         LEFT JOIN den ON den.u = g.user_id)"""

SQL["cf_predict_topk"] = W(CF_PRED) + """
SELECT user_id, product_id, rank, round(p, 6) AS score FROM (
  SELECT user_id, product_id, p,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(p, 9) DESC, product_id) AS BIGINT) AS rank
  FROM pred WHERE NOT seen) WHERE rank <= 20"""

SQL["cf_scores"] = W(CF_PRED,
                     """pop AS (SELECT product_id, sum(score) AS popularity FROM interactions GROUP BY product_id)""",
                     """top AS (SELECT product_id FROM pop ORDER BY popularity DESC, product_id LIMIT 20)""",
                     """cand AS (SELECT u.user_id, t.product_id FROM (SELECT DISTINCT user_id FROM interactions) u
                                 CROSS JOIN top t)""",
                     """rng AS (SELECT min(p) AS lo, max(p) AS hi FROM pred WHERE NOT seen)""",
                     """cj AS (SELECT c.user_id, c.product_id, pr.p, pr.seen, coalesce(pop.popularity, 0.0) AS pp
                               FROM cand c LEFT JOIN pred pr ON pr.user_id = c.user_id AND pr.product_id = c.product_id
                               LEFT JOIN pop ON pop.product_id = c.product_id)""") + """
SELECT user_id, product_id,
       round(CASE WHEN p IS NOT NULL AND NOT seen THEN (CASE WHEN hi <= lo THEN 0.0 ELSE (p - lo) / (hi - lo) END)
                  ELSE (CASE WHEN max(pp) OVER (PARTITION BY user_id) <= min(pp) OVER (PARTITION BY user_id) THEN 0.0
                             ELSE (pp - min(pp) OVER (PARTITION BY user_id))
                                  / (max(pp) OVER (PARTITION BY user_id) - min(pp) OVER (PARTITION BY user_id)) END)
             END, 6) AS cf_score
FROM cj CROSS JOIN rng"""

# --- vectors and search (brute force over all pairs) ---------------------------

VCAT = """vn AS (SELECT vec_id, embedding,
                 sqrt(list_sum(list_transform(embedding, lambda y: CAST(y AS DOUBLE) * CAST(y AS DOUBLE)))) AS nr
          FROM embeddings),
vcat AS (SELECT c.*, list_transform(vn.embedding, lambda x: CAST(x AS DOUBLE) / greatest(vn.nr, 1e-12)) AS vec
         FROM catalog c JOIN vn ON c.product_id = vn.vec_id)"""

SQL["knn_exact"] = W(VCAT, """pr AS (SELECT a.product_id AS q, b.product_id AS n, list_inner_product(a.vec, b.vec) AS s
                                     FROM vcat a JOIN vcat b ON a.product_id <> b.product_id)""") + """
SELECT q AS query_id, n AS neighbor_id, rank, round(s, 6) AS score FROM (
  SELECT q, n, s, CAST(row_number() OVER (PARTITION BY q ORDER BY round(s, 9) DESC, n) AS BIGINT) AS rank FROM pr)
WHERE rank <= 10"""

PAIRS = """pairs AS (
  SELECT a.product_id AS left_id, b.product_id AS right_id, list_inner_product(a.vec, b.vec) AS score,
         a.category = b.category AS sc, a.material = b.material AS sm, a.style = b.style AS ss, a.color = b.color AS sco
  FROM vcat a JOIN vcat b ON a.product_id < b.product_id)"""

SQL["similar_pairs_top"] = W(VCAT, PAIRS) + """
SELECT left_id, right_id, round(score, 6) AS score FROM pairs
ORDER BY round(score, 9) DESC, left_id, right_id LIMIT 5"""

SQL["pair_stats"] = W(VCAT, PAIRS, """cls AS (
  SELECT 'overall' AS pair_class, score FROM pairs
  UNION ALL SELECT 'same_category', score FROM pairs WHERE sc
  UNION ALL SELECT 'structured_relevance', score FROM pairs WHERE sc AND (sm OR ss OR sco)
  UNION ALL SELECT 'exact_attribute_match', score FROM pairs WHERE sc AND sm AND ss AND sco
  UNION ALL SELECT 'different_category', score FROM pairs WHERE NOT sc)""") + """
SELECT pair_class, CAST(count(*) AS BIGINT) AS count, round(min(score), 4) AS min, round(max(score), 4) AS max,
       round(avg(score), 4) AS mean, round(stddev_pop(score), 4) AS std,
       round(quantile_cont(score, 0.1), 4) AS p10, round(quantile_cont(score, 0.25), 4) AS p25,
       round(quantile_cont(score, 0.5), 4) AS p50, round(quantile_cont(score, 0.75), 4) AS p75,
       round(quantile_cont(score, 0.9), 4) AS p90
FROM cls GROUP BY pair_class"""

SQL["filtered_search"] = W(VCAT, """fq AS (SELECT product_id AS qid, vec, lower(trim(category)) AS fc,
                                                price - 50 AS lo, price + 50 AS hi FROM vcat)""",
                           """fs AS (SELECT fq.qid, c.product_id, list_inner_product(fq.vec, c.vec) AS sc
                                     FROM fq JOIN vcat c ON lower(trim(c.category)) = fq.fc AND c.price >= fq.lo
                                          AND c.price <= fq.hi AND c.product_id <> fq.qid)""",
                           """fr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(sc, 9) DESC, product_id)
                                            AS rank FROM fs)""") + """
SELECT fr.qid AS query_id, CAST(fr.rank AS BIGINT) AS rank, round(fr.sc, 4) AS score, c.product_id, c.title, c.category,
       c.style, c.color, c.material, round(c.price, 6) AS price, round(c.rating, 6) AS rating, c.description,
       c.catalog_description
FROM fr JOIN catalog c ON c.product_id = fr.product_id WHERE fr.rank <= 5"""

SQL["user_content_recs"] = W(VCAT,
    """pur AS (SELECT DISTINCT user_id, product_id AS source_id FROM interactions WHERE event_type = 'purchase')""",
    """um AS (SELECT user_id, count(*) AS m FROM pur GROUP BY user_id)""",
    """ncat AS (SELECT count(*) AS n FROM vcat)""",
    """allsc AS (SELECT p.user_id, p.source_id, c.product_id AS cand, list_inner_product(v.vec, c.vec) AS s
                 FROM pur p JOIN vcat v ON v.product_id = p.source_id CROSS JOIN vcat c)""",
    """exs AS (SELECT a.* FROM allsc a ANTI JOIN pur x ON x.user_id = a.user_id AND x.source_id = a.cand)""",
    """rk AS (SELECT exs.*, row_number() OVER (PARTITION BY user_id, source_id ORDER BY round(s, 9) DESC, cand) AS pos
              FROM exs)""",
    """kept AS (SELECT rk.* FROM rk JOIN um ON rk.user_id = um.user_id CROSS JOIN ncat
                WHERE pos <= least(n, greatest(50, 5 + m)))""",
    """agg AS (SELECT user_id, cand, max(s) AS smax, sum(s) AS ssum, count(*) AS cnt,
                      string_agg(CAST(source_id AS VARCHAR), ',' ORDER BY CAST(source_id AS VARCHAR)) AS srcs
               FROM kept GROUP BY user_id, cand)""",
    """fin AS (SELECT *, ssum / cnt AS mean,
                      row_number() OVER (PARTITION BY user_id ORDER BY round(smax, 9) DESC, cnt DESC,
                                         round(ssum / cnt, 9) DESC, cand) AS rank FROM agg)""") + """
SELECT user_id, CAST(rank AS BIGINT) AS rank, cand AS product_id, round(smax, 4) AS score,
       round(mean, 4) AS mean_score, CAST(cnt AS BIGINT) AS support_count, srcs AS matched_from_product_ids
FROM fin WHERE rank <= 5"""

# --- metrics --------------------------------------------------------------------

SQL["precision_recall_map"] = W(ITEM_STATS,
    """top10 AS (SELECT product_id, row_number() OVER (ORDER BY historical_ctr DESC, purchase_rate DESC,
                                                      interaction_score DESC, product_id) AS rank
                 FROM item_stats QUALIFY rank <= 10)""",
    """pred AS (SELECT u.user_id, t.product_id, t.rank FROM (SELECT DISTINCT user_id FROM interactions) u
                CROSS JOIN top10 t)""",
    """act AS (SELECT DISTINCT user_id, product_id FROM interactions WHERE event_type = 'purchase')""",
    """na AS (SELECT user_id, count(*) AS n FROM act GROUP BY user_id)""",
    """ph AS (SELECT p.user_id, p.rank, CASE WHEN a.product_id IS NULL THEN 0 ELSE 1 END AS hit
              FROM pred p LEFT JOIN act a ON a.user_id = p.user_id AND a.product_id = p.product_id)""",
    """pc AS (SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS cum FROM ph)""",
    """per AS (SELECT user_id, sum(hit) AS hits, sum(CASE WHEN hit = 1 THEN cum / rank END) AS aps
               FROM pc GROUP BY user_id)""") + """
SELECT na.user_id, round(coalesce(hits, 0) / 10.0, 6) AS precision_at_k, round(coalesce(hits, 0) / n, 6) AS recall_at_k,
       round(coalesce(aps, 0.0) / least(n, 10), 6) AS ap_at_k
FROM na LEFT JOIN per ON na.user_id = per.user_id"""

SQL["rmse"] = W("""m AS (SELECT user_id, product_id, avg(score) AS v FROM interactions GROUP BY ALL)""",
                """um AS (SELECT user_id, sum(v) / (SELECT count(DISTINCT product_id) FROM m) AS mv
                          FROM m GROUP BY user_id)""") + """
SELECT round(sqrt(avg(pow(v - mv, 2))), 6) AS rmse FROM m JOIN um ON m.user_id = um.user_id"""

RETRIEVAL = """rpr AS (
  SELECT a.product_id AS q, b.product_id AS n, list_inner_product(a.vec, b.vec) AS s,
         CAST(a.category = b.category AS INTEGER) AS sc,
         CAST(a.category = b.category AND (a.material = b.material OR a.style = b.style OR a.color = b.color) AS INTEGER)
           AS hit,
         CAST(a.category = b.category AND a.material = b.material AND a.style = b.style AND a.color = b.color AS INTEGER)
           AS ex,
         CAST(a.category = b.category AS INTEGER) + CAST(a.material = b.material AS INTEGER)
           + CAST(a.style = b.style AS INTEGER) + CAST(a.color = b.color AS INTEGER) AS ov
  FROM vcat a JOIN vcat b ON a.product_id <> b.product_id),
rrk AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY round(s, 9) DESC, n) AS rank,
               row_number() OVER (PARTITION BY q ORDER BY ov DESC, n) AS irank FROM rpr),
perq AS (
  SELECT q, sum(hit) AS total_rel, sum(ex) AS total_exact,
         sum(hit) FILTER (WHERE rank <= 5) AS h5, sum(sc) FILTER (WHERE rank <= 5) AS c5,
         sum(s) FILTER (WHERE rank <= 5) AS s5, count(*) FILTER (WHERE rank <= 5) AS n5,
         sum(ov) FILTER (WHERE rank <= 5) AS o5,
         sum(hit) FILTER (WHERE rank <= 10) AS h10, sum(sc) FILTER (WHERE rank <= 10) AS c10,
         sum(s) FILTER (WHERE rank <= 10) AS s10, count(*) FILTER (WHERE rank <= 10) AS n10,
         sum(ov) FILTER (WHERE rank <= 10) AS o10,
         min(rank) FILTER (WHERE hit = 1 AND rank <= 10) AS fh,
         sum((pow(2.0, ov) - 1) / log2(rank + 1.0)) FILTER (WHERE rank <= 10) AS dcg,
         sum((pow(2.0, ov) - 1) / log2(irank + 1.0)) FILTER (WHERE irank <= 10) AS idcg
  FROM rrk GROUP BY q)"""

_RM = [("queries_with_relevant_neighbors", "CAST(count(*) FILTER (WHERE total_rel > 0) AS DOUBLE)"),
       ("average_relevant_neighbors_per_query", "avg(total_rel)"),
       ("average_exact_attribute_matches_per_query", "avg(total_exact)")]
for _k in (5, 10):
    _RM += [(f"precision_at_{_k}", f"avg(h{_k} / {_k}.0)"),
            (f"recall_at_{_k}", f"avg(CASE WHEN total_rel > 0 THEN h{_k} / total_rel END)"),
            (f"category_match_rate_at_{_k}", f"sum(c{_k}) / sum(n{_k})"),
            (f"mean_similarity_at_{_k}", f"sum(s{_k}) / sum(n{_k})"),
            (f"mean_attribute_overlap_at_{_k}", f"sum(o{_k}) / sum(n{_k})")]
_RM += [("mrr_at_10", "avg(coalesce(1.0 / fh, 0.0))"),
        ("ndcg_at_10", "avg(CASE WHEN idcg = 0 OR idcg IS NULL THEN 0.0 ELSE dcg / idcg END)")]

SQL["retrieval_metrics"] = W(VCAT, RETRIEVAL) + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS metric, round(CAST({expr} AS DOUBLE), 4) AS value FROM perq" for name, expr in _RM)

SQL["mrr_ndcg"] = W(VCAT, RETRIEVAL) + """
SELECT q AS query_id, round(coalesce(1.0 / fh, 0.0), 6) AS reciprocal_rank,
       round(CASE WHEN idcg = 0 OR idcg IS NULL THEN 0.0 ELSE coalesce(dcg, 0.0) / idcg END, 6) AS ndcg_at_10
FROM perq"""

SQL["diversity"] = W(VCAT, SEEDS,
    """sv AS (SELECT s.user_id, s.recency_rank AS r, v.vec FROM seeds s JOIN vcat v ON v.product_id = s.product_id)""",
    """dv AS (SELECT a.user_id, avg(1.0 - list_inner_product(a.vec, b.vec)) AS d
              FROM sv a JOIN sv b ON a.user_id = b.user_id AND a.r < b.r GROUP BY a.user_id)""") + """
SELECT u.user_id, round(coalesce(dv.d, 0.0), 6) AS diversity
FROM (SELECT DISTINCT user_id FROM seeds) u LEFT JOIN dv ON dv.user_id = u.user_id"""

# --- ranking dataset -------------------------------------------------------------

HOLDOUT = """hp AS (SELECT user_id, product_id, timestamp FROM behavior WHERE event_type = 'purchase'),
hpp AS (SELECT user_id, product_id, count(*) AS n FROM hp GROUP BY ALL),
hpu AS (SELECT user_id, count(*) AS np FROM hpp GROUP BY user_id),
honce AS (SELECT hpp.user_id, hpp.product_id FROM hpp JOIN hpu ON hpp.user_id = hpu.user_id
          WHERE n = 1 AND np >= 2),
targets AS (SELECT hp.user_id, hp.product_id AS target_product_id, hp.timestamp AS cutoff_timestamp
            FROM hp JOIN honce ON hp.user_id = honce.user_id AND hp.product_id = honce.product_id
            QUALIFY row_number() OVER (PARTITION BY hp.user_id ORDER BY hp.timestamp DESC NULLS LAST,
                                       hp.product_id) = 1)"""

SQL["holdout_targets"] = W(HOLDOUT) + "SELECT user_id, target_product_id, cutoff_timestamp FROM targets"

SQL["truncated_events"] = W(HOLDOUT) + """
SELECT b.user_id, b.product_id, b.event_type, b.timestamp
FROM behavior b LEFT JOIN targets t ON b.user_id = t.user_id
WHERE t.cutoff_timestamp IS NULL OR b.timestamp < t.cutoff_timestamp"""

# --- hybrid heuristic top-k (R18-R22) ---------------------------------------------

from recflow.functions.weights import DEFAULT_SIGNAL_WEIGHTS  # noqa: E402

_W = {k: v / sum(DEFAULT_SIGNAL_WEIGHTS.values()) for k, v in DEFAULT_SIGNAL_WEIGHTS.items()}

HYBRID_POOL = """husers AS (SELECT DISTINCT user_id FROM interactions),
hex AS (SELECT DISTINCT user_id, product_id FROM interactions WHERE event_type = 'purchase'),
cfrec AS (SELECT pred.user_id, pred.product_id,
                 row_number() OVER (PARTITION BY pred.user_id ORDER BY round(pred.p, 9) DESC, pred.product_id) AS rank
          FROM pred ANTI JOIN hex ON hex.user_id = pred.user_id AND hex.product_id = pred.product_id
          WHERE NOT pred.seen QUALIFY rank <= 25),
sv AS (SELECT s.user_id, v.vec FROM seeds s JOIN vcat v ON v.product_id = s.product_id),
hsc AS (SELECT sv.user_id, c.product_id, max(list_inner_product(sv.vec, c.vec)) AS mx,
               avg(list_inner_product(sv.vec, c.vec)) AS mn
        FROM sv CROSS JOIN vcat c GROUP BY sv.user_id, c.product_id),
ctrec AS (SELECT hsc.user_id, hsc.product_id,
                 row_number() OVER (PARTITION BY hsc.user_id ORDER BY round(mx, 9) DESC, round(mn, 9) DESC,
                                    hsc.product_id) AS rank
          FROM hsc ANTI JOIN hex ON hex.user_id = hsc.user_id AND hex.product_id = hsc.product_id
          WHERE mx >= 0 QUALIFY rank <= 25
          UNION ALL
          SELECT u.user_id, c.product_id, row_number() OVER (PARTITION BY u.user_id ORDER BY c.product_id) AS rank
          FROM (SELECT user_id FROM husers WHERE user_id NOT IN (SELECT user_id FROM sv)) u CROSS JOIN vcat c
          ANTI JOIN hex ON hex.user_id = u.user_id AND hex.product_id = c.product_id
          QUALIFY rank <= 25),
strank AS (SELECT product_id, row_number() OVER (ORDER BY historical_ctr DESC, purchase_rate DESC,
                                                 interaction_score DESC, product_id) AS g FROM item_stats),
strec AS (SELECT u.user_id, s.product_id, row_number() OVER (PARTITION BY u.user_id ORDER BY s.g) AS rank
          FROM husers u CROSS JOIN strank s ANTI JOIN hex ON hex.user_id = u.user_id AND hex.product_id = s.product_id
          QUALIFY rank <= 12),
hun AS (SELECT user_id, product_id, 0 AS src, rank FROM cfrec
        UNION ALL SELECT user_id, product_id, 1, rank FROM ctrec
        UNION ALL SELECT user_id, product_id, 2, rank FROM strec),
pool AS (SELECT user_id, product_id FROM (
           SELECT user_id, product_id, min(src * 1000000 + rank) AS o FROM hun GROUP BY user_id, product_id)
         QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY o) <= 50)"""

HYBRID_FEATURES = f"""hrng AS (SELECT min(p) AS lo, max(p) AS hi FROM pred WHERE NOT seen),
hpop AS (SELECT product_id, sum(score) AS popularity FROM interactions GROUP BY product_id),
hmean_ctr AS (SELECT avg(historical_ctr) AS mc FROM item_stats),
hhist AS (SELECT pl.user_id, pl.product_id, max(list_inner_product(sv.vec, c.vec)) AS hmax
          FROM pool pl JOIN sv ON sv.user_id = pl.user_id JOIN vcat c ON c.product_id = pl.product_id
          GROUP BY pl.user_id, pl.product_id),
fj AS (SELECT pl.user_id, pl.product_id, c.title, c.category, c.material, c.style, c.price,
              pr.p, pr.seen, coalesce(hp.popularity, 0.0) AS pp, greatest(coalesce(hh.hmax, 0.0), 0.0) AS emb,
              coalesce(pp_.avg_price, gv.g) AS avg_price,
              coalesce(pp_.price_std, greatest(coalesce(pp_.avg_price, gv.g) * 0.15, 1.0)) AS price_std,
              coalesce(ist.historical_ctr, hmc.mc) AS ctr,
              coalesce(sc.share, 0.0) AS cat_s, coalesce(sm_.share, 0.0) AS mat_s, coalesce(ss.share, 0.0) AS sty_s
       FROM pool pl
       LEFT JOIN vcat c ON c.product_id = pl.product_id
       LEFT JOIN pred pr ON pr.user_id = pl.user_id AND pr.product_id = pl.product_id
       LEFT JOIN hpop hp ON hp.product_id = pl.product_id
       LEFT JOIN hhist hh ON hh.user_id = pl.user_id AND hh.product_id = pl.product_id
       LEFT JOIN price_profile pp_ ON pp_.user_id = pl.user_id
       LEFT JOIN item_stats ist ON ist.product_id = pl.product_id
       LEFT JOIN shares sc ON sc.user_id = pl.user_id AND sc.attribute = 'category' AND sc.value = c.category
       LEFT JOIN shares sm_ ON sm_.user_id = pl.user_id AND sm_.attribute = 'material' AND sm_.value = c.material
       LEFT JOIN shares ss ON ss.user_id = pl.user_id AND ss.attribute = 'style' AND ss.value = c.style
       CROSS JOIN hmean_ctr hmc CROSS JOIN gavg gv),
hfs AS (SELECT fj.*,
              CASE WHEN p IS NOT NULL AND NOT seen THEN (CASE WHEN hi <= lo THEN 0.0 ELSE (p - lo) / (hi - lo) END)
                   ELSE (CASE WHEN max(pp) OVER (PARTITION BY user_id) <= min(pp) OVER (PARTITION BY user_id) THEN 0.0
                              ELSE (pp - min(pp) OVER (PARTITION BY user_id))
                                   / (max(pp) OVER (PARTITION BY user_id) - min(pp) OVER (PARTITION BY user_id)) END)
              END AS cf_score,
              exp(-abs(price - avg_price) / greatest(price_std, 1.0)) AS pm
       FROM fj CROSS JOIN hrng),
hf AS (SELECT hfs.*, {_W['cf']!r} * cf_score + {_W['embedding']!r} * (CASE WHEN emb >= 0.0 THEN emb ELSE 0.0 END)
                    + {_W['price']!r} * pm + {_W['style']!r} * sty_s + {_W['ctr']!r} * ctr AS hybrid
       FROM hfs)"""

SQL["hybrid_topk"] = W(CF_PRED, ITEM_STATS, VCAT, SEEDS, PRICE_PROFILE, SHARES, HYBRID_POOL, HYBRID_FEATURES) + """
SELECT user_id, rank, product_id, title, category, material, style, round(price, 6) AS price,
       round(cf_score, 6) AS cf_score, round(emb, 6) AS embedding_similarity,
       round(pm, 6) AS price_sensitivity_match, round(ctr, 6) AS historical_ctr,
       round(hybrid, 6) AS hybrid_signal_score, round(hybrid, 6) AS ltr_score
FROM (SELECT hf.*, CAST(row_number() OVER (PARTITION BY user_id ORDER BY round(hybrid, 9) DESC, round(ctr, 9) DESC,
                                           round(cf_score, 9) DESC, product_id) AS BIGINT) AS rank FROM hf)
WHERE rank <= 5"""

# --- training candidates (M18 hard part) on the truncated history ----------------

TRUNC_INTERACTIONS = """interactions AS (
  SELECT b.*, CASE b.event_type WHEN 'view' THEN 3.0 WHEN 'wishlist' THEN 5.0 WHEN 'cart' THEN 7.0
                                WHEN 'purchase' THEN 20.0 ELSE 0.0 END::DOUBLE AS score
  FROM behavior b LEFT JOIN targets t ON b.user_id = t.user_id
  WHERE t.cutoff_timestamp IS NULL OR b.timestamp < t.cutoff_timestamp)"""

HARD = """tex AS (SELECT DISTINCT i.user_id, i.product_id FROM interactions i JOIN targets t ON t.user_id = i.user_id
             WHERE i.event_type = 'purchase' AND i.product_id <> t.target_product_id),
tpop AS (SELECT product_id, sum(score) AS popularity FROM interactions GROUP BY product_id),
tcf AS (SELECT pred.user_id, pred.product_id,
               row_number() OVER (PARTITION BY pred.user_id ORDER BY round(pred.p, 9) DESC, pred.product_id) AS rank
        FROM pred JOIN targets t ON t.user_id = pred.user_id
        ANTI JOIN tex ON tex.user_id = pred.user_id AND tex.product_id = pred.product_id
        WHERE NOT pred.seen QUALIFY rank <= 25
        UNION ALL
        SELECT t.user_id, tp.product_id,
               row_number() OVER (PARTITION BY t.user_id ORDER BY tp.popularity DESC, tp.product_id) AS rank
        FROM targets t CROSS JOIN tpop tp
        ANTI JOIN tex ON tex.user_id = t.user_id AND tex.product_id = tp.product_id
        WHERE t.user_id NOT IN (SELECT user_id FROM sm) QUALIFY rank <= 25),
tsv AS (SELECT s.user_id, v.vec FROM seeds s JOIN targets t ON t.user_id = s.user_id
        JOIN vcat v ON v.product_id = s.product_id),
thsc AS (SELECT tsv.user_id, c.product_id, max(list_inner_product(tsv.vec, c.vec)) AS mx,
                avg(list_inner_product(tsv.vec, c.vec)) AS mn
         FROM tsv CROSS JOIN vcat c GROUP BY tsv.user_id, c.product_id),
tct AS (SELECT thsc.user_id, thsc.product_id,
               row_number() OVER (PARTITION BY thsc.user_id ORDER BY round(mx, 9) DESC, round(mn, 9) DESC,
                                  thsc.product_id) AS rank
        FROM thsc ANTI JOIN tex ON tex.user_id = thsc.user_id AND tex.product_id = thsc.product_id
        WHERE mx >= 0 QUALIFY rank <= 25
        UNION ALL
        SELECT t.user_id, c.product_id, row_number() OVER (PARTITION BY t.user_id ORDER BY c.product_id) AS rank
        FROM (SELECT user_id FROM targets WHERE user_id NOT IN (SELECT user_id FROM tsv)) t CROSS JOIN vcat c
        ANTI JOIN tex ON tex.user_id = t.user_id AND tex.product_id = c.product_id
        QUALIFY rank <= 25),
tst AS (SELECT t.user_id, s.product_id, s.g AS rank
        FROM targets t CROSS JOIN (SELECT product_id, row_number() OVER (ORDER BY historical_ctr DESC,
                                   purchase_rate DESC, interaction_score DESC, product_id) AS g FROM item_stats) s
        WHERE s.g <= 10),
tun AS (SELECT user_id, target_product_id AS product_id, 0 AS src, 1 AS rank FROM targets
        UNION ALL SELECT user_id, product_id, 1, rank FROM tcf
        UNION ALL SELECT user_id, product_id, 2, rank FROM tct
        UNION ALL SELECT user_id, product_id, 3, rank FROM tst),
hard AS (SELECT user_id, product_id,
                CAST(row_number() OVER (PARTITION BY user_id ORDER BY o) AS BIGINT) AS position,
                CAST(o // 1000000 AS INTEGER) AS source
         FROM (SELECT user_id, product_id, min(src * 1000000 + rank) AS o FROM tun GROUP BY user_id, product_id))"""

SQL["ranking_candidates_hard"] = with_(RAW_PRODUCTS, CATALOG, RAW_BEHAVIOR, BEHAVIOR, HOLDOUT, TRUNC_INTERACTIONS,
                                       CF_PRED, ITEM_STATS, VCAT, SEEDS, HARD) + \
    "SELECT user_id, product_id, position, source FROM hard"

SQL["hybrid_features_hard"] = with_(
    RAW_PRODUCTS, CATALOG, RAW_BEHAVIOR, BEHAVIOR, HOLDOUT, TRUNC_INTERACTIONS, CF_PRED, ITEM_STATS, VCAT, SEEDS,
    PRICE_PROFILE, SHARES, HISTORY_COUNTS, HARD,
    """pool AS (SELECT user_id, product_id FROM hard)""",
    """sv AS (SELECT s.user_id, v.vec FROM seeds s JOIN vcat v ON v.product_id = s.product_id)""",
    HYBRID_FEATURES) + """
SELECT hf.user_id, hf.product_id, CAST(hf.product_id = t.target_product_id AS INTEGER) AS label,
       round(cf_score, 6) AS cf_score, round(emb, 6) AS embedding_similarity,
       round(price - avg_price, 6) AS price_delta_from_user_avg, round(pm, 6) AS price_sensitivity_match,
       round(cat_s, 6) AS category_match_score, round(mat_s, 6) AS material_preference_score,
       round(sty_s, 6) AS style_affinity_score, round(ctr, 6) AS historical_ctr,
       coalesce(hc.purchase_history_count, 0) AS purchase_history_count,
       coalesce(hc.interaction_history_count, 0) AS interaction_history_count,
       round(hybrid, 6) AS hybrid_signal_score
FROM hf JOIN targets t ON t.user_id = hf.user_id LEFT JOIN history_counts hc ON hc.user_id = hf.user_id"""

from recflow.operators.sweep import draw_configs as _draw  # noqa: E402

_CFG_ROWS = ",\n".join(
    f"({c['config_id']}, {c['w_cf']!r}, {c['w_embedding']!r}, {c['w_price']!r}, {c['w_style']!r}, {c['w_ctr']!r}, "
    f"{c['similarity_threshold']!r})" for c in _draw(20, 42))

SQL["signal_sweep_hard"] = with_(
    RAW_PRODUCTS, CATALOG, RAW_BEHAVIOR, BEHAVIOR, HOLDOUT, TRUNC_INTERACTIONS, CF_PRED, ITEM_STATS, VCAT, SEEDS,
    PRICE_PROFILE, SHARES, HARD,
    """pool AS (SELECT user_id, product_id FROM hard)""",
    """sv AS (SELECT s.user_id, v.vec FROM seeds s JOIN vcat v ON v.product_id = s.product_id)""",
    HYBRID_FEATURES,
    f"""cfgs AS (SELECT * FROM (VALUES {_CFG_ROWS}) AS v(config_id, w_cf, w_embedding, w_price, w_style, w_ctr,
                                                       similarity_threshold))""",
    """sx AS (SELECT c.config_id, hf.user_id, hf.product_id,
                     CAST(hf.product_id = t.target_product_id AS DOUBLE) AS label,
                     c.w_cf * hf.cf_score
                     + c.w_embedding * (CASE WHEN hf.emb >= c.similarity_threshold THEN hf.emb ELSE 0.0 END)
                     + c.w_price * hf.pm + c.w_style * hf.sty_s + c.w_ctr * hf.ctr AS h
              FROM hf JOIN targets t ON t.user_id = hf.user_id CROSS JOIN cfgs c)""",
    """sr AS (SELECT *, row_number() OVER (PARTITION BY config_id, user_id ORDER BY round(h, 9) DESC, product_id) AS rk,
                    row_number() OVER (PARTITION BY config_id, user_id ORDER BY label DESC, product_id) AS irk
              FROM sx)""",
    """sper AS (SELECT config_id, user_id,
                       coalesce(sum(label) FILTER (WHERE rk <= 5), 0) AS pos5,
                       coalesce(sum((pow(2.0, label) - 1) / log2(rk + 1.0)) FILTER (WHERE rk <= 5), 0) AS dcg5,
                       coalesce(sum((pow(2.0, label) - 1) / log2(irk + 1.0)) FILTER (WHERE irk <= 5), 0) AS idcg5,
                       coalesce(sum(label) FILTER (WHERE rk <= 10), 0) AS pos10,
                       coalesce(sum((pow(2.0, label) - 1) / log2(rk + 1.0)) FILTER (WHERE rk <= 10), 0) AS dcg10,
                       coalesce(sum((pow(2.0, label) - 1) / log2(irk + 1.0)) FILTER (WHERE irk <= 10), 0) AS idcg10
                FROM sr GROUP BY config_id, user_id)""") + """
SELECT c.config_id, round(c.w_cf, 6) AS w_cf, round(c.w_embedding, 6) AS w_embedding, round(c.w_price, 6) AS w_price,
       round(c.w_style, 6) AS w_style, round(c.w_ctr, 6) AS w_ctr,
       round(c.similarity_threshold, 6) AS similarity_threshold,
       round(avg(pos5 / 5.0), 4) AS precision_at_5,
       round(avg(CASE WHEN idcg5 = 0 THEN 0.0 ELSE dcg5 / idcg5 END), 4) AS ndcg_at_5,
       round(avg(CAST(pos5 > 0 AS DOUBLE)), 4) AS hit_rate_at_5,
       round(avg(pos10 / 10.0), 4) AS precision_at_10,
       round(avg(CASE WHEN idcg10 = 0 THEN 0.0 ELSE dcg10 / idcg10 END), 4) AS ndcg_at_10,
       round(avg(CAST(pos10 > 0 AS DOUBLE)), 4) AS hit_rate_at_10
FROM sper JOIN cfgs c ON c.config_id = sper.config_id
GROUP BY c.config_id, c.w_cf, c.w_embedding, c.w_price, c.w_style, c.w_ctr, c.similarity_threshold"""
