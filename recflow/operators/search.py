"""Vector search over a catalog.

Searches run for a **table** of queries.  A query's filters (category / style / material / color equality after
trim+lower, inclusive price range) are join keys: queries that filter by the same attributes meet only the
catalog rows with their values, and a price range only the price buckets that it touches (as a few runs of 1, 2, 4, ... buckets).  Inside a key,
queries and rows are dealt into blocks and multiplied; the exact price bounds, the similarity threshold and the
exclusions are masks there, and only each query's best rows leave a task.  Queries without any filter meet the whole
catalog.  Search is exact, so no over-fetch is needed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.functions import text as T
from recflow.functions.vectors import l2_normalize
from recflow.operators import knn as K
from recflow.session import cut_lineage

# The attributes that can be filtered and the columns of a result row.
FILTER_ATTRS = ("category", "style", "material", "color")
RESULT_FIELDS = ("product_id", "title", "category", "style", "color", "material", "price", "rating",
                 "description", "catalog_description")
QUERIES_PER_BLOCK, ROWS_PER_BLOCK = 16384, 16384
#: most price buckets, and rows that a bucket has at least
PRICE_BUCKETS, ROWS_PER_BUCKET = 64, 2048
_PRICED = 1 << len(FILTER_ATTRS)


def unit_catalog(catalog_with_vectors: DataFrame) -> DataFrame:
    """P16 on the stored vectors (norm floored at 1e-12)."""
    return catalog_with_vectors.withColumn("embedding", l2_normalize("embedding"))


def _search_block(pdf: pd.DataFrame) -> pd.DataFrame:
    qs = pdf[pdf["side"] == 0]
    cs = pdf[pdf["side"] == 1].sort_values("id")
    if qs.empty or cs.empty:
        return pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "product_id": pd.Series([], dtype="int64"),
                             "score": pd.Series([], dtype="float64"), "k": pd.Series([], dtype="int64")})
    price = cs["price"].to_numpy(dtype="float64")
    lo, hi, least = (qs[c].to_numpy(dtype="float64") for c in ("f_min_price", "f_max_price", "f_threshold"))
    qid, cid = qs["id"].to_numpy(dtype="int64"), cs["id"].to_numpy(dtype="int64")
    gone = [(r, i) for r, ids in enumerate(qs["exclude_ids"]) if ids is not None for i in ids if i is not None]
    out = K.id_cells(cid, *np.array(gone, dtype="int64").T) if gone else None

    def in_range(r: slice, c: slice) -> np.ndarray:
        low, high, p = lo[r, None], hi[r, None], price[None, c]
        return (np.isnan(low) | (p >= low)) & (np.isnan(high) | (p <= high))

    priced = not (np.isnan(lo).all() and np.isnan(hi).all())
    wanted = qs["k"].to_numpy(dtype="int64")
    vec = lambda x: np.stack(x["vec"].to_numpy()).astype("float64")
    r, c, score = K.best_cells(vec(qs), vec(cs), cid, wanted, out, in_range if priced else None)
    # a query's rows under its threshold are its last ones
    keep = np.isnan(least[r]) | (score >= least[r])
    r, c = r[keep], c[keep]
    return pd.DataFrame({"query_id": qid[r], "product_id": cid[c], "score": score[keep], "k": wanted[r]})


def _norm_or_null(c):
    v = T.filter_value(c)
    return F.when(F.col(c).isNull() | (v == ""), F.lit(None).cast("string")).otherwise(v)


def _price_cuts(catalog: DataFrame) -> list[float]:
    """At most PRICE_BUCKETS - 1 prices that deal the rows evenly."""
    rows = catalog.count()
    n = min(PRICE_BUCKETS, rows // ROWS_PER_BUCKET)
    if n < 2:
        return []
    cuts = catalog.agg(F.percentile_approx(F.col("price").cast("double"), [i / n for i in range(1, n)])).first()[0]
    return sorted(set(cuts or []))


def _bucket(price: Column, cuts: list[float]) -> Column:
    """Number of cuts below the price (null: null)."""
    below = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), lambda c: c < price))
    return F.when(price.isNotNull() & ~F.isnan(price), below)


def _price_nodes(cuts: list[float]) -> list[tuple[str, int, int]]:
    """(name, first, last) of the runs of 1, 2, 4, ... buckets, the longest last; a range of buckets is made of a few of them."""
    out, width = [], 1
    while True:
        out += [(f"{width}/{i}", i, i + width - 1) for i in range(0, len(cuts) + 1, width)]
        if width > len(cuts):
            return out
        width *= 2


def _covering(first: Column, last: Column, cuts: list[float]) -> Column:
    """Names of the longest runs inside the buckets first..last."""
    nodes = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(a - a % (2 * (b - a + 1))).alias("up"),
                               F.lit(2 * (b - a + 1)).alias("wide")) for n, a, b in _price_nodes(cuts)])
    longest = 2 * max(b - a + 1 for _, a, b in _price_nodes(cuts))
    inside = lambda a, b: (a >= first) & (b <= last)
    return F.transform(F.filter(nodes, lambda n: inside(n["a"], n["b"]) & (
        (n["wide"] == longest) | ~inside(n["up"], n["up"] + n["wide"] - 1))), lambda n: n["name"])


def _runs_of(bucket: Column, cuts: list[float]) -> Column:
    """Names of the runs that hold a bucket (null: none)."""
    widths = sorted({b - a + 1 for _, a, b in _price_nodes(cuts)})
    names = F.array(*[F.concat(F.lit(f"{w}/"), (bucket - F.pmod(bucket, F.lit(w))).cast("string")) for w in widths])
    return F.when(bucket.isNotNull(), names).otherwise(F.array().cast("array<string>"))


def _key(pattern, attributes: dict[str, Column], bucket: Column) -> Column:
    """Text of the attributes that a pattern filters by (null if one of them is missing)."""
    parts = [F.when(F.lit(pattern).bitwiseAND(F.lit(1 << i)) == 0, F.lit("")).otherwise(attributes[a])
             for i, a in enumerate(FILTER_ATTRS)]
    parts.append(F.when(F.lit(pattern).bitwiseAND(F.lit(_PRICED)) == 0, F.lit("")).otherwise(bucket.cast("string")))
    return F.concat(F.lit(pattern).cast("string"), *[x for p in parts for x in (F.lit("\u0001"), p)])


def vector_search(queries: DataFrame, catalog: DataFrame, k: int) -> DataFrame:
    """``queries`` has query_id, vec and optional filter columns
    category/style/material/color/min_price/max_price/threshold (null or blank: no filter),
    exclude_ids (ARRAY<BIGINT>) and k (that query's own number of results); ``catalog`` has product_id, embedding,
    attributes and price.  Returns (query_id, product_id, score, rank)."""
    has = lambda c: c in queries.columns
    # instead of null: the time to send a group to Python grows with the square of a run of null arrays
    nothing = F.array().cast("array<bigint>")
    number = {a: F.col(a).cast("double") if has(a) else F.lit(None).cast("double") for a in ("min_price", "max_price", "threshold")}
    asked = queries.select(
        F.col("query_id").alias("id"), F.col("vec").cast("array<double>").alias("vec"),
        *[(_norm_or_null(a) if has(a) else F.lit(None).cast("string")).alias(f"f_{a}") for a in FILTER_ATTRS],
        *[c.alias(f"f_{a}") for a, c in number.items()],
        F.coalesce(*[F.col(c).cast("array<bigint>") for c in ["exclude_ids"] if has(c)], nothing).alias("exclude_ids"),
        (F.coalesce(F.col("k").cast("long"), F.lit(k)) if has("k") else F.lit(k)).cast("long").alias("k"))
    priced = F.col("f_min_price").isNotNull() | F.col("f_max_price").isNotNull()
    pattern = sum((F.when(F.col(f"f_{a}").isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, a in enumerate(FILTER_ATTRS)),
                  F.when(priced, F.lit(_PRICED)).otherwise(F.lit(0)))
    asked = cut_lineage(asked.withColumn("pattern", pattern))
    patterns = [r[0] for r in asked.select("pattern").distinct().collect()]  # at most 32
    cuts = _price_cuts(catalog) if any(p & _PRICED for p in patterns) else []

    first = F.coalesce(_bucket(F.col("f_min_price"), cuts), F.lit(0))
    last = F.coalesce(_bucket(F.col("f_max_price"), cuts), F.lit(len(cuts)))
    touched = F.when(F.col("pattern").bitwiseAND(F.lit(_PRICED)) == 0, F.array(F.lit(""))).otherwise(_covering(first, last, cuts))
    per_pattern = None
    for p in patterns:
        part = asked.where(F.col("pattern") == p).withColumn("bucket", F.explode(touched)).withColumn(
            "key", _key(p, {a: F.col(f"f_{a}") for a in FILTER_ATTRS}, F.col("bucket")))
        per_pattern = part if per_pattern is None else per_pattern.unionByName(part)
    q = (asked.withColumn("key", F.lit("")) if per_pattern is None else per_pattern).drop("pattern", "bucket")
    rows = catalog.select(F.col("product_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"),
                          *[T.filter_value(a).alias(a) for a in FILTER_ATTRS], F.col("price").cast("double").alias("price"))
    runs = _runs_of(_bucket(F.col("price"), cuts), cuts)
    own = lambda p: F.transform(runs if p & _PRICED else F.array(F.lit("")),
                                lambda run: _key(p, {a: F.col(a) for a in FILTER_ATTRS}, run))
    keys = F.array_compact(F.flatten(F.array(*[own(p) for p in patterns]))) if patterns else F.array().cast("array<string>")
    # rows that nobody asks for stay where they are
    c = rows.withColumn("key", F.explode(keys)).select("key", "id", "vec", "price").join(q.select("key").distinct(), "key", "left_semi")

    # a few smaller blocks while that uses more cores
    dealt = lambda n, size: F.greatest(F.ceil(n / size), F.least(F.lit(K.FEW_BLOCKS), F.ceil(n / K.LEAST_ROWS)))
    parts = lambda df, size, name: df.groupBy("key").agg(dealt(F.count(F.lit(1)), size).cast("int").alias(name))
    sizes = cut_lineage(parts(q, QUERIES_PER_BLOCK, "qp").join(parts(c, ROWS_PER_BLOCK, "cp"), "key"))
    deal = lambda count: F.pmod(F.xxhash64("id"), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    left = q.join(sizes, "key").withColumns({"qb": deal("qp"), "side": F.lit(0)}).withColumn("cb", every("cp"))
    right = c.join(sizes, "key").withColumns({"cb": deal("cp"), "side": F.lit(1)}).withColumn("qb", every("qp"))
    right = right.withColumn("exclude_ids", nothing)
    both = left.drop("qp", "cp").unionByName(right.drop("qp", "cp"), allowMissingColumns=True).drop(*[f"f_{a}" for a in FILTER_ATTRS])
    partial = both.groupBy("key", "qb", "cb").applyInPandas(_search_block, "query_id long, product_id long, score double, k long")
    w = Window.partitionBy("query_id").orderBy(F.round("score", K.SCORE_DIGITS).desc(), F.col("product_id"))
    ranked = partial.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= F.col("k"))
    return ranked.select("query_id", "product_id", "score", "rank")


def result_records(hits: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rank, score rounded to 4 decimals and the catalog fields."""
    return hits.join(catalog.select(*RESULT_FIELDS), "product_id").select(
        "query_id", "rank", F.round("score", 4).alias("score"), *RESULT_FIELDS)


def check_known_products(requested: DataFrame, catalog: DataFrame, col: str = "product_id") -> None:
    """Unknown product ids are an error listing (some of) them."""
    missing = requested.select(col).distinct().join(catalog.select(F.col("product_id").alias(col)), col, "left_anti")
    bad = [r[0] for r in missing.limit(20).collect()]
    if bad:
        raise KeyError(f"unknown product ids: {bad}")


def similar_products(queries: DataFrame, catalog: DataFrame, k: int = 5) -> DataFrame:
    """For a table (query_id, product_id, optional filters) the k most
    similar catalog products, the product itself excluded; unknown ids raise."""
    check_known_products(queries, catalog)
    vec = catalog.select("product_id", F.col("embedding").alias("vec"))
    q = queries.join(vec, "product_id")
    if "exclude_ids" not in queries.columns:
        q = q.withColumn("exclude_ids", F.array(F.col("product_id")))
    return vector_search(q.drop("product_id"), catalog, k)


#: ranks of the first level of a source's list; every further level doubles it
FIRST_LEVEL = 64
USER_FILTERS = ("category", "style", "material", "color", "min_price", "max_price", "threshold")


def rank_level(rank: Column) -> Column:
    """The level of a rank: 0 for the first FIRST_LEVEL, then one more with each doubling."""
    return F.greatest(F.lit(0), F.ceil(F.round(F.log2(rank / F.lit(float(FIRST_LEVEL))), 9))).cast("int")


def recommend_for_users(purchases: DataFrame, catalog: DataFrame, k: int = 5, filters: DataFrame | None = None,
                        unknown: str = "error") -> DataFrame:
    """Content recommendations from a purchase list per user.

    ``purchases``: user_id, position, product_id; a product listed twice counts twice (T22).  ``filters``: user_id and
    any of USER_FILTERS.  For each position the first ``pool = min(n, max(10k, k+m))`` catalog products by
    similarity that pass the filters, all m purchases excluded; then per candidate max, sum, count, mean and the sources
    in the order of their positions; ordered by max desc, count desc, mean desc, product id (catalog position).
    Purchases without a catalog vector raise, or with ``unknown="drop"`` are excluded but no source.

    A source's list is searched once for all users with the same filters, as deep as its most demanding user may need (the
    pool plus as many exclusions).  Lists are cut into levels of doubling length and a user joins only the levels up to
    their own need, so a heavy buyer makes nobody else's lists longer.

    Returns user_id, rank, product_id, score, mean_score, support_count, matched_from_product_ids (array)."""
    if unknown == "error":
        check_known_products(purchases, catalog)
    given = [c for c in USER_FILTERS if filters is not None and c in filters.columns]
    src = purchases.select("user_id", "position", F.col("product_id").alias("source_id"))
    n_cat = catalog.count()
    sizes = src.groupBy("user_id").agg(F.count(F.lit(1)).alias("m"), F.count_distinct("source_id").alias("excluded"))
    sizes = sizes.withColumn("pool", F.least(F.lit(n_cat), F.greatest(F.lit(10 * k), F.lit(k) + F.col("m"))))
    sizes = sizes.withColumn("need", F.least(F.lit(n_cat), F.col("pool") + F.col("excluded")))
    if given:
        sizes = sizes.join(filters.select("user_id", *given), "user_id", "left")
    wanted = src.join(sizes, "user_id").withColumn("asks", F.to_json(F.struct(*given)) if given else F.lit("{}"))
    wanted = cut_lineage(wanted.withColumn("levels", rank_level(F.col("need"))))
    lists = wanted.groupBy("source_id", "asks").agg(F.max("need").alias("k"), *[F.first(c).alias(c) for c in given])
    vec = catalog.select(F.col("product_id").alias("source_id"), F.col("embedding").alias("vec"))
    lists = cut_lineage(lists.join(vec, "source_id").withColumn("query_id", F.monotonically_increasing_id()))
    hits = vector_search(lists.select("query_id", "vec", "k", *given), catalog, 1)
    near = hits.join(lists.select("query_id", "source_id", "asks"), "query_id").select(
        "source_id", "asks", rank_level(F.col("rank")).alias("level"), F.col("product_id").alias("candidate_id"), "score", "rank")
    per = wanted.select("user_id", "position", "source_id", "asks", "pool", "need",
                        F.explode(F.sequence(F.lit(0), F.col("levels"))).alias("level"))
    per = per.join(near, ["source_id", "asks", "level"]).where(F.col("rank") <= F.col("need"))
    own = src.select("user_id", F.col("source_id").alias("candidate_id")).distinct()
    per = per.join(own, ["user_id", "candidate_id"], "left_anti")
    w = Window.partitionBy("user_id", "position").orderBy("rank")
    per = per.withColumn("place", F.row_number().over(w)).where(F.col("place") <= F.col("pool"))
    agg = per.groupBy("user_id", "candidate_id").agg(
        F.max("score").alias("score_max"), F.sum("score").alias("score_sum"),
        F.count(F.lit(1)).cast("bigint").alias("support_count"),
        F.sort_array(F.collect_list(F.struct("position", "source_id"))).alias("sources"))
    agg = agg.withColumn("mean_score", F.col("score_sum") / F.col("support_count"))
    w2 = Window.partitionBy("user_id").orderBy(F.round("score_max", K.SCORE_DIGITS).desc(),
                                               F.col("support_count").desc(),
                                               F.round("mean_score", K.SCORE_DIGITS).desc(), F.col("candidate_id"))
    top = agg.withColumn("rank", F.row_number().over(w2).cast("bigint")).where(F.col("rank") <= k)
    return top.select("user_id", "rank", F.col("candidate_id").alias("product_id"),
                      F.round("score_max", 4).alias("score"), F.round("mean_score", 4).alias("mean_score"),
                      "support_count", F.col("sources.source_id").alias("matched_from_product_ids"))


def user_content_recs(purchases: DataFrame, catalog: DataFrame, k: int = 5) -> DataFrame:
    """R8 for the distinct purchases of each user, those without a vector being no source; the source ids as one text."""
    once = purchases.select("user_id", "product_id").distinct().withColumn("position", F.col("product_id"))
    out = recommend_for_users(once, catalog, k, unknown="drop")
    text = F.array_join(F.sort_array(F.transform("matched_from_product_ids", lambda x: x.cast("string"))), ",")
    return out.withColumn("matched_from_product_ids", text)


def sample_user_profiles(catalog: DataFrame, limit: int = 3) -> DataFrame:
    """Per category the first two product ids, biggest categories first
    (ties by name), categories with fewer than two products skipped."""
    counts = catalog.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    # top-2 ids per category: the window is cut to 2 rows per group map-side
    first2 = catalog.select("category", "product_id").withColumn(
        "_r", F.row_number().over(Window.partitionBy("category").orderBy("product_id"))).where(F.col("_r") <= 2) \
        .groupBy("category").agg(F.sort_array(F.collect_list("product_id")).alias("purchased_product_ids"))
    g = counts.join(first2, "category")
    return g.where(F.col("n") >= 2).orderBy(F.col("n").desc(), F.col("category")).limit(limit).select(
        F.concat(F.lower("category"), F.lit("_shopper")).alias("user_id"), "purchased_product_ids",
        F.col("category").alias("preferred_category"))


def show_products(ids: DataFrame, catalog: DataFrame, fields=("product_id", "title", "category")) -> DataFrame:
    """Catalog rows of the listed ids (semi-join, no duplicates)."""
    return catalog.select(*fields).join(ids.select("product_id").distinct(), "product_id", "left_semi")


def sample_batch_recommendations(catalog: DataFrame, k: int = 5, limit: int = 3) -> DataFrame:
    """The sample shopper table (R9) run through R8."""
    profiles = sample_user_profiles(catalog, limit)
    purchases = profiles.select("user_id", F.explode("purchased_product_ids").alias("product_id"))
    # R8 keys users by a numeric id; the shopper name is carried alongside
    ids = profiles.select("user_id", F.xxhash64("user_id").alias("uid"))
    recs = user_content_recs(purchases.join(ids, "user_id").select(F.col("uid").alias("user_id"), "product_id"),
                             catalog, k)
    return recs.join(ids.withColumnRenamed("user_id", "shopper").withColumnRenamed("uid", "user_id"), "user_id") \
        .drop("user_id").withColumnRenamed("shopper", "user_id")
