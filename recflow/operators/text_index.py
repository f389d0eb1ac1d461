"""Text search over exact vocabulary terms (E1, E10): TF-IDF postings joined on the token.

There is no hashed feature space: two words never share a weight.  Postings are a table
(document, token, unit weight); a query is a set of postings too, and scores are one equi-join and a
sum.  A token in every document weighs log(1) = 0 and is left out of the join, so the most
frequent words cost nothing.

Top-n retrieval does not read all postings of frequent tokens (``top_scores``): the rare tokens of a query give a lower
bound of its n-th score, and frequent ones whose greatest possible contributions add up to less than that cannot
bring in a new document, so they are looked up for the documents already found only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.operators.knn import SCORE_DIGITS
from recflow.operators.search import rank_level
from recflow.plans.fill import complete_in_id_order
from recflow.session import cut_lineage


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\W+"), "")


def term_counts(texts: DataFrame, ident: str, text: str = "text") -> DataFrame:
    return texts.select(F.col(ident), F.explode(tokens(F.col(text))).alias("token")) \
        .groupBy(ident, "token").agg(F.count(F.lit(1)).alias("tf"))


#: rows of a written table up to which it is sent to all tasks
BROADCAST_ROWS = 100_000


def by_size(written: DataFrame) -> DataFrame:
    """A written table as a side of a join, by its number of rows: estimates from compressed files are often too small, and a table
    that is sent to all tasks goes through the driver."""
    return F.broadcast(written) if written.count() <= BROADCAST_ROWS else written.hint("merge")


def inverse_frequencies(counts: DataFrame, texts: DataFrame) -> DataFrame:
    """(token, idf) = ln((documents + 1) / (documents with the token + 1))."""
    n = texts.agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("token").agg(F.count(F.lit(1)).alias("df")).crossJoin(F.broadcast(n)).select(
        "token", F.log((F.col("n") + 1) / (F.col("df") + 1)).alias("idf"))


def unit_postings(counts: DataFrame, idf: DataFrame, ident: str) -> DataFrame:
    """(ident, token, w): tf * idf scaled to unit length per document; zero weights left out."""
    w = counts.where(F.col(ident).isNotNull()).join(by_size(idf.where("idf > 0")), "token").withColumn("w", F.col("tf") * F.col("idf"))
    # the window holds the words of one text
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(ident)))
    return w.withColumn("norm", norm).select(ident, "token", (F.col("w") / F.col("norm")).alias("w"))


@dataclass
class TextIndex:
    """The fitted encoder (E1): unit postings of the catalog texts and the token weights."""

    ids: DataFrame       # (product_id)
    postings: DataFrame  # (product_id, token, w)
    idf: DataFrame       # (token, idf)

    def encode(self, texts: DataFrame, ident: str) -> DataFrame:
        """(ident, token, qw): unit postings of other texts, known tokens only."""
        return unit_postings(term_counts(texts, ident), self.idf, ident).withColumnRenamed("w", "qw")


def fit_index(catalog: DataFrame, text: str = "description") -> TextIndex:
    docs = catalog.select("product_id", F.col(text).alias("text"))
    counts = cut_lineage(term_counts(docs, "product_id"))
    idf = cut_lineage(inverse_frequencies(counts, docs))
    return TextIndex(docs.select("product_id"), cut_lineage(unit_postings(counts, idf, "product_id")), idf)


def all_scores(index: TextIndex, queries: DataFrame, ident: str) -> DataFrame:
    """(ident, product_id, score): cosine of every query and product that share a weighted token."""
    return index.encode(queries, ident).join(index.postings, "token").groupBy(ident, "product_id").agg(
        F.sum(F.col("w") * F.col("qw")).alias("score"))


#: tokens with more postings than this are frequent; the parts that such postings are dealt into
HOT_POSTINGS = 4096
SALTS = 16
#: scores are sums in any order
MARGIN = 1e-9


def _without(scores: DataFrame, exclude: DataFrame | None, ident: str) -> DataFrame:
    return scores if exclude is None else scores.join(exclude.select(ident, "product_id"), [ident, "product_id"], "left_anti")


def frequent_tokens(index: TextIndex, hot_postings: int) -> DataFrame:
    """(token, peak): tokens with more postings than that and their greatest weight in a document."""
    sizes = index.postings.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.max("w").alias("peak"))
    return sizes.where(F.col("df") > hot_postings).select("token", "peak")


def skippable(hard: DataFrame, found: DataFrame, ident: str, n: int, depth: DataFrame | None = None) -> DataFrame:
    """``hard`` (ident, token, qw, peak) with ``least``, the n-th best (``depth``: that of each query's own number) score of ``found`` (ident, product_id, score), null if there
    are fewer, and ``skip``: the weakest frequent tokens whose bounds together stay below it."""
    order = Window.partitionBy(ident).orderBy(F.col("score").desc())
    ranked = found.withColumn("r", F.row_number().over(order))
    ranked = ranked.withColumn("depth", F.lit(n)) if depth is None else ranked.join(depth.select(ident, "depth"), ident)
    least = ranked.where(F.col("r") == F.col("depth")).select(ident, F.col("score").alias("least"))
    bound = F.col("qw") * F.col("peak")
    upto = F.sum(bound).over(Window.partitionBy(ident).orderBy(bound, "token"))
    return hard.join(least, ident, "left").withColumn("bound", bound).withColumn(
        "skip", F.coalesce(upto < F.col("least") - MARGIN, F.lit(False)))


def top_scores(index: TextIndex, queries: DataFrame, ident: str, n: int, exclude: DataFrame | None = None,
               depth: DataFrame | None = None) -> DataFrame:
    """(ident, product_id, score) that holds each query's first n products (``depth``: its own number of them) by cosine with their exact scores, excluded
    pairs left out; a query with fewer than n products with a score gets all of them."""
    asked = cut_lineage(index.encode(queries, ident))
    hot = cut_lineage(frequent_tokens(index, HOT_POSTINGS))
    weighed = (F.col("w") * F.col("qw")).alias("score")
    postings = index.postings.hint("merge")
    if hot.isEmpty():
        return _without(by_size(asked).join(index.postings, "token").select(ident, "product_id", weighed).groupBy(
            ident, "product_id").agg(F.sum("score").alias("score")), exclude, ident)
    rare = cut_lineage(asked.join(hot, "token", "left_anti"))
    rare = by_size(rare).join(index.postings, "token").select(ident, "product_id", weighed)
    rare = cut_lineage(_without(rare.groupBy(ident, "product_id").agg(F.sum("score").alias("score")), exclude, ident))
    hard = cut_lineage(skippable(asked.join(hot, "token"), rare, ident, n, depth))
    # frequent tokens that may bring in documents: all their postings, dealt by document
    salt = F.pmod(F.xxhash64("product_id"), F.lit(SALTS))
    dealt = postings.join(hot.select("token"), "token", "left_semi").withColumn("salt", salt)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    needed = cut_lineage(hard.where(~F.col("skip")).select(ident, "token", "qw").withColumn("salt", every))
    more = by_size(needed).join(dealt, ["token", "salt"]).select(ident, "product_id", weighed)
    found = rare.unionByName(_without(more, exclude, ident)).groupBy(ident, "product_id").agg(F.sum("score").alias("score"))
    # what the skipped ones may still add decides which documents have to be completed
    left = hard.groupBy(ident).agg(F.sum(F.when(F.col("skip"), F.col("bound")).otherwise(0.0)).alias("left"), F.first("least").alias("least"))
    alive = found.join(left, ident, "left").where(
        F.col("least").isNull() | (F.col("score") + F.col("left") >= F.col("least") - MARGIN)).select(ident, "product_id", "score")
    alive = cut_lineage(alive)
    late = alive.select(ident, "product_id").join(hard.where("skip").select(ident, "token", "qw"), ident).join(
        postings, ["product_id", "token"]).select(ident, "product_id", weighed)
    return alive.unionByName(late).groupBy(ident, "product_id").agg(F.sum("score").alias("score"))


def candidate_scores(index: TextIndex, queries: DataFrame, candidates: DataFrame, ident: str = "user_id") -> DataFrame:
    """(ident, product_id, query_similarity) for given pairs; 0 without a shared token."""
    pairs = candidates.select(ident, "product_id").distinct()
    hits = pairs.join(index.encode(queries, ident), ident).join(
        index.postings.hint("merge"), ["product_id", "token"]).groupBy(
        ident, "product_id").agg(F.sum(F.col("w") * F.col("qw")).alias("query_similarity"))
    return pairs.join(hits, [ident, "product_id"], "left").fillna({"query_similarity": 0.0})


def recommend_from_query(index: TextIndex, queries: DataFrame, n: int = 20, exclude: DataFrame | None = None,
                         min_similarity: float = 0.0, ident: str = "user_id") -> DataFrame:
    """R15 for a table (ident, text): first n products by cosine (ties by id), excluded pairs removed, none
    under min_similarity: (ident, product_id, score, rank).  At min_similarity 0 or less short lists
    complete with score 0 in id order.

    A text is searched once for everybody who asks for it, as deep as the one with the most excluded products of the index
    needs; each joins the levels of its list (``search.rank_level``) up to their own need."""
    # the words of all texts of a key are one query
    wanted = queries.groupBy(ident).agg(F.concat_ws(" ", F.sort_array(F.collect_list("text"))).alias("text"))
    wanted = wanted.withColumn("need", F.lit(n).cast("long"))
    if exclude is not None:
        out = exclude.select(ident, "product_id").distinct()
        places = out.join(index.ids, "product_id").groupBy(ident).agg(F.count(F.lit(1)).alias("places"))
        wanted = wanted.join(places, ident, "left").withColumn("need", F.col("need") + F.coalesce("places", F.lit(0))).drop("places")
    wanted = cut_lineage(wanted)
    lists = wanted.where(F.col(ident).isNotNull() & (F.col("text") != "")).groupBy("text").agg(F.max("need").alias("depth"))
    # one written table, so the numbers stay with their rows
    lists = cut_lineage(lists.withColumn("text_id", F.monotonically_increasing_id()))
    scores = top_scores(index, lists.select("text_id", "text"), "text_id", n, depth=lists).where(F.col("score") >= min_similarity)
    order = Window.partitionBy("text_id").orderBy(F.round("score", SCORE_DIGITS).desc(), "product_id")
    near = scores.withColumn("place", F.row_number().over(order).cast("bigint")).join(
        F.broadcast(lists.select("text_id", "depth")) if lists.count() <= BROADCAST_ROWS else lists.select("text_id", "depth"),
        "text_id").where(F.col("place") <= F.col("depth"))
    near = cut_lineage(near.select("text_id", "product_id", "score", "place", rank_level(F.col("place")).alias("level")))
    per = wanted.where(F.col(ident).isNotNull()).join(by_size(lists.select("text_id", "text")), "text").withColumn(
        "level", F.explode(F.sequence(F.lit(0), rank_level(F.col("need")))))
    per = per.join(by_size(near), ["text_id", "level"]).where(F.col("place") <= F.col("need")).select(ident, "product_id", "score", "place")
    if exclude is not None:
        per = per.join(out, [ident, "product_id"], "left_anti")
    rank = F.row_number().over(Window.partitionBy(ident).orderBy("place")).cast("bigint")
    top = cut_lineage(per.withColumn("rank", rank).where(F.col("rank") <= n).select(ident, "product_id", "score", "rank"))
    if min_similarity > 0:
        return top
    found = top.groupBy(ident).agg(F.count(F.lit(1)).alias("k"))
    need = queries.select(ident).distinct().join(found, ident, "left").select(
        ident, (F.lit(n) - F.coalesce("k", F.lit(0))).alias("need"))
    # a short list holds every product with a score that is not excluded
    knocked = top.select(ident, F.col("product_id").alias("item"))
    if exclude is not None:
        knocked = knocked.unionByName(exclude.select(ident, F.col("product_id").alias("item")))
    fill = complete_in_id_order(need, knocked, index.ids.select(F.col("product_id").alias("item")), ident, "item")
    return top.unionByName(fill.join(found, ident, "left").select(
        ident, F.col("item").alias("product_id"), F.lit(0.0).alias("score"),
        (F.coalesce("k", F.lit(0)) + F.col("fill_pos")).cast("bigint").alias("rank")))


def text_search(catalog: DataFrame, queries: DataFrame, k: int = 5, text: str = "description") -> DataFrame:
    """First k catalog rows for each query (query_id, text): (query_id, product_id, score, rank)."""
    return recommend_from_query(fit_index(catalog, text), queries, k, ident="query_id")
