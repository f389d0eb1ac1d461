"""Interaction scores and the user x item matrix kept long."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.functions.weights import event_score
from recflow.operators.profile import require_columns


def build_interactions(behavior: DataFrame) -> DataFrame:
    """P9 (W4): behaviour plus ``score``; unknown event types score 0."""
    return behavior.withColumn("score", event_score("event_type"))


def interaction_scores(behavior: DataFrame) -> DataFrame:
    """P9 (W2): ``(user_id, product_id, score)`` after the column check (V1)."""
    require_columns(behavior, ["user_id", "product_id", "event_type"])
    return behavior.select("user_id", "product_id", event_score("event_type").alias("score"))


def user_item_matrix(interactions: DataFrame, agg: str = "sum") -> DataFrame:
    """A4/A5: the pivot kept long -- ``(user_id, product_id, value)``.

    ``agg='mean'`` is the W2 pivot default, ``'sum'`` the W4 one (T2).  Cells
    with a 0 value (unknown event types) are kept: the user and the item
    still belong to the matrix dimensions (T12)."""
    fn = {"sum": F.sum, "mean": F.avg}[agg]
    return interactions.groupBy("user_id", "product_id").agg(fn("score").cast("double").alias("value"))


def matrix_dims(matrix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Row and column keys of the long matrix."""
    return matrix.select("user_id").distinct(), matrix.select("product_id").distinct()


def user_means(matrix: DataFrame) -> DataFrame:
    """Row mean over **all** matrix columns, zeros included:
    ``sum(value) / n_items``; n_items is one bounded scalar."""
    n_items = matrix.select("product_id").distinct().count()
    return matrix.groupBy("user_id").agg(
        (F.sum("value") / F.lit(float(max(n_items, 1)))).alias("mean_value"))


def popularity(interactions: DataFrame) -> DataFrame:
    """A3: total score per product (partial aggregation map-side)."""
    return interactions.groupBy("product_id").agg(F.sum("score").cast("double").alias("popularity"))


def popularity_topk(interactions: DataFrame, n: int = 10) -> DataFrame:
    """R1 = A3 + L1: global top-n, ties by product id (``TakeOrderedAndProject``)."""
    top = popularity(interactions).orderBy(F.col("popularity").desc(), F.col("product_id")).limit(n)
    from pyspark.sql import Window
    # n rows only: the window runs on the k-row result
    w = Window.orderBy(F.col("popularity").desc(), F.col("product_id"))
    return top.select(F.row_number().over(w).cast("bigint").alias("rank"), "product_id", "popularity")
