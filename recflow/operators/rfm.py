"""RFM user features (A1, A2, J1-J3, P11, P12) as one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.functions.numeric import days_between

# Fills for users without purchases.
RFM_FILLS = {"recency": 999, "frequency": 0, "monetary": 0.0}


def rfm(behavior: DataFrame, reference_date: str, products: DataFrame | None = None) -> DataFrame:
    """recency = floor days since the last purchase, frequency = number of
    purchase rows, monetary = sum of prices, for **every** user of the
    behaviour table; users without purchases get 999 / 0 / 0.

    T1: the event's own ``price`` is used when the behaviour carries one,
    else the catalog price (left join).  One ``groupBy(user_id)`` replaces the
    three joined feature tables: users without purchases fall out with null
    aggregates, which the fills replace."""
    is_p = F.col("event_type") == "purchase"
    if "price" in behavior.columns:
        rows = behavior.select("user_id", "event_type", "timestamp", "price")
    else:
        if products is None:
            raise ValueError("behaviour has no price column: pass the product catalog")
        prices = products.select("product_id", F.col("price").cast("double").alias("price"))
        rows = behavior.select("user_id", "product_id", "event_type", "timestamp") \
            .join(prices, "product_id", "left")
    agg = rows.groupBy("user_id").agg(
        F.max(F.when(is_p, F.col("timestamp"))).alias("last_purchase"),
        F.count_if(is_p).cast("bigint").alias("frequency"),
        F.sum(F.when(is_p, F.col("price"))).alias("monetary"))
    return agg.select(
        "user_id",
        F.coalesce(days_between("last_purchase", reference_date), F.lit(RFM_FILLS["recency"])).cast("bigint")
        .alias("recency"),
        F.col("frequency"),
        F.coalesce(F.col("monetary"), F.lit(RFM_FILLS["monetary"])).cast("double").alias("monetary"))
