"""Exact "complete the list in id order" without a query x catalog grid.

A query ``q`` that found fewer than ``n`` items by score is completed with
the first items of a universe in id order that it has not "knocked out"
(own finds, seen items, exclusions).  Such an item has id position at most
``need + knocked``, so each query takes exactly that many positions of the id-ranked universe
(``ranking.take_positions``), and knocked pairs go with an anti-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recflow.plans.ranking import global_rank, take_positions


def complete_in_id_order(need: DataFrame, knocked: DataFrame, universe: DataFrame,
                         q: str, item: str) -> DataFrame:
    """``need``: (q, need) rows with need > 0; ``knocked``: (q, item) pairs
    that may not be used; ``universe``: (item,) distinct.  Returns
    (q, item, fill_pos) with fill_pos 1..need.  ``need`` should come from a written table: it
    is asked first whether any list is short, and if none is, the universe is not ranked."""
    need = need.where(F.col("need") > 0)
    if need.isEmpty():
        return need.select(q, F.col(q).alias(item), F.lit(0).cast("bigint").alias("fill_pos")).limit(0)
    kn = knocked.select(q, item).distinct()
    kc = kn.groupBy(q).agg(F.count(F.lit(1)).alias("_kc"))
    nd = need.where(F.col("need") > 0).join(kc, q, "left").fillna({"_kc": 0})
    # the universe is id-ranked once
    ranked = global_rank(universe.select(item).distinct(), [item], name="_g")
    asked = nd.select(q, "need", (F.col("need") + F.col("_kc")).alias("_upto"))
    cand = take_positions(asked, ranked, item, "_g").join(kn, [q, item], "left_anti")
    w = Window.partitionBy(q).orderBy("_g")
    return cand.withColumn("fill_pos", F.row_number().over(w).cast("bigint")) \
        .where(F.col("fill_pos") <= F.col("need")).select(q, item, "fill_pos")
