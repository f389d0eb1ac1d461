"""Ranking building blocks.

* ``topk_per_group`` -- ``row_number() <= k`` over a partitioned window; Spark
  plans it as ``WindowGroupLimit`` so each map task keeps only its local k
  rows per group before the shuffle.
* ``prefix_sums`` -- running sums over the whole table without a
  single-partition window: range partitioning, a reliable checkpoint, and
  per-partition offsets.
* ``global_rank`` -- a dense 1..n position, the prefix sum of ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recflow.session import cut_lineage


def topk_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column | str],
                   k: int | None, name: str = "rank") -> DataFrame:
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    out = df.withColumn(name, F.row_number().over(w).cast("bigint"))
    return out.where(F.col(name) <= k) if k is not None else out


def prefix_sums(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Inclusive running sums in the total order of ``keys`` (the last key should make
    rows unique): ``sums`` maps a numeric column to the name of its running sum."""
    n_parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")), 1)
    ordered = cut_lineage(df.repartitionByRange(n_parts, *keys).withColumn("_pid", F.spark_partition_id()))
    totals = ordered.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    # one row per partition: the window over it is tiny
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}")
                                      for c in sums])
    inside = Window.partitionBy("_pid").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ordered.withColumns({f"_s_{c}": F.sum(c).over(inside) for c in sums}).join(F.broadcast(offsets), "_pid")
    out = out.withColumns({name: F.col(f"_s_{c}") + F.col(f"_o_{c}") for c, name in sums.items()})
    return out.drop("_pid", *[f"_s_{c}" for c in sums], *[f"_o_{c}" for c in sums])


#: positions that are sent to every task as one array; further ones are joined
HEAD = 1024
SALTS = 16


def take_positions(asked: DataFrame, ranked: DataFrame, item: str, position: str) -> DataFrame:
    """The rows of ``asked`` (with a column ``_upto``) once for each of the positions 1.._upto of ``ranked``
    (position, item), with both columns.

    All lists start with the same items, so a join on the position would send everybody's rows to a few keys.
    The first ``HEAD`` items travel as an array instead; only the rows that ask for more join the rest, on the position and
    a salt."""
    last = ranked.where(F.col(position) <= HEAD).agg(
        F.sort_array(F.collect_list(F.struct(F.col(position).alias("g"), F.col(item).alias("i")))).alias("_head"))
    cut = F.slice("_head", 1, F.greatest(F.lit(0), F.least(F.col("_upto"), F.lit(HEAD))).cast("int"))
    near = asked.crossJoin(F.broadcast(last)).withColumn("_at", F.explode(cut)).withColumns(
        {position: F.col("_at.g"), item: F.col("_at.i")}).drop("_head", "_at")
    more = asked.where(F.col("_upto") > HEAD)
    if more.isEmpty():
        return near.drop("_upto")
    far = more.withColumn(position, F.explode(F.sequence(F.lit(HEAD + 1).cast("bigint"), F.col("_upto").cast("bigint"))))
    far = far.withColumn("_salt", F.pmod(F.xxhash64(*asked.columns), F.lit(SALTS)))
    deepest = more.agg(F.max("_upto")).first()[0]
    rest = ranked.select(position, item).where((F.col(position) > HEAD) & (F.col(position) <= deepest)).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return near.unionByName(far.join(rest, [position, "_salt"]).drop("_salt")).drop("_upto")


def global_rank(df: DataFrame, sort_cols: Sequence[str], descending: Sequence[bool] | None = None,
                name: str = "grank") -> DataFrame:
    """Exact 1-based position of every row in the total order of
    ``sort_cols`` (the last column should be a unique key)."""
    descending = list(descending or [False] * len(sort_cols))
    keyed = df.withColumn("_one", F.lit(1).cast("bigint"))
    keys = []
    for c, d in zip(sort_cols, descending):
        if d:
            keyed = keyed.withColumn(f"_k_{c}", -F.col(c))
            keys.append(f"_k_{c}")
        else:
            keys.append(c)
    return prefix_sums(keyed, keys, {"_one": name}).drop("_one", *[k for k in keys if k.startswith("_k_")])
