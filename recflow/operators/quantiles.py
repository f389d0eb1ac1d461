"""Exact percentiles (linear interpolation) without gathering a group.

Spark's exact ``percentile`` merges every value of a group into one buffer;
with a hot group that is one task holding a third of the data.  Here the
order statistics are located with a per-group histogram (a small table) and
only the rows of the few buckets that hold a needed rank are ranked.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def _suffix(q: float) -> str:
    return f"p{int(round(q * 100))}" if abs(q * 100 - round(q * 100)) < 1e-9 else f"p{q:g}".replace(".", "_")


def exact_percentiles(df: DataFrame, value: str, probs: Sequence[float],
                      by: Sequence[str] = (), names: Sequence[str] | None = None,
                      buckets: int = 64) -> DataFrame:
    """One row per group of ``by`` with one column per probability.

    Matches ``numpy.percentile`` / SQL ``quantile_cont``: position q*(n-1),
    linear interpolation between the two neighbouring order statistics.

    Selection by histogram: per group the buckets between approximate quantiles hold about
    equally many values wherever these lie, so an outlier cannot fill one bucket; exact counts, minima
    and maxima per bucket (a small table) locate the bucket of every needed order statistic.  A bucket holding a single distinct value answers directly
    (so a hot value costs nothing); only rows of the few other needed buckets
    are ranked, inside their bucket.  Groups without values are absent.
    """
    by = list(by)
    names = list(names) if names else [_suffix(q) for q in probs]
    grouped = bool(by)
    if not grouped:   # one constant group key: every join below stays an equi-join
        df = df.withColumn("_all", F.lit(0))
        by = ["_all"]
    vals = (df.select(*by, F.col(value).cast("double").alias("_v"))
            .where(F.col("_v").isNotNull() & ~F.isnan("_v")))
    cuts = F.array_distinct(F.percentile_approx("_v", [i / buckets for i in range(1, buckets)], 10_000))
    rng = vals.groupBy(*by).agg(cuts.alias("_cuts"), F.count(F.lit(1)).alias("_n"))
    # a value that equals a cut has a bucket of its own
    below = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    bucket = (2 * below + F.array_contains("_cuts", F.col("_v")).cast("int")).cast("bigint")
    # one row in all: broadcast; a row per group: the join strategy follows its measured size
    tagged = vals.join(rng if grouped else F.broadcast(rng), by).withColumn("_b", bucket).drop("_cuts")
    hist = tagged.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_bmin"),
                                         F.max("_v").alias("_bmax"))
    w = Window.partitionBy(*by).orderBy("_b")
    hist = hist.withColumn("_cum", F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                              F.lit(0)))
    per_q = []
    for i, q in enumerate(probs):
        pos = F.lit(float(q)) * (F.col("_n") - 1)
        per_q.append(F.struct(F.lit(i).alias("qi"), F.floor(pos).cast("bigint").alias("lo"),
                              F.ceil(pos).cast("bigint").alias("hi"), (pos - F.floor(pos)).alias("frac")))
    needed = (rng.select(*by, F.explode(F.array(*per_q)).alias("q"))
              .select(*by, "q.qi", "q.frac", F.explode(F.array("q.lo", "q.hi")).alias("_rank")))
    # locate the bucket of every needed rank (small x small)
    loc = needed.join(hist, by, "inner")
    loc = loc.where((F.col("_rank") >= F.col("_cum")) & (F.col("_rank") < F.col("_cum") + F.col("_c"))) \
        .select(*by, "qi", "frac", "_rank", "_b", (F.col("_rank") - F.col("_cum")).alias("_lr"), "_bmin", "_bmax")
    direct = loc.where(F.col("_bmin") == F.col("_bmax")).select(*by, "qi", "frac", "_rank", F.col("_bmin").alias("_v"))
    open_b = loc.where(F.col("_bmin") < F.col("_bmax"))
    keys = open_b.select(*by, "_b").distinct()
    rows = tagged.join(keys, [*by, "_b"], "left_semi")
    lw = Window.partitionBy(*by, "_b").orderBy("_v")
    ranked = rows.withColumn("_lr", F.row_number().over(lw) - 1).select(*by, "_b", "_lr", "_v")
    found = open_b.join(ranked, [*by, "_b", "_lr"]).select(*by, "qi", "frac", "_rank", "_v")
    lohi = direct.unionByName(found)
    interp = lohi.groupBy(*by, "qi").agg(F.min("_v").alias("_lo_v"), F.max("_v").alias("_hi_v"),
                                         F.first("frac").alias("_frac"))
    interp = interp.select(*by, "qi", (F.col("_lo_v") + (F.col("_hi_v") - F.col("_lo_v")) * F.col("_frac")).alias("_q"))
    keep = by if grouped else []
    if not probs:
        return rng.select(*keep)
    wide = interp.groupBy(*by).pivot("qi", list(range(len(probs)))).agg(F.first("_q"))
    return wide.select(*keep, *[F.col(str(i)).alias(names[i]) for i in range(len(probs))])


def exact_median(df: DataFrame, value: str) -> float | None:
    """Scalar median of a column (bounded: one number reaches the driver)."""
    row = exact_percentiles(df, value, [0.5], names=["m"]).first()
    if row is None:
        return None
    m = row["m"]
    return None if m is None or (isinstance(m, float) and math.isnan(m)) else float(m)
