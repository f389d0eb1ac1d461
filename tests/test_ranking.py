"""Ranking dataset invariants: split floors, ordered union, negatives."""
import datetime as dt

from pyspark.sql import functions as F

from recflow.operators import ranking_data as RD
from recflow.operators.metrics import list_metrics, relevance_counts


def test_split_counts_floor(spark):
    t = spark.range(322).select(F.col("id").alias("user_id"), F.lit(0).alias("target_product_id"))
    c = {r["split"]: r["count"] for r in RD.assign_splits(t, 42).groupBy("split").count().collect()}
    assert c == {"train": 225, "val": 48, "test": 49}


def test_holdout_target_choice(spark):
    D = lambda d: dt.datetime(2024, 1, d)
    rows = [(1, 10, "purchase", D(1)), (1, 11, "purchase", D(5)), (1, 11, "purchase", D(6)), (1, 12, "purchase", D(3)),
            (2, 10, "purchase", D(1)), (2, 10, "purchase", D(2))]
    b = spark.createDataFrame(rows, "user_id long, product_id long, event_type string, timestamp timestamp_ntz")
    out = RD.holdout_targets(b).collect()
    assert [(r["user_id"], r["target_product_id"]) for r in out] == [(1, 12)]   # 11 bought twice; user 2 one product


def test_ordered_union_first_source_wins(spark):
    a = spark.createDataFrame([(1, 5, 1), (1, 6, 2)], "user_id long, product_id long, rank long")
    b = spark.createDataFrame([(1, 6, 1), (1, 7, 2)], "user_id long, product_id long, rank long")
    out = [(r["product_id"], r["position"]) for r in RD.ordered_union([a, b], 2).orderBy("position").collect()]
    assert out == [(5, 1), (6, 2)]


def test_random_negatives_avoid_knocked(spark):
    users = spark.range(30).select(F.col("id").alias("user_id"))
    cat = spark.range(60).select(F.col("id").alias("product_id"))
    knocked = users.select("user_id", F.explode(F.array(*[F.lit(i) for i in range(0, 40, 2)])).alias("product_id"))
    neg = RD.random_negatives(users, cat, knocked, 25, 42)
    assert neg.groupBy("user_id").count().where(F.col("count") != 25).count() == 0
    assert neg.join(knocked, ["user_id", "product_id"]).count() == 0
    assert neg.select("user_id", "product_id").distinct().count() == 30 * 25


def test_list_metrics_hand_case(spark):
    pred = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (1, 3, 3)], "user_id long, product_id long, rank long")
    act = spark.createDataFrame([(1, 2), (1, 3), (1, 9)], "user_id long, product_id long")
    r = list_metrics(pred, act, 3).first()
    assert abs(r["precision_at_k"] - 2 / 3) < 1e-12
    assert abs(r["recall_at_k"] - 2 / 3) < 1e-12
    assert abs(r["ap_at_k"] - (1 / 2 + 2 / 3) / 3) < 1e-12


def test_relevance_counts_bruteforce(spark):
    import itertools
    import random
    random.seed(0)
    rows = [(i, random.choice("ab"), random.choice("xyz"), random.choice("pq"), random.choice("rs")) for i in range(30)]
    df = spark.createDataFrame(rows, "product_id long, category string, material string, style string, color string")
    got = {r["product_id"]: r for r in relevance_counts(df).collect()}
    for q in rows:
        others = [o for o in rows if o[0] != q[0]]
        same = lambda o, k: o[k] == q[k]
        struct = sum(1 for o in others if same(o, 1) and (same(o, 2) or same(o, 3) or same(o, 4)))
        exact = sum(1 for o in others if all(same(o, k) for k in (1, 2, 3, 4)))
        h = [sum(1 for o in others if sum(same(o, k) for k in (1, 2, 3, 4)) == L) for L in range(5)]
        r = got[q[0]]
        assert (r["n_structured"], r["n_exact"], [r[f"h{L}"] for L in range(5)]) == (struct, exact, h)


def test_targets_are_computed_once_for_the_split(spark):
    """Counting and ranking read what was written, not the holdout again."""
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for frame in rows:
            seen.add(len(frame))
            yield frame

    users = spark.range(20).withColumnRenamed("id", "user_id").mapInPandas(count, "user_id long")
    assert RD.assign_splits(users).count() == 20
    assert seen.value == 20


def test_ranking_setup_parses_the_events_once(spark, tmp_path):
    """What the setup returns is read from written tables, not from the sources again."""
    from recflow.plans.queries import _ranking_setup
    at = lambda name: str(tmp_path / f"{name}.parquet")
    spark.range(40).selectExpr(
        "id % 4 as user_id", "concat('{\"k\": ', id % 7, '}') as props", "if(id % 3 = 0, 'purchase', 'view') as event_type",
        "timestamp_seconds(id * 1000) as ts").write.parquet(at("events"))
    spark.range(9).selectExpr("id as p_partkey", "'red bolt' as p_name", "'ECONOMY' as p_type", "'Brand#1' as p_brand",
                              "900.0D + id as p_retailprice", "3 as p_size").write.parquet(at("part"))
    spark.range(9).selectExpr("id as vec_id", "array(float(id), 1f) as embedding", "id as label").write.parquet(at("embeddings"))
    beh, _, observed, cat, _ = _ranking_setup(spark, str(tmp_path))
    assert beh.count() == 40 and cat.count() == 9
    for df in (beh, observed, cat):
        assert not df.inputFiles()


def test_norm_is_evaluated_once_per_vector(spark):
    from recflow.functions.vectors import l2_normalize
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([],), (None,)], "v array<double>").select(l2_normalize("v").alias("u"))
    assert [r["u"] for r in df.collect()] == [[0.6, 0.8], [0.0, 0.0], [], None]
    assert "/ greatest(" not in df._jdf.queryExecution().analyzed().toString()


def test_random_negatives_draw_once_per_user(spark):
    """The digests are drawn below the steps of the walk, in rows dealt over all partitions."""
    users = spark.range(50).withColumnRenamed("id", "user_id")
    out = RD.random_negatives(users, spark.range(30).withColumnRenamed("id", "product_id"),
                              users.selectExpr("user_id", "user_id % 30 as product_id"), 5)
    assert out.count() == 250
    above, below = out._jdf.queryExecution().optimizedPlan().toString().split("Generate explode", 1)
    assert "md5" not in above and "md5" in below and "RepartitionByExpression" in below
