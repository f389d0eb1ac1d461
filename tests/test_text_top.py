"""Top-n text retrieval with frequent words against the sum over all postings."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from recflow.operators import text_index as TI


def catalog(spark, n=240, seed=6):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = (["half"] if i % 2 else []) + (["third"] * (1 + i % 4) if i % 3 == 0 else [])
        words += [f"w{int(x)}" for x in rng.integers(0, 60, rng.integers(1, 9))] + ([f"only{i}"] if i % 5 == 0 else [])
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows, "product_id long, description string")


QUERIES = [(1, "half w3 w7"), (2, "half third"), (3, "only25 half third"), (4, "w1 w2 w3 w4 w5"), (5, "unknown"), (6, None),
           (7, "half"), (8, "only10 only15 only20 only25 half"), (9, "third w9 w9 w9 half half")]


@pytest.mark.parametrize("n,with_exclusions", [(1, False), (3, True), (3, False), (40, True), (500, False)])
def test_frequent_words_change_nothing(spark, monkeypatch, n, with_exclusions):
    cat = catalog(spark)
    asked = spark.createDataFrame(QUERIES, "user_id long, text string")
    exclude = spark.createDataFrame([(q, p) for q in (1, 2, 3, 8) for p in range(0, 60, 1 + q % 3)],
                                    "user_id long, product_id long") if with_exclusions else None
    index = TI.fit_index(cat)
    plain = TI.all_scores(index, asked, "user_id")
    gone = set(map(tuple, exclude.collect())) if with_exclusions else set()
    want = {}
    for r in plain.collect():
        if (r["user_id"], r["product_id"]) not in gone:
            want.setdefault(r["user_id"], []).append((-round(r["score"], 9), r["product_id"]))
    monkeypatch.setattr(TI, "HOT_POSTINGS", 30)
    got = {}
    for r in TI.top_scores(index, asked, "user_id", n, exclude).collect():
        got.setdefault(r["user_id"], []).append((-round(r["score"], 9), r["product_id"]))
    assert {q: sorted(v)[:n] for q, v in got.items()} == {q: sorted(v)[:n] for q, v in want.items()}
    assert all(len(got[q]) == len(want[q]) for q in want if len(want[q]) < n)


def test_only_weak_frequent_words_are_skipped(spark):
    index = TI.fit_index(catalog(spark))
    hot = TI.frequent_tokens(index, 30)
    assert {"half", "third"} <= {r["token"] for r in hot.collect()}
    asked = index.encode(spark.createDataFrame(QUERIES, "user_id long, text string"), "user_id")
    rare = asked.join(hot, "token", "left_anti").join(index.postings, "token").groupBy("user_id", "product_id").agg(
        F.sum(F.col("w") * F.col("qw")).alias("score"))
    marked = TI.skippable(asked.join(hot, "token"), rare, "user_id", 1).collect()
    by_query = {}
    for r in marked:
        by_query.setdefault(r["user_id"], []).append(r)
    assert any(r["skip"] for r in marked)
    for rows in by_query.values():
        skipped = sum(r["bound"] for r in rows if r["skip"])
        assert skipped == 0 or skipped < rows[0]["least"]
    # nothing else found: every frequent word is read in full
    assert not any(r["skip"] for r in by_query[2] + by_query[7])
