"""Scalar functions and trap cases T5, T6, T7 (hand-computed)."""
import datetime as dt

from pyspark.sql import functions as F

from recflow.functions import numeric as N, text as T, weights as Wt


def test_clean_text_and_title(spark):
    rows = [("mid-century",), ("o'neil",), ("  a_b ",), ("None",), ("",), (None,), ("BRAND#17x",), ("nan",)]
    df = spark.createDataFrame(rows, "s string")
    out = [r[0] for r in df.select(T.normalize_label("s")).collect()]
    # Python str.title semantics after cleaning
    assert out == ["Mid-Century", "O'Neil", "A B", "Unknown", "Unknown", "Unknown", "Brand#17X", "Unknown"]


def test_capitalize_rest_lower(spark):
    df = spark.createDataFrame([("wOOD",), ("x",)], "s string")
    assert [r[0] for r in df.select(T.capitalize("s")).collect()] == ["Wood", "X"]


def test_description_price_format(spark):
    df = spark.createDataFrame([("Modern", "Wood", "Chair", "Red", 872.0), ("Modern", "Wood", "Chair", "Red", 872.5)],
                               "st string, m string, c string, co string, p double")
    out = [r[0] for r in df.select(T.description("st", "m", "c", "co", "p")).collect()]
    assert out == ["Modern Wood Chair in Red color. Price: 872.", "Modern Wood Chair in Red color. Price: 872.50."]


def test_days_between_floors_exact_interval(spark):
    ref = "2024-01-31 00:00:00"
    rows = [(dt.datetime(2024, 1, 30, 12, 0),), (dt.datetime(2024, 2, 1, 6, 0),), (None,)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    out = [r[0] for r in df.select(N.days_between("ts", ref)).collect()]
    assert out == [0, -2, None]   # 12 h -> 0 (datediff would say 1); -30 h -> -2


def test_event_score_unknown_zero(spark):
    df = spark.createDataFrame([("view",), ("wishlist",), ("cart",), ("purchase",), ("error",)], "e string")
    assert [r[0] for r in df.select(Wt.event_score("e")).collect()] == [3.0, 5.0, 7.0, 20.0, 0.0]


def test_signal_weights(spark):
    import pytest

    def shares(overrides):
        return spark.range(1).select(*[c.alias(k) for k, c in Wt.signal_weights(overrides).items()]).first().asDict()

    got = shares({"cf": -1.0})
    assert got["cf"] == 0.0 and abs(sum(got.values()) - 1.0) < 1e-12
    assert shares({k: 0.0 for k in Wt.SIGNAL_KEYS}) == Wt.DEFAULT_SIGNAL_WEIGHTS
    with pytest.raises(ValueError):
        Wt.signal_weights({"bogus": 1.0})


def test_round_half_up(spark):
    df = spark.createDataFrame([(2.675,)], "x double")
    assert df.select(N.round_to("x", 2)).first()[0] == 2.68
