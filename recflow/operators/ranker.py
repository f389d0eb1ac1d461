"""Pairwise ranker (M5, M21, O3) on MLlib.

The gradient-boosted pairwise ranker of the reference is re-aimed as a
distributed pairwise logistic model: inside each user's candidate group the
positive is paired with every negative (pool-sized per user), the feature
difference is a training row labelled 1 and its negation a row labelled 0,
and ``LogisticRegression(fitIntercept=False)`` learns w so that
``w . x_pos > w . x_neg``.  Scoring is a plain column expression.  A
pointwise ``GBTClassifier`` is the non-linear option.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.operators.hybrid import FEATURE_COLUMNS


def _filled(name: str):
    """A feature as double; missing counts 0 in training and in scoring."""
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def prepare_inputs(frame: DataFrame, features=FEATURE_COLUMNS) -> DataFrame:
    """Features as double, label as int (grouping is by key, no sort)."""
    return frame.select("user_id", "product_id", *[_filled(c).alias(c) for c in features],
                        F.col("label").cast("int").alias("label"))


def pairwise_rows(frame: DataFrame, features=FEATURE_COLUMNS) -> DataFrame:
    """Positive x negatives within each user (bounded by the pool size)."""
    x = prepare_inputs(frame, features)
    pos = x.where(F.col("label") == 1).select("user_id", *[F.col(c).alias("p_" + c) for c in features])
    neg = x.where(F.col("label") == 0).select("user_id", *[F.col(c).alias("n_" + c) for c in features])
    d = pos.join(neg, "user_id")
    plus = d.select(*[(F.col("p_" + c) - F.col("n_" + c)).alias(c) for c in features], F.lit(1.0).alias("label"))
    minus = d.select(*[(F.col("n_" + c) - F.col("p_" + c)).alias(c) for c in features], F.lit(0.0).alias("label"))
    return plus.unionByName(minus)


@dataclass
class PairwiseRanker:
    coefficients: dict[str, float]
    model: LogisticRegressionModel | None = None
    features: tuple[str, ...] = FEATURE_COLUMNS

    def score(self, frame: DataFrame, out: str = "ranker_score") -> DataFrame:
        s = None
        for c in self.features:
            term = _filled(c) * F.lit(float(self.coefficients[c]))
            s = term if s is None else s + term
        return frame.withColumn(out, s)

    def save(self, path: str) -> None:
        if self.model is None:
            raise ValueError("no fitted MLlib model to save")
        self.model.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str, features=FEATURE_COLUMNS) -> "PairwiseRanker":
        m = LogisticRegressionModel.load(path)
        coefs = m.coefficients.toArray().tolist()
        return cls(dict(zip(features, coefs)), m, tuple(features))


def fit_pairwise(frame: DataFrame, reg: float = 0.01, max_iter: int = 100,
                 features=FEATURE_COLUMNS) -> PairwiseRanker:
    rows = pairwise_rows(frame, features)
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    lr = LogisticRegression(featuresCol="features", labelCol="label", fitIntercept=False, regParam=reg,
                            maxIter=max_iter, standardization=True)
    model = lr.fit(va.transform(rows))
    coefs = model.coefficients.toArray().tolist()
    return PairwiseRanker(dict(zip(features, coefs)), model, tuple(features))


def fit_pointwise_gbt(frame: DataFrame, max_depth: int = 4, max_iter: int = 50, seed: int = 42,
                      features=FEATURE_COLUMNS):
    """Non-linear option: pointwise GBT classifier; score = P(label=1)."""
    x = prepare_inputs(frame, features)
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxDepth=max_depth, maxIter=max_iter, seed=seed)
    return va, gbt.fit(va.transform(x))


def gbt_scored(fitted, frame: DataFrame, out: str = "ranker_score") -> DataFrame:
    """``frame`` with the probability that the fitted ``fit_pointwise_gbt`` gives to label 1."""
    assembler, model = fitted
    x = prepare_inputs(frame, tuple(assembler.getInputCols()))
    scored = model.transform(assembler.transform(x)).select(
        "user_id", "product_id", vector_to_array("probability")[1].alias(out))
    return frame.join(scored, ["user_id", "product_id"])


def feature_importance(ranker: PairwiseRanker, frame: DataFrame, digits: int = 6) -> DataFrame:
    """O3: |coefficient| x feature std (population, from the training
    frame), normalised to sum 1, ranked; rows (rank, feature, importance)."""
    stds = frame.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in ranker.features]).first()
    raw = {c: abs(ranker.coefficients[c]) * float(stds[c] or 0.0) for c in ranker.features}
    total = sum(raw.values()) or 1.0
    rows = sorted(((c, round(v / total, digits)) for c, v in raw.items()), key=lambda t: (-t[1], t[0]))
    spark = frame.sparkSession
    return spark.createDataFrame([(i + 1, c, v) for i, (c, v) in enumerate(rows)],
                                 "rank long, feature string, importance double")
