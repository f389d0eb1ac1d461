"""Search of the ranker's parameters by successive halving (O2).

A setting is a regularisation strength and how much more a pair counts the higher the blend
already ranks its negative.  All settings of a rung are fitted together: each Newton step of all of them is one
job, in which a task adds up its rows' gradients and Hessians for every setting, and only settings x (features +
features^2) sums reach the driver.  Rungs train on growing shares of the users (drawn by hash, the last rung on all), are
ranked by ndcg@5 on the validation users in one job, and pass on the better half.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recflow.operators.hybrid import FEATURE_COLUMNS
from recflow.operators.metrics import grouped_ranking
from recflow.operators.ranker import PairwiseRanker, prepare_inputs
from recflow.operators.sweep import _radical_inverse
from recflow.session import cut_lineage

REG_RANGE = (1e-4, 1.0)
HARD_RANGE = (0.0, 4.0)
RUNGS = (0.25, 0.5, 1.0)
STEPS = 8
SHARES = 1 << 20


def draw_parameters(n: int, seed: int = 42) -> list[dict]:
    """``n`` settings from a Halton sequence: reg on a log scale, hard on a linear one."""
    low, high = (math.log(x) for x in REG_RANGE)
    return [{"setting": i, "reg": math.exp(low + (high - low) * _radical_inverse(i + 1 + seed, 2)),
             "hard": HARD_RANGE[0] + (HARD_RANGE[1] - HARD_RANGE[0]) * _radical_inverse(i + 1 + seed, 3)} for i in range(n)]


def difference_rows(frame: DataFrame, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """(d, h): positive less negative within each user, and the negative's blended score."""
    x = prepare_inputs(frame, tuple(features))
    x = x.select("user_id", "label", F.array(*[F.col(c) for c in features]).alias("x"),
                 (F.col("hybrid_signal_score") if "hybrid_signal_score" in features else F.lit(0.0)).alias("h"))
    pos = x.where("label = 1").select("user_id", F.col("x").alias("p"))
    neg = x.where("label = 0").select("user_id", F.col("x").alias("n"), "h")
    return pos.join(neg, "user_id").select(F.zip_with("p", "n", lambda a, b: a - b).alias("d"), "h")


def _sums(rows: DataFrame, betas: np.ndarray, hard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per setting: summed weights, gradient and Hessian of the logistic loss."""
    n, width = betas.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, 1 + width + width * width))
        for b in batches:
            if not len(b):
                continue
            # the values of all rows as one array, not an array per row
            d = b.column("d").flatten().to_numpy(zero_copy_only=False).reshape(len(b), width)
            h = b.column("h").to_numpy(zero_copy_only=False)
            p = 1 / (1 + np.exp(np.clip(d @ betas.T, -500, 500)))
            for s in range(n):
                w = 1 + hard[s] * h
                total[s, 0] += w.sum()
                total[s, 1:1 + width] -= (w * p[:, s]) @ d
                total[s, 1 + width:] += ((d * (w * p[:, s] * (1 - p[:, s]))[:, None]).T @ d).ravel()
        s, j = np.indices(total.shape)
        yield pa.RecordBatch.from_pydict({"s": s.ravel().astype("int64"), "j": j.ravel().astype("int64"), "v": total.ravel()})

    out = np.zeros((n, 1 + width + width * width))
    for r in rows.mapInArrow(partial, "s long, j long, v double").groupBy("s", "j").agg(F.sum("v").alias("v")).collect():
        out[r["s"], r["j"]] = r["v"]
    return out[:, 0], out[:, 1:1 + width], out[:, 1 + width:].reshape(n, width, width)


def pooled_fit(rows: DataFrame, settings: Sequence[dict], features: Sequence[str] = FEATURE_COLUMNS,
               steps: int = STEPS) -> np.ndarray:
    """[settings, features] coefficients of the regularised pairwise logistic model of every setting; ``rows`` (d, h) are
    read once per step and should be written."""
    width = len(features)
    spread = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("d")[j] * F.col("d")[j]).alias(f"s{j}") for j in range(width)]).first()
    if not spread["n"]:
        return np.zeros((len(settings), width))
    variance = np.array([spread[f"s{j}"] for j in range(width)])
    reg, hard = (np.array([s[k] for s in settings]) for k in ("reg", "hard"))
    betas = np.zeros((len(settings), width))
    for _ in range(steps):
        weight, gradient, hessian = _sums(rows, betas, hard)
        for s in range(len(settings)):
            penalty = reg[s] * variance
            g = gradient[s] / weight[s] + penalty * betas[s]
            h = hessian[s] / weight[s] + np.diag(penalty + (variance == 0))
            move = np.linalg.lstsq(h, g, rcond=None)[0]
            # far from the optimum a step may overshoot: no step moves a pair's mean margin by more than 4
            size = math.sqrt(float(move ** 2 @ variance))
            betas[s] -= move * min(1.0, 4 / size) if size else 0.0
    return betas


def evaluate(frame: DataFrame, settings: Sequence[dict], betas: np.ndarray, features: Sequence[str] = FEATURE_COLUMNS) -> dict[int, float]:
    """{setting: ndcg@5 over the users of ``frame``}, all in one job."""
    table = F.array(*[F.struct(F.lit(s["setting"]).alias("setting"), F.array(*[F.lit(float(b)) for b in beta]).alias("beta"))
                      for s, beta in zip(settings, betas)])
    x = prepare_inputs(frame, tuple(features)).withColumn("s", F.explode(table))
    score = sum((F.col(c) * F.col("s.beta")[j] for j, c in enumerate(features)), F.lit(0.0))
    x = x.select(F.col("s.setting").alias("setting"), "user_id", "product_id", "label", score.alias("score"))
    return {r["setting"]: r["ndcg_at_5"] for r in grouped_ranking(x, "score", (5,), by=["setting"]).collect()}


def successive_halving(frame: DataFrame, settings: Sequence[dict], rungs: Sequence[float] = RUNGS, seed: int = 42,
                       features: Sequence[str] = FEATURE_COLUMNS) -> tuple[dict, DataFrame]:
    """(best setting, trials) on a ranking frame with ``split`` and ``label``; trials: rung, setting, reg, hard, share,
    users, ndcg_at_5, kept."""
    drawn = F.pmod(F.xxhash64("user_id", F.lit(seed)), F.lit(SHARES))
    train = frame.where(F.col("split") == "train")
    val = cut_lineage(frame.where(F.col("split") == "val"))
    live, trials = list(settings), []
    for rung, share in enumerate(rungs):
        part = cut_lineage(train.where(drawn < int(round(share * SHARES))))
        betas = pooled_fit(cut_lineage(difference_rows(part, features)), live, features)
        scores = evaluate(val, live, betas, features)
        order = sorted(live, key=lambda s: (-scores.get(s["setting"], 0.0), s["setting"]))
        keep = order[:max(1, math.ceil(len(order) / 2))] if rung < len(rungs) - 1 else order[:1]
        users = part.select("user_id").distinct().count()
        trials += [(rung, s["setting"], float(s["reg"]), float(s["hard"]), float(share), users,
                    float(scores.get(s["setting"], 0.0)), s in keep) for s in order]
        live = keep
    schema = "rung int, setting long, reg double, hard double, share double, users long, ndcg_at_5 double, kept boolean"
    return live[0], frame.sparkSession.createDataFrame(trials, schema)


def fit_ranker(frame: DataFrame, setting: dict, features: Sequence[str] = FEATURE_COLUMNS) -> PairwiseRanker:
    beta = pooled_fit(cut_lineage(difference_rows(frame, features)), [setting], features)[0]
    return PairwiseRanker(dict(zip(features, beta.tolist())), None, tuple(features))
