import random

import numpy as np
from pyspark.sql import functions as F

from recflow.llm import toxicity
from tests.llm.fixtures import awkward, awkward_rows, empty, prose

BAD = ["vilewordone", "vilewordtwo", "nastything", "awfulthing"]


def corpus(n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        sentences = [prose(rng, rng.randrange(9, 15)) for _ in range(rng.randrange(2, 12))]
        label = int(rng.random() < 0.2)
        if label:
            at = rng.randrange(len(sentences))
            sentences[at] = prose(rng, 4) + " " + rng.choice(BAD) + " " + prose(rng, 6) + " " + rng.choice(BAD)
        rows.append((i, ". ".join(sentences) + ".", label))
    return rows


def test_learns_from_text_labels_and_finds_the_sentence(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, label int")
    test = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(df.where(~test))
    got = toxicity.score_texts(df.where(test), model).collect()
    y = np.array([r["label"] for r in got])
    s = np.array([r["toxicity"]["score"] for r in got])
    assert ((s >= 0.5) == (y == 1)).mean() > 0.95
    for r in got:
        if r["label"] and r["toxicity"]["score"] >= 0.5:
            assert any(b in r["toxicity"]["worst_sentence"] for b in BAD) and r["toxicity"]["n_offending"] >= 0


def test_noisy_or_matches_brute_force():
    rng = np.random.default_rng(0)
    weights = np.append(rng.normal(size=toxicity.SLOTS), 0.0)
    model = toxicity.Model(weights.astype(np.float32).tobytes(), -2.0)
    w = np.frombuffer(model.weights, dtype=np.float32).astype(float)
    texts = ["One two three four five six seven eight nine. Ten eleven twelve thirteen.", "", None, "é ü. " * 50]
    score = toxicity._score(texts, model, w)[0]
    for t, got in zip(texts, score):
        buf = (t or "").encode().lower() + b"\n"
        slots, starts, _, begin = toxicity._features(buf, np.array([0, len(buf)]))
        clean = 1.0
        for a, b in zip(begin, [*begin[1:], len(starts)]):
            clean *= 1 - 1 / (1 + np.exp(-(model.bias + sum(w[s] for k in range(a, b) for s in slots[:, k]))))
        want = 1 - clean if len(starts) else 1 / (1 + np.exp(2.0))
        assert abs(got - want) < 1e-9


def test_awkward_and_untrained(spark):
    model = toxicity.train(spark.createDataFrame([], "doc_id long, text string, label int"))
    got = toxicity.score_texts(awkward(spark), model).collect()
    assert len(got) == len(awkward_rows()) and all(r["toxicity"]["score"] == 0 for r in got)
    assert toxicity.score_texts(empty(spark), model).count() == 0
    one = spark.createDataFrame([(1, "a b c", 1), (2, None, 1), (3, "x", None)], "doc_id long, text string, label int")
    assert not toxicity.train(one).known


def test_scores_do_not_depend_on_batches(spark):
    rows = corpus(80, 9)
    model = toxicity.fit_bags([r[1] for r in rows], np.array([r[2] for r in rows]))
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    one = {r["doc_id"]: round(r["toxicity"]["score"], 9) for r in toxicity.score_texts(df.coalesce(1), model).collect()}
    many = {r["doc_id"]: round(r["toxicity"]["score"], 9) for r in toxicity.score_texts(df.repartition(9), model).collect()}
    assert one == many
