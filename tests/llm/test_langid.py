import random

import numpy as np
from pyspark.sql import functions as F

from recflow.llm import langid
from tests.llm.fixtures import awkward, awkward_rows, empty

WORDS = {"xx": "tha ing ent ion her for hat ere oul and".split(), "yy": "eau oux ais ent que les ion aux tre oir".split(),
         "zz": "sch ung ein ich der ach eit ost uch üb".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choices(WORDS[lang], k=rng.randrange(1, 3))) for _ in range(n))


def corpus(n=400):
    rng = random.Random(1)
    return [(i, text(rng, lang, rng.randrange(4, 60)), lang) for i in range(n) for lang in [rng.choice(list(WORDS))]]


def test_held_out_accuracy(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    test = langid.held_out(F.col("doc_id"))
    model = langid.train(df.where(~test))
    got = langid.identify(df.where(test), model).collect()
    assert model.languages == ("xx", "yy", "zz")
    assert np.mean([r["language"]["lang"] == r["lang"] for r in got]) > 0.97
    assert all(0 <= r["language"]["score"] <= 1 for r in got)
    assert langid.identify(df, model).where(~langid.accepted(F.col("language"))).count() == 0


def test_mixtures(spark):
    rng = random.Random(3)
    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    model = langid.train(df)
    both = text(rng, "xx", 60) + "\n" + text(rng, "zz", 30)
    got = langid.identify(spark.createDataFrame([(1, both), (2, text(rng, "yy", 80))], "doc_id long, text string"), model).collect()
    by = {r["doc_id"]: r["language"] for r in got}
    assert by[1]["languages"] == ["xx", "zz"] and abs(by[1]["proportions"][0] - 2 / 3) < 0.12
    assert by[2]["languages"] == ["yy"]


def test_proportions_match_a_plain_em():
    rng = random.Random(4)
    buf = (text(rng, "xx", 12) + " " + text(rng, "yy", 9)).encode() + b"\n"
    gen = np.random.default_rng(1)
    logs = (gen.normal(size=(2, langid.SLOTS)).astype(np.float32), np.zeros((2, langid.SLOTS), np.float32))
    share, count, _ = langid.infer(buf, np.array([0, len(buf)]), logs)
    at, slot, context, start = langid._trigrams(buf)
    words, like = np.flatnonzero(start), []
    for a, b in zip(words, [*words[1:], len(at)]):
        like.append([sum(float(logs[0][j, slot[i]] - logs[1][j, context[i]]) for i in range(a, b)) for j in range(2)])
    like = np.exp(np.array(like) - np.max(like, axis=1, keepdims=True))
    p = np.array([0.5, 0.5])
    for _ in range(langid.ROUNDS):
        w = like * p
        p = (w / w.sum(axis=1, keepdims=True)).mean(axis=0)
    best = np.log((like * p).sum(axis=1)).sum()
    keep = p.argmax()
    if best - np.log(like[:, keep]).sum() <= langid.PENALTY * np.log(len(like)):
        p = np.eye(2)[keep]
    assert count[0] == len(like) and np.allclose(share[0], p, atol=1e-4)


def test_texts_without_letters_and_awkward_rows(spark):
    model = langid.train(spark.createDataFrame(corpus(60), "doc_id long, text string, lang string"))
    got = langid.identify(awkward(spark).drop("language"), model).collect()
    assert len(got) == len(awkward_rows())
    for r in got:
        none = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (r["language"]["lang"] == "und") == none and (not none or r["language"]["score"] == 0)
    nothing = langid.train(empty(spark))
    assert nothing.languages == () and langid.identify(empty(spark), nothing).count() == 0
    assert {r["language"]["lang"] for r in langid.identify(awkward(spark), nothing).collect()} == {"und"}


def test_results_do_not_depend_on_batches(spark):
    rows = corpus(120)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df)
    one = {r["doc_id"]: (r["language"]["lang"], round(r["language"]["score"], 4)) for r in langid.identify(df.coalesce(1), model).collect()}
    assert one == {r["doc_id"]: (r["language"]["lang"], round(r["language"]["score"], 4))
                   for r in langid.identify(df.repartition(7), model).collect()}
