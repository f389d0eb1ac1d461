import random

import numpy as np
import pytest

from recflow.llm import decontam
from tests.llm.fixtures import awkward, awkward_rows, empty, prose


def edited(rng, words, k, vocabulary):
    out = list(words)
    for _ in range(k):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice(vocabulary)
        elif kind == 1 and len(out) > 5:
            del out[at]
        else:
            out.insert(at, rng.choice(vocabulary))
    return out


def items(n=60, seed=2):
    rng = random.Random(seed)
    return [(i, prose(rng, rng.choice([8, 12, 20, 35, 60, 150]), 3000)) for i in range(n)]


@pytest.mark.parametrize("rate,least", [(0.0, 1.0), (0.05, 0.98), (0.1, 0.95)])
def test_recall(spark, rate, least):
    rng = random.Random(int(rate * 100))
    own = items()
    vocabulary = prose(rng, 3000).split()
    docs, truth = [], set()
    for n, (i, t) in enumerate(own * 3):
        words = t.split()
        body = edited(rng, words, int(rate * len(words)), vocabulary)
        docs.append((n, " ".join(rng.choices(vocabulary, k=rng.randrange(90)) + body + rng.choices(vocabulary, k=rng.randrange(90)))))
        truth.add((n, i))
    docs += [(10_000 + j, " ".join(rng.choices(vocabulary, k=200))) for j in range(50)]
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated_pairs(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(own, "item_id long, text string")).collect()}
    assert got <= truth and len(got) >= least * len(truth)


@pytest.mark.parametrize("rate", [0.1, 0.15, 0.2])
def test_recall_at_every_length(rate):
    """Every item length, as many edits as the rate gives (up to all that the similarity allows)."""
    rng = random.Random(int(rate * 100))
    vocabulary = prose(rng, 3000).split()
    shares = []
    for n in [*range(1, 42), 60, 96, 100, 150]:
        own = [" ".join(rng.choices(vocabulary, k=n)) for _ in range(25)]
        index = decontam.build_index(list(range(len(own))), own)
        docs = [" ".join(rng.choices(vocabulary, k=rng.randrange(40)) + edited(rng, t.split(), int(rate * n + 1e-9), vocabulary)
                         + rng.choices(vocabulary, k=rng.randrange(40))) for t in own]
        got = decontam.search(docs, index, index.lut())
        shares.append(np.mean([any(m[0] == i for m in own) for i, own in enumerate(got)]))
        assert shares[-1] >= 0.9, n
    assert np.mean(shares) >= 0.995


def test_tables_follow_from_the_stated_recall():
    assert [decontam.tables(w, 1.0) for w in decontam.WINDOWS] == [1] * len(decontam.WINDOWS)
    for w in decontam.WINDOWS:
        loose, strict = decontam.tables(w, 0.8, 0.5), decontam.tables(w, 0.8)
        assert 1 <= loose <= strict < decontam.MAX_TABLES
        n = 3 * w
        fresh = decontam.Trials(w, n, decontam.edit_limit(n, 0.8), seed=77)
        assert [fresh.add_table(t) for t in range(strict)][-1] >= 0.97


@pytest.mark.parametrize("window", [1, 2, 3, *decontam.WINDOWS])
def test_equal_windows_have_equal_keys_whatever_follows(window):
    rng = np.random.default_rng(5)
    words = rng.integers(1, 1 << 60, window).astype(np.uint64)
    tails = [rng.integers(1, 1 << 60, window + 8).astype(np.uint64) for _ in range(20)]
    for table in range(3):
        assert len({int(decontam.embed(decontam.symbols_of(np.concatenate([words, t])), np.array([0]), window, table)[0])
                    for t in tails}) == 1


def plain_matches(docs, items, similarity):
    """All (document, item, least edits) by plain edit distance over all stretches."""
    out = []
    for d, text in docs:
        words = [decontam.words_of(text).tolist()][0]
        for i, body in items:
            item = decontam.words_of(body).tolist()
            row = [0] * (len(words) + 1)
            for k, x in enumerate(item, 1):
                new = [k]
                for j, y in enumerate(words, 1):
                    new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
                row = new
            if item and words and min(row) <= decontam.edit_limit(len(item), similarity):
                out.append((d, i, min(row)))
    return sorted(out)


def test_whole_result_matches_plain_edit_distance(spark):
    """Items of one word to forty, some of them inside others, texts with up to a quarter of their words edited."""
    rng = random.Random(31)
    vocabulary = [f"w{i}" for i in range(400)]
    own = [(f"i{n}", " ".join(rng.choices(vocabulary, k=n))) for n in (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 24, 30, 40)]
    own += [("part", " ".join(own[-1][1].split()[3:20])), ("none", "..."), ("null", None)]
    docs = []
    for n in range(120):
        body = [w for _, t in rng.choices(own, k=2) for w in
                [*edited(rng, (t or "").split() or ["x"], rng.randrange(1 + len((t or "").split()) // 4), vocabulary),
                 *rng.choices(vocabulary, k=rng.randrange(20))]]
        docs.append((n, " ".join(body)))
    docs += [(500, ""), (501, None)]
    got = sorted((r["doc_id"], r["item_id"], r["edits"]) for r in decontam.contaminated_pairs(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(own, "item_id string, text string")).collect())
    want = plain_matches(docs, own, decontam.SIMILARITY)
    assert {g[:2] for g in got} == {w[:2] for w in want} and len(got) == len(want) > 100
    least = dict(((d, i), e) for d, i, e in want)
    assert all(e >= least[d, i] for d, i, e in got) and sum(e == least[d, i] for d, i, e in got) >= 0.95 * len(got)


def test_best_stretch_matches_plain_edit_distance():
    rng = np.random.default_rng(3)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(60):
        item, region = rng.integers(0, 4, 6).astype(np.uint64), rng.integers(0, 4, 11).astype(np.uint64)
        edits, start, end = decontam.best_stretch(item, region)
        assert edits == min(plain(item, region[a:b]) for a in range(12) for b in range(a, 12))
        assert plain(item, region[start:end]) == edits


def test_normalisation_and_blocks(spark):
    own = [(1, "Alpha beta gamma delta epsilon zeta eta theta."), (2, "One two three four five six seven éight nine"), (3, "too short"),
           (4, None), (None, "this item has no id but it has enough words")]
    docs = [(1, "x ALPHA!! beta, gamma\n\ndelta### epsilon (zeta) eta theta"), (2, "one two three four five six seven ÉIGHT nine"),
            (3, "too short"), (4, None), (5, "This item has no id, but it has enough words"), (1, "x ALPHA!! beta, gamma\n\ndelta### epsilon (zeta) eta theta")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(own, "item_id long, text string")
    for chars in (decontam.BLOCK_CHARS, 10):
        got = sorted(((r["doc_id"], r["item_id"], r["edits"]) for r in decontam.contaminated_pairs(d, i, block_chars=chars).collect()), key=str)
        assert got == sorted([(1, 1, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (5, None, 0)], key=str)


def test_dropping_keeps_columns_and_clean_rows(spark):
    i = spark.createDataFrame([(1, "same row twice in the table"), (2, "alpha beta gamma delta epsilon zeta eta")],
                              "item_id long, text string")
    df = awkward(spark)
    for chars in (decontam.BLOCK_CHARS, 30):  # one pass, and one for each item
        out = decontam.drop_contaminated(df, i, block_chars=chars)
        assert out.columns == df.columns
        assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(r[0]) for r in awkward_rows() if r[0] != 10)
    own = spark.createDataFrame([(1, "same row twice in the table and more")], "item_id long, text string")
    hit = spark.createDataFrame([(1, "so same row twice in the table and more"), (2, None)], "doc_id long, text string")
    assert [r["doc_id"] for r in decontam.drop_contaminated(hit, own).collect()] == [2]


def test_empty_tables(spark):
    i = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated_pairs(awkward(spark), i).count() == 0
    assert decontam.contaminated_pairs(empty(spark), spark.createDataFrame(items(3), "item_id long, text string")).count() == 0
