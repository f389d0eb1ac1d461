import random

import numpy as np
import pytest

from recflow.llm import near_dup
from recflow.llm.graph import components
from tests.llm.fixtures import awkward, awkward_rows, empty, prose


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def brute(rows, k, percent=80):
    """{doc_id: (n, component, kept)} for unique ids."""
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def group_rows(seed=1, bases=12, copies=25):
    rng = random.Random(seed)
    rows = []
    for _ in range(bases):
        base = prose(rng, rng.choice([3, 9, 30, 120, 400])).split()
        for _ in range(rng.randrange(1, copies)):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, len(base) // 20])):
                words[rng.randrange(len(words))] = f"e{rng.randrange(99)}"
            rows.append(" ".join(words).upper() if rng.random() < 0.2 else " ".join(words))
    rows += [None, "", "  ", "solo", "SOLO", "two words", "a b c d", "a b c d e"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k,seed", [(4, 1), (5, 2)])
def test_matches_brute_force(spark, k, seed):
    rows = group_rows(seed)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=k).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, k)


def test_large_group_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 400)
    rows = group_rows(5, bases=2, copies=2)
    rng = random.Random(6)
    base = prose(rng, 90).split()
    for i in range(120):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(90)] = f"q{rng.randrange(999)}"
        rows.append((1000 + i, " ".join(words)))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, 4)


def test_registers_estimate_jaccard():
    rng = np.random.default_rng(2)
    for n, share in ((40, 0.8), (400, 0.5), (5000, 0.8), (5000, 0.0)):
        pool = rng.integers(0, 1 << 63, 3 * n).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        both = int(2 * n * share / (1 + share))
        a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:both], pool[n:2 * n - both]]))
        regs = near_dup.registers(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs(near_dup.estimate(regs[0], regs[1:])[0] - truth) < 0.25 if n < 100 else 0.12


def test_awkward_rows(spark):
    out = near_dup.near_duplicates(awkward(spark)).collect()
    assert len(out) == len(awkward_rows())
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
    assert [r["kept"] for r in by[10]] == [True, True] and [r["component_id"] for r in by[10]] == [10, 10]
    assert by[7][0]["component_id"] == 6 and not by[7][0]["kept"] and by[6][0]["kept"]
    assert by[12][0]["component_id"] == 11 and by[1][0]["n_shingles"] == 0 and by[1][0]["kept"]
    assert by[2][0]["kept"] and by[3][0]["kept"]  # empty texts link with nothing
    assert near_dup.near_duplicates(empty(spark)).count() == 0


def test_many_rows_without_an_id(spark):
    text = "a b c d e f g h i j"
    rows = [(None, text)] * 40 + [(None, text + " k")] + [(None, None)] * 3 + [(5, text)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect()
    assert len(got) == 45 and sum(r["component_id"] == 5 for r in got) == 42 and sum(r["kept"] for r in got) == 4


def test_drop_keeps_one_of_each_class_and_all_columns(spark):
    df = awkward(spark)
    out = near_dup.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(
        str(r[0]) for r in awkward_rows() if r[0] not in (7, 12))


def test_components_on_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (102, 101), (200, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tiles_across_classes_only(spark):
    """Against all pairs of blocks that share a key and do not lie inside one class."""
    rng = random.Random(3)
    rows = {}
    for key in range(30):
        for block in rng.sample(range(20), rng.randrange(1, 12)):
            lo = rng.choice([1, 1, 1, 2, 3])
            rows[key, f"b{block}"] = (lo, lo + rng.choice([0, 0, 0, 1]))
    rows.update({(99, f"b{i}"): (7, 7) for i in range(20)})
    want = {tuple(sorted((a, b))) for (k, a), x in rows.items() for (m, b), y in rows.items()
            if k == m and min(x[0], y[0]) < max(x[1], y[1])}
    seen = spark.createDataFrame([(*k, *v) for k, v in rows.items()], "key long, block string, lo long, hi long")
    assert sorted(tuple(r) for r in near_dup._open_tiles(seen).collect()) == sorted(want)


def test_short_texts_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 400)
    monkeypatch.setattr(near_dup, "BLOCK_NODES", 5)
    rows = [(i, f"{prose(random.Random(i % 7), 12)} t{i % 3}") for i in range(150)]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k=4).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == brute(rows, 4)
