import random
from itertools import combinations

import pytest
import xxhash

from recflow.llm import simhash
from tests.llm.fixtures import awkward, awkward_rows, empty, prose


def plain_fingerprint(text, k):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, k, radius):
    """[(id, hex fingerprint, smallest reachable id)]"""
    prints = [plain_fingerprint(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= radius:
            parent[root(b)] = root(a)
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[root(x)] = min(least.get(root(x), i), i)
    return sorted(((i, f"{prints[x]:016x}", least.get(root(x))) for x, (i, _) in enumerate(rows)), key=str)


def group_rows(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(15):
        base = prose(rng, rng.choice([2, 40, 200, 600])).split()
        for _ in range(rng.randrange(1, 12)):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = f"e{rng.randrange(99)}"
            rows.append(" ".join(words).upper() if rng.random() < 0.2 else "  ".join(words))
    rows += [None, "", " \n", "solo", "SOLO", "two words", "a b c", "a b c d"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def got(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("k,radius,seed", [(3, 2, 1), (5, 2, 2), (3, 1, 3), (3, 0, 4), (3, 3, 5)])
def test_matches_brute_force(spark, k, radius, seed):
    rows = group_rows(seed)
    out = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), k, radius)
    assert got(out) == brute(rows, k, radius)


def test_links_between_all_close_fingerprints(spark):
    rng = random.Random(7)
    prints = {rng.getrandbits(64) for _ in range(40)}
    prints |= {p ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for p in prints for _ in range(5)}
    prints |= {0, 1, 3, 7, (1 << 64) - 1, (1 << 63), (1 << 62)}
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    for radius in (1, 2, 3):
        want = {frozenset(p) for p in combinations(prints, 2) if (p[0] ^ p[1]).bit_count() <= radius}
        pairs = simhash.links(df, radius, every_pair=True).collect()
        assert {frozenset(x % (1 << 64) for x in p) for p in pairs} == want and len(pairs) == len(want)
    chained = simhash.links(df, 2).collect()
    assert all((a % (1 << 64) ^ b % (1 << 64)).bit_count() <= 2 for a, b in chained)


def test_long_text_in_segments(monkeypatch):
    rng = random.Random(3)
    texts = [prose(rng, 900), None, "", prose(rng, 40), "x"]
    whole = simhash.fingerprints(texts, 3)
    monkeypatch.setattr(simhash, "SEGMENT_HASHES", 64)
    assert (simhash.fingerprints(texts, 3) == whole).all()
    assert [int(w) for w in whole] == [plain_fingerprint(t, 3) for t in texts]


def test_awkward_rows_and_dropping(spark):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    assert got(simhash.near_duplicates(awkward(spark), 3)) == brute(rows, 3, 2)
    kept = simhash.drop_near_duplicates(awkward(spark), 3)
    assert kept.columns == awkward(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 2 and ids.count(10) == 2 and 7 not in ids and 2 not in ids and 1 in ids
    assert simhash.near_duplicates(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 5)
