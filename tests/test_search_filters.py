"""Filtered search and purchase-list recommendations against plain loops."""
import numpy as np
import pytest

from recflow.operators import search as SE

ATTRS = ("category", "style", "material", "color")


def catalog(spark, n=160, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = []
    for i in range(n):
        values = [None if rng.random() < 0.05 else f" {a}{rng.integers(3)} ".upper() for a in "csmk"]
        price = None if rng.random() < 0.05 else float(np.round(rng.uniform(1, 100), 2))
        rows.append((10 + 2 * i, x[i].tolist(), *values, price))
    schema = "product_id long, embedding array<double>, " + ", ".join(f"{a} string" for a in ATTRS) + ", price double"
    return rows, spark.createDataFrame(rows, schema)


def passes(row, f):
    for a, value in zip(ATTRS, row[2:6]):
        want = (f.get(a) or "").strip().lower()
        if want and (value is None or value.strip().lower() != want):
            return False
    lo, hi = f.get("min_price"), f.get("max_price")
    if (lo is not None or hi is not None) and row[6] is None:
        return False
    return (lo is None or row[6] >= lo) and (hi is None or row[6] <= hi)


def plain_search(rows, vec, f, k, exclude=()):
    scored = [(-round(float(np.dot(vec, r[1])), 9), r[0]) for r in rows if passes(r, f) and r[0] not in exclude
              and (f.get("threshold") is None or np.dot(vec, r[1]) >= f["threshold"])]
    return [i for _, i in sorted(scored)[:k]]


@pytest.mark.parametrize("small", [False, True])
def test_every_kind_of_filter(spark, monkeypatch, small):
    if small:  # several price buckets, and keys split into several blocks
        for name, value in (("ROWS_PER_BUCKET", 20), ("ROWS_PER_BLOCK", 17), ("QUERIES_PER_BLOCK", 5)):
            monkeypatch.setattr(SE, name, value)
    rows, cat = catalog(spark)
    rng = np.random.default_rng(1)
    asked, want = [], {}
    for q in range(80):
        f = {a: (f"{a[0] if a != 'color' else 'k'}{rng.integers(3)}" if rng.random() < 0.35 else rng.choice([None, "", "  "]))
             for a in ATTRS}
        f["min_price"] = float(rng.uniform(0, 60)) if rng.random() < 0.4 else None
        f["max_price"] = float(rng.uniform(20, 120)) if rng.random() < 0.4 else None
        f["threshold"] = float(rng.uniform(-0.5, 0.5)) if rng.random() < 0.3 else None
        own = rows[rng.integers(len(rows))]
        gone = [own[0]] if rng.random() < 0.5 else None
        k = int(rng.integers(1, 30))
        asked.append((q, own[1], *[f[a] if f[a] is None else str(f[a]) for a in ATTRS], f["min_price"], f["max_price"],
                      f["threshold"], gone, k))
        want[q] = plain_search(rows, own[1], f, k, gone or ())
    schema = ("query_id long, vec array<double>, " + ", ".join(f"{a} string" for a in ATTRS)
              + ", min_price double, max_price double, threshold double, exclude_ids array<long>, k long")
    got = {q: [] for q in want}
    for r in SE.vector_search(spark.createDataFrame(asked, schema), cat, 5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["product_id"])
        assert r["rank"] == len(got[r["query_id"]])
    assert got == want and any(not v for v in want.values())


@pytest.mark.parametrize("first_level", [2, 64])
def test_purchase_lists(spark, monkeypatch, first_level):
    monkeypatch.setattr(SE, "FIRST_LEVEL", first_level)
    rows, cat = catalog(spark, 90, 7)
    by_id = {r[0]: r for r in rows}
    rng = np.random.default_rng(2)
    lists = {u: [rows[j][0] for j in rng.integers(0, 90, m)] for u, m in ((1, 1), (2, 3), (3, 70), (4, 8))}
    lists[2].append(lists[2][0])  # twice: counts twice
    asks = {1: {}, 2: {"category": "c1"}, 3: {"threshold": 0.3}, 4: {"min_price": 20.0, "max_price": 80.0}}
    k = 2
    want = []
    for u, bought in lists.items():
        pool = min(90, max(10 * k, k + len(bought)))
        found = {}
        for source in bought:
            vec = by_id[source][1]
            for c in plain_search(rows, vec, asks[u], pool, set(bought)):
                found.setdefault(c, []).append((float(np.dot(vec, by_id[c][1])), source))
        order = sorted(found, key=lambda c: (-round(max(s for s, _ in found[c]), 9), -len(found[c]),
                                             -round(sum(s for s, _ in found[c]) / len(found[c]), 9), c))
        want += [(u, i, c, len(found[c]), [x for _, x in found[c]]) for i, c in enumerate(order[:k], 1)]
    purchases = spark.createDataFrame([(u, p, i) for u, b in lists.items() for p, i in enumerate(b)],
                                      "user_id long, position int, product_id long")
    filters = spark.createDataFrame([(u, f.get("category"), f.get("min_price"), f.get("max_price"), f.get("threshold"))
                                     for u, f in asks.items()],
                                    "user_id long, category string, min_price double, max_price double, threshold double")
    got = SE.recommend_for_users(purchases, cat, k, filters).orderBy("user_id", "rank").collect()
    assert [(r["user_id"], r["rank"], r["product_id"], r["support_count"], r["matched_from_product_ids"]) for r in got] == want
    bad = purchases.unionByName(spark.createDataFrame([(1, 9, 11)], "user_id long, position int, product_id long"))
    with pytest.raises(KeyError):
        SE.recommend_for_users(bad, cat, k)
