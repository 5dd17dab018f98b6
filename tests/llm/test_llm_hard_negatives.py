import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from agorakit.llm import hard_negatives as H


def brute(rows, every=5, positives=5, negatives=3):
    kept = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.setdefault(i, []).append((label, [np.float32(x) for x in v]))
    kept = {i: min(c, key=lambda t: (t[0], [float(x) for x in t[1]])) for i, c in kept.items()}
    z = {i: (label, [math.floor(256 * float(x)) for x in v]) for i, (label, v) in kept.items()}
    z = {i: (label, v) for i, (label, v) in z.items() if sum(x * x for x in v) < 2**62}
    out = []
    for a, (label, q) in z.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(q, v)) for i, (_, v) in z.items() if i != a and len(v) == len(q)}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if z[i][0] == label][:positives]:
            fit = [i for i in order if z[i][0] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]][:negatives]
            out += [(a, p, r, i, score[p], score[i]) for r, i in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, every=5):
    data = [(i, v, label, "x", 0, 0.5) for i, v, label in rows]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, cell string, anchor int, score double")
    found = H.hard_negatives(frame, F.col("vec_id") % every == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


def clustered(n, dim=6, seed=1):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(8)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        s = rng.choice([0.0, 0.01, 0.3])
        rows.append((i, [x + s * rng.gauss(0, 1) for x in c], rng.randrange(3)))
    return rows


def test_equals_all_products(spark, monkeypatch):
    for name, value in (("CHUNK", 40), ("ANCHORS", 20), ("RANGE", 2), ("LEAF", 4)):
        monkeypatch.setattr(H, name, value)
    rows = clustered(260)
    rows += [(i, [0.5] * 6, i % 3) for i in range(300, 400)]  # ties
    rows += [(500, None, 1), (505, [1.0] * 6, None), (510, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (515, [float("nan")] * 6, 1), (520, [float("inf")] * 6, 1)]
    rows += [(None, [1.0] * 6, 1), (525, [], 1), (526, [], 1), (527, [], 2), (530, [0.0] * 6, 1), (535, [1e30] * 6, 1), (540, [2e6] * 6, 2), (541, [2e6] * 6, 1), (542, [2.5e6] * 6, 2)]
    rows += [(545, [1.0, 2.0], 0), (546, [1.0, 2.0], 0), (547, [0.9, 1.5], 1), (10, rows[10][1], rows[10][2]), (15, [9.0] * 6, 0), (15, [9.0] * 6, 2)]
    expected = brute(rows)
    assert len(expected) > 100
    assert mined(spark, rows) == expected


def test_no_rows_and_no_partners(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0, 0.0], 1)]) == []
    assert mined(spark, [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [-1.0, 0.0], 2)]) == []


@pytest.mark.parametrize("same", [True, False])
def test_search_finds_what_all_products_find_and_skips_nodes(same):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 300, (12, 8))
    x = np.floor(centres[rng.integers(0, 12, 900)] + rng.normal(0, 5, (900, 8))).astype(np.int64)
    ids, labels = np.sort(rng.choice(5000, 900, replace=False)), rng.integers(0, 4, 900)
    tree = H.CoverTree(x, ids, labels)
    assert sorted(np.concatenate([n["points"] for n in tree.nodes])) == list(range(900))
    low = np.full((30, 2), -(10**6))
    high = np.tile([10**9, 50_000], (30, 1))
    search = H.Search(x[:30], ids[:30], labels[:30], low, high, 4, same)
    search.run([tree])
    for a in range(30):
        score = x @ x[a]
        for w in range(2):
            fit = [i for i in range(900) if (labels[i] == labels[a]) == same and i != a and low[a, w] <= score[i] <= high[a, w]]
            fit.sort(key=lambda i: (-score[i], ids[i]))
            assert list(search.found[a, w])[: len(fit)] == [ids[i] for i in fit[:4]]
    assert search.verified < 0.7 * 900 * 30


def test_levels_separate_centres_and_cover_points():
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(0, 200, (400, 3))).astype(np.int64)
    tree = H.CoverTree(x, np.arange(400), np.zeros(400, np.int64))
    norms = (x * x).sum(axis=1)
    y = np.c_[x, np.sqrt(norms.max() - norms)] / math.sqrt(norms.max())

    def below(node):
        found = list(tree.nodes[node]["points"])
        for c in tree.nodes[node]["children"]:
            found += below(c["node"])
        return found

    def check(ball):
        rows = below(ball["node"])
        away = np.arccos(np.clip(y[rows] @ y[ball["centre"]], -1, 1))
        assert away.max() <= ball["angle"] + 1e-9
        for c in tree.nodes[ball["node"]]["children"]:
            check(c)

    check(tree.root)
