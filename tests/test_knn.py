import numpy as np
import pytest

from orchard.operators import knn


def brute(X, ids, k):
    out = {}
    for n, i in enumerate(ids):
        d2 = ((X - X[n]) ** 2).sum(1)
        out[i] = [j for _, j in sorted((d2[m], j) for m, j in enumerate(ids) if j != i)][:k]
    return out


def got(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.id, []).append((r.rank, r.nb))
    return {i: [n for _, n in sorted(v)] for i, v in out.items()}


@pytest.mark.parametrize("shape", ["clusters", "even", "ties"])
def test_neighbours_against_all_distances(spark, monkeypatch, shape):
    monkeypatch.setattr(knn, "VISITORS", 50)
    monkeypatch.setattr(knn, "TILE", 16)
    r = np.random.default_rng(1)
    if shape == "clusters":
        X = r.normal(size=(400, 3)) * 0.1 + r.normal(size=(12, 3))[r.integers(0, 12, 400)] * 5
    elif shape == "even":
        X = r.uniform(size=(300, 4))
    else:  # a grid with a third of the points equal
        X = r.integers(0, 4, (300, 2)).astype(float)
        X[:100] = 1.0
    ids = [7 * k + 1 for k in range(len(X))]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, X)], "id long, x array<double>").repartition(3)
    assert got(knn.nearest_neighbours(df, 5)) == brute(X, ids, 5)


def test_few_points(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [5.0])], "id long, x array<double>")
    assert got(knn.nearest_neighbours(df, 5)) == {1: [2, 3], 2: [1, 3], 3: [2, 1]}
    assert knn.nearest_neighbours(df.where("id = 1"), 5).count() == 0
    assert knn.nearest_neighbours(df.where("id = 9"), 5).count() == 0


def test_bounds_close_most_cells():
    r = np.random.default_rng(2)
    centers = r.normal(size=(30, 4)) * 10
    X = centers[r.integers(0, 30, 3000)] + r.normal(size=(3000, 4)) * 0.1
    cells = knn.Cells(centers)
    cell, d = cells.assign(X)
    for c in range(30):
        cells.count[c], cells.radius[c] = (cell == c).sum(), d[cell == c].max()
    visits, _ = cells.visits(X[:200], cell[:200], np.full(200, np.inf), 5)
    assert sum(map(len, visits)) < 200


def test_choosing_cells_needs_little_memory_whatever_the_batch():
    import tracemalloc

    import pandas as pd

    r = np.random.default_rng(4)
    X = r.normal(size=(10_000, 1))
    cells = knn.Cells(np.unique(X[:1024], axis=0))
    tracemalloc.start()
    cell, d = cells.assign(X)
    for c in range(1024):
        mine = cell == c
        cells.count[c], cells.radius[c] = mine.sum(), d[mine].max(initial=0)
    pdf = pd.DataFrame({"id": np.arange(10_000), "x": list(X), "cell": cell, "reach": np.nan})
    rows = sum(len(part) for part in cells.choose(pdf, 5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows > 0 and peak < 100 << 20  # all at once: 80 MB for each of several matrices
