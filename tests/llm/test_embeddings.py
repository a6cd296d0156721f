import math

import numpy as np

from orchard.llm import embeddings, queries


def brute(rows, threshold=0.98):
    """rows: (vec_id, vector, label), unique ids."""
    def fine(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    ok = [(i, np.array(v, np.float64), g) for i, v, g in rows if fine(v, g)]
    links = {i: set() for i, _, _ in rows}
    for k, (i, p, g) in enumerate(ok):
        for j, q, h in ok[k + 1:]:
            if g == h and len(p) == len(q) and p @ q / math.sqrt(p @ p) / math.sqrt(q @ q) >= threshold:
                links[i].add(j)
                links[j].add(i)
    out, seen = {}, set()
    for i in sorted(links):
        if i in seen:
            continue
        todo, part = [i], {i}
        while todo:
            for j in links[todo.pop()] - part:
                part.add(j)
                todo.append(j)
        seen |= part
        out |= {j: (len(links[j]), i, j == i) for j in part}
    return out


def check(spark, sf_of, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = queries.op1_pca_tiled_embedding_dedup(spark, sf_of(embeddings=df.repartition(3))).collect()
    flat = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], g) for i, v, g in rows]
    assert {x.vec_id: (x.n_links, x.component_id, x.kept) for x in got} == brute(flat)
    assert len(got) == len(rows)


def vectors(n, d, seed, spread=0.06):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(max(1, n // 6), d))
    x = centres[r.integers(0, len(centres), n)] + spread * r.normal(size=(n, d)) * r.choice([0, 1, 2], (n, 1))
    return x.astype(np.float32).tolist()


def test_equals_brute_force(spark, sf_of, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 16)
    x = vectors(300, 24, 1) + vectors(60, 5, 2) + vectors(40, 2, 3)
    rows = [(1000 - k, v, k % 3 if k % 50 else None) for k, v in enumerate(x)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 24, 1), (2003, [None] * 24, 1), (2004, [float("nan")] * 24, 1),
             (2005, [float("inf")] + [0.0] * 23, 1), (2006, x[4], 1), (2007, x[4], 1), (2008, [1e-30] * 24, 2),
             (2009, [3e38] * 24, 2), (2010, [-v for v in x[4]], 1)]
    check(spark, sf_of, rows)


def test_one_dense_group(spark, sf_of, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 32)
    r = np.random.default_rng(5)
    x = (r.normal(size=64) + 0.12 * r.normal(size=(250, 64))).astype(np.float32)
    check(spark, sf_of, [(k, v, 7) for k, v in enumerate(x.tolist())])


def test_repeated_ids_and_empty_table(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (None, [1.0, 0.0], 5), (None, None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS sound", "2 AS rep")
    got = sorted(embeddings.near_duplicates(df).collect(), key=lambda x: x.vec_id or 0)
    assert [tuple(x) for x in got] == [(None, 0, None, True), (1, 1, 1, True), (2, 1, 1, False)]
    assert embeddings.near_duplicates(df.where("false")).count() == 0
