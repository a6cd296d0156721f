import hashlib
import math
import random

import pytest

from orchard.llm import queries, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, v int, totals string"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """[(vec_id, code, error, label)], codebooks: k-means in Python integers without bounds."""
    kept = [(i, [math.floor(scale * x) for x in v], c) for i, v, c in rows
            if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    w = len(kept[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    books = [[cut[k][p] for k in range(min(entries, len(cut)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for v in cut:
                held.setdefault(nearest(v[p], books[p])[1], []).append(v[p])
            books[p] = [[sum(c) // len(c) for c in zip(*held[k])] if k in held else e for k, e in enumerate(books[p])]
    out = []
    for (i, _, label), v in zip(kept, cut):
        found = [nearest(x, b) for x, b in zip(v, books)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    return out, books


def digest(books):
    return hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(i, v, c, "x", 1, "y") for i, v, c in rows], SCHEMA).repartition(3)


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


@pytest.mark.parametrize("size", [1e-2, 1.0, 1e5])
def test_query_against_brute_force(spark, sf_of, size):
    r = random.Random(int(size * 100))
    centers = [[r.gauss(0, size) for _ in range(16)] for _ in range(9)]
    rows = [(k, [x + r.gauss(0, size / 3) for x in r.choice(centers)], r.choice([None, 1, 2])) for k in range(400)]
    rows += [(1000, None, 1), (1001, [float("nan")] * 16, 1), (1002, [None] * 16, 2), (1003, [1.0] * 8, 2), (1004, [], 2),
             (1005, [float("-inf")] + [0.0] * 15, 2), (1006, [0.5] * 15, 2), (None, [size] * 16, None), (7, [0.0] * 16, 2)]
    rows += [(k, rows[3][1], 1) for k in range(300, 330)] + [rows[5]] * 4  # repeated vectors, repeated rows
    got = queries.op12_norm_of_sum_codes(spark, sf_of(embeddings=frame(spark, rows))).collect()
    want, books = brute(rows)
    totals = {}
    for _, _, e, label in want:
        totals[label] = totals.get(label, 0) + e
    assert sorted([(x.vec_id, x.code, x.error, x.label_error) for x in got], key=key) == sorted(
        [(i, c, e, min(totals[label], 2 ** 63 - 1)) for i, c, e, label in want], key=key)
    assert {x.codebooks_sha256 for x in got} == {digest(books)}


def test_large_components_stay_exact(spark):
    r = random.Random(3)
    rows = [(k, [r.gauss(0, 1e6) for _ in range(4)], 1) for k in range(60)]
    codes = vector_codes.compress(frame(spark, rows), parts=2, entries=5, rounds=3)
    want, books = brute(rows, 2, 5, 3)
    assert codes.codebooks == books
    assert sorted((x.vec_id, x.code.hex(), x.error) for x in codes.rows.collect()) == sorted(
        (i, c, min(e, 2 ** 63 - 1)) for i, c, e, _ in want)
    huge = vector_codes.compress(frame(spark, [(1, [1e300, -1e300], 1), (2, [0.0, 1.0], 1), (3, [5.0, 1e300], None)]), 1, 2, 2)
    assert vector_codes.label_errors(huge).count() == 3


def test_small_tables(spark, sf_of):
    assert queries.op12_norm_of_sum_codes(spark, sf_of(embeddings=frame(spark, [(1, None, 1)]))).count() == 0
    got = vector_codes.compress(frame(spark, [(1, [0.25] * 8, 1), (2, [0.5] * 8, None)]))
    assert len(got.codebooks[0]) == 2 and {x.error for x in got.rows.collect()} == {0}


def test_bounds_spare_scans(spark):
    r = random.Random(4)
    centers = [[r.gauss(0, 1) for _ in range(8)] for _ in range(16)]
    rows = [(k, [x + r.gauss(0, 0.05) for x in centers[k % 16]], 1) for k in range(3000)]
    codes = vector_codes.compress(frame(spark, rows), parts=1, entries=16, rounds=6)
    assert codes.scans[0] == 3000 and max(codes.scans[1:]) < 300
    assert len(codes.scans) == 7


def test_net_displacement_is_at_most_the_drifts():
    import numpy as np

    r = np.random.default_rng(5)
    history = [r.integers(-100, 100, (2, 4, 3)) for _ in range(5)]
    net = vector_codes.Round(history).net
    drift = sum(np.sqrt(((b - a) ** 2).sum(2)) for a, b in zip(history, history[1:]))
    assert (net[0] <= drift * (1 + 1e-5)).all() and (net[-1] == 0).all()
    true = np.sqrt(((history[-1] - history[0]) ** 2).sum(2))
    assert (net[0] >= true).all()


def test_decoded_vectors_are_near(spark):
    r = random.Random(6)
    rows = [(k, [r.gauss(0, 1) for _ in range(8)], 1) for k in range(200)]
    df = frame(spark, rows)
    codes = vector_codes.compress(df, parts=4, entries=64, rounds=4)
    back = codes.rows.select("vec_id", "error", vector_codes.decoded(codes.rows["code"], codes.codebooks).alias("near"))
    for x in back.collect():
        v = [math.floor(4096 * a) for a in rows[x.vec_id][1]]
        assert sum((a - 4096 * b) ** 2 for a, b in zip(v, x.near)) == pytest.approx(x.error)
