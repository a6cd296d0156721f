import random

import pytest

from orchard.operators import dictionary as D
from orchard.operators import interactions as I


def test_text_ids_have_a_dense_index(spark):
    r = random.Random(1)
    ids = ["".join(r.choices("abcé\U0001f600Z", k=r.randint(0, 4))) for _ in range(500)] + [None]
    got = I.dense_index(spark.createDataFrame([(x,) for x in ids], "uid string").repartition(4), "uid", "idx").collect()
    want = sorted({x for x in ids if x is not None}, key=lambda x: x.encode())
    assert {x.uid: x.idx for x in got} == {x: k for k, x in enumerate(want)}


def test_dates_and_big_numbers(spark):
    big = [2 ** 60 + k for k in range(30)]
    got = I.dense_index(spark.createDataFrame([(x,) for x in big * 2], "id long"), "id", "idx").collect()
    assert {x.id: x.idx for x in got} == {x: k for k, x in enumerate(big)}
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-03-01')) AS day")
    assert [x.idx for x in I.dense_index(days, "day", "idx").orderBy("day").collect()] == list(range(61))


def test_numbers_stay_from_run_to_run(spark, tmp_path):
    path = f"{tmp_path}/users"
    frame = lambda ids: spark.createDataFrame([(x,) for x in ids], "uid string")
    first = {x.uid: x.idx for x in D.update_index(frame(["m", "c", None, "c"]), "uid", "idx", path).collect()}
    assert first == {"c": 0, "m": 1}
    second = {x.uid: x.idx for x in D.update_index(frame(["z", "a", "m"]), "uid", "idx", path).collect()}
    assert second == first | {"a": 2, "z": 3}
    again = {x.uid: x.idx for x in D.update_index(frame(["a", "z"]), "uid", "idx", path).collect()}
    assert again == second and D.versions(spark, path) == [1, 2]
    assert {x.uid: x.idx for x in D.load_index(spark, path, 1).collect()} == first
    (tmp_path / "users" / "version=3").mkdir()  # left by a writer that died: no _SUCCESS
    third = {x.uid: x.idx for x in D.update_index(frame(["b"]), "uid", "idx", path).collect()}
    assert third == second | {"b": 4} and D.versions(spark, path) == [1, 2, 3]


def test_empty_first_run(spark, tmp_path):
    with pytest.raises(ValueError):
        D.load_index(spark, f"{tmp_path}/none")
    empty = spark.createDataFrame([], "uid string")
    assert D.update_index(empty, "uid", "idx", f"{tmp_path}/x").count() == 0
    got = D.update_index(spark.createDataFrame([("q",)], "uid string"), "uid", "idx", f"{tmp_path}/x").collect()
    assert [tuple(x) for x in got] == [("q", 0)]
