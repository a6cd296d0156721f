import zlib

import pytest

from orchard.llm import queries, sharding


@pytest.fixture(scope="module")
def rows():
    return [(i, "word " * (i * 7 % 400) + ("é" if i % 3 else "")) for i in range(600)] + [
        (None, None), (None, ""), (None, "x"), (5, "same"), (5, "same")]


def test_law_and_digests(spark, docs_of, sf_of, rows):
    got = queries.op9_virtual_slot_sharding(spark, sf_of(documents=docs_of(rows))).collect()
    want = sorted((-1 if i is None else i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.size, r.text_crc32) for r in got) == want
    load = {}
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 24
        load.setdefault(r.shard, []).append(r)
    for held in load.values():
        assert sorted(r.slot for r in held) == list(range(len(held)))
    sizes = [sum(r.size for r in held) for held in load.values()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= max(r.size for r in got)


def test_empty_table(spark, docs_of):
    assert sharding.shard(docs_of([])).count() == 0


def test_more_shards_take_slots_only_into_the_new_one():
    totals = [(v, 1, 100 + v * 37 % 91) for v in range(1000)]
    first = sharding.balanced_map(totals, 24)
    grown = sharding.rebalanced_map(first, totals, 25)
    moved = {v for v in first if grown[v] != first[v]}
    assert moved and {grown[v] for v in moved} == {24}
    load = [sum(b for v, _, b in totals if grown[v] == s) for s in range(25)]
    assert max(load) <= 1.06 * sum(load) / 25
    fewer = sharding.rebalanced_map(first, totals, 23)
    assert set(fewer.values()) == set(range(23))
    skewed = {v: 0 if v < 300 else first[v] for v in first}
    edited = sharding.rebalanced_map(skewed, totals, 24)
    load = [sum(b for v, _, b in totals if edited[v] == s) for s in range(24)]
    assert max(load) <= 1.06 * sum(load) / 24


def test_versions_are_kept(spark, tmp_path):
    path = str(tmp_path / "map")
    sharding.store_map(spark, {0: 0, 1: 1}, path, 1)
    sharding.store_map(spark, {0: 0, 1: 2}, path, 2)
    assert sorted(map(tuple, sharding.load_map(spark, path).collect())) == [(2, 0, 0), (2, 1, 2)]
    assert sorted(map(tuple, sharding.load_map(spark, path, 1).collect())) == [(1, 0, 0), (1, 1, 1)]


def test_written_shards_hold_the_texts(spark, docs_of, tmp_path):
    docs = docs_of([(i, f"text {i}") for i in range(50)])
    placed = sharding.shard(docs, n_shards=3)
    path = str(tmp_path / "out")
    sharding.write_shards(docs, placed, path)
    back = spark.read.parquet(path)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == [(i, f"text {i}") for i in range(50)]


def test_equal_rows_spread(spark, docs_of):
    twin = "the same text again and again " * 3
    rows = [(i, "word " * (i * 7 % 40)) for i in range(2000)] + [(None, twin)] * 1000 + [(7, twin)] * 500
    got = sharding.shard(docs_of(rows).withColumnsRenamed({"source": "size", "lang": "Shard"})).collect()
    assert len(got) == 3500 and len({r.vslot for r in got if r.doc_id is None}) > 700
    load = {}
    for r in got:
        load.setdefault(r.shard, []).append(r)
    sizes = [sum(r.size for r in held) for held in load.values()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= max(r.size for r in got)
    for held in load.values():
        assert sorted(r.slot for r in held) == list(range(len(held)))


def test_very_long_text(spark, docs_of):
    got = sharding.shard(docs_of([(1, "é" * 3_000_000), (2, "x")])).collect()
    assert sorted(r.size for r in got) == [9, 6_000_008]


def test_twins_are_numbered_over_all_parts(spark):
    df = spark.createDataFrame([(i % 3, i % 5, 1) for i in range(100)], "hash long, part int, doc_id long")
    seen = {}
    for r in sharding.number_twins(df).collect():
        seen.setdefault(r.hash, []).append(r.twin)
    assert {h: sorted(t) for h, t in seen.items()} == {h: list(range(len(t))) for h, t in seen.items()}
