import itertools
import random

import numpy as np
import xxhash

from orchard.llm import queries, simhash


def brute_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    n = max(1, len(words) - 2)
    grams = [b" ".join(words[i:i + 3]) for i in range(n)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 3:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return [find(i) for i in range(len(prints))]


def texts(seed=1):
    r = random.Random(seed)
    words = ["w%d" % i for i in range(300)] + ["É", "Été"]
    out = []
    for _ in range(40):
        base = [r.choice(words) for _ in range(r.choice([2, 30, 300]))]
        out.append(" ".join(base))
        for _ in range(r.randrange(4)):
            near = list(base)
            near[r.randrange(len(near))] = "X" + str(r.randrange(9))
            out.append("\t".join(near).upper() if r.random() < 0.2 else "  ".join(near))
    return out + ["", None, " \n ", "one", "ONE", "one two", out[0], out[0]]


def test_masks_cover_every_triple():
    masks = [m & (2**64 - 1) for m in simhash.covering_masks(3)]
    assert len(masks) == 15
    for bits in itertools.combinations(range(0, 64), 3):
        flipped = sum(1 << b for b in bits)
        assert any(m & flipped == 0 for m in masks)


def test_query_equals_brute_force(spark, docs_of, sf_of):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in queries.op4_simhash_near_dedup(spark, sf_of(documents=docs_of(rows))).collect()}
    prints = [brute_print(t) for _, t in rows]
    heads = brute_components(prints)
    assert len(got) == len(rows)
    for k, _ in rows:
        assert got[k].fingerprint == f"{prints[k]:016x}"
        assert got[k].component_id == heads[k]


def test_large_bucket_is_tiled(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 40)
    r = np.random.default_rng(3)
    base = 0x0123456789ABCDEF
    fps = sorted({base ^ sum(1 << int(b) for b in r.choice(64, r.integers(0, 5), replace=False)) for _ in range(400)}
                 | {int(x) for x in r.integers(0, 2**63, 200)})
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    links = simhash.bucket_links(df, 3).collect()
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in links:
        a, b = (int(np.int64(v).view(np.uint64)) for v in (x.a, x.b))
        parent[max(find(a), find(b))] = min(find(a), find(b))
    heads = brute_components(fps)
    assert [find(f) for f in fps] == [fps[h] for h in heads]


def test_chain_of_links(spark, docs_of):
    """Prints at distance 3 from the next one only are one group, found over several rounds."""
    from orchard.llm.common import Scratch, components

    chain = [(i + 1, i) for i in range(200)]
    links = spark.createDataFrame(chain, "a long, b long")
    roots = {r.node: r.root for r in components(links, Scratch(spark, "chain")).collect()}
    assert roots == {i: 0 for i in range(1, 201)}


def test_keep_one_keeps_one_row_of_each_group(spark, docs_of):
    rows = [(3, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (2, "x y z v w u"), (None, ""), (None, None)]
    docs = docs_of(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (1, "a b c d e"), (2, "x y z v w u")]


def test_empty_table_and_clashing_columns(spark, docs_of):
    assert simhash.near_duplicates(docs_of([]), ["doc_id"]).count() == 0
    docs = docs_of([(1, "a"), (2, "a")]).withColumnRenamed("lang", "fp").withColumnRenamed("source", "component")
    assert {r.component.doc_id for r in simhash.near_duplicates(docs, ["doc_id"]).collect()} == {1}
    assert simhash.keep_one(docs).count() == 1
