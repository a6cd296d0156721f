import random
import zlib

import numpy as np
import pytest

from orchard.llm import packing, queries, vector_packing
from orchard.llm.vector_packing import Limits, Piece, Pool, fill

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = packing.default_tokenizer()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def padding(total, capacity):
    return 0 if total & (total - 1) == 0 else capacity - total


def check(rows, want, limits):
    """Every token once, gapless places, limits kept; returns the padding of all sequences."""
    pieces, held = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        held.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(want)
    for doc_id, ids in want.items():
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    waste = 0
    for parts in held.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and sum(r.segments for r in parts) <= limits.segments
        assert sum(r.loss for r in parts) <= limits.loss
        waste += padding(at, limits.tokens)
    return waste


def test_query_contract(spark, docs_of, sf_of, tokenizer):
    r = random.Random(5)
    texts = ["", None, "Hello, world's  BEST!!", "日本語 ไทย", "x " * 9000] + [
        " ".join(r.choices(["alpha", "Beta,", "x1", "déjà"], k=r.choice([1, 3, 200, 6000]))) for _ in range(200)]
    rows = list(enumerate(texts)) + [(None, "no id")]
    docs = docs_of(rows).withColumnsRenamed({"source": "length", "lang": "Sequence_Id"})
    got = queries.op11_vector_bin_packing(spark, sf_of(documents=docs)).collect()
    want = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for k, t in rows}
    assert check(got, want, Limits()) == 0


def test_repeated_rows_are_examples_of_their_own(spark, docs_of):
    got = vector_packing.pack(docs_of([(7, "same text")] * 500 + [(None, None)] * 300), PATH, Limits(16, 3, 16)).collect()
    assert sum(r.length for r in got) == 500 * 3 + 300
    assert vector_packing.pack(docs_of([]), PATH).count() == 0


@pytest.mark.parametrize("cut", [True, False])
def test_prompts_and_three_limits(spark, tokenizer, cut):
    r = random.Random(6)
    rows = [(k, "ask " * r.choice([0, 2, 30, 90]) if k % 9 else None, "say " * r.choice([0, 1, 5, 40, 200]),
             r.choice([None, 0, 1, 2, 5, 99])) for k in range(700)]
    df = spark.createDataFrame(rows, "id long, prompt string, text string, turns int").repartition(2)
    limits = Limits(tokens=128, segments=12, loss=64)
    got = vector_packing.pack(df, PATH, limits, cut=cut, id_col="id", prompt_col="prompt", segments_col="turns").collect()
    ids = {w: tokenizer.encode(w, add_special_tokens=False).ids for w in ("ask", "say")}
    want = {k: ids["ask"] * (p or "").count("ask") + ids["say"] * t.count("say") + [2] for k, p, t, _ in rows}
    waste = check(got, want, limits)
    prompt = {k: len(ids["ask"]) * (p or "").count("ask") for k, p, _, _ in rows}
    for x in got:
        assert x.loss == sum(x.start <= i < x.start + x.length for i in range(prompt[x.doc_id], x.doc_tokens))
    if cut:
        assert waste == 0
    else:  # whole but where the example itself breaks a limit
        parts = {k: sum(x.doc_id == k for x in got) for k in want}
        assert all(n == 1 for k, n in parts.items() if len(want[k]) <= 128 and len(want[k]) - prompt[k] <= 64)


def naive_best(pieces, left, weights):
    fits = [p for p in pieces if p.length <= left[0] and p.segments <= left[1] and p.loss <= left[2]]
    return max((sum(w * c * d for w, c, d in zip(weights, left, (p.length, p.segments, p.loss))) for p in fits), default=None)


def test_choice_has_the_largest_dot_product():
    r = random.Random(7)
    for loss_from in (0, 10 ** 6):  # every token bears loss, or none: one cell, so the choice is exact
        pool = Pool(Limits(100, 10, 80))
        pieces = [Piece(k, b"", 0, r.randint(1, 70), 1, loss_from) for k in range(60)]
        for p in pieces:
            pool.add(p)
        while pieces:
            left, weights = (r.randint(1, 100), r.randint(1, 10), r.randint(1, 80)), pool.weights()
            got, want = pool.best(*left, weights), naive_best(pieces, left, weights)
            assert (got is None) == (want is None)
            if got:
                assert got.length <= left[0] and got.loss <= left[2]
                assert sum(w * c * d for w, c, d in zip(weights, left, (got.length, 1, got.loss))) == pytest.approx(want)
                pieces.remove(got)
            else:
                p = pool.held[(*pool.cell(pieces[0]), pieces[0].length)][-1]
                pieces.remove(pool.take(pool.cell(p), p.length))


def test_whole_packing_is_about_as_tight_as_first_fit_decreasing():
    r = random.Random(8)
    sizes = [(r.randint(1, 90), r.random()) for _ in range(800)]
    limits = Limits(100, 8, 60)
    pool = Pool(limits)
    demands = []
    for n, share in sizes:
        p = Piece(None, b"", 0, n, 1, n - min(60, int(n * share)))
        demands.append((n, 1, p.loss))
        pool.add(p)
    bins = []
    for d in sorted(demands, reverse=True):
        for b in bins:
            if all(x <= y for x, y in zip(d, b)):
                break
        else:
            bins.append(b := [100, 8, 60])
        b[:] = [y - x for x, y in zip(d, b)]
    used = 0
    while pool.rows:
        fill(pool, cut=False)
        used += 1
    assert used <= 1.03 * len(bins)


def test_waiting_pieces_are_bounded(spark, docs_of, monkeypatch, tokenizer):
    monkeypatch.setattr(vector_packing, "POOL_TOKENS", 64)
    rows = [(k, "word " * (k % 50)) for k in range(400)]
    got = vector_packing.pack(docs_of(rows), PATH, Limits(32, 4, 32)).collect()
    one = tokenizer.encode("word", add_special_tokens=False).ids
    assert check(got, {k: one * (k % 50) + [2] for k, _ in rows}, Limits(32, 4, 32)) == 0


def test_sequences_hold_the_ids(spark, docs_of):
    packed = vector_packing.pack(docs_of([(k, "word " * (k * 90)) for k in range(60)]), PATH, with_ids=True)
    got = vector_packing.sequences(packed).collect()
    assert all(len(x.ids) == sum(x.lengths) and not padding(len(x.ids), 4096) for x in got)
