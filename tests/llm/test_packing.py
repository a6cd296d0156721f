import math
import random
import zlib

import numpy as np
import pytest

from orchard.llm import packing, queries

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = packing.default_tokenizer()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


TEXTS = ["", None, "Hello, world's  BEST!!", "É é ß ÿ ŉ İstanbul", "a\x1cb c\x85d e\xa0f g", "日本語 ไทย Ωμέγας ΣΑΣ",
         "<|endoftext|> x<|startoftext|>y", "don't I'LL 'sa $'s 12½²x_y", "é å ́x", "×÷ªº\xad", "\U0001f600 ok"]


def test_ids_equal_the_library(tokenizer):
    own = packing.WordTokenizer(PATH)
    r = random.Random(2)
    chars = "aB é'sT$_1½\t\n Σς<|>ÀŐ"
    for text in [t or "" for t in TEXTS] + ["".join(r.choices(chars, k=60)) for _ in range(300)]:
        for _ in range(2):
            assert np.frombuffer(own(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_every_character_between_letters(tokenizer):
    own = packing.WordTokenizer(PATH)
    for c in map(chr, range(0x21, 0x250)):
        for text in (f"a{c}b", f"{c}b", f"a{c}", f"A{c}{c}B"):
            assert np.frombuffer(own(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)


def test_rare_words_do_not_push_out_frequent_ones():
    made = []
    cache = packing._generations(lambda key: made.append(key) or str(key), 50)
    assert all(cache[k] == str(k) and cache["often"] == "often" for k in range(1000))
    assert made.count("often") == 1 and len(made) == 1001 and len(cache) <= 50


def naive_bfd(lengths, capacity):
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, c in enumerate(left) if c >= n]
        if fits:
            left[min(fits, key=left.__getitem__)] -= n
        else:
            left.append(capacity - n)
    return sorted(left)


def test_segment_tree_finds_the_tightest_bin():
    r = np.random.default_rng(4)
    for capacity in (1, 7, 64, 4096):
        lengths = r.integers(1, capacity + 1, 300)
        bins, offsets = packing.best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, lengths)
        assert sorted((capacity - fill).astype(int).tolist()) == naive_bfd(lengths.tolist(), capacity)
        for b in range(bins.max() + 1):
            own = sorted(zip(offsets[bins == b], lengths[bins == b]))
            assert [o for o, _ in own] == np.concatenate(([0], np.cumsum([n for _, n in own])[:-1])).tolist()


def test_query_contract(spark, docs_of, sf_of, tokenizer):
    r = random.Random(3)
    texts = TEXTS + [" ".join(r.choices(["alpha", "Beta,", "x1", "déjà"], k=r.choice([3, 200, 6000]))) for _ in range(40)]
    rows = list(enumerate(texts)) + [(3, "twin"), (3, "twin"), (None, "no id")]
    got = queries.op3_best_fit_packing(spark, sf_of(documents=docs_of(rows))).collect()
    want = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for p in range(math.ceil(len(ids) / 4096)):
            part = ids[p * 4096:(p + 1) * 4096]
            want.append((-1 if doc_id is None else doc_id, p, p * 4096, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((-1 if x.doc_id is None else x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in got) == sorted(want)
    held = {}
    for x in got:
        held.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(held) <= math.ceil(sum(w[3] for w in want) / 4096) + 1


def test_sequences_hold_the_ids(spark, docs_of, tokenizer):
    docs = docs_of([(k, "word " * (k * 90)) for k in range(60)])
    got = packing.sequences(docs, PATH).collect()
    assert all(len(x.ids) <= 4096 for x in got)
    assert sum(len(x.ids) for x in got) == sum(len(tokenizer.encode("word " * (k * 90)).ids) + 1 for k in range(60))


def test_groups_split_many_pieces(spark, docs_of, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    docs = docs_of([(7, "same text") for _ in range(400)])
    got = packing.pack_documents(docs, PATH, capacity=16).collect()
    assert len(got) == 400 and len({x.sequence_id >> 32 for x in got}) == 8


def test_empty_table(spark, docs_of):
    assert packing.pack_documents(docs_of([]), PATH).count() == 0
