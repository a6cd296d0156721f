import hashlib
import random

import numpy as np
import pytest

from orchard.llm import queries, substrings


def brute(rows, length=100):
    """rows: (doc_id, text) with unique ids -> digests by id."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            w = data[s:s + length]
            if w in seen:
                gone[s:s + length] = True
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[doc_id] = (len(data), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()),
                       hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed=1):
    r = random.Random(seed)
    words = ["the", "of", "été", "x", "日本", "stone", "river", "ab" * 9]
    text = lambda n: " ".join(r.choices(words, k=n))
    shared = [text(40) for _ in range(4)]
    line = text(30)
    out = [text(r.choice([1, 10, 60, 400])) for _ in range(25)]
    out += [text(20) + r.choice(shared) + text(20) for _ in range(25)]
    out += [text(r.randrange(9)) + "\n" + line + "\n" + text(9) for _ in range(25)]
    base = text(300).split()
    for _ in range(6):
        near = list(base)
        near[r.randrange(300)] = "changed"
        out.append(" ".join(near))
    return out + ["a" * 500, "a" * 99, "a" * 100, "ab" * 300, None, "", out[3], out[3], " " * 1000 + "b" + " " * 120,
                  shared[0][:99], shared[0][1:]]


@pytest.mark.parametrize("batch,hot,buffer", [(2000, 8192, 1 << 22), (5, 8192, 700), (7, 4, 1 << 14)])
def test_query_equals_brute_force(spark, docs_of, sf_of, monkeypatch, batch, hot, buffer):
    for name, value in (("BATCH", batch), ("HOT", hot), ("BUFFER", buffer)):
        monkeypatch.setattr(substrings, name, value)
    rows = list(enumerate(corpus()))
    random.Random(2).shuffle(rows)
    got = queries.op7_suffix_index_dedup(spark, sf_of(documents=docs_of(rows))).collect()
    assert {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got} == brute(rows)
    assert len(got) == len(rows)


@pytest.mark.parametrize("batch,buffer", [(4000, 1 << 22), (5, 700)])
def test_header_and_line_against_header_and_repeated_line(spark, docs_of, sf_of, monkeypatch, batch, buffer):
    monkeypatch.setattr(substrings, "BATCH", batch)
    monkeypatch.setattr(substrings, "BUFFER", buffer)
    r = random.Random(4)
    noise = lambda n: "".join(r.choices("abcdefghijklmnopqrstuvwxyz0123456789 ", k=n))
    texts = []
    for _ in range(120):
        header, line = noise(r.randrange(60, 200)), noise(r.randrange(30, 76)) + "\n"
        pair = [header + line + noise(r.randrange(60)), header + line * r.randrange(2, 5) + noise(r.randrange(60))]
        texts += r.sample(pair, 2)
    rows = list(enumerate(texts))
    got = queries.op7_suffix_index_dedup(spark, sf_of(documents=docs_of(rows))).collect()
    assert {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got} == brute(rows)


def test_index_is_the_sorted_collection():
    r = random.Random(3)
    for _ in range(60):
        strings = [bytes(r.choices(range(r.choice([2, 4, 256])), k=r.randrange(0, 12))) for _ in range(r.randrange(1, 12))]
        string, at, common, before = substrings.column_index(strings, 5)
        want = sorted((s[k:], i, k) for i, s in enumerate(strings) for k in range(len(s) + 1))
        assert [(strings[i][k:]) for i, k in zip(string, at)] == [w[0] for w in want]
        assert sorted(zip(string.tolist(), at.tolist())) == sorted((i, k) for _, i, k in want)
        for t in range(1, len(want)):
            a, b = want[t - 1][0], want[t][0]
            shared = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
            assert common[t] == min(shared, 5)
        assert [int(b) == 0 for b in before] == [k == 0 for k in at]


def test_gram_hashes_depend_on_the_gram_only():
    data = np.frombuffer(b"abcabcabcabcxabcabcabcabc", np.uint8)
    for gram in (1, 3, 5, 8, 11):
        h = substrings.gram_hashes(data, gram)
        assert len(h) == len(data) - gram + 1
        seen = {}
        for k, v in enumerate(h.tolist()):
            assert seen.setdefault(data[k:k + gram].tobytes(), v) == v
        assert len(set(seen.values())) == len(seen)


def test_rows_that_share_an_id_and_empty_table(spark, docs_of):
    t = "0123456789" * 9 + "the end of a line of text"
    got = substrings.deduplicate(docs_of([(None, t), (None, t), (5, t), (5, t + "x"), (5, "y")]), with_text=True).collect()
    assert sorted((x.doc_id or 0, x.n_removed) for x in got) == [(0, 0), (0, len(t)), (5, 0), (5, len(t)), (5, len(t))]
    assert sorted(bytes(x.kept) for x in got) == [b"", b"", t.encode(), b"x", b"y"]
    assert substrings.deduplicate(docs_of([])).count() == 0
