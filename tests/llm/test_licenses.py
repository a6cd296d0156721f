import random
import re

from orchard.llm import licenses, queries


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    starts, labels, best = [], set(), 0.0
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        own = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        starts += own
        labels |= {label} if own else set()
    base = sorted(labels)
    for b in range(0, len(words), 64):
        block = set(words[b:b + 128])
        for label, t in licenses.TEMPLATES:
            ws = licenses._template_words(t)
            share = len(block & set(ws)) / len(ws)
            if len(block & set(ws)) >= 0.8 * len(ws) - 1e-9:
                labels.add(label)
                best = max(best, share)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(base),
            ",".join(sorted(labels)), 1.0 if base else best)


def test_query_equals_brute_force(spark, docs_of, sf_of):
    r = random.Random(8)
    words = ["the", "of", "to", "in", "work", "is", "under", "license", "été", "İx", "K", "a1"]
    texts = [None, "", "\x7f ...", "CC-BY cc by, All Rights\nReserved. all rights reserved", "cc by" * 3, "cc",
             "general public general public license", "ALL RIGHTS", "licenKse general publiK license"]
    for k in range(60):
        body = r.choices(words, k=r.choice([3, 70, 700]))
        if k % 2:
            t = r.choice(licenses.TEMPLATES)[1].split()
            for _ in range(r.randrange(6)):
                t[r.randrange(len(t))] = "other"
            at = r.randrange(len(body))
            body[at:at] = t
        texts.append(r.choice([" ", "\n", " - "]).join(body))
    rows = list(enumerate(texts)) + [(None, texts[10]), (None, "gnu"), (3, texts[3]), (3, "other text")]
    got = queries.op5_license_similarity_join(spark, sf_of(documents=docs_of(rows))).collect()
    cols = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    key = lambda t: [(x is None, x if x is not None else 0) for x in t]
    assert sorted(([x.doc_id, *(x[c] for c in cols)] for x in got), key=key) == sorted(
        ([k, *brute(t)] for k, t in rows), key=key)
    assert {"mit", "bsd", "gpl", "cc-by"} & {label for x in got for label in x.labels.split(",") if not x.n_base}


def test_no_python_and_empty_table(spark, docs_of):
    out = licenses.scan(docs_of([]).withColumnRenamed("lang", "labels"))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_templates_longer_than_a_block(spark, docs_of):
    words = [f"w{k}" for k in range(300)]
    templates = [("long", " ".join(words)), ("middle", " ".join(words[:90])), ("short", "p q r s t")]
    rows = [(at, " ".join(["x"] * at + words + ["y"] * 50)) for at in (0, 63, 200, 299, 450)]
    rows += [(1000 + at, " ".join(["x"] * at + words[:90] + ["y"] * 50)) for at in (50, 100)]
    rows += [(2000, " ".join(words[:60])), (2001, " ".join(words[60:290])), (2002, ("z " * 150).join("pqrst"))]
    got = {x.doc_id: x.labels for x in licenses.scan(docs_of(rows), templates=templates).collect()}
    assert all(got[at] == ["long", "middle"] for at in (0, 63, 200, 299, 450))
    assert got[1050] == got[1100] == ["middle"] and got[2000] == got[2001] == got[2002] == []
