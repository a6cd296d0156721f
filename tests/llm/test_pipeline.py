import math
import random

import pytest

import corpus_pipeline
from orchard.llm import decontaminate, packing
from .test_secrets import brute as secret_spans
from .test_simhash import brute_components, brute_print

pytest.importorskip("public_tokenizers")


def corpus():
    r = random.Random(11)
    words = {"en": "the of and house river quick brown language speaking".split(),
             "fr": "le la les maison rivière voilà langue parler quelque".split()}
    item = " ".join(r.choices(words["en"], k=30))
    rows = []
    for k in range(120):
        lang = ("en", "fr")[k % 2]
        rows.append((k, " ".join(r.choices(words[lang], k=r.choice([8, 60, 400]))), lang))
    rows += [(200, "first " + item + " last", "en"), (201, "123 ...", "en"), (202, None, "fr"), (203, "", "fr"),
             (204, rows[4][1], "en"), (205, rows[5][1] + " ", "fr"), (206, "password = abcdef123 " + rows[8][1], "en"),
             (207, rows[9][1] + " AKIA" + "B2" * 8, "fr"), (208, rows[8][1] + " token=abc", "en"), (4, rows[4][1], "en")]
    return rows, item


def brute(rows, item):
    kept = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    heads = brute_components([brute_print(t) for _, t, _ in kept])
    groups = {}
    for row, head in zip(kept, heads):
        groups.setdefault(head, []).append(row)
    kept = [min(g, key=lambda r: r[0]) for g in groups.values()]
    q = set(decontaminate.shingles_of(decontaminate.words_of(item), 5))
    kept = [r for r in kept if len(q & set(decontaminate.shingles_of(decontaminate.words_of(r[1]), 5))) < 0.8 * len(q)]
    return [r for r in kept if not secret_spans(r[1])]


def test_pipeline_equals_brute_force(spark, docs_of, sf_of):
    rows, item = corpus()
    bench = spark.createDataFrame([(1, item), (2, None)], "item_id long, text string")
    got = corpus_pipeline.run(spark, sf_of(documents=docs_of(rows), benchmark=bench)).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    want = []
    for doc_id, text, _ in brute(rows, item):
        n = len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
        want += [(doc_id, p, min(4096, n - p * 4096)) for p in range(math.ceil(n / 4096))]
    assert sorted((x.doc_id, x.piece, x.length) for x in got) == sorted(want)
    assert {200, 201, 202, 203, 204, 205, 206, 207}.isdisjoint(x.doc_id for x in got) and len(want) > 100


def test_stages_keep_the_columns_and_survive_empty_tables(spark, docs_of, sf_of):
    bench = spark.createDataFrame([], "item_id long, text string")
    folder = sf_of(benchmark=bench)
    for rows in ([], [(None, None, None), (1, "", None)]):
        docs = docs_of(rows).selectExpr("*", "1 AS secret_spans", "'x' AS fp")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns, name
            assert out.count() <= len(rows)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == len(rows)
