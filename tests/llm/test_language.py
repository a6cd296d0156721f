import random
import zlib

import numpy as np
import pytest

from orchard.llm import language, queries

EN = "the of and that house river quick brown language speaking which through"
FR = "le la les des maison rivière être voilà langue parler dans quelque chose"
RU = "это был дом река язык говорить через который быстро"


def text(words, r, n):
    return " ".join(r.choices(words.split(), k=n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(1)
    out = []
    for k in range(300):
        lang, words = [("en", EN), ("fr", FR), ("ru", RU)][k % 3]
        out.append((k, text(words, r, r.choice([3, 30, 300])), lang))
    return out + [(300, None, "en"), (301, "", None), (302, "123 ... ²½", "fr"), (303, "", "en"),
                  (304, text(EN, r, 60) + ". " + text(FR, r, 60), None), (None, text(RU, r, 9), None)]


def test_held_out_accuracy_and_edges(spark, docs_of, sf_of, rows):
    got = {x.doc_id: x for x in queries.op8_language_id(spark, sf_of(documents=docs_of(rows))).collect()}
    assert len(got) == len(rows)
    for k, _, lang in rows[:300]:
        assert got[k].held_out == (zlib.crc32(str(k).encode()) % 4 == 2)
        assert got[k].lang_pred == lang and 0 < got[k].score <= 1
    for k in (300, 301, 302, 303):
        assert (got[k].lang_pred, got[k].score, got[k].spans) == ("und", 0.0, "")
    assert got[None].lang_pred == "ru" and got[None].held_out is False
    first, second = got[304].spans.split(",")
    assert first.startswith("en:0:") and second.startswith("fr:")


def test_prediction_ignores_labels_of_held_out_rows(spark, docs_of, rows):
    docs = docs_of([(k, t, "zz" if k is not None and zlib.crc32(str(k).encode()) % 4 == 2 else g) for k, t, g in rows])
    from pyspark.sql import functions as F

    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    assert model.langs == ["en", "fr", "ru"]


def plain_viterbi(scores, switch):
    n, k = scores.shape
    best = scores[0].copy()
    total = [best.copy()]
    for row in scores[1:]:
        best = np.maximum(best, best.max() - switch) + row
        total.append(best.copy())
    return best.max()


def value(path, scores, switch):
    return scores[np.arange(len(path)), path].sum() - switch * (np.diff(path) != 0).sum()


def test_path_is_optimal():
    r = np.random.default_rng(0)
    for n in (1, 2, 5, 40, 200):
        for k in (1, 2, 4):
            for scale in (0.5, 3, 8):
                scores = -r.gamma(1, scale, (n, k))
                path = language.viterbi(scores, 6.0)
                assert abs(value(path, scores, 6.0) - plain_viterbi(scores, 6.0)) < 1e-9


def test_nothing_learned_and_empty_table(spark, docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(1, "words here", None), (2, "12", None)])
    model = language.fit(docs)
    found = {x.doc_id: x.f for x in docs.select("doc_id", language.label(F.col("text"), model).alias("f")).collect()}
    assert found[1].lang == "und" and found[1].letters and not found[2].letters
    assert docs_of([]).select(language.label(F.col("text"), model)).count() == 0
