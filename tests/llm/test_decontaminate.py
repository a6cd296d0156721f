import random

from orchard.llm import decontaminate, queries


def brute(doc, item):
    own, words = decontaminate.words_of(doc), decontaminate.words_of(item)
    width = min(5, len(words))  # items of fewer words are one run of their own width
    q = set(decontaminate.shingles_of(words, 5))
    d = {" ".join(own[i:i + width]) for i in range(len(own) - width + 1)}
    return (len(d & q), len(q)) if q and len(d & q) >= 0.8 * len(q) - 1e-9 else None


def test_query_equals_brute_force(spark, docs_of, sf_of, monkeypatch):
    monkeypatch.setattr(decontaminate.Search.__init__, "__defaults__", (8,))  # a filter that lets most values through
    r = random.Random(5)
    words = [f"w{k}" for k in range(40)] + ["Été", "x_1"]
    items = [" ".join(r.choices(words, k=r.choice([1, 2, 3, 4, 5, 8, 30, 60]))) for _ in range(30)] + [None, "", "...", "w1, W2"]
    docs = []
    for k in range(60):
        body = r.choices(words, k=r.choice([1, 20, 200, 2000]))
        if k % 2:
            passage = (r.choice(items[:30])).split()
            for _ in range(r.randrange(3)):
                passage[r.randrange(len(passage))] = "changed"
            at = r.randrange(len(body) + 1)
            body[at:at] = passage
        docs.append(" ".join(body).upper() if k % 3 else ",  ".join(body))
    docs += [None, "", "w1 w2", "W1; w2!", items[0], items[0]]
    rows = list(enumerate(docs))
    bench = spark.createDataFrame(list(enumerate(items)) + [(0, items[0])], "item_id long, text string")
    got = queries.op6_benchmark_decontamination(spark, sf_of(documents=docs_of(rows), benchmark=bench)).collect()
    want = [(d, i, *brute(doc, item)) for d, doc in rows for i, item in [*enumerate(items), (0, items[0])]
            if brute(doc, item)]
    assert sorted((x.doc_id, x.item_id, x.n_shared, x.n_shingles) for x in got) == sorted(want)
    assert len(want) >= 15
    assert all(abs(x.containment - x.n_shared / x.n_shingles) < 1e-12 for x in got)


def test_clean_keeps_rows_and_columns(spark, docs_of):
    items = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    docs = docs_of([(1, "x a b c d e f g h i j y"), (None, "p q"), (2, None), (2, None)]).withColumnRenamed(
        "source", "item_id")
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted((x.doc_id or 0, x.text or "") for x in kept.collect()) == [(0, "p q"), (2, ""), (2, "")]
    assert decontaminate.contaminated(docs, items).select("doc_id", "item_id").collect() == [(1, 1)]


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(docs_of([(1, "a")]), none).count() == 0
    assert decontaminate.clean(docs_of([(1, "a")]), none).count() == 1
    assert decontaminate.contaminated(docs_of([]), none).count() == 0


def test_short_items_inside_long_documents(spark, docs_of):
    items = spark.createDataFrame([(1, "what is blue"), (2, "Blue"), (3, "is what"), (4, "one two three four")], "item_id long, text string")
    docs = docs_of([(1, "tell me: What is BLUE? " + "filler " * 3000), (2, "one two three, four"), (None, "one two three 4"), (None, "blue")])
    got = decontaminate.contaminated(docs, items).collect()
    assert sorted((x.doc_id or 0, x.item_id) for x in got) == [(0, 2), (1, 1), (1, 2), (2, 4)]
    assert [x.text for x in decontaminate.clean(docs, items).collect()] == ["one two three 4"]


def test_a_third_of_the_documents_hold_one_item(spark, docs_of):
    item = " ".join(f"q{k}" for k in range(20))
    docs = docs_of([(k, f"a{k} {item} b{k}" if k % 3 == 0 else f"c{k} d") for k in range(600)] + [(None, item)] * 50)
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert decontaminate.contaminated(docs, items).count() == 250
    assert decontaminate.clean(docs, items).count() == 400
