import random
import re
from itertools import permutations

from orchard.llm import filter_audit, queries

LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    """Rows of the report: every order replayed document by document."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    fails = []
    for doc_id, text, lang in rows:
        t = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        f = set()
        if len(words) < 200:
            f.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            f.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 3 * len(t):
            f.add("C")
        if re.search("[#$%&*|]", t):
            f.add("D")
        if doc_id is not None and any(j is not None and j < doc_id and (u or "") == t for j, u, _ in rows):
            f.add("E")
        fails.append((lang or "", f, doc_id in good and doc_id is not None, doc_id in toxic and doc_id is not None))
    out, shapley = {}, {}
    for part in {p for p, *_ in fails}:
        own = [x for x in fails if x[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                hit = [x for x in left if f in x[1]]
                gone = [x for x in own if f in x[1] and not any(x is y for y in left)]
                left = [x for x in left if f not in x[1]]
                out[part, order, step] = (len(left), len(hit), len(gone), sum(x[1] == {f} for x in own),
                                          sum(x[2] for x in hit), sum(x[3] for x in hit))
                shapley[part, f] = shapley.get((part, f), 0) + len(hit)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got_of(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
                                               r.shapley) for r in df.collect()}


def random_rows(r, n):
    texts = ["", None, "a b c", "A|B", "#", " \t\n", "x " * 300, "Word " * 250, "MANY CAPS " * 5] + [
        " ".join(r.choices(["alpha", "Beta", "x$", "déjà", "ÉCOLE", "d\x0be"], k=k)) for k in (3, 150, 199, 200, 201, 400)] + [
        " ".join(f"w{r.randint(0, 9999)}" for _ in range(220)) for _ in range(5)]
    return [(r.randint(0, n), r.choice(texts), r.choice(["en", "de", None, ""])) for _ in range(n)]


def write(spark, rows, path, files=6):
    """One file per run of rows, in the order of the rows, as separate writes would leave them."""
    size = -(-len(rows) // files)
    for k in range(0, len(rows), size):
        part = [(i, t, lang, "s", "clash", 0) for i, t, lang in rows[k:k + size]]
        df = spark.createDataFrame(part, "doc_id long, text string, lang string, source string, key string, mask int")
        df.coalesce(1).write.mode("append").parquet(path)


def test_query_against_brute_force(spark, tmp_path):
    r = random.Random(11)
    rows = random_rows(r, 120) + [(None, "a b c", "en"), (None, "a b c", "en"), (3, "twin", "en"), (3, "twin", "en"),
                                  (3, "twin", "de"), (1, "twin", "de")]
    rows.sort(key=lambda x: -(x[0] or 0))  # smaller ids come later: every batch retracts
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 120, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    write(spark, rows, f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    assert got_of(queries.op13_filter_interaction_audit(spark, str(tmp_path))) == brute(rows, labels)


def test_later_files_retract_and_nothing_is_read_twice(spark, tmp_path):
    r = random.Random(12)
    labels = spark.createDataFrame([(5, 1, 1)], LABELS)
    late = [(5, "copy of all", "en")]
    rows = [(100 + k, "copy of all", r.choice(["en", "de"])) for k in range(40)] + [(7, "copy of all", "de"), (7, "copy of all", "de")]
    path, folder = f"{tmp_path}/d", f"{tmp_path}/state"
    write(spark, rows, path, 3)
    first = got_of(filter_audit.audit(spark, path, labels, folder))
    assert first == brute(rows, [(5, 1, 1)])
    again = got_of(filter_audit.audit(spark, path, labels, folder))
    assert again == first
    write(spark, late, path, 1)
    assert got_of(filter_audit.audit(spark, path, labels, folder)) == brute(rows + late, [(5, 1, 1)])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/d")
    assert filter_audit.audit(spark, f"{tmp_path}/d", spark.createDataFrame([], LABELS)).count() == 0
