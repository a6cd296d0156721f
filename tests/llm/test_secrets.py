import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from orchard.llm import queries, secrets

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def name(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def texts():
    r = random.Random(6)
    chars = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    token = lambda n, c=chars: "".join(r.choices(c, k=n))
    word = lambda n: "".join(r.choices("etaoinshrdlu", weights=range(12, 0, -1), k=n))
    prose = lambda n: " ".join(word(r.choice([2, 5, 17, 24, 30])) for _ in range(n))
    out = [prose(80) for _ in range(80)]
    out += [f"é😀 {prose(5)} PassWord = \"{token(18)}\" {prose(3)}" for _ in range(10)]
    out += [f"{prose(5)} AKIA{token(16, chars[26:52])} {token(40, '0123456789abcdef')} {prose(3)}" for _ in range(10)]
    out += [f"{prose(9)} {token(64)} {prose(9)}" for _ in range(10)]
    out += ["secret: token: abcdefgh", "token=abc token=abcdef", "AKIAAKIA" + "A" * 16, "AKIA" + "B" * 15, "paſſword=abcdefgh",
            "api_key='x.y-z=' apikey:123456", "f" * 24 + "g" + "0" * 23, "", None, "password=" + "a1" * 5000, prose(1),
            " ".join(f"token=abcdef{k}" for k in range(1500))]
    return out


def test_base_and_random_spans(spark, docs_of, sf_of):
    rows = list(enumerate(texts())) + [(None, "token = abcdefg"), (0, texts()[0])]
    got = queries.op2_randomness_secret_scan(spark, sf_of(documents=docs_of(rows))).collect()
    assert len(got) == len(rows)
    by = {(x.doc_id, x.base_sha256): x for x in got}
    for k, text in rows:
        base = brute(text or "")
        digest = hashlib.sha256(name(base).encode()).hexdigest()
        x = by[k, digest]
        assert [x.n_assign, x.n_access, x.n_hex] == [sum(s[3] == kind for s in base) for kind in ("assign", "access", "hex")]
        spans = [] if not x.spans else x.spans.split(",")
        assert [s for s in spans if not s.startswith("random")] == (name(base).split(",") if base else [])
        assert [(int(s.split(":")[1]), secrets.KINDS.index(s.split(":")[0])) for s in spans] == sorted(
            (int(s.split(":")[1]), secrets.KINDS.index(s.split(":")[0])) for s in spans)
    found = {x.doc_id: x.n_random for x in got}
    assert all(found[k] >= 1 for k in range(100, 110))  # 64 random characters
    assert sum(found[k] for k in range(80)) == 0  # words


def test_short_keys_among_ordinary_runs(spark, docs_of, sf_of):
    r = random.Random(9)
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    syllables = ["con", "ter", "ing", "pre", "ma", "tion", "al", "is", "re", "der", "ly", "un", "est", "for", "ver", "ba"]
    word = lambda n: "".join(r.choices(syllables, k=n))
    plain = [lambda: word(8), lambda: word(9).upper(), lambda: "/".join(word(3) for _ in range(5)),
             lambda: "_".join(word(2) for _ in range(5)), lambda: "".join(word(2).title() for _ in range(5)),
             lambda: f"20{r.randrange(10, 30)}/{r.randrange(10, 13)}/{r.randrange(10, 29)}/{word(5)}-{r.randrange(100)}"]
    rows = [(k, " ".join(r.choice(plain)() for _ in range(60))) for k in range(200)]
    keys = [(200 + k, f"see {''.join(r.choices(lower + lower.upper() + digits, k=n))} here")
            for k, n in enumerate([20, 24, 32, 40] * 10)]
    got = queries.op2_randomness_secret_scan(spark, sf_of(documents=docs_of(rows + keys))).collect()
    found = {x.doc_id: x.n_random for x in got}
    assert all(sum(found[k] for k, _ in keys[c::4]) >= 9 for c in range(4))  # the battery may reject one
    assert sum(found[k] for k, _ in rows) == 0


def plain_surprise(run, name, chain):
    """The statistic of a run, by its definition in plain Python."""
    size = {e: a for e, _, a in secrets.ENCODINGS}[name]
    codes = [ord(c) for c in run]
    n, before, ratio = len(codes), 0, -len(codes) * math.log(size)
    for c in codes:
        ratio += chain[before * secrets.CODES + c - secrets.LOW_CODE]
        before = c - secrets.LOW_CODE + 1
    free = size - 1
    chi = sum((run.count(c) - n / size) ** 2 / (n / size) for c in set(run)) + (size - len(set(run))) * n / size
    z_chi = ((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free))
    mean = sum(codes) / n
    up = [c > mean for c in codes]
    mu = 2 * sum(up) * (n - sum(up)) / n + 1
    var = (mu - 1) * (mu - 2) / (n - 1)
    runs = 1 + sum(a != b for a, b in zip(up, up[1:]))
    z_runs = (runs - mu) / math.sqrt(var) if var > 0 else 0.0
    power = sum((c - mean) ** 2 for c in codes)
    lag = sum((a - mean) * (b - mean) for a, b in zip(codes, codes[1:]))
    z_lag = (lag / power + 1 / n) * math.sqrt(n) if power else 99.0
    ps = [math.erfc(z_chi / math.sqrt(2)) / 2, math.erfc(abs(z_runs) / math.sqrt(2)), math.erfc(abs(z_lag) / math.sqrt(2))]
    x = -sum(math.log(max(p, secrets.LEAST_P)) for p in ps)
    weighed = ratio + math.log1p(secrets.TILT) + secrets.TILT * (math.log1p(x + x * x / 2) - x)
    return min(max(weighed, 0.0), secrets.LOG_MAX)


def test_random_spans_equal_plain_version(spark, docs_of):
    r = random.Random(12)
    chars = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
    piece = [lambda: "".join(r.choices("etaoinshrdlu", weights=range(12, 0, -1), k=r.randrange(10, 40))),
             lambda: "".join(r.choices(chars[:62], k=r.randrange(16, 50))),
             lambda: "".join(r.choices("0123456789abcdef", k=r.randrange(16, 90))), lambda: r.choice(chars) * r.randrange(16, 40),
             lambda: "".join(r.choices(chars, k=r.randrange(16, 100))), lambda: chars[:r.randrange(20, 60)],
             lambda: "".join(r.choices("ACGT", k=r.randrange(20, 60))), lambda: str(r.randrange(10 ** 24, 10 ** 40))]
    rows = [(k, " ".join(r.choices(piece, weights=[20, 2, 1, 1, 1, 1, 1, 1])[0]() for _ in range(25))) for k in range(80)]
    runs = [(k, m.start(), m.end(), m[0]) for k, text in rows for m in re.finditer("[A-Za-z0-9+/_-]{16,}", text)]
    chain = secrets.ordinary_chain(spark.createDataFrame([(x[3],) for x in runs], "run string"))
    name = lambda run: next(e for e, p, _ in secrets.ENCODINGS if re.match(p, run))
    tested = [(*x, max(c for c in secrets.CLASSES if c <= len(x[3])), plain_surprise(x[3], name(x[3]), chain))
              for x in runs if len(x[3]) >= 20]
    near = {s[3]: s[5] for s in tested}
    df = spark.createDataFrame(list(near.items()), "run string, want double").withColumn(
        "got", secrets.surprise(F.col("run"), secrets.encoding(F.col("run")), chain))
    assert all(abs(x.want - x.got) < 1e-4 for x in df.collect())
    want = set()
    for c in secrets.CLASSES:
        own = sorted((math.floor(s[5] / secrets.LOG_STEP) for s in tested if s[4] == c), reverse=True)
        good = [k for i, k in enumerate(own) if math.exp(-k * secrets.LOG_STEP) <= secrets.FDR
                * sum(x >= k for x in own) / len(own)]
        want |= {s[:3] for s in tested if s[4] == c and good and math.floor(s[5] / secrets.LOG_STEP) >= min(good)}
    got = {(x.doc_id, s.start, s.end) for x in secrets.scan(docs_of(rows)).collect() for s in x.secret_spans if s.kind == "random"}
    assert got == want and len(want) > 40


def test_prefix_sums(spark):
    for n in (0, 1, 5, 512, 513, 1500):
        df = spark.createDataFrame([(list(range(n)),)], "v array<long>")
        got = df.select(secrets.prefix_sums(F.col("v"), 512)).first()[0]
        assert got == [sum(range(i)) for i in range(n)]


def test_only_frame_expressions(spark, docs_of):
    plan = secrets.scan(docs_of([(1, "token=abcdefgh")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table_and_clashing_column(spark, docs_of):
    assert secrets.scan(docs_of([])).count() == 0
    docs = docs_of([(1, "token=abcdefgh")]).withColumnRenamed("lang", "secret_spans")
    assert [s.kind for s in secrets.scan(docs).first().secret_spans] == ["assign"]
