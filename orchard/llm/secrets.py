"""Secrets in texts: fixed patterns plus a battery of randomness tests, in DataFrame expressions.

Runs of 20 or more characters of A-Z a-z 0-9 + / _ - are tested. The encoding is inferred
from the characters (hex, base 32, decimal, base 36, base 62, base 64), then

* chi-squared: symbol counts against the uniform distribution over the encoding's alphabet,
* runs: Wald-Wolfowitz runs above and below the mean symbol,
* serial correlation: lag-1 correlation of neighbouring symbols

each give a p-value, and Fisher's method makes one p-value q of the three, which is about
uniform in random runs and near 0 in others. A run must also be unlike ordinary runs: a chain of
symbols is fitted on the corpus's different runs, with pre-set frequencies of letter case,
digits and letters behind it where the corpus has few. What a run is weighed against that chain
by are uniform symbols tilted towards large q, of density (1 + ``TILT``) q ^ ``TILT`` times the
uniform one's. That likelihood ratio is at least t with a chance of at most 1 / t in a run from
the chain, so its inverse is the p-value: the battery weighs in it, for or against, and no test
decides alone. Benjamini-Hochberg at ``FDR`` over all runs of a length class decides, so that
short runs, whose tests are weak, do not spend the error of long ones.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import Scratch
from orchard.operators.monitoring import erfc

# The base patterns
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
ASSIGN_MIN = 6

KINDS = ("assign", "access", "hex", "random")
RUN = "[A-Za-z0-9+/_-]{16,}"
SYMBOLS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-"
TESTED = 20  # least length of a tested run; shorter ones only tell what ordinary runs look like
# alphabets from the narrowest on: (name, pattern, size)
ENCODINGS = (
    ("decimal", "^[0-9]+$", 10),
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", 16),
    ("base32", "^[A-Z2-7]+$", 32),
    ("base36", "^([0-9a-z]+|[0-9A-Z]+)$", 36),
    ("base62", "^[0-9A-Za-z]+$", 62),
    ("base64", "^[0-9A-Za-z+/_-]+$", 64),
)
CLASSES = (20, 24, 32, 48, 80)  # least lengths of the length classes
FDR = 0.01
TILT = 1.0  # how steeply the battery's p-value weighs in the likelihood ratio
LEAST_P = 1e-300  # p-values of single tests are not taken as smaller
# English letters per thousand, and how often a symbol's kind follows another's (^: the start)
LETTERS = dict(zip("abcdefghijklmnopqrstuvwxyz", (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91,
                                                  28, 10, 24, 2, 20, 1)))
FOLLOWS = {"^": {"a": 0.6, "A": 0.3, "0": 0.07, "-": 0.03}, "a": {"a": 0.94, "A": 0.02, "0": 0.02, "-": 0.02},
           "A": {"a": 0.45, "A": 0.5, "0": 0.03, "-": 0.02}, "0": {"a": 0.08, "A": 0.04, "0": 0.8, "-": 0.08},
           "-": {"a": 0.6, "A": 0.2, "0": 0.15, "-": 0.05}}
PRIOR = 1000  # counts that the pre-set frequencies weigh, and those of kinds beside those of symbols
LOW_CODE, CODES = 43, 80  # code points of SYMBOLS: the first, and how many from it on
LOG_STEP, LOG_MAX = 0.01, 100.0  # p-values are compared as -ln p, rounded down to steps, 100 at most


def prefix_sums(values: Column, block: int = 512) -> Column:
    """Sums before each element of an array of longs; blocks keep a long array from quadratic copying."""
    def running(a: Column) -> Column:
        start = F.array(F.lit(0).cast("long"))
        return F.aggregate(a, start, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int")),
        lambda b: running(F.slice(values, b * block + 1, F.lit(block))))
    before = running(F.transform(blocks, lambda b: F.element_at(b, -1)))
    out = F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), F.slice(before, F.lit(1), F.size(blocks)).alias("o")),
                                lambda z: F.transform(F.slice(z["b"], F.lit(1), F.size(z["b"]) - 1),
                                                      lambda x: x + z["o"])))
    return F.when(F.size(values) > 0, out).otherwise(F.array().cast("array<long>"))


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches, in code points.

    ``pattern`` must not match the empty string or look around. What stands between matches
    gives their places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    sizes = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found,
                       lambda g, m: (F.length(g) + F.length(m)).cast("long"))
    placed = F.zip_with(F.zip_with(prefix_sums(sizes), F.slice(gaps, F.lit(1), F.size(found)),
                                   lambda p, g: p + F.length(g)), found,
                        lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("value")))
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return F.when(F.size(found) > 0, placed).otherwise(none)


def encoding(run: Column) -> Column:
    out = F.lit(ENCODINGS[-1][0])
    for name, pattern, _ in reversed(ENCODINGS[:-1]):
        out = F.when(run.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def by_encoding(name: Column, values: dict[str, float]) -> Column:
    return reduce(lambda out, kv: F.when(name == kv[0], F.lit(float(kv[1]))).otherwise(out), values.items(), F.lit(0.0))


def squares(run: Column) -> Column:
    """Sum of squared symbol counts."""
    return F.aggregate(F.array_distinct(F.split(run, "")), F.lit(0.0), lambda acc, c: acc + F.when(
        c != "", F.pow(F.length(run) - F.length(F.replace(run, c, F.lit(""))), F.lit(2))).otherwise(0.0))


def pairs(run: Column) -> Column:
    """For each symbol, its place in the table of a chain: by the symbol before it (row 0: none) and itself."""
    codes = F.transform(F.filter(F.split(run, ""), lambda c: c != ""), lambda c: F.ascii(c) - LOW_CODE)
    before = F.concat(F.array(F.lit(-1)), F.slice(codes, F.lit(1), F.size(codes) - 1))
    return F.zip_with(before, codes, lambda a, b: (a + 1) * CODES + b)


def log_likelihood_ratio(run: Column, name: Column, chain: list[float]) -> Column:
    """ln of how much likelier a run is under uniform symbols of its encoding than under the chain."""
    table = F.split(F.lit(",".join(f"{v:.6f}" for v in chain)), ",").cast("array<double>")
    uniform = F.length(run) * by_encoding(name, {e: math.log(a) for e, _, a in ENCODINGS})
    return F.aggregate(pairs(run), F.lit(0.0), lambda total, k: total + F.get(table, k)) - uniform


def surprise(run: Column, name: Column, chain: list[float]) -> Column:
    """-ln p of a run from the chain: its likelihood ratio with the battery's weight, between 0 and ``LOG_MAX``."""
    best = log_likelihood_ratio(run, name, chain) + math.log1p(TILT)  # the battery can only lower it
    return bind(best, lambda b: F.when(b > 0, F.least(F.greatest(b + TILT * battery(run, name), F.lit(0.0)), F.lit(LOG_MAX)))
                .otherwise(0.0))


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def battery(run: Column, name: Column) -> Column:
    """ln of the three tests' joint p-value by Fisher's method: chi-squared with six degrees of freedom."""
    def surprisal(z: Column, k: Column) -> Column:  # chi-squared rejects large scores only, the others both
        p = F.when(k == 0, 0.5 * erfc(z / math.sqrt(2))).otherwise(erfc(F.abs(z) / math.sqrt(2)))
        return -F.log(F.greatest(p, F.lit(LEAST_P)))

    total = F.aggregate(F.transform(test_scores(run, name), surprisal), F.lit(0.0), lambda a, x: a + x)
    return bind(total, lambda x: F.log1p(x + x * x / 2) - x)


def test_scores(run: Column, name: Column) -> Column:
    """Normal scores of chi-squared (large: uneven), runs and serial correlation, as an array."""
    n = F.length(run).cast("double")
    free = by_encoding(name, {e: a - 1 for e, _, a in ENCODINGS})
    chi = (free + 1) / n * squares(run) - n
    # Wilson-Hilferty: the cube root of chi-squared over its degrees of freedom is about normal
    z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    codes = F.transform(F.filter(F.split(run, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("double"))
    off = bind(codes, lambda c: bind(add(c) / n, lambda mean: F.transform(c, lambda x: x - mean)))

    def by_order(off: Column) -> Column:
        last, rest = F.slice(off, F.lit(1), F.size(off) - 1), F.slice(off, F.lit(2), F.size(off) - 1)
        runs = 1 + add(F.zip_with(last, rest, lambda x, y: F.when((x > 0) != (y > 0), 1.0).otherwise(0.0)))
        above = add(F.transform(off, lambda x: F.when(x > 0, 1.0).otherwise(0.0)))
        z_runs = bind(2 * above * (n - above) / n + 1, lambda mu: bind((mu - 1) * (mu - 2) / (n - 1), lambda var: F.when(
            var > 0, (runs - mu) / F.sqrt(var)).otherwise(0.0)))
        lag = add(F.zip_with(last, rest, lambda x, y: x * y))
        z_lag = bind(add(F.transform(off, lambda x: x * x)), lambda power: F.when(
            power > 0, (lag / power + 1 / n) * F.sqrt(n)).otherwise(F.lit(99.0)))
        return F.array(z_chi, z_runs, z_lag)

    return bind(off, by_order)


def length_class(run: Column) -> Column:
    out = F.lit(CLASSES[0])
    for least in CLASSES[1:]:
        out = F.when(F.length(run) >= least, F.lit(least)).otherwise(out)
    return out


def _kind(symbol: str) -> str:
    return "a" if symbol.islower() else "A" if symbol.isupper() else "0" if symbol.isdigit() else "-"


def ordinary_chain(runs: DataFrame) -> list[float]:
    """-ln of the chance of each symbol after each other in ordinary runs, laid out as by ``pairs``.

    Counts are of the different runs, so a key that is repeated weighs once. Behind the
    counts of pairs stand those of kinds (lower case, capitals, digits, others) and of letters
    whatever their case. The driver gets one count per pair of symbols.
    """
    counted = runs.distinct().select(F.explode(pairs(F.col("run"))).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = {r["pair"]: r["n"] for r in counted.collect()}
    rows = [(0, "^"), *((ord(s) - LOW_CODE + 1, _kind(s)) for s in SYMBOLS)]
    at = [(ord(s) - LOW_CODE, s, _kind(s)) for s in SYMBOLS]
    follows = {(k, j): PRIOR * share for k, own in FOLLOWS.items() for j, share in own.items()}
    shares = {s: PRIOR * LETTERS[s] / sum(LETTERS.values()) if s in LETTERS else PRIOR / (10 if s.isdigit() else 4)
              for s in SYMBOLS if not s.isupper()}
    for row, kind in rows:
        for place, s, other in at:
            n = counts.get(row * CODES + place, 0)
            follows[kind, other] += n
            shares[s.lower()] += n
    total = {k: sum(n for s, n in shares.items() if _kind(s) == k) for k in "a0-"}
    chain = [0.0] * ((CODES + 1) * CODES)
    for row, kind in rows:
        own = sum(counts.get(row * CODES + place, 0) for place, _, _ in at)
        kinds = sum(follows[kind, k] for k in FOLLOWS["^"])
        for place, s, other in at:
            behind = follows[kind, other] / kinds * shares[s.lower()] / total[other.lower()]
            chain[row * CODES + place] = -math.log((counts.get(row * CODES + place, 0) + PRIOR * behind) / (own + PRIOR))
    return chain


def discovery_limits(tested: DataFrame, chain: list[float]) -> dict[int, float]:
    """Least -ln p of each length class's discoveries: Benjamini-Hochberg over all tested runs.

    p-values are rounded up to steps, so the table that reaches the driver has a bounded
    number of rows (classes x steps) and no discovery is added.
    """
    step = F.floor(surprise(F.col("run"), F.col("encoding"), chain) / LOG_STEP).cast("long")
    bins = tested.select(length_class(F.col("run")).alias("cls"), step.alias("step")).groupBy("cls", "step").agg(
        F.count("*").alias("n")).collect()
    limits = {}
    for cls in CLASSES:
        own = sorted(((b["step"], b["n"]) for b in bins if b["cls"] == cls), reverse=True)
        total, ahead, limit = sum(n for _, n in own), 0, LOG_MAX + 1
        for k, n in own:
            ahead += n
            if math.exp(-k * LOG_STEP) <= FDR * ahead / total:
                limit = k * LOG_STEP
        limits[cls] = limit
    return limits


def spans(text: Column, chain: list[float], limits: dict[int, float]) -> Column:
    """array<struct<start, rank, end, kind>> of all spans of a non-null text, in order."""
    def of(found: Column, kind: str) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                                                     m["end"].alias("end"), F.lit(kind).alias("kind")))

    def discovered(m: Column) -> Column:
        run = m["value"]
        name = encoding(run)
        limit = reduce(lambda out, c: F.when(length_class(run) == c, F.lit(limits[c])).otherwise(out), CLASSES,
                       F.lit(LOG_MAX + 1))
        return (F.length(run) >= TESTED) & (F.floor(surprise(run, name, chain) / LOG_STEP) * LOG_STEP >= limit - 1e-9)

    assign = F.filter(matches(text, ASSIGN), lambda m: F.length(
        F.regexp_extract(m["value"], ASSIGN, 2)) >= ASSIGN_MIN)
    return F.array_sort(F.concat(of(assign, "assign"), of(matches(text, ACCESS), "access"), of(matches(text, HEX), "hex"),
                                 of(F.filter(matches(text, RUN), discovered), "random")))


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``secret_spans``: array<struct<start, rank, end, kind>> by start, then kind.

    Null texts count as empty and have no spans. Rows are judged one by one under limits that
    come from all rows, so repeated rows, ids of any kind and other columns (one named
    secret_spans gives way) play no part but for the counts. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "secrets")
    text = F.coalesce(F.col(text_col), F.lit(""))
    run = F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run")
    runs = scratch.write(docs.select(run), "runs")
    chain = ordinary_chain(runs)
    tested = runs.where(F.length("run") >= TESTED).withColumn("encoding", encoding(F.col("run")))
    limits = discovery_limits(tested, chain)
    scratch.drop("runs")
    keep = [c for c in docs.columns if c.lower() != "secret_spans"]
    return docs.select(*[F.col(f"`{c}`") for c in keep], spans(text, chain, limits).alias("secret_spans"))


def joined(found: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def of_kind(found: Column, kind: str) -> Column:
    return F.filter(found, lambda s: s["kind"] == kind)


def base_only(found: Column) -> Column:
    return F.filter(found, lambda s: s["kind"] != "random")
