import random

from orchard.llm import queries, url_rules


def brute(url, rules=url_rules.BASE_RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(-len(h + p), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = min(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


URLS = [None, "", "no scheme", "http://", "http:///en/", "https://Example.COM/en/x?q=/en/#f", "http://www.example.com/en/",
        "http://a.www.example.com/en/1", "http://notexample.com/en/", "http://example.com", "http://example.com?x=/en/",
        "http://x.net/es/#a", "http://net/fr/", "http://x.net/de/", "http://x.org/en/", "http://com/", "http://.com/",
        "http://a..b.com/q", "x://y://z.com/a", "http://ÉX.com/en/", "http://x.com." , "http://example.com:80/en/"]


def test_equals_brute_force(spark, sf_of):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(None, URLS[5], "<p>"), (None, URLS[5], "<p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = queries.op10_url_range_join(spark, sf_of(pages=pages)).collect()
    want = [(p, *brute(u)) for p, u, _ in rows]
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_nested_rules_and_random_hosts(spark):
    r = random.Random(7)
    labels = ["a", "b", "ab", "c", "com", "a-b"]
    host = lambda: ".".join(r.choice(labels) for _ in range(r.randrange(1, 5)))
    rules = [(r.choice(["allow", "block"]), host(), r.choice(["", "/", "/x/", "/x/y"])) for _ in range(60)]
    rules = list({(h, p): (v, h, p) for v, h, p in rules}.values())
    urls = [f"http://{host()}{r.choice(['', '/', '/x/', '/x/y/z', '/q'])}" for _ in range(500)]
    df = spark.createDataFrame([(u, "clash") for u in urls], "url string, rule string")
    got = url_rules.judge(df, rules, default="none")
    assert got.columns == ["url", "host", "path", "rule", "verdict"]
    for row in got.collect():
        want = brute(row.url, rules)
        assert row.rule == want[2] and row.verdict == (want[3] if want[2] else "none")


def test_empty_table(spark):
    assert url_rules.judge(spark.createDataFrame([], "url string")).count() == 0


def test_rules_that_fit_nothing_and_equal_text(spark):
    rules = spark.createDataFrame(
        [("block", "a.com", "/"), ("allow", "a.com", "/"), (None, "a.com", "/x/"), ("block", None, "/"), ("block", "", "/"),
         ("block", "a.com", "x"), ("block", "b.com/x", "/"), ("block", "A.net", "/"), ("block", "c.com", None)],
        "verdict string, host string, path string")
    df = spark.createDataFrame([(f"http://{u}",) for u in ("a.com/x/", "a.com", "b.com/x/", "a.net/", "x.c.com", "xc.com")],
                               "url string")
    got = {r.url[7:]: (r.rule, r.verdict) for r in url_rules.judge(df, rules, default="none").collect()}
    assert got == {"a.com/x/": ("a.com/", "allow"), "a.com": (None, "none"), "b.com/x/": (None, "none"),
                   "a.net/": (None, "none"), "x.c.com": ("c.com", "block"), "xc.com": (None, "none")}
    assert url_rules.judge(df, [], default="none").where("rule is null and verdict = 'none'").count() == 6


def test_deep_nests_across_ranges(spark):
    # chains of nested hosts and paths, longer than a range, with urls on every level
    deep = [".".join(["a"] * n) for n in range(1, 30)]
    rules = [("block" if n % 2 else "allow", h, "/" + "p" * (n % 5)) for n, h in enumerate(deep)]
    rules += [("block", "x.y", "/" + "q" * n) for n in range(40)] + [("allow", "y", "")]
    urls = [f"http://{h}/{'p' * n}" for h in deep for n in range(6)] + [f"http://w.x.y/{'q' * n}r" for n in range(45)]
    urls += ["http://x.y", "http://w.x.y/z"] * 300
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = url_rules.judge(df, rules, default="none").collect()
    assert len(got) == len(urls)
    for row in got:
        want = brute(row.url, rules)
        assert row.rule == want[2] and row.verdict == (want[3] if want[2] else "none"), row.url


def test_many_rules(spark):
    # 100,000 rules as a table, none of them in the plan; one host has a third of the urls
    n = 100_000
    ids = spark.range(n)
    rules = ids.selectExpr("CASE WHEN id % 3 = 0 THEN 'allow' ELSE 'block' END AS verdict",
                           "CASE WHEN id % 2 = 0 THEN concat('h', id, '.com') ELSE 'big.org' END AS host",
                           "CASE WHEN id % 2 = 0 THEN '/' ELSE concat('/', id, '/') END AS path")
    urls = ids.selectExpr("id", "concat('http://www.', CASE WHEN id % 3 = 0 THEN 'big.org' ELSE concat('h', id, '.com') END, "
                          "'/', id, '/x') AS url")
    out = url_rules.judge(urls, rules, default="none")
    assert "ELSE block END" not in out._jdf.queryExecution().toString()
    got = out.selectExpr(
        "count(*) AS n", "count_if(rule IS NOT NULL) AS hit",
        """count_if(NOT rule <=> CASE WHEN id % 3 = 0 THEN IF(id % 2 = 1, concat('big.org/', id, '/'), NULL)
           ELSE IF(id % 2 = 0, concat('h', id, '.com/'), NULL) END) AS wrong""").first()
    assert got.n == n and got.wrong == 0 and got.hit > 0
