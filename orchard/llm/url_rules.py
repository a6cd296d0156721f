"""URL allow / block rules by a sort-merge range join over reversed-host keys.

A rule covers its host and all subdomains, for paths that start with the rule's path. With
the host's labels reversed (``www.example.com`` -> ``com.example.www.``) whatever a rule
covers is one interval of keys, and intervals nest or are disjoint. Rules and URLs are
ordered together and cut into ranges; a sweep over a range counts rules that open and close,
so the count at a URL is the height of its stack of active rules, and the rule on level l of
that stack is the last one that opened on level l. Rules still open where a range
begins are carried into it. Two sweeps: by reversed host, for the hosts with rules that
enclose a URL, then by such a host and path, for its innermost rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orchard.llm.common import Scratch, lower_ascii, shuffle_partitions

# Fixed values: (verdict, host, path) of the base rules
BASE_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or # (A-Z lower-cased); else empty."""
    authority = F.split(_after_scheme(url), "[/?#]", 2)[0]
    return F.coalesce(lower_ascii(authority), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; empty without ://."""
    rest = F.split(_after_scheme(url), "[?#]", 2)[0]
    slash = F.instr(rest, "/")
    return F.coalesce(F.when(slash > 0, F.substring(rest, slash, F.length(rest))), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def reversed_key(host: Column) -> Column:
    """Labels in reverse order, a dot after each; the empty host has the empty key."""
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _after_all(key: Column) -> Column:
    """The end of a rule's interval: no UTF-8 text holds the byte FF."""
    return F.concat(key, F.unhex(F.lit("FF")))


def _probe_place(key: Column, *spread: str) -> Column:
    """Behind every rule that the key's own extensions open and close, before the end of the
    rules that are prefixes of the key; equal keys are spread by hash, so that they can be cut."""
    mixed = F.lpad(F.hex(F.xxhash64(*spread)), 16, "0")
    return F.concat(key, F.unhex(F.concat(F.lit("FE"), mixed)))


def enclosing(rules: DataFrame, probes: DataFrame, scratch: Scratch, name: str, innermost: bool) -> DataFrame:
    """``probes`` joined with the rules whose key is a prefix of theirs, as column ``hit``.

    ``rules``: key (binary, distinct), rule (any type). ``probes``: place (binary, from
    ``_probe_place``) and other columns. One row per probe and enclosing rule, or only the
    one with the longest key. Probes that no rule encloses are left out. Writes the ranges as table ``name``.
    """
    carried = [c for c in probes.columns if c != "place"]
    rule_type = rules.schema["rule"].dataType
    row_type = probes.select(F.struct(*carried)).schema[0].dataType
    none = F.lit(None)
    opens = rules.select(F.col("key").alias("place"), "key", F.lit(1).alias("step"), "rule", none.cast(row_type).alias("row"))
    ends = rules.select(_after_all(F.col("key")).alias("place"), "key", F.lit(-1).alias("step"),
                        none.cast(rule_type).alias("rule"), none.cast(row_type).alias("row"))
    asked = probes.select("place", none.cast("binary").alias("key"), F.lit(0).alias("step"),
                          none.cast(rule_type).alias("rule"), F.struct(*carried).alias("row"))
    laid = scratch.write(
        opens.unionAll(ends).unionAll(asked).repartitionByRange(shuffle_partitions(rules.sparkSession), "place")
        .withColumn("range", F.spark_partition_id()), name)
    # a rule that ends in a later range than it opens in is open at the start of every range between
    last = laid.where("step = -1").select("key", F.col("range").alias("last"))
    open_at_start = (laid.where("step = 1").join(last, "key").where("last > range")
                     .withColumn("range", F.explode(F.sequence(F.col("range") + 1, F.col("last"))))
                     .select(*laid.columns))
    along = Window.partitionBy("range").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    high = laid.unionAll(open_at_start).withColumn("height", F.sum("step").over(along)).where("step >= 0 and height > 0")
    asks = F.col("step") == 0
    if innermost:
        high = high.withColumn("level", F.col("height"))
    else:
        high = high.withColumn("level", F.explode(
            F.when(asks, F.sequence(F.lit(1).cast("long"), F.col("height"))).otherwise(F.array("height"))))
    on_level = Window.partitionBy("range", "level").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (high.withColumn("hit", F.last("rule", ignorenulls=True).over(on_level)).where(asks)
            .select(*[F.col(f"row.`{c}`").alias(c) for c in carried], "hit"))


def judge(urls: DataFrame, rules: DataFrame | Sequence[tuple[str, str, str]] = BASE_RULES, url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """``urls`` with host, path, rule and verdict in place of columns of those names.

    ``rules``: a table with columns verdict, host, path (others play no part) or a list of such
    triples; path null, empty or from "/"; the text of a rule is host followed by path. Of the
    rules that fit, the longest text wins, then the smaller text; of rules of equal text the
    smaller verdict counts. Rules with a null verdict, a null or empty host, or a host or path that no
    url can have fit nothing. Without a fitting rule, rule is null and verdict ``default``. A null url or one
    without :// has empty host and path, which no rule fits. Repeated rows stay; an empty
    table gives none.

    The sweeps see each different (host, path) once; the last join gives the rows their
    verdicts, and Spark splits its partitions where one url has most of the rows.
    """
    spark = urls.sparkSession
    scratch = Scratch(spark, "url-rules")
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "verdict string, host string, path string")
    path = F.coalesce("path", F.lit(""))
    rules = (rules.where(r"verdict is not null and host != '' and not host rlike '[/?#]'")
             .where((path == "") | (path.startswith("/") & ~path.rlike("[?#]")))
             .select(reversed_key(F.col("host")).cast("binary").alias("host_key"), path.alias("path"),
                     F.concat("host", path).alias("text"), "verdict"))
    rules = scratch.write(rules.groupBy("host_key", "path", "text").agg(F.min("verdict").alias("verdict")), "rules")

    keep = [c for c in urls.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    url = F.col(f"`{url_col}`")
    rows = urls.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), host_of(url).alias("host"), path_of(url).alias("path"))
    named = urls.select(host_of(url).alias("host"), path_of(url).alias("path")).where("host != ''").distinct()
    full = F.concat(reversed_key(F.col("host")).cast("binary"), F.col("path").cast("binary"))
    hosts = rules.select(F.col("host_key").alias("key"), F.col("host_key").alias("rule")).distinct()
    within = enclosing(hosts, named.withColumn("place", _probe_place(full, "host", "path")), scratch, "by-host", innermost=False)

    paths = rules.select(F.concat("host_key", F.col("path").cast("binary")).alias("key"),
                         F.struct((-F.length("text")).alias("size"), "text", "verdict").alias("rule"))
    under = F.concat("hit", F.col("path").cast("binary"))
    fits = enclosing(paths, within.withColumn("place", _probe_place(under, "host", "path")).drop("hit"), scratch,
                     "by-path", innermost=True)
    best = scratch.write(fits.groupBy("host", "path").agg(F.min("hit").alias("best")), "verdicts")
    scratch.drop("rules", "by-host", "by-path")
    return rows.join(best, ["host", "path"], "left").select(
        *[F.col(f"row.`{c}`").alias(c) for c in keep], "host", "path", F.col("best.text").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


# DuckDB: every rule tried on every page
ORACLE = """
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN url[instr(url, '://') + 3:] ELSE '' END AS rest FROM pages
), named AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/'))
SELECT page_id, host, path,
  (SELECT h || p FROM rules WHERE (host = h OR suffix(host, '.' || h)) AND starts_with(path, p)
   ORDER BY length(h || p) DESC, h || p LIMIT 1) AS rule,
  coalesce((SELECT verdict FROM rules WHERE (host = h OR suffix(host, '.' || h)) AND starts_with(path, p)
   ORDER BY length(h || p) DESC, h || p LIMIT 1), 'allow') AS verdict
FROM named
"""
