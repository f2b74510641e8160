"""URL filters by a sort-merge range join over reversed-host keys [native].

A rule ``host/path`` fits a URL whose host is the rule's host or a subdomain
of it and whose path starts with the rule's path. The canonical key of a
(host, path) pair is the host with its labels reversed followed by the path
(``org.example/es/1``); a rule's key is then a prefix of the keys it fits,
that is an interval of the sorted key space. Each URL is looked up once per
parent domain (its key for ``org``, ``org.example``, ...). Rules and lookups
are swept in key order; the sweep carries the stack of nested rules that
were open at the last rule start, and a lookup takes the longest rule of the
stack that is a prefix of its key. Rules are nested or disjoint, so every
rule that contains a key is on that stack.

Sweep partitions are one reversed host each. Hosts that hold over 1/512 of
all lookups (fewer than 512 times the number of labels) are dealt over
several salts, with their rules copied to each salt. Everything is built-in
expressions and windows.

Defined cases: a null URL or one without ``://`` has empty host and path, no
rule and the default verdict; repeated rows give repeated results; null ids
are kept; an empty table gives an empty result; other columns of ``pages``
are not read. Of rules that fit, the longest ``host + path`` wins, then the
longer host, then the smaller string, then ``block`` before ``allow``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_VERDICT = "allow"
HOT_SHARE = 512
RULE_ROWS = 50_000
LOT = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def rules_frame(spark, rules=RULES) -> DataFrame:
    """Columns verdict, rule, host, path from (verdict, 'host/path') pairs."""
    df = spark.createDataFrame(list(rules), "verdict string, rule string")
    cut = F.locate("/", "rule")
    return df.select("verdict", "rule", F.translate(F.expr("substring(rule, 1, locate('/', rule) - 1)"), UPPER, LOWER)
                     .alias("host"), F.expr("substring(rule, locate('/', rule))").alias("path")).where(cut > 0)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """page_id, host, path, rule (null if none) and verdict of every row of ``pages``."""
    urls = pages.select(F.col("page_id"), F.col("url").alias("_url"))
    urls = urls.select("page_id", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))

    # one lookup per parent domain; the full host's own lookup marks the row
    n = F.size("labels")
    looked = (urls.withColumn("labels", F.reverse(F.split("host", r"\.")))
              .select("page_id", "host", "path", n.alias("n"),
                      F.explode(F.transform(F.sequence(F.lit(1), n), lambda k: F.struct(
                          k.alias("k"), F.array_join(F.slice("labels", F.lit(1), k), ".").alias("area")))).alias("at"))
              .select("page_id", "host", "path", F.col("at.area").alias("area"),
                      (F.col("at.k") == F.col("n")).cast("int").alias("own")))

    r = (rules.select("verdict", "rule", "host", "path").distinct()
         .select(F.col("verdict").alias("r_verdict"), "rule", reversed_host(F.col("host")).alias("area"),
                 F.col("path").alias("r_path")))
    areas = r.select("area").distinct()
    few = areas.limit(RULE_ROWS + 1).count() <= RULE_ROWS
    marked = F.broadcast(areas) if few else areas
    live = looked.join(marked, "area", "left_semi")

    # hot areas: fewer than HOT_SHARE of them can hold over 1/HOT_SHARE of the lookups
    counts = live.groupBy("area").count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    share = max(total // HOT_SHARE, 1000)
    hot = F.broadcast(counts.where(F.col("count") > share)
                      .select("area", F.ceil(F.col("count") / share).cast("int").alias("salts")))

    point = (live.join(hot, "area", "left")
             .withColumn("salt", F.pmod(F.xxhash64("page_id", "host", "path"), F.coalesce("salts", F.lit(1))).cast("int"))
             .select("area", "salt", F.concat("area", "path").alias("key"), F.lit(1).alias("kind"),
                     "page_id", "host", "path", "own", F.lit(None).cast("array<struct<n:int,h:int,rule:string,verdict:string,key:string>>").alias("stack")))

    # rules nested in the same area: the stack a rule opens is itself and the rules that are prefixes of its key,
    # found by their lengths (a join on the prefix), so a rule is never compared with all others of its area
    one = F.struct(F.length("rule").alias("n"), F.length("area").alias("h"), F.col("rule"),
                   F.col("r_verdict").alias("verdict"), F.concat("area", "r_path").alias("key"))
    keyed = r.select("area", F.concat("area", "r_path").alias("key"), one.alias("me"))
    lengths = keyed.groupBy("area").agg(F.collect_set(F.length("key")).alias("lengths"))
    prefixes = (keyed.select("area", "key").distinct().join(lengths, "area")
                .select("area", "key", F.explode(F.filter("lengths", lambda n: n <= F.length("key"))).alias("n"))
                .select("area", "key", F.expr("substring(key, 1, n)").alias("prefix")))
    opened = (prefixes.join(keyed.withColumnRenamed("key", "prefix"), ["area", "prefix"])
              .groupBy("area", "key").agg(F.collect_list("me").alias("stack")))
    start = (opened.join(hot, "area", "left")
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
             .select("area", "salt", "key", F.lit(0).alias("kind"), F.lit(None).cast(pages.schema["page_id"].dataType).alias("page_id"),
                     F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"),
                     F.lit(None).cast("int").alias("own"), "stack"))

    sweep = Window.partitionBy("area", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = (point.unionByName(start)
             .withColumn("open", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
             .withColumn("fit", F.expr("filter(open, x -> startswith(key, x.key))"))
             .withColumn("best", F.expr("""element_at(array_sort(fit, (a, b) -> case
                 when a.n <> b.n then b.n - a.n when a.h <> b.h then b.h - a.h
                 when a.rule <> b.rule then if(a.rule < b.rule, -1, 1)
                 when a.verdict <> b.verdict then if(a.verdict > b.verdict, -1, 1) else 0 end), 1)"""))
             .where("size(fit) > 0")
             .select("page_id", "host", "path", F.struct(
                 F.col("best.n").alias("n"), F.col("best.h").alias("h"), F.col("best.rule").alias("rule"),
                 F.col("best.verdict").alias("verdict")).alias("best"), F.lit(0).alias("own")))

    every = looked.where("own = 1").select("page_id", "host", "path", F.lit(None).cast(
        "struct<n:int,h:int,rule:string,verdict:string>").alias("best"), "own").unionByName(found)
    merged = every.groupBy("page_id", "host", "path").agg(
        F.sum("own").alias("rows"),
        F.max("best").alias("best"))
    # repeated rows come back in two steps, so that no array is as long as a row is frequent
    lots = merged.withColumn("lot", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("rows") / LOT))))
    last = F.least(F.lit(LOT).cast("long"), F.col("rows") - (F.col("lot") - 1) * LOT)
    return lots.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
                       F.explode(F.sequence(F.lit(1).cast("long"), last)).alias("copy")).drop("copy")


ORACLE = """
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(substr(regexp_extract(rest, '^[^?#]*'), length(regexp_extract(rest, '^[^/?#]*')) + 1), '') AS path FROM u),
r(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                  ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
SELECT p.page_id, p.host, p.path,
       (SELECT r.host || r.path FROM r WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
        ORDER BY length(r.host || r.path) DESC LIMIT 1) AS rule,
       coalesce((SELECT r.verdict FROM r WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
        ORDER BY length(r.host || r.path) DESC LIMIT 1), 'allow') AS verdict
FROM p
"""
