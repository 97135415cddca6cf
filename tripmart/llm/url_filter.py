"""URL filters by a sort-merge range join.

A rule is a host, a path and a verdict, written ``host/path``. It fits a url
whose host is the rule's or a subdomain of it and whose path starts with the
rule's path; of the rules that fit, the longest wins. Urls that no rule fits get
the default verdict.

Host keys are reversed and end in a dot (``net.example.``), so the subdomains of
a host are one interval of keys, and intervals are nested or apart. Rules and
keys are sorted together and swept once: the rule opened last before a key, with
the stack of rules that enclose it, has all rules that may still be open there;
those that the key starts with are. A first sweep over the different hosts finds
each host's rule hosts, a second one over the different (rule host, path) keys
finds the rules.

The sweep runs in range partitions: each block of the sorted order is swept by a
window, and takes over the last rule opened in the blocks before it (one row per
block). Hosts and paths are made distinct first, so a host that has a third of
all pages is one key; its pages meet the verdict in a join that can be split.
Only DataFrame functions are used.

Defined cases: a url that is null or has no ``://`` has an empty host and path,
which no rule fits. Host letters A-Z are lower-cased, in rules too; a rule
without ``/`` has an empty path, which every path starts with. Rules that are
null are left out; of equal rules with both verdicts, block wins. Repeated pages
each get their row; null page_ids are kept; further columns are left out. An empty
pages table gives no row; without rules every page gets the default verdict.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm.common import written

#: The rules of the registered query (fixed values).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def _lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return _lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _stacks(rules: DataFrame) -> DataFrame:
    """key, stack: for each different key, the keys that it starts with (itself
    too), shortest first."""
    keys = rules.select("key").distinct()
    starts = keys.select("key", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("n")) \
        .select("key", F.expr("substring(key, 1, n)").alias("outer"))
    return starts.join(keys.withColumnRenamed("key", "outer"), "outer") \
        .groupBy("key").agg(F.sort_array(F.collect_set("outer")).alias("stack"))


def sweep(points: DataFrame, rules: DataFrame) -> DataFrame:
    """points (key) with open: the rule keys that the point's key starts with,
    shortest first. Points without any are left out."""
    events = _stacks(rules).select("key", F.lit(0).alias("kind"), "stack").unionByName(
        points.select("key").distinct().withColumn("kind", F.lit(1)), allowMissingColumns=True)
    events = written(events.repartitionByRange("key", "kind").withColumn("block", F.spark_partition_id()), "sweep")
    last = events.where("kind = 0").groupBy("block").agg(F.max_by("stack", "key").alias("last"))
    blocks = events.select("block").distinct().join(last, "block", "left")
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("block", F.last("last", ignorenulls=True).over(before).alias("carried"))
    here = Window.partitionBy("block").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = events.withColumn("opened", F.last("stack", ignorenulls=True).over(here)).where("kind = 1") \
        .join(F.broadcast(carried), "block")  # at most one row per partition
    found = F.filter(F.coalesce("opened", "carried"), lambda r: F.startswith(F.col("key"), r))
    return swept.select("key", found.alias("open")).where(F.size("open") > 0)


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RULES), "rule string, verdict string")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every page; rules: rule, verdict."""
    rules = rules.where("rule IS NOT NULL AND verdict IS NOT NULL").select("rule", "verdict")
    host = _lower(F.substring_index("rule", "/", 1))
    rules = rules.groupBy("rule").agg(F.max("verdict").alias("verdict")).select(
        "rule", "verdict", _host_key(host).alias("host_key"), F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("rule_path"))
    rules = rules.withColumn("key", F.concat("host_key", F.lit("\n"), "rule_path"))
    pages = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = pages.where("host != ''").select("host", "path").distinct()
    hosts = urls.select("host").distinct().withColumn("key", _host_key(F.col("host")))
    by_host = hosts.join(sweep(hosts, rules.select(F.col("host_key").alias("key"))), "key") \
        .select("host", F.explode("open").alias("host_key"))
    asked = written(urls.join(by_host, "host").withColumn("key", F.concat("host_key", F.lit("\n"), "path")), "url-keys")
    found = sweep(asked, rules.select("key")).select("key", F.get("open", F.size("open") - 1).alias("rule_key"))
    fitting = asked.join(found, "key").join(rules.select(F.col("key").alias("rule_key"), "rule", "verdict"), "rule_key")
    best = fitting.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
    return pages.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


ORACLE_SQL = """
WITH rules(rule, rule_host, rule_path, verdict) AS (VALUES
  ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
urls AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fits AS (
  SELECT page_id, host, path, rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC, rule DESC) AS place
  FROM urls JOIN rules ON (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM urls u LEFT JOIN fits f ON u.page_id = f.page_id AND f.place = 1
"""
