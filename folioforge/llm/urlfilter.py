"""URL filters by a sort-merge range join; native DataFrame operations only.

The canonical key of a host is its labels in reverse order, so a rule for a host and its subdomains is the interval of
the keys that its own key begins. Such intervals nest or are apart. Rules and hosts are sorted together, and a sweep
over the sorted keys keeps a stack of the rules that have begun: one place for each number of labels, holding the last
rule host of that many labels. What is on the stack is active where the key still begins with it. The paths are compared
last, among the active rules only.

The sweep runs over distinct hosts, in blocks of the key space (the key's first label), each dealt out over parts by a
hash of the host, as many as there are PART hosts; rules, which are few against hosts, go to every one of these parts. The stacks are joined
back to the urls by host, where the adaptive join splits a host that holds a large part of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioforge.llm.common import materialize, own, table

#: Verdict, host, path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Hosts that a part of a block sweeps about; a block has as many parts as all hosts fill, each with the block's rules.
PART = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, "://") + 3)
    return F.when(F.instr(url, "://") > 0, F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, "://") + 3)
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def key_of(host: Column) -> Column:
    """The labels in reverse order, each closed by a dot: every subdomain's key begins with its parent's."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def active_rules(hosts: DataFrame, rules: DataFrame, spread: int | None = None) -> DataFrame:
    """(host, stack): for each distinct host the rule hosts that hold it, an array of (path, rule, verdict) each.

    hosts: a column `host`. The depth of the stack is the largest number of labels of a rule host, which names limit.
    """
    keyed = materialize(hosts.select("host").distinct().withColumn("key", key_of(F.col("host"))), "hosts")
    spread = spread or keyed.count() // PART + 1
    by_host = rules.groupBy("host").agg(F.collect_list(F.struct("path", F.concat("host", "path").alias("rule"), "verdict")).alias("paths"))
    starts = by_host.select(key_of(F.col("host")).alias("key"), F.size(F.split("host", r"\.")).alias("depth"), "paths")
    depth = starts.agg(F.max("depth")).first()[0] or 0
    first_label = F.substring_index("key", ".", 1)
    starts = starts.select("key", first_label.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("part"), "depth", "paths", F.lit(None).cast("string").alias("host"))
    points = keyed.select("key", first_label.alias("block"), F.pmod(F.xxhash64("host"), F.lit(spread)).cast("int").alias("part"), F.lit(0).alias("depth"), F.lit(None).cast(starts.schema["paths"].dataType).alias("paths"), "host")
    # A rule stands before a host of the same key.
    sweep = Window.partitionBy("block", "part").orderBy("key", F.col("depth") == 0).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stack = {own(f"stack{d}"): F.last(F.when(F.col("depth") == d, F.struct("key", "paths")), ignorenulls=True).over(sweep) for d in range(1, depth + 1)}
    swept = starts.unionByName(points).withColumns(stack).where(F.col("depth") == 0)
    still = [F.when(F.startswith(F.col("key"), F.col(s)["key"]), F.col(s)["paths"]) for s in stack]
    return swept.select("host", F.filter(F.array(*still), lambda p: p.isNotNull()).alias("stack")) if still else swept.select("host", F.expr("cast(array() as array<array<struct<path:string,rule:string,verdict:string>>>)").alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", spread: int | None = None) -> DataFrame:
    """`pages` with host, path, rule and verdict.

    The longest rule that fits wins: the one with most characters of host and path. Without one, rule is null and the
    verdict is `default`. A null url, and one without ://, has an empty host and path and fits no rule. Repeated urls are
    judged one by one; an empty rule table gives the default to all; rules that are listed twice count once (of two
    verdicts for one rule, block). The caller's columns stay, but for those four names.
    """
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    cut = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    stacks = active_rules(cut, rules, spread).where(F.size("stack") > 0).select(F.col("host").alias(own("host")), F.col("stack").alias(own("stack")))
    joined = cut.join(stacks, F.col("host") == F.col(own("host")), "left")
    fits = F.filter(F.flatten(own("stack")), lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(F.char_length(r["rule"]).alias("length"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    return joined.withColumn(own("best"), best).withColumns({"rule": F.col(own("best"))["rule"], "verdict": F.coalesce(F.col(own("best"))["verdict"], F.lit(default))}).drop(own("best"), own("host"), own("stack"))


def digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op4_urls: every url of `pages`."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), rule_frame(spark)).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
r(verdict, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
f AS (
  SELECT p.page_id, r.host || r.path AS rule, r.verdict FROM p JOIN r
  ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path)),
b AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM f GROUP BY page_id)
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, 'allow') AS verdict FROM p LEFT JOIN b USING (page_id)
"""
