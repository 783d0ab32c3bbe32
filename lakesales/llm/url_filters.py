"""URL filters: a sort-merge range join of URLs with nested host and path rules.

A host is turned round (`www.example.net` -> `net.example.www.`), so a rule for a host and all its subdomains
is the interval of keys that begin with the rule's key; a path prefix is such an interval already. Intervals of
prefixes nest. URLs and rules are sorted together; walking up, the last rule that began before a URL carries
the stack of rules it is nested in, and the rules still active at the URL are those of the stack that are
prefixes of its key. The walk is done twice, first over hosts, then over paths below each active host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesales.llm.common import cut, parts_for

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parts host and path in a key; no URL text that is split by white space holds it.
_JOINT = "\u0001"
#: Points that a slice of a walk holds on average.
SLICE_ROWS = 500_000


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; null or no `://`: empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _SMALL)


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; null or no `://`: empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(
        F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def stabbed(points: DataFrame, intervals: DataFrame, key: str, slices: int) -> DataFrame:
    """Adds `active`: the keys of all intervals that hold the point, by one sorted walk in `slices` slices.

    points: any rows with a column `key`; a null key is in no interval.
    intervals: rows (key, nest), nest: the keys of the intervals that enclose it, itself included.
    A slice begins with the last interval of the slices before it.
    """
    kinds = points.withColumn("_nest", F.lit(None).cast("array<string>")).unionByName(
        intervals.select(key, F.col("nest").alias("_nest")), allowMissingColumns=True)
    # rules sort before points of the same key; other columns spread a key that many rows share
    order = [F.col(key), F.col("_nest").isNull()]
    spread = [F.xxhash64(*[c for c in points.columns if c != key])] if len(points.columns) > 1 else []
    cutting = cut(kinds.repartitionByRange(slices, *order, *spread).withColumn("_slice", F.spark_partition_id()),
                  "slices")
    lasts = cutting.filter(F.col("_nest").isNotNull()).groupBy("_slice").agg(F.max_by("_nest", key).alias("_last"))
    # one row a slice
    begins = cutting.select("_slice").distinct().join(lasts, "_slice", "left").select(
        "_slice", F.last("_last", ignorenulls=True).over(
            Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)).alias("_begin"))
    walk = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    walked = cutting.withColumn("_stack", F.last("_nest", ignorenulls=True).over(walk)).filter(F.col("_nest").isNull())
    stack = F.coalesce("_stack", "_begin", F.array().cast("array<string>"))
    return (walked.join(begins, "_slice")
            .withColumn("active", F.filter(stack, lambda r: F.col(key).startswith(r)))
            .drop("_slice", "_nest", "_stack", "_begin"))


def nested(intervals: DataFrame, key: str) -> DataFrame:
    """(key, nest) of distinct prefix keys; nest: those of them that are prefixes of the key."""
    keys = intervals.select(key).filter(F.col(key).isNotNull()).distinct()
    prefixes = keys.select(F.col(key).alias("_of"), F.explode(F.transform(
        F.sequence(F.lit(0), F.length(key)), lambda n: F.substring(F.col(key), F.lit(1), n))).alias(key))
    return prefixes.join(keys, key).groupBy(F.col("_of").alias(key)).agg(F.collect_list(key).alias("nest"))


def judge_urls(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
               slices: int | None = None) -> DataFrame:
    """Adds host, path, rule and verdict to rows with a URL.

    rules: host, path, verdict ('allow' or 'block'); extra columns are ignored, null host or path counts as
    empty. A rule fits its host, all subdomains and every path that starts with its own (an empty host fits all);
    the longest host and path together wins, then the longest host; of equal rules a block wins. Without a
    fitting rule: rule null, verdict `default`. Every row of `urls` returns once with its own columns;
    own columns named host, path, rule or verdict are replaced. Null URL: empty host and path. A URL counts whole,
    however long it is; every prefix of a rule is looked at, so rules should have some thousand characters at most. No rules: every URL has the default; an empty table of URLs gives no rows.
    Each different host and path is judged once, in `slices` slices, else as many as their number asks for.
    """
    rules = rules.select(
        F.translate(F.coalesce("host", F.lit("")), _UPPER, _SMALL).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"), "verdict").groupBy("host", "path").agg(
        F.max("verdict").alias("verdict"))
    rules = rules.select(host_key(F.col("host")).alias("host_key"), F.length("host").alias("host_size"), "path",
                         F.concat("host", "path").alias("rule"), "verdict")
    out = urls.drop("host", "path", "rule", "verdict").withColumn("host", url_host(F.col(url))) \
        .withColumn("path", url_path(F.col(url)))

    different = cut(out.select("host", "path").distinct(), "hosts").withColumn("host_key", host_key(F.col("host")))
    hosts = stabbed(different, nested(rules, "host_key"), "host_key", slices or parts_for(different.count(), SLICE_ROWS))
    below = cut(hosts.select("host", "path", F.explode("active").alias("active_host")).withColumn(
        "path_key", F.concat("active_host", F.lit(_JOINT), "path")).drop("active_host"), "below")
    keyed = rules.withColumn("path_key", F.concat("host_key", F.lit(_JOINT), "path"))
    paths = stabbed(below, nested(keyed, "path_key"), "path_key", slices or parts_for(below.count(), SLICE_ROWS))
    # prefixes of one key: the longest of them is the largest
    found = paths.select("host", "path", F.array_max("active").alias("path_key")).filter("path_key is not null").join(
        keyed.select("path_key", "host_size", "rule", "verdict"), "path_key")
    best = found.groupBy("host", "path").agg(F.max(F.struct(
        F.length("rule").alias("size"), "host_size", "rule", "verdict")).alias("_best"))
    return out.join(best, ["host", "path"], "left").select(
        *[c for c in out.columns], F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
