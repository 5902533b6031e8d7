"""URL filters as a sort-merge range join over reversed-host keys.

A rule (host, path, verdict) fits its host and all subdomains if a URL's path
starts with the rule's path.  Hosts are written label by label from the right
(``example.net`` as ``net.example``) and joined with the path by a character that
sorts before all others; a rule then fits exactly the keys that it is a prefix of,
which are one interval of the sorted keys.  A URL enters the sweep once for each of
its host's suffixes, up to the number of labels of the longest rule host.

Rules and URL keys are sorted together.  Intervals of prefixes are nested or apart,
so the rules active at a URL are a part of the stack of the rule that started last:
that rule and the rules it lies in.  Each rule carries this stack, and the sweep is
a running "last rule so far" over the sorted keys; entries of the stack that have
ended before the URL no longer are prefixes of it and are taken off.  The longest
rule that is left over all suffixes wins (by characters, then host, then path).

Keys are dealt out by range and, behind the key, by the URL, so a frequent host is
spread over many tasks; the last rule of the ranges before is carried into each.
Only DataFrame functions are used.

Inputs and edge cases: a null URL or one without ``://`` has an empty host and path;
null or empty rule hosts never fit; a null rule path is empty; repeated rules count
once (the least verdict); repeated and null page ids each keep their row; an empty
page table gives an empty result and empty rules the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARK = "\x00"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; empty texts if it has none."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _stacks(rules: DataFrame) -> DataFrame:
    """(key, host_key, stack): each rule with the rules it lies in, the shortest first.

    A rule's proper prefixes are looked up among the rules of its host, so no host's
    rules come together in one task."""
    whole = rules.withColumn("upto", F.explode(F.sequence(F.lit(0), F.length("path"))))
    inner = whole.select("host_key", "path", F.expr("substring(path, 1, upto)").alias("outer"))
    outer = rules.select("host_key", F.col("path").alias("outer"), "rule", "verdict")
    entry = F.struct(F.length("outer").alias("size"), F.col("outer").alias("path"), "rule", "verdict")
    return (inner.join(outer, ["host_key", "outer"]).groupBy("host_key", "path")
            .agg(F.sort_array(F.collect_list(entry)).alias("stack"))
            .select(F.concat("host_key", F.lit(MARK), "path").alias("key"), "host_key", "stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow",
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule (``host`` + ``path`` or null), verdict."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    asked = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    listed = (rules.where("host IS NOT NULL AND host <> ''")
              .select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
              .groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
              .withColumn("host_key", F.concat_ws(".", _labels(F.col("host"))))
              .withColumn("rule", F.concat("host", "path")))
    stacks = written(_stacks(listed), "url-rules")
    depth = F.lit(listed.agg(F.max(F.size(_labels(F.col("host"))))).first()[0] or 1)

    targets = asked.select("host", "path").distinct()
    labels = _labels(F.col("host"))
    keys = F.transform(F.sequence(F.lit(1), F.least(depth, F.size(labels))), lambda n: F.concat_ws(".", F.slice(labels, 1, n)))
    urls = targets.withColumn("host_key", F.explode(keys))
    events = (stacks.select("key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"),
                            F.lit(None).cast("string").alias("path"), "host_key", F.struct("host_key", "stack").alias("started"))
              .unionByName(urls.select(F.concat("host_key", F.lit(MARK), "path").alias("key"), F.lit(1).alias("kind"),
                                       "host", "path", "host_key"), allowMissingColumns=True))
    # the ranges are fixed by writing them: bounds are sampled anew whenever a plan runs
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = written(events.repartitionByRange(ranges, "key", "kind", F.xxhash64("host"))
                     .withColumn("range", F.spark_partition_id()), "url-sweep")
    ends = placed.where("kind = 0").groupBy("range").agg(F.max_by("started", "key").alias("ended"))
    every = spark.range(ranges).select(F.col("id").cast("int").alias("range"))  # one row per range
    before = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.join(ends, "range", "left").select("range", F.last("ended", ignorenulls=True).over(before).alias("carry"))
    sweep = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = (placed.withColumn("latest", F.last("started", ignorenulls=True).over(sweep)).where("kind = 1")
             .join(F.broadcast(carried), "range").withColumn("latest", F.coalesce("latest", "carry")))
    active = F.filter("latest.stack", lambda r: (F.col("latest.host_key") == F.col("host_key")) & F.startswith(F.col("path"), r.path))
    best = F.try_element_at(active, F.lit(-1))
    found = (swept.select("host", "path", best.alias("best"), "host_key").where("best IS NOT NULL")
             .groupBy("host", "path")
             .agg(F.max_by("best", F.struct(F.length("best.rule"), F.length("host_key"), F.col("best.rule"))).alias("best"))
             .select("host", "path", "best.rule", "best.verdict"))
    # written, so that the join reads two plain shuffles and Spark may split a frequent URL
    return (asked.join(written(found, "url-found"), ["host", "path"], "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))
