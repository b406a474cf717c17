"""URL verdicts: rules first, then a tree of path templates per host. DataFrame operations only.

Tree. Digits in a path segment become a wildcard, and so does a whole level of a node
whose children hardly repeat (at least KIDS different ones, on average fewer than two
urls each). From DEPTH segments on, or as many as the longest rule has, a node is followed
further only while labels of both kinds lie below it; what lies below any other is one
wildcard. A url's template is its way through the tree of its host.

Labels are the verdicts of the rules. Branches of one node merge from the leaves up: a
branch leaves its group where its share of blocked labels differs from that of the rest of
the group by a two-proportion test (CHI_SQUARE), below and above apart, until no group has
one that differs. A branch that is one group as a whole may merge with its siblings one
level further up, a mixed one stays as it is; branches without labels differ from none.
A merged branch's share is smoothed towards its host's, a host's towards that of all urls,
with the weight of WEIGHT urls. Its purity is the share of allowed labels; below MIN_PURITY
the branch is rejected (block), else allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.components import written

DEPTH = 4
KIDS = 8
WEIGHT = 4.0
MIN_PURITY = 0.5
# 95 % of one degree of freedom
CHI_SQUARE = 3.84
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rule = tuple[str, str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lowered and path of a url; both empty for null or without `://`."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for domain, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(domain + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _paths(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Different (host, path) with counts and their segments, digits as wildcards."""
    labelled = pages.groupBy("host", "path").agg(F.count("*").alias("urls"))
    ruled = _rule(F.col("host"), F.col("path"), rules)["verdict"]
    segments = F.filter(F.split(F.regexp_replace("path", "[0-9]+", "*"), "/"), lambda s: s != "")
    return (
        labelled.withColumn("labels", F.when(ruled.isNull(), 0).otherwise(F.col("urls")))
        .withColumn("blocked", F.when(ruled == "block", F.col("urls")).otherwise(0))
        .withColumn("segments", segments)
        .withColumn("template", F.lit(""))
    )


def _grow(paths: DataFrame, level: int, depth: int) -> DataFrame:
    """Follow one more segment; a level that hardly repeats becomes a wildcard. `open`: the path goes on."""
    part = F.get("segments", F.lit(level))
    sums = [F.sum(c).alias(c) for c in ("urls", "labels", "blocked")]
    kids = paths.where(part.isNotNull()).groupBy("host", "template", part.alias("part")).agg(*sums)
    nodes = (
        kids.groupBy("host", "template")
        .agg(F.count("*").alias("kids"), *sums)
        .select(
            "host",
            "template",
            F.expr(f"kids >= {KIDS} AND 2 * kids > urls").alias("varied"),
            (F.lit(level >= depth) & F.expr("blocked = 0 OR blocked = labels")).alias("alike"),
        )
    )
    step = (
        F.when(part.isNull(), "")
        .when(F.col("alike"), "/**")
        .when(F.col("varied"), "/*")
        .otherwise(F.concat(F.lit("/"), part))
    )
    more = (F.size("segments") > level + 1) & ~F.coalesce("alike", F.lit(True))
    grown = paths.join(nodes, ["host", "template"], "left").withColumn("template", F.concat("template", step))
    return grown.withColumn("open", more).drop("varied", "alike")


def _tree(spark: SparkSession, paths: DataFrame, depth: int) -> DataFrame:
    """`paths` with their whole templates, grown level by level until no path goes on."""
    level, done, left = 0, None, paths
    while True:
        grown = written(spark, _grow(left, level, depth), "tree")
        ended = grown.where("NOT open").drop("open")
        done = ended if done is None else done.union(ended)
        left, level = grown.where("open").drop("open"), level + 1
        if left.isEmpty():
            return done


def _side(labels: Column, blocked: Column, all_labels: Column, all_blocked: Column) -> Column:
    """-1, 0 or 1: a share is below, like or above that of the rest of all, by the chi-square of their counts."""
    rest, rest_blocked = all_labels - labels, all_blocked - blocked
    lean = blocked * rest - rest_blocked * labels
    far = lean * lean * all_labels > F.lit(CHI_SQUARE) * labels * rest * all_blocked * (all_labels - all_blocked)
    return F.when(far & (lean < 0), -1).when(far, 1).otherwise(0)


def _alike(spark: SparkSession, kids: DataFrame) -> DataFrame:
    """(host, kid, merged): for each of `kids` (host, node, kid, branch, labels, blocked) the least branch it merges with.

    Every round parts a group that has kids unlike their rest; one that lies below the
    group's share has another that does not, so the groups get smaller.
    """
    group = ["host", "node", "mark"]
    marked = kids.withColumn("mark", F.lit(""))
    while True:
        pools = marked.groupBy(*group).agg(
            F.sum("labels").alias("all_labels"), F.sum("blocked").alias("all_blocked"), F.min("branch").alias("merged")
        )
        counts = [F.col(c).cast("double") for c in ("labels", "blocked", "all_labels", "all_blocked")]
        sided = written(spark, marked.join(pools, group).withColumn("side", _side(*counts)), "alike")
        if sided.where("side <> 0").isEmpty():
            return sided.select("host", "kid", "merged")
        part = F.when(F.col("side") < 0, "-").when(F.col("side") > 0, "+").otherwise("0")
        marked = sided.withColumn("mark", F.concat("mark", part)).drop("all_labels", "all_blocked", "merged", "side")


def _merge(spark: SparkSession, leaves: DataFrame) -> DataFrame:
    """`leaves` (host, template, labels, blocked) with the `branch` each has merged into, named by its least template."""
    # an empty last step, so that a path's end is a branch of its node beside longer ones
    steps = F.split(F.concat("template", F.lit("/")), "/")
    leaves = written(spark, leaves.withColumn("branch", F.col("template")), "leaves")
    deepest = leaves.agg(F.max(F.size(steps)).alias("steps")).first().steps or 0
    for depth in range(deepest, 1, -1):
        at = leaves.withColumn("node", F.array_join(F.slice(steps, 1, depth - 1), "/"))
        at = at.withColumn("kid", F.when(F.size(steps) >= depth, F.array_join(F.slice(steps, 1, depth), "/")))
        kids = (
            at.where("kid IS NOT NULL")
            .groupBy("host", "node", "kid")
            .agg(
                F.min("branch").alias("branch"),
                F.max("branch").alias("last"),
                F.sum("labels").alias("labels"),
                F.sum("blocked").alias("blocked"),
            )
        )
        merged = _alike(spark, kids.where("branch = last").drop("last"))
        at = at.join(merged, ["host", "kid"], "left").withColumn("branch", F.coalesce("merged", "branch"))
        leaves = written(spark, at.drop("node", "kid", "merged"), "leaves")
    return leaves


def _smoothed(blocked: Column, labels: Column, towards: Column) -> Column:
    return (blocked + towards * WEIGHT) / (labels + WEIGHT)


def judge_urls(spark: SparkSession, pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule, template, branch and verdict of each row of pages (page_id, url).

    `rules` are (host, path, block or allow): a rule fits its host and all subdomains when
    the path starts with the rule's; the longest wins. Null urls and urls without `://`
    have an empty host and path and are judged as the template they share. Repeated rows
    count as often as they occur and come back so; other columns are not read. Without any
    label every share is one half, which no purity is below: all are allowed.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    longest = max((sum(map(bool, start.split("/"))) for _, start, _ in rules), default=0)
    paths = _tree(spark, _paths(urls, rules), max(DEPTH, longest))
    total = paths.agg(F.sum("labels").alias("labels"), F.sum("blocked").alias("blocked")).first()
    overall = ((total.blocked or 0) + 0.5 * WEIGHT) / ((total.labels or 0) + WEIGHT)
    sums = [F.sum("labels").alias("labels"), F.sum("blocked").alias("blocked")]
    hosts = paths.groupBy("host").agg(*sums)
    hosts = hosts.select("host", _smoothed(F.col("blocked"), F.col("labels"), F.lit(overall)).alias("of_host"))
    merged = _merge(spark, paths.groupBy("host", "template").agg(*sums))
    branches = merged.groupBy("host", "branch").agg(*sums).join(hosts, "host")
    purity = 1 - _smoothed(F.col("blocked"), F.col("labels"), F.col("of_host"))
    branches = branches.select("host", "branch", purity.alias("purity"))
    judged = merged.select("host", "template", "branch").join(branches, ["host", "branch"])
    ways = paths.select("host", "path", "template").join(judged, ["host", "template"])
    ruled = _rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("purity") < MIN_PURITY, "block").otherwise("allow")
    return urls.join(ways, ["host", "path"]).select(
        "page_id",
        "host",
        "path",
        ruled["rule"].alias("rule"),
        "template",
        "branch",
        F.coalesce(ruled["verdict"], own).alias("verdict"),
    )
