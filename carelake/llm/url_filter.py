"""URL filters by a path-template tree.

Explicit rules (host, path prefix, verdict) come first: a rule fits its host
and all subdomains if the url's path starts with the rule's; the longest wins.
Other urls get the verdict of their *template*.  Per host, the segments of all
paths form a tree.  Digits and long hexadecimal runs in a segment become
wildcards at once; then, level by level, the many rare children of a node
become one wildcard, and children that are statistically alike - the same
shape below them and labelled purities in the same Wilson band - merge.  Few
labels tell nothing of other branches: a child in the middle band merges only
with those of the same majority, one without labels only with others without,
and rare children with labels join the wildcard only if, counted by child, their
majorities agree beyond the Wilson band.  The
urls that rules decide are the labels: a template is rejected if its smoothed
share of blocked labels is above ``REJECT``; without labels it is the prior,
and is kept.

The tree is grown on one row per host and shape of path with counts (a partial
aggregate), so a host with a third of all pages is no more work than others.

Cases: null urls and urls without ``://`` have an empty host and path, no rule
and the verdict allow, unless a rule is for the empty host; an empty path
starts with no rule's path; repeated rows give repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import cut, small, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host, path prefix, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: levels of the tree; the segments from this one on are compared as one, by all their words
DEPTH = 6
#: a node with more children than MANY, seen less than RARE times each on average, has a wildcard child
MANY, RARE = 20, 5
#: smoothing: weight and value of the prior purity; templates above REJECT are blocked
WEIGHT, PRIOR, REJECT = 2.0, 0.5, 0.5
Z = 1.96
#: rows up to which templates are broadcast (about 200 bytes each)
MAX_BROADCAST = 200_000


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The text and the verdict of the longest rule that fits, or null."""
    name = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name = F.when(fits, F.lit(h + p)) if name is None else name.when(fits, F.lit(h + p))
        verdict = F.when(fits, F.lit(v)) if verdict is None else verdict.when(fits, F.lit(v))
    return (name, verdict) if name is not None else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def segments(path: Column) -> Column:
    """Segments of a path with hexadecimal runs of 12 and more characters and
    digits as wildcards; those from the DEPTH-th on are joined to one."""
    shape = F.regexp_replace(F.regexp_replace(path, "(?<![0-9A-Za-z])(?=[a-f]*[0-9])[0-9a-f-]{12,}(?![0-9A-Za-z])", "*"), "[0-9]+", "*")
    s = F.split(F.regexp_replace(shape, "^/", ""), "/")
    return F.when(F.size(s) > DEPTH, F.concat(F.slice(s, 1, DEPTH - 1), F.array(F.array_join(F.slice(s, DEPTH, F.size(s)), "/")))).otherwise(s)


def band(blocked: Column, allowed: Column) -> Column:
    """1 if the Wilson interval of the blocked share is above a half, -1 if below, else 0."""
    n, z2 = blocked + allowed, Z * Z
    p = blocked / F.greatest(n, F.lit(1))
    mid, half = (p + z2 / (2 * n)) / (1 + z2 / n), Z / (1 + z2 / n) * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))
    return F.when(n == 0, 0).when(mid - half > 0.5, 1).when(mid + half < 0.5, -1).otherwise(0)


def standing(blocked: Column, allowed: Column) -> Column:
    """The band, with the majority in the middle one; 'none' without labels."""
    side = F.when(blocked > allowed, "0+").when(blocked < allowed, "0-").otherwise("0")
    within = band(blocked, allowed)
    return F.when(blocked + allowed == 0, "none").when(within == 0, side).otherwise(within.cast("string"))


def templates(shapes: DataFrame) -> DataFrame:
    """(host, segs, template) from (host, segs, n, blocked, allowed): the
    wildcards and merged branches of each level in turn."""
    t = cut(shapes.withColumn("template", F.array().cast("array<string>")))
    for level in range(DEPTH):
        deep = F.size("segs") > level
        seg = F.get("segs", F.lit(level))
        below = F.xxhash64(F.slice("segs", level + 2, DEPTH))
        children = t.where(deep).groupBy("host", "template", seg.alias("seg")).agg(
            F.sum("n").alias("n"), F.sum("blocked").alias("b"), F.sum("allowed").alias("a"), F.sum(F.pmod(below, F.lit(1 << 40)).cast("decimal(13,0)")).alias("under"))
        node = children.groupBy("host", "template").agg(
            F.count("*").alias("kids"), F.sum("n").alias("total"), F.count_if(F.col("b") > F.col("a")).alias("kb"), F.count_if(F.col("b") < F.col("a")).alias("ka"))
        alone = standing(F.col("b"), F.col("a"))
        like = F.concat_ws("~", F.lit("="), alone, F.col("under"))
        rare = F.when((alone == "none") | (band(F.col("kb"), F.col("ka")) != 0), "*").otherwise(F.concat(F.lit("*~"), alone))
        named = children.join(node, ["host", "template"]).withColumn(
            "name", F.when(F.col("seg").contains("*") | (F.col("seg") == ""), F.col("seg")).when(
                (F.col("kids") > MANY) & (F.col("total") < RARE * F.col("kids")), rare).otherwise(like))
        named = cut(named.select("host", "template", F.col("seg").alias("at"), "name"))
        t = t.withColumn("at", seg).join(named, ["host", "template", "at"], "left").withColumn(
            "template", F.when(deep, F.concat("template", F.array("name"))).otherwise(F.col("template"))).drop("at", "name")
        t = cut(t.select("host", "segs", "n", "blocked", "allowed", "template"))
    return t


def filter_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) per row of ``pages`` (page_id, url)."""
    host, path = parts(F.col("url"))
    each = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    each = each.withColumn("rule", rule).withColumn("by_rule", verdict).withColumn("segs", segments(F.col("path")))
    shapes = each.groupBy("host", "segs").agg(
        F.count("*").alias("n"), F.count_if(F.col("by_rule") == "block").alias("blocked"), F.count_if(F.col("by_rule") == "allow").alias("allowed"))
    t = templates(shapes)
    purity = t.groupBy("host", "template").agg(
        ((F.sum("blocked") + WEIGHT * PRIOR) / (F.sum("blocked") + F.sum("allowed") + WEIGHT)).alias("purity"))
    judged = cut(t.join(purity, ["host", "template"]).select("host", "segs", F.array_join("template", "/").alias("template"), "purity"))
    return each.join(small(judged, MAX_BROADCAST), ["host", "segs"]).select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.col("purity") > REJECT, "block").otherwise("allow")).alias("verdict"), "template", "purity")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).drop("template", "purity")
