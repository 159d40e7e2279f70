"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a target in words; see ``source_targets``.  A source takes all
its documents for as many complete epochs as the target holds; the rest of the
target is a weighted sample without replacement: every document gets the
exponential key ``-ln(u) / quality`` (u from a hash of its doc_id, so reruns
agree), documents are sorted by key within their source, and sizes are summed
up to the rest.  The document on which the rest ends gives as many words as
are still missing.

No source is sorted in one task: keys fall into ordered buckets, sizes are
summed per source and bucket, and only documents of the one bucket in which a
source's rest ends are sorted.  Bucket bounds are quantiles of the slowest key,
so a bucket holds at most (largest / smallest sampling weight) times its even
share of a source, and there are as many buckets as the counted documents need
for about ``PER_BUCKET`` in each.  Rows that repeat a doc_id share its key and
so its bucket.

Cases: null or empty texts have size 0 and give 0 words; a null source is a
source of its own, last; repeated rows count as documents of their own; an
empty table gives an empty result; all sizes 0 give targets of 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelake.llm.common import cut, small, table

WORDS = r"[^\x20\x09-\x0D]+"
#: buckets of sampling keys at least, and documents of the largest source per bucket, about
BUCKETS, PER_BUCKET = 1024, 100_000
#: most copies of a document, and so of a source
MOST = 3
#: rows up to which the table of sources is broadcast (about 100 bytes each)
MAX_BROADCAST = 500_000
#: sampling weights by labels.quality; the last one is for documents without a label
QUALITY = {1: 1.0, 0: 0.25, None: 0.5}


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources in code point order, null last, weigh 1, 2, 3, 1, ... and share all
    words; none gets more than ``most`` times its size, the excess is shared
    by weight among the others.  With sources in the order of limit / weight,
    the common words per weight are the greatest of (all words - limits so
    far) / (weights from here on)."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("w", (rank - 1) % 3 + 1).withColumn("top", F.col("source_size") * most)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("top") / F.col("w"), F.col("source").asc_nulls_last())
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.sum("source_size").over(everything) - (F.sum("top").over(so_far) - F.col("top"))
    weights = F.sum("w").over(everything) - (F.sum("w").over(so_far) - F.col("w"))
    per = per.withColumn("share", left.cast("double") / weights)
    return per.withColumn("share", F.max("share").over(everything)).select(
        "source", "source_size", F.least(F.col("top").cast("double"), F.col("share") * F.col("w")).alias("target"))


def sampling_key(doc_id: Column, weight: Column) -> Column:
    """Exponential key with rate ``weight``; the uniform number is the first 52 bits of the id's MD5."""
    bits = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 1) / (2.0**52 + 1)) / weight


def mix(docs: DataFrame, quality: DataFrame | None = None, most: int = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken) per row of ``docs`` (doc_id,
    text, source); ``quality``: (doc_id, quality) labels, may be absent."""
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"))
    weight, slowest = F.lit(QUALITY[None]), min(QUALITY.values())
    if quality is not None:
        labels = quality.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
        sized = sized.join(labels, "doc_id", "left")
        weight = F.when(F.col("quality") == 1, QUALITY[1]).when(F.col("quality") == 0, QUALITY[0]).otherwise(QUALITY[None])
    sized = cut(sized.select("doc_id", "source", "size", sampling_key(F.col("doc_id"), weight).alias("key")))
    buckets = max(BUCKETS, math.ceil(sized.count() * max(QUALITY.values()) / slowest / PER_BUCKET))
    sized = sized.withColumn("bucket", F.least(F.floor((1 - F.exp(-F.col("key") * slowest)) * buckets), F.lit(buckets - 1)).cast("int"))
    per = cut(source_targets(sized, most).withColumn("words", F.round("target").cast("long"))
              .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.col("source_size"))).otherwise(0))
              .withColumn("rest", F.col("words") - F.col("epochs") * F.col("source_size")))
    # where the rest of each source ends
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    ends = sums.withColumn("before", before).withColumnRenamed("source", "s2").join(per, F.col("s2").eqNullSafe(F.col("source"))).where(
        "before + n > rest").groupBy("source").agg(F.min(F.struct("bucket", "before")).alias("end"))
    per = cut(per.join(ends.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2")), "left").select(
        F.col("source").alias("of"), "source_size", "target", "epochs", "rest", "end.bucket", "end.before").withColumnRenamed("bucket", "last"))
    each = sized.join(small(per, MAX_BROADCAST), F.col("source").eqNullSafe(F.col("of")))
    whole = each.where("last is null or bucket != last").withColumn("part", F.when(F.col("bucket") < F.coalesce("last", F.lit(buckets)), F.col("size")).otherwise(0))
    so_far = F.sum("size").over(Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ending = each.where("bucket = last").withColumn("upto", F.col("before") + so_far).withColumn(
        "part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - (F.col("upto") - F.col("size"))))).drop("upto")
    return whole.unionByName(ending).select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = """
WITH q AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, d.source, CAST(coalesce(len(regexp_extract_all(d.text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
    -ln((CAST(CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) + 1) / (4503599627370496.0::DOUBLE + 1))
      / (CASE q.quality WHEN 1 THEN 1.0::DOUBLE WHEN 0 THEN 0.25::DOUBLE ELSE 0.5::DOUBLE END) AS key
  FROM documents d LEFT JOIN q USING (doc_id)),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM sized GROUP BY source),
shares AS (
  SELECT *, CAST(sum(source_size) OVER () - (sum(3 * source_size) OVER o - 3 * source_size) AS DOUBLE) / CAST(sum(w) OVER () - (sum(w) OVER o - w) AS DOUBLE) AS share
  FROM per WINDOW o AS (ORDER BY 3 * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
targets AS (SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), (max(share) OVER ()) * w) AS target FROM shares),
plan AS (SELECT *, CAST(round(target) AS BIGINT) AS words, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS epochs FROM targets),
each AS (
  SELECT s.*, p.source_size, p.target, p.epochs, p.words - p.epochs * p.source_size AS rest,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, rest - (upto - size))) AS BIGINT) AS taken FROM each
"""
