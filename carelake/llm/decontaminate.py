"""Benchmark decontamination by a distributed positional inverted index.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
lower-cased.  Test items are cut into windows of ``window`` words (a shorter
item is one window).  For each window the *rarest* term, by its count over all
training documents, is its anchor.  The index stores the postings of the
anchors only: document, position, and the words around it.  A posting at
position p of a term that stands at offset o of a window starts a candidate
at p - o; the lists of the window's other terms are intersected there by
comparing the stored words.  Only built-in functions run, and the corpus is
shuffled only as counts per term, postings and one row per document.

Cases: null and empty texts have no words (``n_words`` 0); empty test tables
give no hits; repeated rows give repeated rows; items without an id make words
hit but are not listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import cut, small, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: rows up to which test terms and windows are broadcast (about 100 bytes each)
MAX_BROADCAST = 1_000_000


def words(text: Column) -> Column:
    """The words of a text; ``lower`` is faster, and right where all is ASCII."""
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.regexp_extract_all(F.coalesce(low, F.lit("")), F.lit(WORD), F.lit(0))


def windows(items: DataFrame, window: int) -> DataFrame:
    """(h, w, items): distinct windows, their hash and the items that hold them."""
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - window + 1))).alias("i")
    return (w.select("item_id", "w", at).select("item_id", F.slice("w", F.col("i"), window).alias("w"))
            .groupBy("w").agg(F.collect_set("item_id").alias("items")).withColumn("h", F.xxhash64("w")))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): how often each of ``terms`` occurs in all documents."""
    seen = docs.select(F.explode(words(F.col("text"))).alias("term"))
    return seen.join(small(terms, MAX_BROADCAST), "term").groupBy("term").agg(F.count("*").alias("n"))


def anchors(wins: DataFrame, counts: DataFrame) -> DataFrame:
    """(term, places): the rarest term of each window; places are its offsets
    and the lengths of the windows."""
    each = wins.select("h", F.size("w").alias("len"), F.posexplode("w").alias("o", "term"))
    rarest = each.join(counts, "term", "left").groupBy("h", "len").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "o")).alias("a"))
    return rarest.groupBy(F.col("a.term").alias("term")).agg(F.collect_set(F.struct(F.col("a.o").alias("o"), "len")).alias("places"))


def postings(docs: DataFrame, terms: DataFrame, window: int) -> DataFrame:
    """The stored index: (rid, doc_id, pos, places, first, around) for each
    occurrence of an anchor, and per document a row with null places whose
    pos is its number of words."""
    each = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", words(F.col("text")).alias("w")).select(
        "rid", "doc_id", "w", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("pos", "term"))
    end = terms.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(None).cast(terms.schema["places"].dataType).alias("places"))
    hit = each.join(small(terms.unionByName(end), MAX_BROADCAST), "term")
    first = F.greatest(F.col("pos") - (window - 1), F.lit(0))
    around = F.when(F.col("places").isNotNull(), F.slice("w", first + 1, F.lit(2 * window - 1)))
    return cut(hit.select("rid", "doc_id", "pos", "places", first.alias("first"), around.alias("around")))


def phrase_matches(index: DataFrame, wins: DataFrame) -> DataFrame:
    """(rid, start, len, items): exact occurrences of windows."""
    at = index.where("places is not null").select("rid", "pos", "first", "around", F.explode("places").alias("p")).select(
        "rid", "first", "around", (F.col("pos") - F.col("p.o")).alias("start"), F.col("p.len").alias("len"))
    found = at.where("start >= first").withColumn("s", F.expr("slice(around, start - first + 1, len)")).where(
        "size(s) = len").withColumn("h", F.xxhash64("s")).select("rid", "start", "len", "s", "h")
    return found.join(small(wins, MAX_BROADCAST), "h").where("s = w").select("rid", "start", "len", "items")


def proximity_matches(index: DataFrame, wins: DataFrame, counts: DataFrame) -> DataFrame:
    """(rid, pos, h): windows all of whose words, in any order, stand within
    the words stored around an occurrence of the window's anchor."""
    each = wins.select("h", "w", F.explode("w").alias("term")).join(counts, "term", "left")
    key = each.groupBy("h", "w").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term")).alias("a"))
    key = key.select("h", "w", F.col("a.term").alias("term"))
    at = index.where("places is not null").withColumn("term", F.expr("around[pos - first]"))
    return at.join(small(key, MAX_BROADCAST), "term").where("size(array_except(w, around)) = 0").select("rid", "pos", "h")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per row of
    ``docs`` (doc_id, text) against ``items`` (item_id, text)."""
    wins = cut(windows(items, window))
    counts = term_counts(docs, wins.select(F.explode("w").alias("term")).distinct())
    index = postings(docs, cut(anchors(wins, counts)), window)
    found = phrase_matches(index, wins).groupBy("rid").agg(
        F.collect_set(F.struct("start", "len")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    rows = index.where("places is null").select("rid", "doc_id", F.col("pos").cast("long").alias("n_words")).join(found, "rid", "left")
    hit = F.expr("aggregate(array_sort(spans), named_struct('e', 0, 'n', 0), (a, x) -> named_struct("
                 "'e', greatest(a.e, x.start + x.len), 'n', a.n + greatest(0, x.start + x.len - greatest(a.e, x.start))), a -> a.n)")
    rows = rows.withColumn("n_hit", F.coalesce(hit, F.lit(0)).cast("long")).withColumn("items", F.coalesce("items", F.array().cast("array<bigint>")))
    listed = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return rows.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(listed, 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


SQL = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents),
b AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, w[i:i + 9] AS p FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len(p) AS n FROM wins),
starts AS (
  SELECT rid, i, n, w[i:i + n - 1] AS p
  FROM (SELECT rid, w, n, unnest(range(1, greatest(0, len(w) - n + 1) + 1)) AS i FROM d, lens)),
found AS (SELECT s.rid, s.i, s.n, wins.item_id FROM starts s JOIN wins ON wins.p = s.p),
hits AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + n)) AS pos FROM found) GROUP BY rid),
its AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN its USING (rid)
"""
