"""Corpus pipeline over ``documents``: toxicity, near duplicates,
decontamination, secrets, mixing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``; all but the
last return the columns of ``documents``.

*   toxicity: documents with a score of 0.5 or more go; the model is learned
    from the labels of the stage's own documents.
*   near duplicates: word 5-grams, Jaccard similarity of 0.8 or more; of each
    group of linked documents the one with the smallest doc_id stays.
    Documents without words are alone and stay; rows with a null doc_id can't
    be named and stay; of rows that repeat a doc_id one stays.
*   decontamination: documents with a 10-word window of a benchmark item go,
    row by row: rows without a doc_id too, and of rows that repeat one only
    those whose own text holds a window.
*   secrets: secrets are replaced by ``[secret]`` and n_chars is set anew.
*   mixing: (doc_id, size, source_size, target, taken) per document left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import decontaminate, mixing, ngram_join, secrets, toxicity
from carelake.llm.common import cut, small, table

#: ids up to which a list of documents that go is broadcast (24 bytes each)
MAX_BROADCAST = 4_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = cut(ngram_join.near_duplicates(docs, k=5, pct=80))
    named = found.where("doc_id is not null")
    gone = cut(named.where("component_id is not null and doc_id != component_id").select("doc_id").distinct())
    kept = docs.join(small(gone, MAX_BROADCAST), "doc_id", "left_anti").select(docs.columns)
    again = cut(named.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if again.limit(1).count():
        twice = small(again, MAX_BROADCAST)
        one = kept.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*kept.columns)).alias("d")).select("d.*")
        kept = kept.join(twice, "doc_id", "left_anti").select(docs.columns).unionByName(one)
    return kept


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text_hash = F.xxhash64(docs["text"])
    rows = docs.select(F.struct("doc_id", text_hash.alias("text_hash")).alias("doc_id"), "text")
    found = decontaminate.decontaminate(rows, table(spark, sf_dir, "benchmark"))
    gone = small(cut(found.where("contaminated").select("doc_id.*").distinct()), MAX_BROADCAST)
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["doc_id"]) & (text_hash == gone["text_hash"]), "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: the field, the battery and the components of near copies aren't SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
