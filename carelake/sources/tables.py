"""Reading the source tables (S1) with explicit schemas and normalised keys."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.sources.schemas import CODE_COLUMNS, DOMAIN_TABLES, PERSON_KEY_ALIASES, schema


def normalise(name: str, df: DataFrame) -> DataFrame:
    """Person key → ``origid`` (the source spells it four ways) and codes
    upper-cased (the source compares them case-insensitively, P14)."""
    src = PERSON_KEY_ALIASES.get(name)
    if src and src in df.columns and "origid" not in df.columns:
        df = df.withColumnRenamed(src, "origid")
    for c in CODE_COLUMNS.get(name, []):
        if c in df.columns:
            df = df.withColumn(c, F.upper(F.trim(F.col(c))))
    return df


def read_tables(spark: SparkSession, base: str, names: Iterable[str] | None = None,
                fmt: str = "parquet", absent: Iterable[str] = ()) -> dict[str, DataFrame]:
    """``{name: DataFrame}`` for the tables under ``base/<name>``.

    A missing table is an error (Spark's reader looks, so the driver need not
    see the folder); only those named in ``absent`` are read as empty."""
    absent = set(absent)
    out = {}
    for n in names or DOMAIN_TABLES:
        df = (spark.createDataFrame([], schema(n)) if n in absent
              else spark.read.schema(schema(n)).format(fmt).load(os.path.join(base, n)))
        out[n] = normalise(n, df)
    return out


def from_frames(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Normalise already-loaded frames; absent tables become empty frames."""
    spark = next(iter(frames.values())).sparkSession
    out = {}
    for n in DOMAIN_TABLES:
        df = frames.get(n)
        if df is None:
            df = spark.createDataFrame([], schema(n))
        out[n] = normalise(n, df)
    return out


def only_persons(tables: Mapping[str, DataFrame], persons: DataFrame,
                 encounter_tables=("adt_encounter", "mra1_encounter"), xref: str | None = None) -> dict[str, DataFrame]:
    """Restrict every person-keyed table to a set of persons (semi-join), so
    an incremental rebuild joins and groups only the affected persons' rows.
    Tables keyed by encounter or result follow their parent; lookup tables
    stay whole.  Of :class:`PartitionedTables` only the partitions of the
    persons, of their encounters and of their results are scanned; of other
    tables all rows are.

    ``xref`` names the cross-reference table (ref, origid) through which the
    roster's ids lead to persons (J15)."""
    ids = persons.select("origid").distinct()

    def kept(names: Iterable[str], keys: DataFrame) -> None:
        """The rows of the tables whose key is among ``keys``."""
        parts = tables.parts(keys) if isinstance(tables, PartitionedTables) else None
        for n in names:
            df = tables[n] if parts is None else tables.scan(n, parts)
            out[n] = df.join(keys, keys.columns[0], "left_semi")

    out = dict(tables.items())
    kept([n for n, df in tables.items() if "origid" in df.columns], ids)
    refs = ids.withColumnRenamed("origid", "mm_curr_mbi_id")
    if xref:
        refs = out[xref].select(F.col("ref").alias("mm_curr_mbi_id")).distinct()
    kept(["dc_bene_alignment_rostr_m01"], refs)
    encs = out[encounter_tables[0]].select("encounter_nr").unionByName(
        out[encounter_tables[1]].select("encounter_nr"))
    kept(["adt_encounter_icd_codes", "mra1_encounter_icd_codes", "mra1_encounter_bill_cpts",
          "cclf_encounter_patient_medication", "cpoe_result"], encs)
    kept(["cpoe_result_values"], out["cpoe_result"].select("result_id"))
    return out


# Bucketing keys: person-keyed tables by person, encounter children by encounter.
BUCKET_KEYS = {
    "patient": "origid", "adt_encounter": "origid", "mra1_encounter": "origid",
    "mra_raf_patient": "origid", "mra_uamcc_details": "origid", "mra_scorecard_alerts": "origid",
    "drfirst_patient_medications": "origid", "mra_assessments_and_screenings": "origid",
    "mra_member_history_data": "origid", "transportation_benefit": "origid", "sdoh_meal_plan": "origid",
    "chronic_disease_reward_program": "origid", "care_plan_patient": "origid",
    "allergies_medications": "origid", "dc_bene_alignment_rostr_m01": "mm_curr_mbi_id",
    "adt_encounter_icd_codes": "encounter_nr", "mra1_encounter_icd_codes": "encounter_nr",
    "mra1_encounter_bill_cpts": "encounter_nr", "cclf_encounter_patient_medication": "encounter_nr",
    "cpoe_result": "encounter_nr",
}


def write_bucketed(tables: Mapping[str, DataFrame], database: str, n_buckets: int,
                   keys: Mapping[str, str] = BUCKET_KEYS) -> None:
    """One-time layout step: save the large tables as bucketed, sorted
    catalog tables (``bucketBy(n, key).sortBy(key)``).  Later record builds
    read them with ``read_bucketed`` and the per-person aggregates and the
    joins on the bucket key need no shuffle of the source rows: Spark plans
    them on the bucketed scan's existing distribution.  Small lookup tables
    are saved plainly."""
    spark = next(iter(tables.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in tables.items():
        w = df.write.mode("overwrite").format("parquet")
        if name in keys:
            w = w.bucketBy(n_buckets, keys[name]).sortBy(keys[name])
        w.saveAsTable(f"{database}.{name}")


def read_bucketed(spark: SparkSession, database: str,
                  names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The tables written by :func:`write_bucketed` (already normalised)."""
    return {n: spark.table(f"{database}.{n}") for n in (names or DOMAIN_TABLES)}


# ── sources partitioned by key, for refreshes that read only what changed ──

PART = "_part"
PART_KEYS = {**BUCKET_KEYS, "cpoe_result_values": "result_id", "person_xref": "origid"}


def _part_of(key: str, n_parts: int):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(n_parts)).cast("int")


def write_partitioned(tables: Mapping[str, DataFrame], base: str, n_parts: int) -> None:
    """Save the tables under ``base``, the large ones partitioned by a hash of
    their key (person, encounter or result).  A partition beyond the advisory
    size is written by several tasks."""
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        w = df
        if name in PART_KEYS:
            w = df.withColumn(PART, _part_of(PART_KEYS[name], n_parts)).hint("rebalance", F.col(PART))
        w = w.write.mode("overwrite")
        (w.partitionBy(PART) if name in PART_KEYS else w).parquet(f"{base}/{name}")
    spark.createDataFrame([(n_parts, sorted(tables))], "n_parts int, tables array<string>").write.mode("overwrite").parquet(f"{base}/_layout")


class PartitionedTables(Mapping):
    """The tables written by :func:`write_partitioned` (already normalised).
    As a mapping it gives whole tables; :meth:`scan` reads the partitions that
    hold some keys."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        layout = spark.read.parquet(f"{base}/_layout").first()
        self.n_parts, self.names = layout["n_parts"], layout["tables"]

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.base}/{name}")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        return self._read(name).drop(PART)

    def __iter__(self):
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)

    def parts(self, keys: DataFrame) -> list[int]:
        """Partitions that hold the keys of a one-column frame: at most
        ``n_parts`` numbers."""
        found = keys.select(_part_of(keys.columns[0], self.n_parts).alias("p")).where("p is not null").distinct().collect()
        return sorted(r["p"] for r in found)

    def scan(self, name: str, parts: list[int]) -> DataFrame:
        """The rows of some partitions; a table that isn't partitioned whole."""
        df = self._read(name)
        return df.where(F.col(PART).isin(parts)).drop(PART) if name in PART_KEYS else df
