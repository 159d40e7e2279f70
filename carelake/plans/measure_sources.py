"""Item rows of the measure paths straight from the source tables, for
:func:`carelake.plans.measures.evaluate_items`: the same elements as the nested
record holds, without building it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.functions import columns as C
from carelake.plans import sections as S
from carelake.plans.document import persons_with_roster


def encounter_keys(t: S.Tables) -> DataFrame:
    """(encounter_nr, origid, enc_date) of both branches of the spine."""
    me = t["mra1_encounter"].select("encounter_nr", "origid", F.col("enc_admit_date").alias("enc_date"))
    return t["adt_encounter"].select("encounter_nr", "origid", F.col("encounter_date").alias("enc_date")).unionByName(me)


def item_sources(t: S.Tables, as_of) -> dict[str, DataFrame]:
    """Path of an array → its elements ``(origid, fields…)``."""
    keys = encounter_keys(t)
    diag = t["adt_encounter_icd_codes"].join(keys, "encounter_nr").select(
        "origid", F.col("diagnosis_code").alias("icd_code"), C.iso_date("onset_date").alias("onset_date"),
        F.coalesce("status", F.lit("Active")).alias("status"))
    proc = t["mra1_encounter_bill_cpts"].join(keys, "encounter_nr").select(
        "origid", F.col("bb_Code").alias("billing_code"), C.iso_date("enc_date").alias("procedure_date"))
    chronic = t["adt_encounter_icd_codes"].join(S.adt_keys(t), "encounter_nr").groupBy(
        "origid", F.col("diagnosis_code").alias("icd_code")).agg(C.iso_date(F.max("encounter_date")).alias("last_seen_date"))
    alerts = S.hedis_measures(t, as_of, None, S.ITEMS).select("origid", "hedis_measures._v.*")
    return {"encounters[].diagnoses[]": diag, "encounters[].procedures[]": proc, "chronic_conditions[]": chronic, "hedis_measures[]": alerts}


def measure_persons(t: S.Tables, as_of, cc_version: str | None = None, how: str = "inner", xref: DataFrame | None = None) -> DataFrame:
    """One row per person with the flat paths: demographics and care_team."""
    persons, roster = persons_with_roster(t, cc_version, how, xref)
    g = S.with_care_roles(t, S.gather(persons, "origid", {"patient": t["patient"], "roster": roster}, {}))
    return g.select("origid", S.demographics_section(as_of).alias("demographics"), S.care_team_section(as_of).alias("care_team"))
