"""Registered queries that run the record builder on the source tables derived
from the benchmark tables, and show its values: every section, every flag."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.plans import sections as S
from carelake.plans.cdc import affected, persons_to_rebuild, table_changes
from carelake.plans.document import build_documents
from carelake.plans.routing import ROUTES, with_xref
from carelake.session import shared_dir
from carelake.sources.derived import AS_OF, derive
from carelake.sources.driver import Tables
from carelake.sources.tables import PartitionedTables, only_persons, write_partitioned


def _tables(spark, sf_dir) -> dict[str, DataFrame]:
    return derive(Tables(spark, sf_dir))


def _record(spark, sf_dir, *sections: str, **kw) -> DataFrame:
    return build_documents(_tables(spark, sf_dir), AS_OF, sections=sections, **kw).select("origid", "patient.*")


def _text(c: str) -> Column:
    """An array as text; NULL elements are left out."""
    return F.array_join(c, ",")


def _items(df: DataFrame, section: str) -> DataFrame:
    return df.select("origid", F.explode(section).alias("x")).select("origid", "x.*")


def doc_person(spark, sf_dir) -> DataFrame:
    """D-demo, D-cont, D-care, D-enr (P16 J1 J2 J13 T3 T4): the person's own
    sections, without building any other."""
    d = _record(spark, sf_dir, "demographics", "contact", "care_team", "enrollment")
    return d.select(
        "origid", "demographics.last_name", "demographics.dob", "demographics.age", "demographics.sex",
        F.col("contact.phone_primary").alias("phone"), F.col("contact.address.country").alias("country"),
        F.col("contact.address.verified").alias("verified"), F.col("care_team.id").alias("team_id"), "care_team.market_id",
        "care_team.dce_provider_npi", "care_team.care_manager", "care_team.outreach_worker", "care_team.census_manager", "care_team.mos",
        _text("care_team.member_nrs").alias("member_nrs"), "enrollment.status", "enrollment.align_status_code", "enrollment.ccm_enabled",
        "enrollment.ccm_level", "enrollment.consent_on_file")


def doc_flags(spark, sf_dir) -> DataFrame:
    """D-flag: the 26 flags and the five extension flags."""
    f = _record(spark, sf_dir, "rule_flags").select("origid", "rule_flags.*")
    lists = ["hedis_gap_measures", "uamcc_conditions", "unresolved_alert_types", "hcc_gap_codes"]
    return f.select(*[_text(c).alias(c) if c in lists else F.col(c).cast("double").alias(c) if c == "raf_score" else c for c in f.columns])


def doc_scores(spark, sf_dir) -> DataFrame:
    """D-raf, D-hcc, D-risk, D-uam, D-adh, D-meta."""
    d = _record(spark, sf_dir, "raf_profile", "hcc_capture", "risk_scores", "uamcc", "medication_adherence", "_meta")
    raf = [c for ty in S.RAF_TYPES for c in (F.col(f"raf_profile.{ty}.detail_score").cast("double").alias(f"{ty}_score"),
                                             F.col(f"raf_profile.{ty}.month").alias(f"{ty}_month"))]
    return d.select(
        "origid", *raf, F.col("raf_profile.year").alias("raf_year"), F.col("hcc_capture.id").alias("capture_id"), "hcc_capture.eligible_hccs",
        "hcc_capture.captured_hccs", "hcc_capture.capture_pct", _text("hcc_capture.gap_hccs").alias("gap_hccs"),
        F.size("risk_scores.uha").alias("n_uha"), F.col("risk_scores.roster_scores.cdi_score").alias("cdi_score"),
        "uamcc.summary.condition_count", "uamcc.summary.program_eligible", _text("uamcc.summary.conditions").alias("conditions"),
        _text("uamcc.summary.icd_prefixes").alias("icd_prefixes"), "medication_adherence.covered_days", "medication_adherence.rx_adherence_pct",
        "medication_adherence.adherence_flag", "_meta.schema_version", "_meta.trigger_source", "_meta.created_at")


def doc_variants(spark, sf_dir) -> DataFrame:
    """D-hcc counted by code, D-adh with overlaps merged."""
    d = _record(spark, sf_dir, "hcc_capture", "medication_adherence", capture_level="code", merge_overlaps=True)
    return d.select("origid", "hcc_capture.eligible_hccs", "hcc_capture.captured_hccs", "medication_adherence.covered_days",
                    "medication_adherence.rx_adherence_pct")


def doc_chronic(spark, sf_dir) -> DataFrame:
    """D-chron (A4 J4 J5 J6 J7 P8): a row per condition."""
    x = _items(_record(spark, sf_dir, "chronic_conditions"), "chronic_conditions")
    return x.select("origid", "icd_code", "hcc_number", F.col("hcc_score").cast("double").alias("hcc_score"), "condition_category", "is_comorbid",
                    "status", "first_onset_date", "last_seen_date", "days_since_last_seen", "encounter_count", "recapture_needed")


def doc_encounters(spark, sf_dir) -> DataFrame:
    """D-enc (U1 J14 J3 X3): a row per encounter with its children counted."""
    t = derive(Tables(spark, sf_dir), share_lines=True)
    x = _items(build_documents(t, AS_OF, sections=["encounters"]).select("origid", "patient.*"), "encounters")
    return x.select(
        "origid", "encounter_nr", "source_system", "setting", "encounter_status", F.col("dates.admission_date").alias("admitted"),
        F.col("dates.discharge_date").alias("discharged"), F.col("dates.length_of_stay_days").alias("days"),
        F.col("dates.tcm_7day_deadline").alias("tcm_7day"), F.col("discharge.readmit_30d").alias("readmit"), "market_name", "is_readmission",
        F.size("diagnoses").alias("n_diagnoses"), F.size("procedures").alias("n_procedures"), F.size("enc_medications").alias("n_medications"),
        F.size(F.filter("diagnoses", lambda d: d["is_comorbid"])).alias("n_comorbid"), "specialty", "specialty_code")


def doc_labs(spark, sf_dir) -> DataFrame:
    """D-lab (J9 F17): a row per result value."""
    x = _items(_record(spark, sf_dir, "labs"), "labs")
    return x.select("origid", "encounter_nr", "result_date", "item_id", "test_name", "result_value", "alert_flag", "abnormal", "result_status")


def doc_medications(spark, sf_dir) -> DataFrame:
    """D-med (P9 P11)."""
    x = _items(_record(spark, sf_dir, "medications"), "medications")
    return x.select("origid", "medication_name", "start_date", "stop_date", "active", "source", "delete_status")


def doc_alerts(spark, sf_dir) -> DataFrame:
    """D-alr and D-hed (F14 U3): both arrays' items, told apart by ``kind``."""
    d = _record(spark, sf_dir, "alerts", "hedis_measures")
    a = _items(d, "alerts").select("origid", F.lit("alert").alias("kind"), F.col("id").cast("string").alias("id"), F.col("alert_type").alias("name"),
                                   F.col("status_desc").alias("status"), "open", F.col("added_date").alias("date"))
    h = _items(d, "hedis_measures").select("origid", F.lit("hedis").alias("kind"), "id", F.col("measure_name").alias("name"), "status",
                                           F.col("gap_open").alias("open"), F.lit(None).cast("string").alias("date"))
    return a.unionByName(h)


def doc_sdoh(spark, sf_dir) -> DataFrame:
    """D-sdoh (A13 A15 A16): yearly answers, flags and programme counts."""
    d = _record(spark, sf_dir, "sdoh")
    return d.select("origid", _text("sdoh.food_insecurity.responses").alias("responses"), _text("sdoh.food_insecurity.latest_date").alias("latest"),
                    "sdoh.food_insecurity_flag", "sdoh.transport_barrier_flag", F.coalesce(F.size("sdoh.meal_plans"), F.lit(0)).alias("n_meal_plans"),
                    F.size(F.filter("sdoh.reward_programs", lambda r: r["gift_card_received"])).alias("n_gift_cards"))


def doc_lists(spark, sf_dir) -> DataFrame:
    """D-ass, D-tra, D-app and the lists of D-uam and D-sdoh (T5 P10): their
    items as (section, id, date, text)."""
    d = _record(spark, sf_dir, "assessments", "transport_benefits", "emr_appointments", "uamcc", "sdoh").select("*", "uamcc.details", "sdoh.meal_plans", "sdoh.reward_programs")
    parts = [("assessments", "date_completed", F.concat_ws("|", "tool", "score")), ("transport_benefits", "date", F.lit("")),
             ("emr_appointments", "encounter_date", F.concat_ws("|", "appointment_start", "account_id", F.col("completed").cast("string"))),
             ("details", "service_date", F.concat_ws("|", "condition_category", "icd_code", "claim_type")),
             ("meal_plans", "created_date", F.concat_ws("|", "order_status", "end_date")), ("reward_programs", "date", F.col("program"))]
    out = None
    for section, date, text in parts:
        rows = _items(d, section).select("origid", F.lit(section).alias("section"), F.col("id").cast("string").alias("id"), F.col(date).alias("date"), text.alias("text"))
        out = rows if out is None else out.unionByName(rows)
    return out


def refresh_pruned(spark, sf_dir) -> DataFrame:
    """S6 and C1 with pruned reads: some alerts change, and their persons'
    records are built from the source partitions that hold them."""
    base = shared_dir(spark, "refresh_pruned", uuid.uuid4().hex)
    some = ["patient", "dc_bene_alignment_rostr_m01", "adt_encounter", "mra1_encounter", "adt_encounter_icd_codes", "mra1_encounter_icd_codes",
            "mra1_encounter_bill_cpts", "cclf_encounter_patient_medication", "cpoe_result", "cpoe_result_values", "cpoe_item", "mra_hcc_coefficients",
            "mra_scorecard_alerts"]
    write_partitioned({n: df for n, df in _tables(spark, sf_dir).items() if n in some}, base, n_parts=16)
    t = PartitionedTables(spark, base)
    changed = t["mra_scorecard_alerts"].where("type = 'signup' and ref_id = '7'")
    ch = table_changes(changed, "mra_scorecard_alerts", F.col("nr"), F.lit("2024-01-01"), cols=["nr", "origid", "added_date"])
    todo = persons_to_rebuild(affected(ch, ROUTES, t, prune=True)).checkpoint()
    d = build_documents(only_persons(t, todo), AS_OF, sections=["encounters", "labs", "alerts"]).select("origid", "patient.*")
    n = lambda c: F.coalesce(F.when(F.col(c).isNotNull(), F.size(c)), F.lit(0)).alias(f"n_{c}")
    return d.select("origid", n("encounters"), n("labs"), n("alerts"))


def cdc_roster_xref(spark, sf_dir) -> DataFrame:
    """C10 and J15 through the routes: rosters carry foreign ids.  Moved,
    deleted and new roster rows, changed personnel and a re-pointed
    cross-reference reach the persons of both images."""
    t = _tables(spark, sf_dir)
    roster, patient = "dc_bene_alignment_rostr_m01", t["patient"]
    foreign = lambda c: F.concat(F.lit("MBI-"), F.reverse(c), F.lit("-"), c)
    k = F.col("origid").cast("long")
    t["person_xref"] = patient.select(foreign(F.col("origid")).alias("ref"), "origid")
    t[roster] = t[roster].withColumn("mm_curr_mbi_id", foreign(F.col("mm_curr_mbi_id")))
    row = lambda ref, status: F.create_map(F.lit("mm_curr_mbi_id"), ref, F.lit("ALIGN_STATUS_CODE"), F.lit(status))
    ref, next_ref = foreign(F.col("origid")), foreign((k + 1).cast("string"))
    none = F.lit(None).cast("map<string,string>")
    change = lambda df, table, op, before, after: df.select(
        k.alias("event_id"), k.alias("sequence"), F.lit("2024-01-01").cast("timestamp").alias("change_ts"), F.lit(table).alias("table"),
        F.lit(op).alias("op"), before.alias("before"), after.alias("after"))
    ch = change(patient.where(k % 10 == 0), roster, "U", row(ref, "AL"), row(next_ref, "AL")) \
        .unionByName(change(patient.where(k % 10 == 3), roster, "D", row(ref, "D1Y"), none)) \
        .unionByName(change(patient.where(k % 10 == 5), roster, "I", none, row(ref, "XX"))) \
        .unionByName(change(patient.where(k % 50 == 7), "person_xref", "U", F.create_map(F.lit("ref"), ref, F.lit("origid"), F.col("origid")),
                            F.create_map(F.lit("ref"), ref, F.lit("origid"), (k + 1).cast("string"))))
    staff = table_changes(t["personell"].where("nr = 4"), "personell", F.col("nr"), F.lit("2024-01-01"), cols=["nr"])
    aff = affected(ch.unionByName(staff), with_xref(), t, prune=True)
    return aff.where("section = 'care_team'").select("table", "origid").distinct()


def cdc_due(spark, sf_dir) -> DataFrame:
    """C11 (P7 P9 P13 F4): the day on which a person's record next changes by
    itself, as the record carries it."""
    return _record(spark, sf_dir, "_meta").select("origid", F.col("_meta.next_due").alias("next_due"))


QUERIES = {f.__name__: f for f in (doc_person, doc_flags, doc_scores, doc_variants, doc_chronic, doc_encounters, doc_labs, doc_medications, doc_alerts,
                                   doc_sdoh, doc_lists, refresh_pruned, cdc_roster_xref, cdc_due)}
