"""Routing of source-table changes to persons and record sections.

Covers every table the record reads (decision D15), including those the
reference's routing file leaves out; hops follow the source keys
(encounter, result, item, code, provider, personnel).
"""

from __future__ import annotations

from dataclasses import replace

from carelake.plans.cdc import Hop, Route

ADT = Hop("adt_encounter", "encounter_nr", "origid")
MRA1 = Hop("mra1_encounter", "encounter_nr", "origid")
ROSTER = Hop("dc_bene_alignment_rostr_m01", "prov_npi_nr", "mm_curr_mbi_id",
             "ALIGN_STATUS_CODE IN ('AL', 'D1Y')")

ENC_SECTIONS = ("encounters", "rule_flags")

ROUTES = [
    Route("patient", "origid", (), ("demographics", "contact", "enrollment", "care_team", "rule_flags",
                                     "emr_appointments")),
    Route("dc_bene_alignment_rostr_m01", "mm_curr_mbi_id", (), ("care_team", "enrollment"), "mm_date",
          row_filter="ALIGN_STATUS_CODE IN ('AL', 'D1Y')", row_cols=("ALIGN_STATUS_CODE",)),
    Route("mra_dce_cm_mapping", "provider_npi", (ROSTER,), ("care_team",)),
    Route("personell", "nr", (Hop("mra_dce_cm_mapping", "cm_nr", "provider_npi"), ROSTER), ("care_team",)),
    Route("adt_encounter", "origid", (), ENC_SECTIONS + ("chronic_conditions", "labs"), "encounter_date"),
    Route("mra1_encounter", "origid", (), ENC_SECTIONS + ("hcc_capture",), "enc_admit_date"),
    Route("adt_encounter_icd_codes", "encounter_nr", (ADT,), ("encounters", "chronic_conditions"), "onset_date"),
    Route("adt_encounter_icd_codes", "encounter_nr", (MRA1,), ("encounters",), "onset_date"),
    Route("mra1_encounter_icd_codes", "encounter_nr", (MRA1,), ("hcc_capture", "rule_flags")),
    Route("mra1_encounter_bill_cpts", "encounter_nr", (ADT,), ENC_SECTIONS),
    Route("mra1_encounter_bill_cpts", "encounter_nr", (MRA1,), ENC_SECTIONS),
    Route("cclf_encounter_patient_medication", "encounter_nr", (ADT,), ("encounters",), "start_date"),
    Route("cclf_encounter_patient_medication", "encounter_nr", (MRA1,), ("encounters",), "start_date"),
    Route("mra_hcc_coefficients", "diagnosis_code",
          (Hop("adt_encounter_icd_codes", "diagnosis_code", "encounter_nr"), ADT),
          ("chronic_conditions", "encounters")),
    Route("mra_hcc_coefficients", "diagnosis_code",
          (Hop("adt_encounter_icd_codes", "diagnosis_code", "encounter_nr"), MRA1), ("encounters",)),
    Route("mra_hcc_coefficients", "diagnosis_code",
          (Hop("mra1_encounter_icd_codes", "diagnosis_code", "encounter_nr"), MRA1),
          ("hcc_capture", "encounters", "rule_flags")),
    Route("mra_raf_patient", "origid", (), ("raf_profile", "rule_flags"), "year", change_date_is_year=True),
    Route("mra_uamcc_details", "origid", (), ("uamcc", "rule_flags", "chronic_conditions"), "service_date"),
    Route("mra_scorecard_alerts", "origid", (), ("alerts", "hedis_measures", "rule_flags"), "added_date"),
    Route("drfirst_patient_medications", "origid", (), ("medications", "medication_adherence", "rule_flags"),
          "start_date"),
    Route("cpoe_result", "encounter_nr", (ADT,), ("labs",), "result_date"),
    Route("cpoe_result_values", "result_id", (Hop("cpoe_result", "result_id", "encounter_nr"), ADT), ("labs",)),
    Route("cpoe_item", "item_id", (Hop("cpoe_result_values", "item_id", "result_id"),
                                   Hop("cpoe_result", "result_id", "encounter_nr"), ADT), ("labs",)),
    Route("mra_assessments_and_screenings", "origid", (), ("assessments",), "created_date"),
    Route("mra_member_history_data", "origid", (), ("sdoh", "rule_flags"), "created_date",
          row_filter="CAST(history_nr AS INT) IN (15074, 15078)", row_cols=("history_nr",)),
    Route("transportation_benefit", "origid", (), ("transport_benefits", "sdoh", "rule_flags"), "date"),
    Route("sdoh_meal_plan", "origid", (), ("sdoh", "rule_flags"), "created_date"),
    Route("chronic_disease_reward_program", "origid", (), ("sdoh",), "date"),
    Route("care_plan_patient", "origid", (), ("rule_flags",), "updated_date"),
    Route("allergies_medications", "origid", (), ("emr_appointments",), "encounterdate"),
]

# ── rosters whose ids aren't the persons' (C10, J15, decision D2) ─────────

XREF = Hop("person_xref", "ref", "origid")


def with_xref(routes=ROUTES) -> list[Route]:
    """The routes where the roster carries a foreign id: every chain that ends
    at a roster id goes on through the cross-reference ``person_xref`` (ref,
    origid), and a change of the cross-reference itself concerns the persons
    of both its images."""
    out = []
    for r in routes:
        foreign = r.table == "dc_bene_alignment_rostr_m01" if not r.hops else r.hops[-1] == ROSTER
        out.append(replace(r, hops=(*r.hops, XREF)) if foreign else r)
    return [*out, Route("person_xref", "origid", (), ("care_team", "enrollment"))]
