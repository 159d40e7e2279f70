"""Explicit schemas of the source tables the person record is built from.

Column names are those the reference reads; types follow their use (codes
and ids as strings, 0/1 flags as int, money and scores as decimals).
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql.types import StructType

from carelake.plans.visits import VISIT_COLUMNS


def _visit_type(col: str) -> str:
    if col in ("enc_admit_date", "enc_disch_date", "m72hr_flwup_date", "tfu_followup_date"):
        return "DATE"
    if col in ("mh1_cal_amount", "mc1_cal_amount"):
        return "DECIMAL(14,2)"
    if col == "m_cal_bed_days":
        return "INT"
    if col.startswith("is_") or col in ("m_flwup_flag", "tfu_pb_er", "tfu_pb_obs", "tfu_denom",
                                          "tfu_numer", "acr_numer", "acr_denom", "uamcc_numerator"):
        return "INT"
    return "STRING"


_MRA1_EXTRA = ["patient_id STRING", "enc_proc_type STRING", "enc_date DATE"]

DOMAIN_DDL = {
    "patient": (
        "origid STRING, lastname STRING, firstname STRING, middlename STRING, birthdate DATE, "
        "sex STRING, sex_at_birth STRING, race STRING, ethnicgroup STRING, language STRING, "
        "civil_status STRING, blood_group STRING, dnr_status STRING, nursing_home_alert INT, "
        "phone_1_code STRING, phone_1_nr STRING, phone_2_nr STRING, cellphone_2_nr STRING, "
        "email STRING, no_email INT, addr_str STRING, addr_citytown_name STRING, addr_state STRING, "
        "addr_zip STRING, addr_country STRING, addr_is_valid INT, contact_person STRING, "
        "contact_relation STRING, contact_person_phone STRING, Next_Office_Visit DATE, "
        "Last_PCP_Visit_Date DATE, status STRING, is_ccm_enabled INT, ccm_level STRING, "
        "ccm_activedate DATE, ccm_inactivedate DATE, consent_onfile INT, dr_first_status STRING, "
        "is_alert_inc_alerts INT, long_term_care INT, inactive_date DATE, inactive_reason STRING, "
        "account_id STRING"),
    "dc_bene_alignment_rostr_m01": (
        "mm_curr_mbi_id STRING, cc_version STRING, mm_date DATE, ALIGN_STATUS_CODE STRING, "
        "market_id INT, market_names STRING, dce_group_name STRING, dce_sub_group_name STRING, "
        "dce_sub_group_nr INT, dce_group_nr INT, dce_provider_name STRING, prov_npi_nr STRING, "
        "Last_PCP_Visit_Date DATE"),
    "mra_dce_cm_mapping": "provider_npi STRING, cm_nr INT, type STRING",
    "personell": "nr INT, name STRING",
    "adt_encounter": (
        "encounter_nr STRING, origid STRING, mos_type STRING, encounter_class_nr INT, "
        "encounter_status STRING, encounter_date DATE, discharge_date DATE, next_pcp_visit_date DATE, "
        "hcc_followup DATE, cm_followup DATE, hospital_name STRING, hospital_npi STRING, "
        "hos_taxonomy01 STRING, hospital_nr STRING, PRVDR_OSCAR_NUM STRING, dce_provider_name STRING, "
        "ATNDG_PRVDR_NPI_NUM STRING, taxonomy STRING, mh2patient_class_curr STRING, "
        "mh_admission_source STRING, referrer_diagnosis STRING, mh_patient_class STRING, "
        "appt_confirmed_mra STRING, high_utilizer INT, m_discharge_to STRING, BENE_PTNT_STUS_CD STRING, "
        "m_redmit_flag INT, readmit_er_status INT, readmit_rate_percentile DECIMAL(6,2), "
        "tfu_enabled INT, followup_days INT, acr_numerator INT, tcm_num INT, CUR_CLM_UNIQ_ID STRING, "
        "CLM_EFCTV_DT DATE, CLM_PRVDR_SPCLTY_CD STRING, care_status STRING, audit_status STRING, "
        "mos STRING, tfu_numerator INT, mif_exclusion INT, census_status STRING"),
    "mra1_encounter": ", ".join(
        _MRA1_EXTRA + [f"{c} {_visit_type(c)}" for c, _ in VISIT_COLUMNS]),
    "adt_encounter_icd_codes": (
        "id BIGINT, encounter_nr STRING, diagnosis_code STRING, diagnosis_desc STRING, onset_date DATE, "
        "problem_type STRING, icd_order INT, status STRING, is_comorbid INT, SNOMED_CID STRING, "
        "SNOMED_FSN STRING, ccm_track INT, source STRING"),
    "mra1_encounter_icd_codes": "encounter_nr STRING, diagnosis_code STRING",
    "mra1_encounter_bill_cpts": (
        "encounter_nr STRING, bb_Code STRING, bb_modifier STRING, CLM_LINE_PROD_REV_CTR_CD STRING"),
    "cclf_encounter_patient_medication": (
        "id BIGINT, encounter_nr STRING, NDCID STRING, RxnormID STRING, medications STRING, dose STRING, "
        "dose_unit STRING, start_date TIMESTAMP, stop_date TIMESTAMP, delete_status STRING"),
    "mra_hcc_coefficients": (
        "diagnosis_code STRING, description STRING, hcc STRING, hcc_nr STRING, "
        "community_nondual_aged DECIMAL(6,3), active_date TIMESTAMP, inactive_date TIMESTAMP"),
    "mra_raf_patient": (
        "origid STRING, type STRING, year INT, month INT, total_score DECIMAL(12,4), "
        "initial_score DECIMAL(12,4)"),
    "mra_uamcc_details": (
        "nr BIGINT, origid STRING, service_date DATE, condition_category STRING, diagnosis_code STRING, "
        "diagnosis_desc STRING, prov_npi_nr STRING, prov_name STRING, prov_taxonomy STRING, "
        "facility_name STRING, claim_source STRING, claim_type STRING, version INT, "
        "is_most_recent_per_category INT"),
    "mra_scorecard_alerts": (
        "nr BIGINT, origid STRING, type STRING, ref_description STRING, ref_detail STRING, ref_id STRING, "
        "ref_date DATE, added_date DATE, ack_date DATE, resolved_date DATE, ack_by STRING, "
        "ack_notes STRING, resolved_by STRING, current_status INT, original_status INT, version_no INT"),
    "drfirst_patient_medications": (
        "id BIGINT, patientid STRING, RxnormID STRING, NDCID STRING, medications STRING, "
        "generic_name STRING, schedule STRING, dose STRING, dose_unit STRING, rout STRING, "
        "start_date TIMESTAMP, fill_date TIMESTAMP, stop_date TIMESTAMP, quantity STRING, "
        "quantity_unit STRING, refills STRING, prescribed_doctor STRING, source STRING, "
        "delete_status STRING, reconciled_status STRING, risk_indicator STRING, duration STRING"),
    "cpoe_result": (
        "result_id BIGINT, encounter_nr STRING, result_date DATE, result_status STRING, "
        "result_created_by STRING, specimen_type STRING, specimen_collection_date DATE"),
    "cpoe_result_values": (
        "result_id BIGINT, item_id BIGINT, notes STRING, unit STRING, notes_abnormality_flag STRING"),
    "cpoe_item": "item_id BIGINT, item_name STRING",
    "mra_assessments_and_screenings": (
        "nr BIGINT, origid STRING, assessment_tools STRING, date_completed DATE, acuity STRING, "
        "score STRING, completed_by STRING, notes STRING, created_date DATE"),
    "mra_member_history_data": (
        "origid STRING, history_nr INT, history_value STRING, created_date TIMESTAMP"),
    "transportation_benefit": (
        "nr BIGINT, orig_id STRING, encounter_nr STRING, date DATE, mode STRING, eligible_rides INT, "
        "ride_booked_by STRING, cost_of_the_ride DECIMAL(10,2), transportation_company STRING, "
        "pickup_address STRING, dropoff_address STRING, notes STRING, facility_name STRING, "
        "facility_sub_name STRING, dce_provider_name STRING, member_type STRING"),
    "sdoh_meal_plan": (
        "nr BIGINT, origid STRING, meal_type STRING, product_sku STRING, order_id STRING, "
        "order_status STRING, eligibility_status STRING, start_date DATE, end_date DATE, "
        "created_date DATE, updated_date DATE, ship_frequency_id INT, assigned_cm STRING, "
        "source STRING, notes STRING, created_by STRING, updated_by STRING"),
    "chronic_disease_reward_program": (
        "nr BIGINT, origid STRING, program STRING, chronic_disease STRING, criteria STRING, "
        "status STRING, date DATE, gift_card_number_issued STRING, gift_card_received STRING, "
        "address_verified STRING, associate_name STRING, gift_card_to_be_issued STRING"),
    "care_plan_patient": (
        "origid STRING, plan_status INT, plan_inactive_datetime TIMESTAMP, reassessment STRING, "
        "updated_date DATE, plan_start_date DATE"),
    "allergies_medications": (
        "appointmentid STRING, origid STRING, encounterdate STRING, appointmentstartdate STRING, "
        "closeddate STRING, encountertype STRING, encountervisitname STRING, patientstatus STRING, "
        "type STRING"),
}

DOMAIN_TABLES = list(DOMAIN_DDL)

# Not a source of every installation: foreign person ids.
XREF_DDL = "ref STRING, origid STRING"

# Person-key column of each table where it is not ``origid`` (normalised at load).
PERSON_KEY_ALIASES = {
    "mra1_encounter": "patient_id",
    "drfirst_patient_medications": "patientid",
    "transportation_benefit": "orig_id",
}

# Code columns compared case-insensitively by the source (collation), upper-cased at load.
CODE_COLUMNS = {
    "adt_encounter_icd_codes": ["diagnosis_code"],
    "mra1_encounter_icd_codes": ["diagnosis_code"],
    "mra_hcc_coefficients": ["diagnosis_code"],
    "mra_uamcc_details": ["diagnosis_code"],
    "mra1_encounter_bill_cpts": ["bb_Code"],
}


@lru_cache(maxsize=None)
def schema(name: str) -> StructType:
    """Parsed schema of a source table (parsed once per process)."""
    return StructType.fromDDL(DOMAIN_DDL[name])
