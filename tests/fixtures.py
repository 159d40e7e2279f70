"""Small domain fixtures with the source tables' shapes, invented values.

Edge rows (FIXTURES.md §C): leap-day birth, open encounter, NULL status with
NOT IN / !=, encounter without children, person without labs/medications,
alert with NULL description, two active coefficients for one code,
reassessment '90 days' / 'abc', two codes of one HCC with one seen this
year, overlapping prescriptions with a future stop date, answers in two
years with the latest negative, lower-case codes.
"""

from __future__ import annotations

import datetime as dt

from carelake.sources.schemas import DOMAIN_DDL
from carelake.sources.tables import from_frames

D = dt.date
T = dt.datetime
AS_OF = "2023-02-28"


def _rows(spark, name, rows):
    from decimal import Decimal

    from pyspark.sql.types import DecimalType, StructType
    schema = StructType.fromDDL(DOMAIN_DDL[name])
    conv = [(f.name, isinstance(f.dataType, DecimalType)) for f in schema.fields]
    data = [tuple(Decimal(str(r[c])) if dec and r.get(c) is not None else r.get(c) for c, dec in conv)
            for r in rows]
    return spark.createDataFrame(data, schema)


ROWS = {
    "patient": [
        dict(origid="P1", lastname="Doe", firstname="Ann", birthdate=D(2000, 2, 29), sex="M",
             nursing_home_alert=1, phone_1_code="+1", phone_1_nr="5550100", addr_country=None,
             addr_is_valid=1, Last_PCP_Visit_Date=D(2021, 1, 1), is_ccm_enabled=1, consent_onfile=None,
             ccm_level="2", account_id="ACC1", Next_Office_Visit=D(2023, 3, 10), status="active"),
        dict(origid="P2", lastname="Roe", firstname="Bo", birthdate=D(1950, 6, 15), sex="X",
             phone_1_nr="5550101", Last_PCP_Visit_Date=D(2022, 12, 1), account_id="ACC2"),
        dict(origid="P3", lastname="Poe", birthdate=D(1960, 1, 1), sex="F"),
    ],
    "dc_bene_alignment_rostr_m01": [
        dict(mm_curr_mbi_id="P1", cc_version="V1", mm_date=D(2023, 1, 1), ALIGN_STATUS_CODE="AL",
             market_id=7, market_names="North", dce_group_name="G1", prov_npi_nr="NPI1",
             Last_PCP_Visit_Date=D(2021, 1, 1)),
        dict(mm_curr_mbi_id="P1", cc_version="V1", mm_date=D(2023, 2, 1), ALIGN_STATUS_CODE="XX",
             market_id=8, prov_npi_nr="NPI9"),
        dict(mm_curr_mbi_id="P2", cc_version="V1", mm_date=D(2022, 11, 1), ALIGN_STATUS_CODE="D1Y",
             market_id=7, market_names="North", prov_npi_nr="NPI2"),
        dict(mm_curr_mbi_id="P3", cc_version="V1", mm_date=D(2023, 1, 1), ALIGN_STATUS_CODE="XX"),
    ],
    "mra_dce_cm_mapping": [
        dict(provider_npi="NPI1", cm_nr=1, type="CCM_MNGT"), dict(provider_npi="NPI1", cm_nr=2, type="Outreach"),
        dict(provider_npi="NPI1", cm_nr=3, type="CCM_MNGT"), dict(provider_npi="NPI2", cm_nr=2, type="census_mos"),
    ],
    "personell": [dict(nr=1, name="Zed Care"), dict(nr=2, name="Amy Out"), dict(nr=3, name="Bob Care")],
    "adt_encounter": [
        dict(encounter_nr="E1", origid="P1", mos_type="IP", encounter_class_nr=1, encounter_status="closed",
             encounter_date=D(2023, 2, 10), discharge_date=D(2023, 2, 15), m_redmit_flag=1, tcm_num=1,
             hospital_name="H1"),
        dict(encounter_nr="E3", origid="P1", mos_type="IP", encounter_class_nr=3, encounter_status="active",
             encounter_date=D(2022, 6, 1), discharge_date=None),
        dict(encounter_nr="E5", origid="P1", mos_type="OV", encounter_class_nr=5, encounter_status="closed",
             encounter_date=D(2021, 12, 1), discharge_date=D(2021, 12, 1)),
        dict(encounter_nr="E4", origid="P2", mos_type="IP", encounter_class_nr=1, encounter_status=None,
             encounter_date=D(2023, 1, 3), discharge_date=None),
    ],
    "mra1_encounter": [
        dict(encounter_nr="M1", patient_id="P1", enc_proc_type="SNF", enc_admit_date=D(2023, 1, 5),
             enc_disch_date=D(2023, 1, 20), enc_date=D(2023, 1, 5), pt_facility_nr="F1", is_readmit=1,
             mh1_cal_amount=12.5),
        dict(encounter_nr="M2", patient_id="P1", enc_proc_type="Emergency", enc_admit_date=D(2022, 3, 1),
             enc_disch_date=D(2022, 3, 1), enc_date=D(2022, 3, 1), pt_facility_nr="F1"),
        dict(encounter_nr="M3", patient_id="P2", enc_proc_type="SNF", enc_admit_date=D(2021, 5, 1),
             enc_disch_date=D(2021, 5, 9), enc_date=D(2021, 5, 1), pt_facility_nr="F2"),
    ],
    "adt_encounter_icd_codes": [
        dict(id=11, encounter_nr="E1", diagnosis_code="i10", icd_order=1, status=None, is_comorbid=1,
             onset_date=D(2020, 1, 1)),
        dict(id=12, encounter_nr="E1", diagnosis_code="E11.9", icd_order=2, status="Resolved"),
        dict(id=13, encounter_nr="E3", diagnosis_code="I10", icd_order=1, SNOMED_CID="38341003",
             source="emr"),
    ],
    "mra1_encounter_icd_codes": [
        dict(encounter_nr="M1", diagnosis_code="E11.9"), dict(encounter_nr="M2", diagnosis_code="I10"),
        dict(encounter_nr="M2", diagnosis_code="N18.3"),
    ],
    "mra1_encounter_bill_cpts": [
        dict(encounter_nr="E5", bb_Code="g0439"), dict(encounter_nr="M1", bb_Code="99213", bb_modifier="25"),
    ],
    "cclf_encounter_patient_medication": [
        dict(id=501, encounter_nr="E1", medications="lisinopril", start_date=T(2023, 2, 10, 8, 0)),
    ],
    "mra_hcc_coefficients": [
        dict(diagnosis_code="E11.9", description="Diabetes", hcc="37", hcc_nr="37",
             community_nondual_aged=0.166, active_date=T(2020, 1, 1), inactive_date=T(2030, 1, 1)),
        dict(diagnosis_code="N18.3", description="CKD 3", hcc="37", hcc_nr="37",
             community_nondual_aged=0.127, active_date=T(2020, 1, 1), inactive_date=T(2030, 1, 1)),
        dict(diagnosis_code="I10", description="Hypertension", hcc="226", hcc_nr="226",
             community_nondual_aged=0.300, active_date=T(2020, 1, 1), inactive_date=T(2030, 1, 1)),
        dict(diagnosis_code="I10", description="Hypertension", hcc="226", hcc_nr="226",
             community_nondual_aged=0.400, active_date=T(2022, 1, 1), inactive_date=T(2030, 1, 1)),
        dict(diagnosis_code="Z99", description="Old", hcc="1", hcc_nr="1",
             community_nondual_aged=1.0, active_date=T(2010, 1, 1), inactive_date=T(2012, 1, 1)),
    ],
    "mra_raf_patient": [
        dict(origid="P1", type="prmra", year=2023, month=1, total_score=1.23456, initial_score=1.1),
        dict(origid="P1", type="prmra", year=2022, month=12, total_score=2.0, initial_score=2.0),
        dict(origid="P1", type="pmra", year=2023, month=2, total_score=0.9, initial_score=0.8),
        dict(origid="P1", type="pmra", year=2023, month=1, total_score=0.7, initial_score=0.6),
    ],
    "mra_uamcc_details": [
        dict(nr=1, origid="P1", service_date=D(2023, 1, 1), condition_category="CHF", diagnosis_code="I50.9",
             is_most_recent_per_category=1),
        dict(nr=2, origid="P1", service_date=D(2022, 5, 1), condition_category="DIAB", diagnosis_code="E11.9",
             is_most_recent_per_category=1),
        dict(nr=3, origid="P1", service_date=D(2021, 5, 1), condition_category="CHF", diagnosis_code="I50.1",
             is_most_recent_per_category=0),
    ],
    "mra_scorecard_alerts": [
        dict(nr=1, origid="P1", type="Hedis/Quality", ref_description="Controlling High BP", ref_detail="CBP",
             ref_id="F1", added_date=D(2023, 1, 10), current_status=1, original_status=1),
        dict(nr=2, origid="P1", type="Hedis/Quality", ref_description=None, ref_id="F2",
             added_date=D(2023, 1, 12), current_status=9, original_status=2),
        dict(nr=3, origid="P1", type="Care", ref_description="x", added_date=D(2022, 1, 1),
             resolved_date=D(2023, 1, 1), current_status=4, original_status=1),
        dict(nr=4, origid="P1", type="Care", ref_description="y", added_date=D(2022, 2, 1),
             original_status=None),
        dict(nr=5, origid="P1", type="Hedis/Quality", ref_description="z", added_date=D(2022, 3, 1),
             original_status=4),
    ],
    "drfirst_patient_medications": [
        dict(id=1, patientid="P1", medications="a", start_date=T(2023, 1, 1), stop_date=None, delete_status="n"),
        dict(id=2, patientid="P1", medications="b", start_date=T(2023, 1, 15), stop_date=T(2023, 3, 31),
             delete_status="n"),
        dict(id=3, patientid="P1", medications="c", start_date=T(2022, 1, 1), delete_status="y"),
    ],
    "cpoe_result": [dict(result_id=100, encounter_nr="E1", result_date=D(2023, 2, 11), result_status="final")],
    "cpoe_result_values": [dict(result_id=100, item_id=7, notes="150", unit="mg/dL", notes_abnormality_flag="H")],
    "cpoe_item": [dict(item_id=7, item_name="Glucose")],
    "mra_assessments_and_screenings": [
        dict(nr=1, origid="P1", assessment_tools="PHQ-9", date_completed=D(2023, 1, 2), score="5"),
    ],
    "mra_member_history_data": [
        dict(origid="P1", history_nr=15074, history_value="Often true", created_date=T(2022, 5, 1)),
        dict(origid="P1", history_nr=15078, history_value="Never true", created_date=T(2023, 1, 5)),
        dict(origid="P1", history_nr=15078, history_value="", created_date=T(2023, 2, 5)),
        dict(origid="P1", history_nr=15074, history_value="Sometimes true", created_date=T(2022, 2, 1)),
    ],
    "transportation_benefit": [dict(nr=1, orig_id="P1", date=D(2023, 1, 7), mode="van", cost_of_the_ride=12.5)],
    "sdoh_meal_plan": [dict(nr=1, origid="P1", order_status="ordered", created_date=D(2023, 1, 1))],
    "chronic_disease_reward_program": [
        dict(nr=1, origid="P1", program="walk", date=D(2023, 1, 1), gift_card_received="yes",
             address_verified="no"),
    ],
    "care_plan_patient": [
        dict(origid="P1", plan_status=1, reassessment="90 days", updated_date=D(2022, 10, 1)),
        dict(origid="P2", plan_status=1, reassessment="abc", updated_date=D(2023, 2, 27),
             plan_inactive_datetime=T(2023, 1, 1)),
    ],
    "allergies_medications": [
        dict(appointmentid="A1", origid="P1", encounterdate="2023-02-01",
             appointmentstartdate="2023-02-01T09:30:00+05:00", closeddate="", patientstatus="Completed",
             type="appointment"),
        dict(appointmentid="A2", origid="P1", encounterdate="2023-02-02", type="allergy"),
    ],
}


def domain_tables(spark):
    return from_frames({n: _rows(spark, n, rows) for n, rows in ROWS.items()})
