"""Claim visits by care setting.

The reference runs one parameterised statement per setting, each projecting
the same 54 renamed columns, and each with the discharge-date window.  Here it
is one scan: ``setting IN (...)``, the window, and the rename from a single
mapping list.  Writing the result partitioned by setting gives
each setting its own folder in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions.columns import as_date

# Source column → output name of the visit listing, in the
# order of the reference statements.
VISIT_COLUMNS = [
    ("encounter_nr", "EncounterNr"), ("enc_admit_date", "admitDate"),
    ("enc_admit_time", "admitTime"), ("enc_disch_date", "dischargeDate"),
    ("enc_disch_time", "dischargeTime"), ("dce_group_type", "groupType"),
    ("dce_sub_group_type", "subGroupType"), ("market_nr", "marketId"),
    ("market_name", "marketName"), ("pt_facility_nr", "facilityId"),
    ("pt_facility_sub_nr", "facilitySubId"), ("pt_provider_num", "providerId"),
    ("pt_facility_name", "facilityName"), ("pt_facility_sub_name", "facilitySubName"),
    ("pt_sp_dr_1", "primaryPhysician"), ("m_provider_npi", "providerNpi"),
    ("pt_aligned_status", "alignedStatus"), ("pt_aligned2status", "secondaryAlignedStatus"),
    ("mh1_cal_amount", "mh1CalculatedAmount"), ("mc1_cal_amount", "mc1CalculatedAmount"),
    ("is_enc_ref_admitdate", "isReferenceAdmitDate"), ("is_readmit", "isReadmission"),
    ("is_c2_readmit", "isC2Readmission"), ("is_enc_transfer", "isTransferredEncounter"),
    ("is_snf_rec", "isSnfRecord"), ("is_snf_admitdate_ref", "isSnfAdmitDateReference"),
    ("is_er_visit", "isEmergencyRoomVisit"), ("is_visit_pcp", "isPrimaryCareVisit"),
    ("is_offvisit_rec", "isOfficeVisitRecord"), ("is_offvisit2rec", "isOfficeVisitSecondaryRecord"),
    ("m_flwup_flag", "followUpFlag"), ("is_72_hr_flwup", "is72HourFollowUp"),
    ("is_flwup_7_days", "is7DayFollowUp"), ("is_flwup_14_days", "is14DayFollowUp"),
    ("is_gflwup_14_days", "isGlobal14DayFollowUp"), ("m72hr_flwup_date", "followUp72HourDate"),
    ("tfu_pb_er", "emergencyRoomFollowUp"), ("tfu_pb_obs", "observationFollowUp"),
    ("hospital_nr", "hospitalId"), ("hospital_name", "hospitalName"),
    ("hos_taxonomy01", "hospitalTaxonomy"), ("is_bcda_match", "isBcdaMatch"),
    ("m_cal_bed_days", "calculatedBedDays"), ("e_discharge_type", "dischargeType"),
    ("e_discharge_text", "dischargeText"), ("m_provider_name", "providerName"),
    ("m_pos_txt", "placeOfService"), ("m_prov_spclty_txt", "providerSpecialty"),
    ("tfu_followup_date", "followUpDate"), ("tfu_denom", "tfuDenominator"),
    ("tfu_numer", "tfuNumerator"), ("acr_numer", "acrNumerator"),
    ("acr_denom", "acrDenominator"), ("uamcc_numerator", "uamccNumerator"),
]

# The 13 care settings.
ALL_SETTINGS = ["Acute Hospital", "Long Term Care Hospital", "Observation",
                "Psychiatric", "Rehabilitation", "SNF",
                "Emergency", "HHA", "Hospice", "Part B", "Part C", "Part D", "Part DME"]


def visits(enc: DataFrame, settings: Sequence[str] | None = None, start=None, end=None,
           patient_id=None, facility=None, *,
           columns: Sequence[tuple[str, str]] = VISIT_COLUMNS,
           setting_col: str = "enc_proc_type", date_col: str = "enc_disch_date",
           patient_col: str = "patient_id", facility_col: str = "pt_facility_nr",
           keep_setting_as: str = "setting") -> DataFrame:
    """Visits of the given settings (all 13 by default) in one pass.

    ``start``/``end`` bound ``date_col`` inclusively, each by itself if only
    one is given; ``patient_id`` and ``facility`` are optional equality filters
    (NULL = no filter).  All filters are plain column predicates, so they
    reach the Parquet scan as pushed filters."""
    settings = list(settings or ALL_SETTINGS)
    cond: Column = F.col(setting_col).isin(settings)
    if start is not None:
        cond = cond & (F.col(date_col) >= as_date(start))
    if end is not None:
        cond = cond & (F.col(date_col) <= as_date(end))
    if patient_id is not None:
        cond = cond & (F.col(patient_col) == F.lit(patient_id))
    if facility is not None:
        cond = cond & (F.col(facility_col) == F.lit(facility))
    proj = [F.col(s).alias(a) for s, a in columns]
    if keep_setting_as:
        proj.append(F.col(setting_col).alias(keep_setting_as))
    return enc.filter(cond).select(*proj)


def write_by_setting(df: DataFrame, path: str, setting: str = "setting") -> None:
    """Sink: one folder per setting, written by one job."""
    df.write.mode("overwrite").partitionBy(setting).parquet(path)


def visits_sql(spark, view: str, setting: str, start, end, facility=None,
               columns: Sequence[tuple[str, str]] = VISIT_COLUMNS) -> DataFrame:
    """The per-setting statement as parameterised Spark SQL (S3, S4):
    ``spark.sql(text, args=…)`` binds values as literals, never by string
    formatting.  ``view`` names a registered table / view."""
    proj = ",\n  ".join(f"`{s}` AS `{a}`" for s, a in columns)
    text = (f"SELECT {proj} FROM {view} WHERE enc_proc_type = :setting"
            + (" AND pt_facility_nr = :facility" if facility is not None else "")
            + (" AND enc_disch_date >= CAST(:start AS DATE)" if start is not None else "")
            + (" AND enc_disch_date <= CAST(:end AS DATE)" if end is not None else ""))
    args = {"setting": setting}
    if facility is not None:
        args["facility"] = facility
    if start is not None:
        args["start"] = str(start)
    if end is not None:
        args["end"] = str(end)
    return spark.sql(text, args=args)
