"""Sections of the person record, all persons at once.

Three kinds of functions, all over the normalised source tables (``dict``
name → DataFrame, see :mod:`carelake.sources.tables`):

*   ``*_rows`` and ``*_counts``: one row per person with what a section needs
    from a table;
*   array sections (``labs(t, …)``): their items, as one array per person, as
    parts of a hot person, or as plain item rows (``ITEMS``);
*   ``*_section(…)``: the section as an expression over the gathered parts.

:mod:`carelake.plans.document` gathers rows and items of all sections by one
aggregate on the person and evaluates the expressions over it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelake.functions import columns as C
from carelake.operators.aggregates import pivot_latest
from carelake.operators.arrays import ordered_array, ordered_array_parts, ordered_distinct_concat
from carelake.operators.gather import gather, item_rows
from carelake.operators.latest import latest_row

Tables = Mapping[str, DataFrame]

# Fixed values of the source logic.
SEX_LABELS = {"M": "Male", "F": "Female"}
CARE_ROLES = {"CCM_MNGT": "care_manager", "Outreach": "outreach_worker",
              "census_notes": "census_manager", "census_mos": "mos"}
ALIGNED_STATUSES = ["AL", "D1Y"]
INPATIENT_CLASSES = [1, 2, 3, 4]
AWV_CODES = ["G0438", "G0439"]
RAF_TYPES = ["pmra", "prmra", "rmra"]
RAF_VERSION = 28
HCC_VERSION = 28
QUALITY_ALERT_TYPE = "Hedis/Quality"
RESOLVED_STATUSES = [4, 5]
ABNORMAL_FLAGS = ["H", "L", "HH", "LL", "A", "AA"]
ALERT_STATUS = {0: "New", 1: "Red", 2: "Yellow", 3: "Acknowledged", 4: "Resolved"}
FOOD_HISTORY_NRS = [15074, 15078]
FOOD_POSITIVE = ["Sometimes true", "Often true"]
APPOINTMENT_TYPES = ["encounter", "appointment"]
COMPLETED_STATUSES = ["Checked Out", "Completed", "checked_out"]
ADHERENCE_THRESHOLD = 80
LIVE_DELETE_STATUS = "n"


#: asks an array section for its item rows
ITEMS = "items"


def person_array(df: DataFrame, order, fields, alias: str, part_size: int | str | None = None,
                 item_id=None) -> DataFrame:
    """Person-level ordered array: one row per person, with a number as
    ``part_size`` hot-person-safe parts ``(origid, part_no, n_parts, alias)``,
    with ``ITEMS`` one row per item."""
    if part_size == ITEMS:
        return item_rows(df, "origid", order, fields, alias, item_id)
    if part_size:
        return ordered_array_parts(df, ["origid"], order, fields, alias, part_size, item_id)
    return ordered_array(df, ["origid"], order, fields, alias)


def obj(*pairs) -> Column:
    """``JSON_OBJECT('k', expr, …)`` → ``struct(expr AS k, …)``."""
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in pairs])


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


def _ts(as_of) -> Column:
    """``NOW()`` pinned to midnight of ``as_of``."""
    return C.as_date(as_of).cast("timestamp")


def _year(as_of) -> Column:
    return F.year(C.as_date(as_of))


def part(name: str):
    """Column accessor of a gathered part: ``part("patient")("birthdate")``."""
    return lambda field: F.col(f"{name}.{field}")


# ── person-row sections ──────────────────────────────────────────────────

def demographics_section(as_of) -> Column:
    p = part("patient")
    return obj(
        ("last_name", p("lastname")), ("first_name", p("firstname")),
        ("middle_name", p("middlename")), ("dob", C.iso_date(p("birthdate"))),
        ("age", C.full_years(p("birthdate"), as_of)),
        ("sex", C.map_label(p("sex"), SEX_LABELS, p("sex"))),
        ("sex_at_birth", p("sex_at_birth")), ("race", p("race")),
        ("ethnicity", p("ethnicgroup")), ("language", p("language")),
        ("civil_status", p("civil_status")), ("blood_group", p("blood_group")),
        ("dnr_status", p("dnr_status")), ("nursing_home_alert", C.flag(p("nursing_home_alert"))))


def contact_section() -> Column:
    p = part("patient")
    return obj(
        ("phone_primary", C.concat_nonnull(p("phone_1_code"), p("phone_1_nr"))),
        ("phone_secondary", p("phone_2_nr")), ("cellphone", p("cellphone_2_nr")),
        ("email", p("email")), ("no_email", C.flag(p("no_email"))),
        ("address", obj(("street", p("addr_str")), ("city", p("addr_citytown_name")),
                        ("state", p("addr_state")), ("zip", p("addr_zip")),
                        ("country", F.coalesce(p("addr_country"), F.lit("US"))),
                        ("verified", C.flag(p("addr_is_valid"))))),
        ("emergency_contact", obj(("name", p("contact_person")),
                                  ("relation", p("contact_relation")),
                                  ("phone", p("contact_person_phone")))))


def roster_latest(t: Tables, cc_version: str | None = None, statuses=ALIGNED_STATUSES,
                  xref: DataFrame | None = None) -> DataFrame:
    """Latest aligned roster row per person (J1 T3 T6, decision D1: per
    person, not globally), keyed ``origid``.  The roster key is the person
    key by default; with ``xref`` ``(ref, origid)`` it is resolved through the
    person cross-reference instead (J15, decision D2)."""
    r = t["dc_bene_alignment_rostr_m01"].filter(F.col("ALIGN_STATUS_CODE").isin(list(statuses)))
    if cc_version is not None:
        r = r.filter(C.ci_equals("cc_version", F.lit(cc_version)))
    if xref is not None:
        r = r.join(xref, r.mm_curr_mbi_id == xref.ref).drop("ref", "mm_curr_mbi_id") \
            .withColumnRenamed("origid", "mm_curr_mbi_id")
    r = r.withColumnRenamed("mm_curr_mbi_id", "origid")
    cols = [c for c in r.columns if c != "origid"]
    first = ["mm_date", "prov_npi_nr", "market_id"]
    # all other columns settle ties, so equal rows alone are interchangeable
    return latest_row(r, ["origid"], first + [c for c in cols if c not in first], cols)


def care_roles(t: Tables) -> DataFrame:
    """Names of the four care roles per provider (J2 J13 T4): one join of the
    role mapping with personnel and one pivot; ``min`` makes "any row"
    deterministic.  Both inputs are small dimension tables."""
    m = t["mra_dce_cm_mapping"]
    per = t["personell"]
    named = m.join(per, m.cm_nr == per.nr).select("provider_npi", "type", "name", "nr")
    pick = lambda role: F.min(F.when(F.col("type") == role, F.col("name")))
    members = F.array_sort(F.collect_set(F.when(F.col("type").isin(list(CARE_ROLES)), F.col("nr"))))
    return named.groupBy("provider_npi").agg(*[pick(k).alias(v) for k, v in CARE_ROLES.items()], members.alias("member_nrs"))


def with_care_roles(t: Tables, gathered: DataFrame) -> DataFrame:
    """Gathered rows with ``care_roles``, the roles of their roster's provider.

    A provider's members grow with the personnel, so they join the persons
    after the last exchange: persons × members would grow with the square of
    the data.  The broadcast side holds each member of a provider once."""
    roles = care_roles(t).select("provider_npi", F.struct(*CARE_ROLES.values(), "member_nrs").alias("care_roles"))
    return gathered.join(F.broadcast(roles), F.col("roster.prov_npi_nr") == F.col("provider_npi"), "left").drop("provider_npi")


def care_team_section(as_of) -> Column:
    r, p, roles = part("roster"), part("patient"), part("care_roles")
    return F.when(F.col("roster").isNotNull(), obj(
        ("id", F.concat(F.col("origid"), F.lit("_care_team"))), ("market_id", r("market_id")),
        ("market_name", r("market_names")), ("group_name", r("dce_group_name")),
        ("sub_group_name", r("dce_sub_group_name")), ("subgroup_id", r("dce_sub_group_nr")),
        ("facility_nr", r("dce_group_nr")), ("facility_name", r("dce_group_name")),
        ("dce_provider", r("dce_provider_name")), ("dce_provider_npi", r("prov_npi_nr")),
        *[(v, roles(v)) for v in CARE_ROLES.values()], ("member_nrs", roles("member_nrs")),
        ("last_pcp_visit", C.iso_date(r("Last_PCP_Visit_Date"))),
        ("next_pcp_visit", C.iso_date(p("Next_Office_Visit"))),
        ("days_since_pcp_visit", C.days_between(as_of, r("Last_PCP_Visit_Date")))))


def enrollment_section() -> Column:
    p = part("patient")
    return obj(
        ("status", p("status")), ("align_status_code", F.col("roster.ALIGN_STATUS_CODE")),
        ("ccm_enabled", C.flag(p("is_ccm_enabled"))), ("ccm_level", p("ccm_level")),
        ("ccm_active_date", C.iso_date(p("ccm_activedate"))),
        ("ccm_inactive_date", C.iso_date(p("ccm_inactivedate"))),
        ("consent_on_file", C.flag(p("consent_onfile"))), ("dr_first_status", p("dr_first_status")),
        ("high_utilizer", C.flag(p("is_alert_inc_alerts"))), ("long_term_care", C.flag(p("long_term_care"))),
        ("inactive_date", C.iso_date(p("inactive_date"))), ("inactive_reason", p("inactive_reason")))


def adt_keys(t: Tables) -> DataFrame:
    """(encounter_nr, origid, encounter_date) of clinical encounters — one
    projection shared by every join on the encounter key (conditions,
    wellness visits, labs), so Spark shuffles it once and reuses the
    exchange."""
    return t["adt_encounter"].select("encounter_nr", "origid", "encounter_date")


# ── code lookups ─────────────────────────────────────────────────────────

def active_coefficients(t: Tables, as_of) -> DataFrame:
    """Coefficient rows valid on ``as_of`` (P8), one per code (decision D6:
    the latest active row wins, so a duplicate row cannot fan out)."""
    hc = t["mra_hcc_coefficients"].filter(C.in_window("active_date", "inactive_date", as_of))
    return latest_row(hc, ["diagnosis_code"], ["active_date", "hcc", "hcc_nr"],
                      ["description", "hcc", "hcc_nr", "community_nondual_aged"])


# ── chronic conditions, scores, capture ──────────────────────────────────

def chronic_conditions(t: Tables, as_of, part_size: int | str | None = None) -> DataFrame:
    """Per (person, code) over clinical diagnoses (A4; J5 folded into one
    aggregate), coefficient lookup (J6), category of the latest detail (J7,
    D6), newest last-seen first."""
    ai = t["adt_encounter_icd_codes"]
    cc = ai.join(adt_keys(t), "encounter_nr").groupBy("origid", "diagnosis_code").agg(
        F.max("is_comorbid").alias("is_comorbid"), F.max("problem_type").alias("problem_type"),
        F.max("status").alias("status"), F.min("encounter_date").alias("first_date"),
        F.max("encounter_date").alias("last_date"),
        F.count_distinct("encounter_nr").alias("enc_count"),
        F.max("SNOMED_CID").alias("SNOMED_CID"), F.max("SNOMED_FSN").alias("SNOMED_FSN"),
        F.max("ccm_track").alias("ccm_track"), F.max("source").alias("source"))
    hc = active_coefficients(t, as_of)
    ud = t["mra_uamcc_details"]
    cat = latest_row(ud, ["origid", "diagnosis_code"], ["service_date", "nr"], ["condition_category"])
    j = cc.join(hc, "diagnosis_code", "left").join(cat, ["origid", "diagnosis_code"], "left")
    item = [
        F.col("diagnosis_code").alias("id"), F.col("diagnosis_code").alias("icd_code"),
        F.col("description").alias("icd_desc"), F.col("hcc").alias("hcc_number"),
        F.col("community_nondual_aged").alias("hcc_score"), "condition_category",
        C.flag("is_comorbid").alias("is_comorbid"), "problem_type",
        F.coalesce("status", F.lit("Active")).alias("status"),
        C.iso_date("first_date").alias("first_onset_date"),
        C.iso_date("last_date").alias("last_seen_date"),
        C.days_between(as_of, "last_date").alias("days_since_last_seen"),
        F.col("enc_count").alias("encounter_count"), F.col("SNOMED_CID").alias("snomed_cid"),
        F.col("SNOMED_FSN").alias("snomed_fsn"), F.lit("Agree").alias("agreement_status"),
        C.flag("ccm_track").alias("ccm_tracked"),
        C.null_false(F.col("hcc").isNotNull()
                     & (F.year("last_date") < _year(as_of))).alias("recapture_needed"),
        "source"]
    return person_array(j, ["last_date", "diagnosis_code"], item, "chronic_conditions", part_size)


def raf_scores(t: Tables, as_of) -> DataFrame:
    """Latest month per (person, type) in the current year."""
    r = t["mra_raf_patient"].filter((F.col("year") == _year(as_of))
                                    & F.col("type").isin(RAF_TYPES))
    return latest_row(r, ["origid", "type"], ["month", "total_score", "initial_score"],
                      ["total_score", "initial_score", "month"])


def raf_rows(t: Tables, as_of) -> DataFrame:
    """Pivot of the three types (A8), one struct per type."""
    return pivot_latest(raf_scores(t, as_of), ["origid"], "type", RAF_TYPES,
                        ["total_score", "initial_score", "month"])


def raf_section(as_of) -> Column:
    """A person without rows still gets the object with NULL scores."""
    y = _year(as_of)
    parts = [("id", F.concat(F.col("origid"), F.lit("_"), y.cast("string"))), ("year", y)]
    for ty in RAF_TYPES:
        r = part(f"raf.{ty}")
        parts.append((ty, obj(("detail_score", r("total_score")), ("initial_score", r("initial_score")),
                              ("month", r("month")))))
    parts += [("raf_version", F.lit(RAF_VERSION)), ("score_trend", F.lit("Stable"))]
    return obj(*parts)


def claim_codes(t: Tables) -> DataFrame:
    """(origid, diagnosis_code, enc_date) of claim diagnoses."""
    ai = t["mra1_encounter_icd_codes"]
    me = t["mra1_encounter"].select("encounter_nr", "origid", "enc_date")
    return ai.join(me, "encounter_nr").select("origid", "diagnosis_code", "enc_date")


def hcc_capture_counts(t: Tables, as_of, level: str = "hcc") -> DataFrame:
    """Per person: eligible HCCs, captured HCCs, pct and open gaps (decision
    D4: distinct HCCs on both sides; a gap is an eligible HCC with no code
    seen this year).  Aggregated first per (person, hcc), so a heavy person
    is spread over its groups.

    ``level="code"`` counts as the source text does: captured is the number of
    the person's (code, active category row) pairs with a code seen this year,
    so two codes of one category count twice."""
    if level not in ("hcc", "code"):
        raise ValueError(f"level {level}: hcc or code")
    codes = claim_codes(t)
    seen = codes.groupBy("origid", "diagnosis_code").agg(
        F.count_if(F.year("enc_date") == _year(as_of)).alias("cnt"))
    # a code with several active categories counts for each of them
    hc = t["mra_hcc_coefficients"].filter(C.in_window("active_date", "inactive_date", as_of)).select(
        "diagnosis_code", "hcc", "hcc_nr")
    hc = hc.distinct() if level == "hcc" else hc
    g = seen.join(hc, "diagnosis_code").groupBy("origid", "hcc").agg(
        F.bool_or(F.col("cnt") > 0).alias("seen"), F.min("hcc_nr").alias("hcc_nr"),
        F.count_if(F.col("cnt") > 0).alias("seen_codes"))
    captured = F.count_if("seen") if level == "hcc" else F.sum("seen_codes")
    gaps = F.array_sort(F.collect_list(F.when(~F.col("seen"), F.concat(F.lit("HCC-"), "hcc_nr"))))
    return g.groupBy("origid").agg(
        F.count("*").alias("eligible_hccs"), captured.alias("captured_hccs"),
        F.when(F.size(gaps) > 0, gaps).alias("gap_hccs"))


def hcc_capture_section(as_of) -> Column:
    c, y = part("capture"), _year(as_of)
    eligible = F.coalesce(c("eligible_hccs"), F.lit(0))
    return obj(
        ("id", F.concat(F.col("origid"), F.lit("_"), y.cast("string"), F.lit(f"_v{HCC_VERSION}"))),
        ("year", y), ("hcc_version", F.lit(HCC_VERSION)),
        ("eligible_hccs", eligible), ("captured_hccs", c("captured_hccs")),
        ("capture_pct", C.pct(c("captured_hccs"), eligible, 1)),
        ("gap_hccs", c("gap_hccs")), ("gap_revenue_at_risk", F.lit(0.0)))


def risk_scores_section(as_of) -> Column:
    """Placeholders only (P3): empty score arrays, NULL roster scores."""
    y = _year(as_of)
    empty = F.array().cast("array<struct<score:double,date:string>>")
    return obj(
        ("id", F.concat(F.col("origid"), F.lit("_"), y.cast("string"))), ("year", y),
        ("uha", empty), ("chf", empty),
        ("roster_scores", obj(("avg_adi_score", _null("double")), ("cdi_score", _null("double")),
                              ("equity_score", _null("double")))))


def _uamcc_current(t: Tables) -> DataFrame:
    return t["mra_uamcc_details"].filter(F.col("is_most_recent_per_category") == 1)


def uamcc_details(t: Tables, part_size: int | str | None = None) -> DataFrame:
    ud = _uamcc_current(t)
    return person_array(ud, ["service_date", "nr"], [
        F.col("nr").alias("id"), C.iso_date("service_date").alias("service_date"),
        "condition_category", F.col("diagnosis_code").alias("icd_code"),
        F.col("diagnosis_desc").alias("icd_desc"), F.col("prov_npi_nr").alias("provider_npi"),
        F.col("prov_name").alias("provider_name"), F.col("prov_taxonomy").alias("provider_taxonomy"),
        "facility_name", "claim_source", "claim_type", "version"], "details", part_size, ["nr"])


def uamcc_rows(t: Tables) -> DataFrame:
    """Distinct conditions and code prefixes per person (A14 A18 F9); a NULL
    value is kept as an element."""
    distinct = lambda v: F.transform(F.array_sort(F.collect_set(F.struct(v.alias("v")))), lambda x: x["v"])
    return _uamcc_current(t).groupBy("origid").agg(
        F.count_distinct("condition_category").alias("condition_count"),
        distinct(F.col("condition_category")).alias("conditions"),
        distinct(F.left("diagnosis_code", F.lit(3))).alias("prefixes"))


def uamcc_section(as_of) -> Column:
    """Multiple-chronic-condition summary and details (T5)."""
    u, y = part("uamcc_summary"), _year(as_of)
    count = F.coalesce(u("condition_count"), F.lit(0))
    return obj(
        ("id", F.concat(F.col("origid"), F.lit("_uamcc_"), y.cast("string"))),
        ("summary", obj(
            ("id", F.concat(F.col("origid"), F.lit("_"), y.cast("string"))), ("year", y),
            ("conditions", u("conditions")), ("icd_prefixes", u("prefixes")),
            ("condition_count", count), ("program_eligible", count >= 2))),
        ("details", F.col("details")))


def adherence_counts(t: Tables, as_of, merge_overlaps: bool = False) -> DataFrame:
    """Covered days (A9 F12): spans clipped at ``as_of``, overlaps summed as
    the source does (D18); pct over days since the first start (A7).

    ``merge_overlaps`` counts a day under several prescriptions once: spans
    are cut at year ends, which makes the years independent, and per (person,
    year, first day) only the longest counts, so a window holds at most 366
    rows whoever the person is."""
    now = _ts(as_of)
    m = t["drfirst_patient_medications"].filter(
        (F.col("delete_status") == LIVE_DELETE_STATUS) & F.col("start_date").isNotNull())
    end = F.least(F.coalesce("stop_date", now), now)
    summed = m.groupBy("origid").agg(F.sum(F.datediff(end, F.col("start_date"))).alias("covered"),
                                     F.min("start_date").alias("first_start"))
    if not merge_overlaps:
        return summed
    spans = m.select("origid", F.to_date("start_date").alias("a"), F.to_date(end).alias("b")).where("b > a")
    years = spans.select("origid", "a", "b", F.explode(F.sequence(F.year("a"), F.year(F.date_sub("b", 1)))).alias("y"))
    first, last = F.make_date("y", F.lit(1), F.lit(1)), F.make_date(F.col("y") + 1, F.lit(1), F.lit(1))
    cut = years.groupBy("origid", "y", F.greatest("a", first).alias("a")).agg(F.max(F.least("b", last)).alias("b"))
    before = Window.partitionBy("origid", "y").orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("b").over(before), F.col("a"))
    days = cut.select("origid", F.greatest(F.datediff("b", F.greatest("a", reached)), F.lit(0)).alias("n"))
    merged = days.groupBy("origid").agg(F.sum("n").alias("covered"))
    firsts = summed.select("origid", F.lit(0).cast("bigint").alias("covered"), "first_start")
    return merged.select("origid", "covered", _null("timestamp").alias("first_start")).unionByName(firsts).groupBy("origid").agg(
        F.sum("covered").alias("covered"), F.min("first_start").alias("first_start"))


def adherence_section(as_of) -> Column:
    a, y = part("adherence"), _year(as_of)
    covered = F.coalesce(a("covered"), F.lit(0))
    pct = C.pct(covered, F.datediff(_ts(as_of), a("first_start")), 2)
    return obj(
        ("id", F.concat(F.col("origid"), F.lit("_"), y.cast("string"))), ("year", y),
        ("covered_days", covered), ("rx_adherence_pct", pct),
        ("adherence_flag", F.when(pct >= ADHERENCE_THRESHOLD, "Adequate").otherwise("Inadequate")),
        ("star_rating_impact", F.lit("On Track")))


def hedis_measures(t: Tables, as_of, dedupe_keys=None, part_size: int | str | None = None) -> DataFrame:
    """Quality measures newest first.  ``dedupe_keys`` (U3), e.g.
    ``("ref_description", "ref_id")`` or ``("ref_description",)``: keep only
    the latest entry per key within the person (the year is constant)."""
    a = t["mra_scorecard_alerts"].filter((F.col("type") == QUALITY_ALERT_TYPE)
                                         & ~F.col("original_status").isin(RESOLVED_STATUSES))
    if dedupe_keys:
        cols = [c for c in a.columns if c not in ("origid", *dedupe_keys)]
        a = latest_row(a, ["origid", *dedupe_keys], ["added_date", "nr"], cols)
    y = _year(as_of)
    return person_array(a, ["added_date", "nr"], [
        F.concat(F.coalesce("ref_detail", F.lit("")), F.lit("_"), y.cast("string")).alias("id"),
        F.col("ref_id").alias("frows_nr"), y.alias("measure_year"),
        F.col("ref_description").alias("measure_name"),
        C.iso_date("ref_date").alias("last_screening_date"),
        F.when(F.col("resolved_date").isNotNull(), "Compliant").otherwise("Gap").alias("status"),
        F.col("resolved_date").isNull().alias("gap_open")], "hedis_measures", part_size)


# ── encounter spine with children ────────────────────────────────────────

_DIAG_T = ("array<struct<id:bigint,icd_code:string,icd_desc:string,onset_date:string,"
           "problem_type:string,icd_order:int,status:string,hcc_number:string,"
           "hcc_score:decimal(6,3),hcc_included:boolean,is_comorbid:boolean,"
           "agreement_status:string,source:string>>")
_PROC_T = ("array<struct<id:string,billing_code:string,cpt_modifier:string,"
           "procedure_date:string,revenue_code:string>>")
_MED_T = ("array<struct<id:bigint,ndc_id:string,rxnorm_id:string,medication_name:string,dose:string,"
          "dose_unit:string,start_date:string,stop_date:string,delete_status:string>>")


def encounter_children(t: Tables, as_of) -> dict[str, DataFrame]:
    """Child items per encounter key (J14): diagnoses with their coefficient
    lookup, billing codes, encounter medications, with what they read alone and
    without what they are sorted by (:data:`CHILDREN` has it back in place);
    :func:`finished_encounter` makes fields of it once they are with the person."""
    hc = active_coefficients(t, as_of)
    ai = t["adt_encounter_icd_codes"].join(hc.select("diagnosis_code", "hcc", "community_nondual_aged"),
                                           "diagnosis_code", "left")
    diag = item_rows(ai, "encounter_nr", ["icd_order", "id"], [
        F.col("diagnosis_code").alias("icd_code"), F.col("diagnosis_desc").alias("icd_desc"),
        "onset_date", "problem_type", "status", F.col("hcc").alias("hcc_number"),
        F.col("community_nondual_aged").alias("hcc_score"), "is_comorbid", "source"], "diagnoses")
    cpt = t["mra1_encounter_bill_cpts"]
    proc = item_rows(cpt, "encounter_nr", ["bb_Code", "bb_modifier", "CLM_LINE_PROD_REV_CTR_CD"], [], "procedures")
    em = t["cclf_encounter_patient_medication"]
    meds = item_rows(em, "encounter_nr", ["start_date", "id"], [
        F.col("NDCID").alias("ndc_id"), F.col("RxnormID").alias("rxnorm_id"),
        F.col("medications").alias("medication_name"), "dose", "dose_unit", "stop_date", "delete_status"], "enc_medications")
    return {"diagnoses": diag, "procedures": proc, "enc_medications": meds}


def _fields(x: Column, *names: str) -> list:
    return [(c, x["_v"][c]) for c in names]


#: elements of the children's arrays, made from items and what these are sorted by
CHILDREN = {
    "diagnoses": lambda x: obj(("id", x["_o1"]), *_fields(x, "icd_code", "icd_desc", "onset_date", "problem_type"), ("icd_order", x["_o0"]),
                               *_fields(x, "status", "hcc_number", "hcc_score", "is_comorbid", "source")),
    "procedures": lambda x: obj(("billing_code", x["_o0"]), ("cpt_modifier", x["_o1"]), ("revenue_code", x["_o2"])),
    "enc_medications": lambda x: obj(("id", x["_o1"]), *_fields(x, "ndc_id", "rxnorm_id", "medication_name", "dose", "dose_unit"),
                                     ("start_date", x["_o0"]), *_fields(x, "stop_date", "delete_status")),
}


def finished_encounter(e: Column, kids: Column | None = None) -> Column:
    """An encounter as the record shows it, from one with its children or from
    the two apart.  Texts and repeated values are made here, after the last
    exchange, so none of them is shuffled."""
    head, k = e, e if kids is None else kids
    claim, dates = e["source_system"] == "mra1", e["dates"]
    day = C.iso_date(dates["admission_date"])
    default = F.when(claim, "mra1").otherwise(e["setting"])
    d = F.coalesce(F.transform(k["diagnoses"], lambda x: obj(
        *[(c, x[c]) for c in ("id", "icd_code", "icd_desc")], ("onset_date", C.iso_date(x["onset_date"])),
        *[(c, x[c]) for c in ("problem_type", "icd_order")], ("status", F.coalesce(x["status"], F.lit("Active"))),
        *[(c, x[c]) for c in ("hcc_number", "hcc_score")], ("hcc_included", F.when(claim, x["hcc_number"].isNotNull())),
        ("is_comorbid", C.flag(x["is_comorbid"])), ("agreement_status", F.lit("Agree")),
        ("source", F.coalesce(x["source"], default)))), F.array().cast(_DIAG_T))
    p = F.coalesce(F.transform(k["procedures"], lambda x: obj(
        ("id", F.concat(x["billing_code"], F.lit("_"), day)), ("billing_code", x["billing_code"]), ("cpt_modifier", x["cpt_modifier"]),
        ("procedure_date", day), ("revenue_code", x["revenue_code"]))), F.array().cast(_PROC_T))
    m = F.coalesce(F.transform(k["enc_medications"], lambda x: x.withField("start_date", C.iso_ts_local(x["start_date"]))
                               .withField("stop_date", C.iso_ts_local(x["stop_date"]))), F.array().cast(_MED_T))
    shown = obj(("admission_date", day), ("discharge_date", C.iso_date(dates["discharge_date"])),
                ("length_of_stay_days", dates["length_of_stay_days"]),
                *[(c, C.iso_date(dates[c])) for c in ("next_pcp_visit", "hcc_followup_date", "cm_followup_date")],
                *[(f"tcm_{n}day_deadline", C.iso_date(F.date_add(dates["discharge_date"], n))) for n in (7, 14)])
    e = e.withField("dates", shown).withField("diagnoses", d).withField("procedures", p).withField("enc_medications", m)
    return e if kids is None else e.dropFields("audit").withField("audit", head["audit"])


def encounters_section() -> Column:
    """The gathered items of :func:`encounter_heads` and :func:`encounter_kids`,
    one for one, as both are sorted by the same keys."""
    return F.zip_with("encounters", "encounter_children", finished_encounter)


def adt_branch(t: Tables, as_of) -> DataFrame:
    """Clinical encounters, without their children."""
    ae = t["adt_encounter"]
    enc = obj(
        ("id", F.col("encounter_nr")), ("encounter_nr", F.col("encounter_nr")),
        ("source_system", F.lit("adt")), ("encounter_type", F.col("mos_type")),
        ("enc_class_nr", F.col("encounter_class_nr")), ("encounter_status", F.col("encounter_status")),
        ("setting", F.col("mos_type")),
        ("dates", obj(
            ("admission_date", F.col("encounter_date")), ("discharge_date", F.col("discharge_date")),
            ("length_of_stay_days", F.datediff(F.coalesce("discharge_date", C.as_date(as_of)),
                                               F.col("encounter_date"))),
            ("next_pcp_visit", F.col("next_pcp_visit_date")),
            ("hcc_followup_date", F.col("hcc_followup")), ("cm_followup_date", F.col("cm_followup")))),
        ("facility", obj(("name", F.col("hospital_name")), ("npi", F.col("hospital_npi")),
                         ("taxonomy", F.col("hos_taxonomy01")), ("hospital_nr", F.col("hospital_nr")),
                         ("oscar_num", F.col("PRVDR_OSCAR_NUM")))),
        ("provider", obj(("attending_name", F.col("dce_provider_name")),
                         ("attending_npi", F.col("ATNDG_PRVDR_NPI_NUM")),
                         ("attending_taxonomy", F.col("taxonomy")))),
        ("admission", obj(("point_of_origin", F.col("mh2patient_class_curr")),
                          ("org_admission_source", F.col("mh_admission_source")),
                          ("purpose", F.col("referrer_diagnosis")),
                          ("admit_type_cd", F.col("mh_patient_class")),
                          ("confirmed_mra", F.col("appt_confirmed_mra").isNotNull()),
                          ("high_utilizer", C.flag("high_utilizer")),
                          ("referrer_diagnosis", F.col("referrer_diagnosis")))),
        ("discharge", obj(("disposition", F.col("m_discharge_to")),
                          ("discharge_to_code", F.col("BENE_PTNT_STUS_CD")),
                          ("readmit_30d", C.flag("m_redmit_flag")),
                          ("readmit_er_30d", C.flag("readmit_er_status")),
                          ("readmit_rate_pct", F.col("readmit_rate_percentile")),
                          ("tfu_enabled", C.flag("tfu_enabled")),
                          ("followup_days", F.col("followup_days")),
                          ("acr_numerator", F.col("acr_numerator")),
                          ("tcm_numerator", F.col("tcm_num")), ("tcm_completed", C.flag("tcm_num")))),
        ("claim", obj(("clm_uniq_id", F.col("CUR_CLM_UNIQ_ID")),
                      ("clm_efctv_dt", C.iso_date("CLM_EFCTV_DT")),
                      ("rndrg_prvdr_npi", F.col("ATNDG_PRVDR_NPI_NUM")),
                      ("patient_status_cd", F.col("BENE_PTNT_STUS_CD")),
                      ("prvdr_spclty_cd", F.col("CLM_PRVDR_SPCLTY_CD")))),
        # Provider specialty as text (here the taxonomy) and as code
        ("specialty", F.col("taxonomy")), ("specialty_code", F.col("CLM_PRVDR_SPCLTY_CD")),
    )
    audit = obj(("care_status", F.col("care_status")), ("audit_status", F.col("audit_status")),
                ("mos", F.col("mos")), ("mos_type", F.col("mos_type")),
                ("tfu_numerator", F.col("tfu_numerator")), ("mif_exclusion", C.flag("mif_exclusion")),
                ("census_status", F.col("census_status")))
    return ae.select("origid", F.col("encounter_date").alias("enc_date"), "encounter_nr",
                     F.lit("adt").alias("source_system"), F.col("mos_type").alias("setting"),
                     F.struct(enc.alias("_b"), audit.alias("audit")).alias("_e"))


# Claim-only encounter fields — output name, source column, kind.
CLAIM_FIELDS = [
    ("admit_time", "enc_admit_time", "raw"), ("discharge_time", "enc_disch_time", "raw"),
    ("group_type", "dce_group_type", "raw"), ("sub_group_type", "dce_sub_group_type", "raw"),
    ("market_id", "market_nr", "raw"), ("market_name", "market_name", "raw"),
    ("facility_id", "pt_facility_nr", "raw"), ("facility_sub_id", "pt_facility_sub_nr", "raw"),
    ("provider_id", "pt_provider_num", "raw"), ("facility_name", "pt_facility_name", "raw"),
    ("facility_sub_name", "pt_facility_sub_name", "raw"), ("primary_physician", "pt_sp_dr_1", "raw"),
    ("aligned_status", "pt_aligned_status", "raw"),
    ("secondary_aligned_status", "pt_aligned2status", "raw"),
    ("mh1_calculated_amount", "mh1_cal_amount", "raw"), ("mc1_calculated_amount", "mc1_cal_amount", "raw"),
    ("is_reference_admit_date", "is_enc_ref_admitdate", "flag"), ("is_readmission", "is_readmit", "flag"),
    ("is_c2_readmission", "is_c2_readmit", "flag"), ("is_transferred_encounter", "is_enc_transfer", "flag"),
    ("is_snf_record", "is_snf_rec", "flag"), ("is_snf_admit_date_reference", "is_snf_admitdate_ref", "flag"),
    ("is_er_visit", "is_er_visit", "flag"), ("is_pcp_visit", "is_visit_pcp", "flag"),
    ("is_office_visit", "is_offvisit_rec", "flag"), ("is_office_visit_secondary", "is_offvisit2rec", "flag"),
    ("follow_up_flag", "m_flwup_flag", "flag"), ("is_72_hour_follow_up", "is_72_hr_flwup", "flag"),
    ("is_7_day_follow_up", "is_flwup_7_days", "flag"), ("is_14_day_follow_up", "is_flwup_14_days", "flag"),
    ("is_global_14_day_follow_up", "is_gflwup_14_days", "flag"),
    ("follow_up_72_hour_date", "m72hr_flwup_date", "date"), ("er_follow_up", "tfu_pb_er", "flag"),
    ("observation_follow_up", "tfu_pb_obs", "flag"), ("is_bcda_match", "is_bcda_match", "flag"),
    ("calculated_bed_days", "m_cal_bed_days", "raw"), ("place_of_service", "m_pos_txt", "raw"),
    ("provider_specialty", "m_prov_spclty_txt", "raw"), ("follow_up_date", "tfu_followup_date", "date"),
    ("tfu_denominator", "tfu_denom", "flag"), ("acr_numerator", "acr_numer", "flag"),
    ("acr_denominator", "acr_denom", "flag"), ("uamcc_numerator", "uamcc_numerator", "flag"),
]


def _claim_value(src: str, kind: str) -> Column:
    return {"raw": F.col(src), "flag": C.flag(src), "date": C.iso_date(src)}[kind]


def mra1_branch(t: Tables, as_of) -> DataFrame:
    """Claim encounters, without their children."""
    me = t["mra1_encounter"]
    enc = obj(
        ("id", F.col("encounter_nr")), ("encounter_nr", F.col("encounter_nr")),
        ("source_system", F.lit("mra1")), ("encounter_type", F.col("enc_proc_type")),
        ("enc_class_nr", _null("int")), ("encounter_status", _null("string")),
        ("setting", F.col("enc_proc_type")),
        ("dates", obj(
            ("admission_date", F.col("enc_admit_date")), ("discharge_date", F.col("enc_disch_date")),
            ("length_of_stay_days", F.datediff(F.coalesce("enc_disch_date", C.as_date(as_of)),
                                               F.col("enc_admit_date"))),
            ("next_pcp_visit", _null("date")), ("hcc_followup_date", _null("date")), ("cm_followup_date", _null("date")))),
        ("facility", obj(("name", F.col("hospital_name")), ("npi", _null("string")),
                         ("taxonomy", F.col("hos_taxonomy01")), ("hospital_nr", F.col("hospital_nr")),
                         ("oscar_num", _null("string")))),
        ("provider", obj(("attending_name", F.col("m_provider_name")),
                         ("attending_npi", F.col("m_provider_npi")),
                         ("attending_taxonomy", F.col("m_prov_spclty_txt")))),
        ("admission", obj(("point_of_origin", _null("string")), ("org_admission_source", _null("string")),
                          ("purpose", _null("string")), ("admit_type_cd", _null("string")),
                          ("confirmed_mra", F.lit(False)), ("high_utilizer", F.lit(False)),
                          ("referrer_diagnosis", _null("string")))),
        ("discharge", obj(("disposition", F.col("e_discharge_text")),
                          ("discharge_to_code", F.col("e_discharge_type")),
                          ("readmit_30d", C.flag("is_readmit")), ("readmit_er_30d", F.lit(False)),
                          ("readmit_rate_pct", _null("decimal(6,2)")),
                          ("tfu_enabled", C.flag("m_flwup_flag")), ("followup_days", _null("int")),
                          ("acr_numerator", F.col("acr_numer")), ("tcm_numerator", F.col("tfu_numer")),
                          ("tcm_completed", C.flag("tfu_numer")))),
        ("claim", obj(("clm_uniq_id", _null("string")), ("clm_efctv_dt", _null("string")),
                      ("rndrg_prvdr_npi", F.col("m_provider_npi")),
                      ("patient_status_cd", _null("string")),
                      ("prvdr_spclty_cd", F.col("m_prov_spclty_txt")))),
        ("specialty", F.col("m_prov_spclty_txt")), ("specialty_code", _null("string")),
    )
    claim = obj(*[(name, _claim_value(src, kind)) for name, src, kind in CLAIM_FIELDS])
    audit = obj(("care_status", _null("string")), ("audit_status", _null("string")),
                ("mos", F.col("enc_proc_type")), ("mos_type", F.col("enc_proc_type")),
                ("tfu_numerator", F.col("tfu_numer")), ("mif_exclusion", F.lit(False)),
                ("census_status", _null("string")))
    return me.select("origid", F.col("enc_admit_date").alias("enc_date"), "encounter_nr",
                     F.lit("mra1").alias("source_system"), F.col("enc_proc_type").alias("setting"),
                     F.struct(enc.alias("_b"), claim.alias("cclf"), audit.alias("audit")).alias("_e"))


#: what encounters are sorted by, and what deals those of a hot person to parts
ENCOUNTER_ORDER, ENCOUNTER_ID = ["enc_date", "source_system", "encounter_nr"], ["source_system", "encounter_nr"]


def _spine(t: Tables, as_of) -> DataFrame:
    """Both branches unioned by name (U1): the nested claim block is missing on
    clinical rows and filled with NULL."""
    return adt_branch(t, as_of).unionByName(mra1_branch(t, as_of), allowMissingColumns=True)


def _with_children(t: Tables, as_of, spine: DataFrame) -> DataFrame:
    """Rows of ``spine`` with the children of their encounter, by one aggregate on it."""
    fields, kids = [c for c in spine.columns if c != "encounter_nr"], encounter_children(t, as_of)
    rows = item_rows(spine, "encounter_nr", [], fields, "spine", fields)
    g = gather("spine", "encounter_nr", {}, {"spine": rows, **kids}, desc={"diagnoses": False, "procedures": False}, unpack=CHILDREN, apart=True)
    claim = F.col("source_system") == "mra1"      # a clinical encounter has no category on its diagnoses
    diag = F.transform("diagnoses", lambda x: x.withField("hcc_number", F.when(claim, x["hcc_number"]))
                       .withField("hcc_score", F.when(claim, x["hcc_score"])))
    return g.select("encounter_nr", F.inline("spine"), *kids).withColumn("diagnoses", diag)


def encounters(t: Tables, as_of, part_size: int | str | None = None) -> DataFrame:
    """The encounter spine with its children, the claim fields promoted to the
    encounter's top level, newest first (T5)."""
    u = _with_children(t, as_of, _spine(t, as_of))
    out = person_array(u, ENCOUNTER_ORDER, [F.col("_e._b.*"), F.col("_e.cclf.*"), "diagnoses", "procedures", "enc_medications",
                                            F.col("_e.audit").alias("audit")], "encounters", part_size, ENCOUNTER_ID)
    return out if part_size == ITEMS else out.withColumn("encounters", F.transform("encounters", lambda e: finished_encounter(e)))


def encounter_heads(t: Tables, as_of) -> DataFrame:
    """Item rows of the encounters without their children, which so go straight
    to the person."""
    return person_array(_spine(t, as_of), ENCOUNTER_ORDER, [F.col("_e._b.*"), F.col("_e.cclf.*"), F.col("_e.audit").alias("audit")],
                        "encounters", ITEMS, ENCOUNTER_ID)


def encounter_kids(t: Tables, as_of) -> DataFrame:
    """Item rows of the children of each encounter, for which only the keys of
    the encounters go to the children."""
    u = _with_children(t, as_of, _spine(t, as_of).drop("setting", "_e"))
    return person_array(u, ENCOUNTER_ORDER, ["diagnoses", "procedures", "enc_medications"], "encounter_children", ITEMS, ENCOUNTER_ID)


# ── person-level arrays ──────────────────────────────────────────────────

def _from_item(order: list[str]):
    """Accessor maker: a source column of an item, which may be one it is sorted by."""
    return lambda x: lambda c: x[f"_o{order.index(c)}"] if c in order else x["_v"][c]


LAB_ORDER = ["result_date", "result_id", "item_id"]
LAB_COLUMNS = ["encounter_nr", "item_name", "notes", "unit", "notes_abnormality_flag", "result_status", "result_created_by", "specimen_type",
               "specimen_collection_date"]


def _lab(c) -> list[Column]:
    return [c("result_id").alias("id"), c("encounter_nr").alias("encounter_nr"), C.iso_date(c("result_date")).alias("result_date"),
            c("item_id").alias("item_id"), c("item_name").alias("test_name"), c("notes").alias("result_value"),
            c("unit").alias("result_unit"), c("notes_abnormality_flag").alias("alert_flag"),
            C.in_set(c("notes_abnormality_flag"), ABNORMAL_FLAGS).alias("abnormal"), c("result_status").alias("result_status"),
            c("result_created_by").alias("ordered_by"), c("specimen_type").alias("specimen_type"),
            C.iso_date(c("specimen_collection_date")).alias("collection_date")]


def labs(t: Tables, part_size: int | str | None = None) -> DataFrame:
    """result ⋈ encounter ⟕ values ⟕ item (J9), abnormal set (F17).  Item rows
    hold the source's columns once; :func:`late` makes the elements of them."""
    cr = t["cpoe_result"]
    ae = adt_keys(t).drop("encounter_date")
    crv = t["cpoe_result_values"]
    ci = t["cpoe_item"]
    j = cr.join(ae, "encounter_nr").join(crv, "result_id", "left").join(ci, "item_id", "left")
    return person_array(j, LAB_ORDER, LAB_COLUMNS if part_size == ITEMS else _lab(F.col), "labs", part_size)


MEDICATION_ORDER = ["start_date", "id"]
MEDICATION_COLUMNS = ["RxnormID", "NDCID", "medications", "generic_name", "schedule", "dose", "dose_unit", "rout", "fill_date", "stop_date", "quantity",
                      "quantity_unit", "refills", "prescribed_doctor", "source", "delete_status", "reconciled_status", "risk_indicator", "duration"]


def _medication(c, as_of) -> list[Column]:
    same = lambda *names: [c(n).alias(n) for n in names]
    return [*same("id"), c("RxnormID").alias("rxnorm_id"), c("NDCID").alias("ndc_id"), c("medications").alias("medication_name"),
            *same("generic_name", "schedule", "dose", "dose_unit"), c("rout").alias("route"),
            *[C.iso_date(c(n)).alias(n) for n in ("start_date", "fill_date", "stop_date")],
            C.open_ended(c("stop_date"), _ts(as_of)).alias("active"), *same("quantity", "quantity_unit", "refills", "prescribed_doctor"),
            F.coalesce(c("source"), F.lit("DrFirst")).alias("source"), *same("delete_status", "reconciled_status", "risk_indicator", "duration")]


def medications(t: Tables, as_of, part_size: int | str | None = None) -> DataFrame:
    m = t["drfirst_patient_medications"].filter(F.col("delete_status") == LIVE_DELETE_STATUS)
    return person_array(m, MEDICATION_ORDER, MEDICATION_COLUMNS if part_size == ITEMS else _medication(F.col, as_of), "medications", part_size)


def late(as_of) -> dict:
    """Elements of the arrays whose items cross with the source's columns."""
    lab, medication = _from_item(LAB_ORDER), _from_item(MEDICATION_ORDER)
    return {"labs": lambda x: F.struct(*_lab(lab(x))), "medications": lambda x: F.struct(*_medication(medication(x), as_of))}


def assessments(t: Tables, thresholds: DataFrame | None = None, part_size: int | str | None = None) -> DataFrame:
    """Assessments newest first.  With a ``thresholds`` table
    ``(assessment_tools, score_threshold)`` each item also carries
    ``score_numeric`` and ``above_threshold`` (X2); scores that are not
    numbers give NULL, never an error."""
    a = t["mra_assessments_and_screenings"]
    extra = []
    if thresholds is not None:
        a = a.join(thresholds, "assessment_tools", "left")
        num = F.col("score").try_cast("double")
        extra = [num.alias("score_numeric"), F.col("score_threshold"),
                 (num >= F.col("score_threshold")).alias("above_threshold")]
    return person_array(a, ["date_completed", "nr"], [
        F.col("nr").alias("id"), F.col("assessment_tools").alias("tool"),
        C.iso_date("date_completed").alias("date_completed"), "acuity", "score", "completed_by",
        "notes", C.iso_date("created_date").alias("created_date"), *extra], "assessments", part_size)


def alerts(t: Tables, part_size: int | str | None = None) -> DataFrame:
    a = t["mra_scorecard_alerts"].filter(~F.col("original_status").isin(RESOLVED_STATUSES))
    return person_array(a, ["added_date", "nr"], [
        F.col("nr").alias("id"), F.col("type").alias("alert_type"), "ref_description", "ref_detail",
        "ref_id", C.iso_date("added_date").alias("added_date"), C.iso_date("ack_date").alias("acked_date"),
        "ack_by", "ack_notes", C.iso_date("resolved_date").alias("resolved_date"), "resolved_by",
        F.col("current_status").alias("status_code"),
        C.map_label("current_status", ALERT_STATUS, "Unknown").alias("status_desc"),
        F.col("resolved_date").isNull().alias("open"),
        F.col("original_status").cast("string").alias("original_status"), "version_no"], "alerts", part_size)


def food_answers(t: Tables) -> DataFrame:
    h = t["mra_member_history_data"]
    return h.filter(F.col("history_nr").isin(FOOD_HISTORY_NRS) & F.col("history_value").isNotNull()
                    & (F.col("history_value") != ""))


def food_insecurity(t: Tables, part_size: int | str | None = None) -> DataFrame:
    """Per (person, year): distinct answers newest first (A15 A16), years
    newest first."""
    h = food_answers(t).withColumn("assessment_year", F.year("created_date"))
    per_year = ordered_distinct_concat(h, ["origid", "assessment_year"], "history_value",
                                       "created_date", "responses", latest_alias="latest")
    return person_array(per_year, ["assessment_year"], [
        "assessment_year", C.iso_date(F.to_date("latest")).alias("latest_date"), "responses"],
        "food_insecurity", part_size)


def meal_plans(t: Tables, part_size: int | str | None = None) -> DataFrame:
    m = t["sdoh_meal_plan"]
    return person_array(m, ["created_date", "nr"], [
        F.col("nr").alias("id"), "meal_type", "product_sku", "order_id", "order_status",
        "eligibility_status", C.iso_date("start_date").alias("start_date"),
        C.iso_date("end_date").alias("end_date"), C.iso_date("created_date").alias("created_date"),
        "ship_frequency_id", "assigned_cm", "source", "notes", "created_by", "updated_by",
        C.iso_date("updated_date").alias("updated_date")], "meal_plans", part_size, ["nr"])


def reward_programs(t: Tables, part_size: int | str | None = None) -> DataFrame:
    r = t["chronic_disease_reward_program"]
    return person_array(r, ["date", "nr"], [
        F.col("nr").alias("id"), "program", "chronic_disease", "criteria", "status",
        C.iso_date("date").alias("date"), F.col("gift_card_number_issued").alias("gift_card_number"),
        C.null_false(F.col("gift_card_received") == "yes").alias("gift_card_received"),
        C.null_false(F.col("address_verified") == "yes").alias("address_verified"),
        "associate_name", "gift_card_to_be_issued"], "reward_programs", part_size, ["nr"])


def transport_benefits(t: Tables, part_size: int | str | None = None) -> DataFrame:
    tb = t["transportation_benefit"]
    return person_array(tb, ["date", "nr"], [
        F.col("nr").alias("id"), "encounter_nr", C.iso_date("date").alias("date"), "mode",
        "eligible_rides", "ride_booked_by", "cost_of_the_ride", "transportation_company",
        "pickup_address", "dropoff_address", "notes", "facility_name", "facility_sub_name",
        "dce_provider_name", "member_type"], "transport_benefits", part_size)


def sdoh_section() -> Column:
    """Social factors: yearly food answers (``[]`` when none, A13), the
    transport flag, meal plans and reward programs; ``food_insecurity_flag``
    repeats the rule flag (decision D11)."""
    food_t = "array<struct<assessment_year:int,latest_date:string,responses:string>>"
    return obj(
        ("id", F.concat(F.col("origid"), F.lit("_sdoh"))),
        ("food_insecurity", F.coalesce("food_insecurity", F.array().cast(food_t))),
        ("food_insecurity_flag", F.coalesce("food.sdoh_food_insecurity", F.lit(False))),
        ("transport_barrier_flag", F.coalesce("rides.sdoh_transport_barrier", F.lit(False))),
        ("housing_instability", F.lit(False)),
        ("meal_plans", F.col("meal_plans")), ("reward_programs", F.col("reward_programs")))


def emr_appointments(t: Tables, part_size: int | str | None = None) -> DataFrame:
    """Appointments of the listed types joined to the person's account (J12),
    text times trimmed to 19 characters (F9 F10)."""
    am = t["allergies_medications"].filter(F.col("type").isin(APPOINTMENT_TYPES))
    p = t["patient"].select("origid", "account_id")
    j = am.join(p, "origid")
    return person_array(j, ["encounterdate", "appointmentid"], [
        F.col("appointmentid").alias("id"), "account_id", F.col("encounterdate").alias("encounter_date"),
        C.trim_ts_text("appointmentstartdate").alias("appointment_start"),
        C.trim_ts_text("closeddate").alias("closed_date"), F.col("encountertype").alias("encounter_type"),
        F.col("encountervisitname").alias("visit_name"), F.col("patientstatus").alias("patient_status"),
        "type", C.in_set("patientstatus", COMPLETED_STATUSES).alias("completed")], "emr_appointments",
        part_size)


def meta_section(run_ts, trigger: Column | str = "initial_load",
                 sequence: Column | None = None, source_db: str | None = None, next_due: Column | None = None) -> Column:
    """``_meta``: run time, source, schema version, trigger (C16), the
    change sequence that produced the record (C15) and the day on which it has
    to be built again without a change (C11)."""
    ts = C.iso_ts(F.lit(str(run_ts)).cast("timestamp"))
    trig = trigger if isinstance(trigger, Column) else F.lit(trigger)
    seq = sequence if sequence is not None else _null("bigint")
    return obj(
        ("created_at", ts), ("last_modified_at", ts), ("source_db", F.lit(source_db)),
        ("schema_version", F.lit("2.0")), ("trigger_source", trig), ("cdc_sequence", seq),
        ("next_due", C.iso_date(next_due if next_due is not None else _null("date"))))
