"""The pre-computed ``rule_flags`` for every person.

One aggregate per source table (not one subquery per flag): encounters,
billing codes, alerts, history answers, plans, details, scores.  Each is a
``groupBy(origid)`` with map-side partial aggregation.  They are gathered by
the person, and the flags are expressions over the gathered parts, in which
missing values get the value an aggregate over no rows has in the source
(false, 0 or NULL).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions import columns as C
from carelake.operators.gather import gather
from carelake.operators.latest import latest_row
from carelake.plans import sections as S

FLAG_ORDER = [
    "raf_score", "readmit_30d", "readmit_90d", "last_admission_date", "last_discharge_date",
    "open_inpatient", "awv_due", "awv_last_date", "pcp_visit_overdue", "pcp_days_since_visit",
    "hedis_gaps_open", "hedis_gap_measures", "ccm_enrolled", "ccm_consent_on_file", "ccm_level",
    "sdoh_food_insecurity", "sdoh_transport_barrier", "sdoh_meal_plan_active", "care_plan_active",
    "care_plan_overdue_reassessment", "uamcc_eligible", "uamcc_conditions", "uamcc_condition_count",
    "active_alerts", "unresolved_alert_types", "last_updated",
]
# Declared by the document schema, computed from data the record already reads.
EXTENSION_FLAGS = ["hcc_capture_pct", "hcc_gaps_open", "hcc_gap_codes", "rx_adherence_pct",
                   "rx_adherence_flag"]


def encounter_flags(t, as_of) -> DataFrame:
    """readmit_30d/90d (A2 P7), last admission/discharge (T1 P5 P10),
    open_inpatient (P11) — one pass over the clinical encounters."""
    a = C.as_date(as_of)
    ae = t["adt_encounter"]
    inpatient = F.col("encounter_class_nr").isin(S.INPATIENT_CLASSES)
    readmit = F.col("m_redmit_flag") == 1
    return ae.groupBy("origid").agg(
        C.null_false(F.bool_or(readmit & (F.col("discharge_date") >= F.date_sub(a, 30)))).alias("readmit_30d"),
        C.null_false(F.bool_or(readmit & (F.col("discharge_date") >= F.date_sub(a, 90)))).alias("readmit_90d"),
        F.max(F.when(readmit, F.col("discharge_date"))).alias("_last_readmit"),
        F.max(F.when(inpatient, F.col("encounter_date"))).alias("_last_adm"),
        F.max(F.when(inpatient & F.col("discharge_date").isNotNull(), F.col("discharge_date"))).alias("_last_dis"),
        C.null_false(F.bool_or(inpatient & F.col("discharge_date").isNull()
                               & (F.col("encounter_status") != "closed"))).alias("open_inpatient"))


def awv_flags(t, as_of) -> DataFrame:
    """Annual wellness visit (J3 A10 P13): latest clinical encounter having an
    AWV billing code (semi-join: codes never multiply encounters)."""
    cpt = t["mra1_encounter_bill_cpts"].filter(F.col("bb_Code").isin(S.AWV_CODES))
    ae = S.adt_keys(t).join(cpt, "encounter_nr", "left_semi")
    return ae.groupBy("origid").agg(F.max("encounter_date").alias("_awv_last"))


def alert_flags(t) -> DataFrame:
    """Unresolved alerts with original status not in (4, 5) (A1 A14 P5):
    counts and distinct-value arrays (a NULL value is kept as an element;
    no rows → NULL array, as JSON_ARRAYAGG)."""
    a = t["mra_scorecard_alerts"].filter(F.col("resolved_date").isNull()
                                         & ~F.col("original_status").isin(S.RESOLVED_STATUSES))
    q = F.col("type") == S.QUALITY_ALERT_TYPE
    measures = F.array_sort(F.collect_set(F.when(q, F.struct(F.col("ref_description").alias("v")))))
    types = F.array_sort(F.collect_set(F.struct(F.col("type").alias("v"))))
    return a.groupBy("origid").agg(
        F.count("*").alias("active_alerts"), F.count_if(q).alias("hedis_gaps_open"),
        F.when(F.size(measures) > 0, F.transform(measures, lambda x: x["v"])).alias("hedis_gap_measures"),
        F.transform(types, lambda x: x["v"]).alias("unresolved_alert_types"))


def food_flag(t) -> DataFrame:
    """Any positive answer in the person's latest answered year (A17 A6):
    per (person, year) then the latest year — both partial-aggregated."""
    h = S.food_answers(t).withColumn("y", F.year("created_date"))
    per_year = h.groupBy("origid", "y").agg(
        F.sum(F.when(F.col("history_value").isin(S.FOOD_POSITIVE), 1).otherwise(0)).alias("pos"))
    last = latest_row(per_year, ["origid"], ["y"], ["pos"])
    return last.select("origid", (F.col("pos") > 0).alias("sdoh_food_insecurity"))


def sdoh_flags(t, as_of) -> DataFrame:
    tb = t["transportation_benefit"].select("origid").distinct() \
        .withColumn("sdoh_transport_barrier", F.lit(True))
    mp = t["sdoh_meal_plan"].filter((F.col("order_status") == "ordered")
                                    & C.open_ended("end_date", as_of))
    meal = mp.groupBy("origid").agg(F.lit(True).alias("sdoh_meal_plan_active"),
                                    F.when(F.count("end_date") == F.count("*"), F.max("end_date")).alias("_last_meal"))
    return tb, meal


def care_plan_flags(t, as_of) -> DataFrame:
    """care_plan_active (P9) and overdue reassessment (F4): last update plus
    the day count held as text (leading digits, 0 when none) before as_of."""
    cp = t["care_plan_patient"].filter(F.col("plan_status") == 1)
    due = F.date_add(F.coalesce("updated_date", "plan_start_date"), C.numeric_prefix_int("reassessment"))
    end = F.col("plan_inactive_datetime")
    return cp.groupBy("origid").agg(
        C.null_false(F.bool_or(C.open_ended(end, S._ts(as_of)))).alias("care_plan_active"),
        C.null_false(F.bool_or(F.col("reassessment").isNotNull() & (due < C.as_date(as_of)))).alias("care_plan_overdue_reassessment"),
        F.when(F.count(end) == F.count("*"), F.to_date(F.max(end))).alias("_last_plan"),
        F.min(F.when(F.col("reassessment").isNotNull(), due)).alias("_first_due"))


def raf_flag(t) -> DataFrame:
    """Latest prmra score by (year, month), rounded to 4."""
    r = t["mra_raf_patient"].filter(F.col("type") == "prmra")
    last = latest_row(r, ["origid"], ["year", "month", "total_score"], ["total_score"])
    return last.select("origid", F.round("total_score", 4).alias("raf_score"))


def flag_parts(t, as_of) -> dict[str, Callable[[], DataFrame]]:
    """What the flags need, one row per person each, built when asked for."""
    return {"patient": lambda: t["patient"], "raf_flag": lambda: raf_flag(t), "stays": lambda: encounter_flags(t, as_of),
            "awv": lambda: awv_flags(t, as_of), "alert_counts": lambda: alert_flags(t), "food": lambda: food_flag(t),
            "rides": lambda: sdoh_flags(t, as_of)[0], "meals": lambda: sdoh_flags(t, as_of)[1], "plans": lambda: care_plan_flags(t, as_of),
            "uamcc_summary": lambda: S.uamcc_rows(t), "capture": lambda: S.hcc_capture_counts(t, as_of),
            "adherence": lambda: S.adherence_counts(t, as_of)}


#: what next_due reads
DUE_PARTS = ["patient", "stays", "awv", "meals", "plans", "stops"]


def next_stop(t, as_of) -> DataFrame:
    """The first day, today or later, that is a live prescription's last."""
    m = t["drfirst_patient_medications"].filter(F.col("delete_status") == S.LIVE_DELETE_STATUS)
    return m.where(F.col("stop_date") >= S._ts(as_of)).groupBy("origid").agg(F.to_date(F.min("stop_date")).alias("_next_stop"))


def flag_columns(as_of, run_ts=None) -> list[Column]:
    """The 26 flags and the extension flags over the gathered parts."""
    p, stays, alerts, plans, u, c, a = (S.part(x) for x in ("patient", "stays", "alert_counts", "plans", "uamcc_summary", "capture", "adherence"))
    false, zero = F.lit(False), F.lit(0)
    count = F.coalesce(u("condition_count"), zero)
    pct = C.pct(F.coalesce(a("covered"), zero), F.datediff(S._ts(as_of), a("first_start")), 2)
    run = run_ts if run_ts is not None else f"{as_of} 00:00:00"
    values = {
        "raf_score": F.col("raf_flag.raf_score"),
        "readmit_30d": F.coalesce(stays("readmit_30d"), false), "readmit_90d": F.coalesce(stays("readmit_90d"), false),
        "last_admission_date": C.iso_date(stays("_last_adm")), "last_discharge_date": C.iso_date(stays("_last_dis")),
        "open_inpatient": F.coalesce(stays("open_inpatient"), false),
        "awv_due": C.overdue(F.col("awv._awv_last"), as_of, 365), "awv_last_date": C.iso_date(F.col("awv._awv_last")),
        "pcp_visit_overdue": C.overdue(p("Last_PCP_Visit_Date"), as_of, 365),
        "pcp_days_since_visit": C.days_between(as_of, p("Last_PCP_Visit_Date")),
        "hedis_gaps_open": F.coalesce(alerts("hedis_gaps_open"), zero), "hedis_gap_measures": alerts("hedis_gap_measures"),
        "ccm_enrolled": C.flag(p("is_ccm_enabled")), "ccm_consent_on_file": C.flag(p("consent_onfile")), "ccm_level": p("ccm_level"),
        "sdoh_food_insecurity": F.coalesce(F.col("food.sdoh_food_insecurity"), false),
        "sdoh_transport_barrier": F.coalesce(F.col("rides.sdoh_transport_barrier"), false),
        "sdoh_meal_plan_active": F.coalesce(F.col("meals.sdoh_meal_plan_active"), false),
        "care_plan_active": F.coalesce(plans("care_plan_active"), false),
        "care_plan_overdue_reassessment": F.coalesce(plans("care_plan_overdue_reassessment"), false),
        "uamcc_eligible": count >= 2, "uamcc_conditions": u("conditions"), "uamcc_condition_count": count,
        "active_alerts": F.coalesce(alerts("active_alerts"), zero), "unresolved_alert_types": alerts("unresolved_alert_types"),
        "last_updated": C.iso_ts(F.lit(str(run)).cast("timestamp")),
        "hcc_capture_pct": C.pct(c("captured_hccs"), F.coalesce(c("eligible_hccs"), zero), 1),
        "hcc_gaps_open": F.coalesce(F.when(c("gap_hccs").isNotNull(), F.size(c("gap_hccs"))), zero), "hcc_gap_codes": c("gap_hccs"),
        "rx_adherence_pct": pct,
        "rx_adherence_flag": F.when(pct >= S.ADHERENCE_THRESHOLD, "Adequate").otherwise("Inadequate")}
    return [values[n].alias(n) for n in FLAG_ORDER + EXTENSION_FLAGS]


def next_due(as_of) -> Column:
    """The next day on which a value of the record changes though no source
    does (C11), over the gathered parts: a window behind the day ends (P7), an
    open end is passed (P9), a visit or reassessment becomes overdue (P13 F4),
    a birthday, the last day of a prescription, or the new coding year, which
    concerns everybody.  Numbers that count days change every day and are left
    to the reader (days since a visit, open stays, covered days)."""
    p, stays, a = S.part("patient"), S.part("stays"), C.as_date(as_of)
    born = C.as_date(p("birthdate"))
    years = C.full_years(born, a) + 1
    birthday = F.add_months(born, years * 12)
    # born on the 29th of February: reached on the 1st of March in common years
    birthday = F.when(C.full_years(born, birthday) < years, F.date_add(birthday, 1)).otherwise(birthday)
    days = [F.date_add(stays("_last_readmit"), 31), F.date_add(stays("_last_readmit"), 91), F.date_add(F.col("awv._awv_last"), 366),
            F.date_add(p("Last_PCP_Visit_Date"), 366), F.date_add(F.col("meals._last_meal"), 1), F.date_add(F.col("plans._last_plan"), 1),
            F.when(~F.col("plans.care_plan_overdue_reassessment"), F.date_add(F.col("plans._first_due"), 1)), birthday,
            F.date_add(F.col("stops._next_stop"), 1), F.make_date(F.year(a) + 1, F.lit(1), F.lit(1))]
    return F.least(*[F.when(d > a, d) for d in days], F.lit(None).cast("date"))


def rule_flags(t, as_of, run_ts=None, persons: DataFrame | None = None) -> DataFrame:
    """``(origid, <26 flags>, <5 extension flags>)`` as flat columns."""
    base = persons if persons is not None else t["patient"]
    rows = {name: build() for name, build in flag_parts(t, as_of).items()}
    return gather(base.select("origid"), "origid", rows, {}).select("origid", *flag_columns(as_of, run_ts))
