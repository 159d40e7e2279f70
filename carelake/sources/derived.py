"""The 25 source tables of the person record, derived by Spark from the
benchmark tables, so the real record builder runs on data that grows with
them (registered query ``doc_domain`` and the benchmark).

Mapping: customer → patient (+ one aligned roster row); supplier → personnel
and role mapping; orders with status F/O → clinical encounters, status P →
claim encounters (setting from the order key); lines → diagnoses (code =
part brand), billing codes (part type; returned-and-finished lines carry the
annual-visit code), encounter and patient medications, lab values (item =
part); part → code lookup; events → alerts, yearly answers, rides, meal
plans, appointments (by event type).  Modulo expressions derive categorical
attributes from keys and payloads; no row is dropped to make anything
cheaper.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions import columns as C
from carelake.operators.aggregates import spread
from carelake.plans.visits import ALL_SETTINGS
from carelake.sources.driver import Tables
from carelake.sources.schemas import DOMAIN_DDL
from carelake.sources.schemas import schema as table_schema
from carelake.sources.tables import normalise

# Fixed values of the derivation.
# Flag columns of the claim encounters: the n-th (from 2) is set where the order key is a multiple of n.
VISIT_FLAGS = ["is_enc_ref_admitdate", "is_readmit", "is_c2_readmit", "is_enc_transfer", "is_snf_rec", "is_snf_admitdate_ref",
               "is_er_visit", "is_visit_pcp", "is_offvisit_rec", "is_offvisit2rec", "m_flwup_flag", "is_72_hr_flwup",
               "is_flwup_7_days", "is_flwup_14_days", "is_gflwup_14_days", "tfu_pb_er", "tfu_pb_obs", "is_bcda_match",
               "tfu_denom", "tfu_numer", "acr_numer", "acr_denom", "uamcc_numerator"]
ROLES = ["CCM_MNGT", "Outreach", "census_notes", "census_mos"]
ANSWERS = ["Often true", "Never true", "Sometimes true"]
AWV_CODE = "G0439"
AS_OF, PLAN_START = "2001-08-01", "2001-05-01"
ERAS = [("", "1990-01-01", "2100-01-01"), ("OLD-", "1990-01-01", "2000-01-01"), ("NEXT-", "2050-01-01", "2100-01-01")]


def shape(df: DataFrame, name: str) -> DataFrame:
    """Project onto the table's declared schema: present columns cast to
    their type, absent ones NULL."""
    schema = table_schema(name)
    have = set(df.columns)
    cols = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields]
    return df.select(*cols)


def _k(props: str = "props") -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def _dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key`` as rows that cross whole: inside an array no reader's
    choice of columns or rows goes below the exchange, so all readers share it."""
    whole = df.select(key, F.array(F.struct(*[c for c in df.columns if c != key])).alias("row"))
    return spread(whole, key).select(key, F.inline("row"))


def derive(t: Tables, share_lines: bool = False) -> dict[str, DataFrame]:
    """``share_lines``: lines meet their parts and orders once for all the tables
    made of them, and not once for each with its own columns; for records that
    read several of them."""
    c, o, l, p, s, e = t.customer, t.orders, t.lineitem, t.part, t.supplier, t.events
    pid = F.col("o_custkey").cast("string")
    d = F.to_date("o_orderdate")
    cls = C.numeric_prefix_int("o_orderpriority")
    out: dict[str, DataFrame] = {}

    out["patient"] = c.select(
        F.col("c_custkey").cast("string").alias("origid"), F.col("c_name").alias("lastname"),
        F.make_date(1930 + F.col("c_nationkey"), 1 + F.col("c_custkey") % 12,
                    1 + F.col("c_custkey") % 28).alias("birthdate"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("sex"),
        F.col("c_mktsegment").alias("status"), F.col("c_custkey").cast("string").alias("account_id"),
        F.when(F.col("c_custkey") % 3 != 0, F.date_sub(F.lit(AS_OF).cast("date"), (F.col("c_custkey") % 800).cast("int"))).alias("Last_PCP_Visit_Date"),
        (F.col("c_custkey") % 2).cast("int").alias("consent_onfile"), (F.col("c_custkey") % 3).cast("string").alias("ccm_level"),
        (F.col("c_acctbal") > 5000).cast("int").alias("is_ccm_enabled"))
    k = F.col("c_custkey")
    out["care_plan_patient"] = c.select(
        k.cast("string").alias("origid"), (k % 3).cast("int").alias("plan_status"),
        F.when(k % 4 != 0, F.date_add(F.lit(AS_OF).cast("date"), (k % 60 - 30).cast("int"))).alias("plan_inactive_datetime"),
        F.when(k % 5 == 1, "abc").when(k % 5 != 0, F.concat((k % 90).cast("string"), F.lit(" days"))).alias("reassessment"),
        F.when(k % 2 == 0, F.date_add(F.lit(PLAN_START).cast("date"), (k % 80).cast("int"))).alias("updated_date"),
        F.date_add(F.lit(PLAN_START).cast("date"), (k % 60).cast("int")).alias("plan_start_date"))
    out["dc_bene_alignment_rostr_m01"] = c.select(
        F.col("c_custkey").cast("string").alias("mm_curr_mbi_id"), F.lit("1").alias("cc_version"),
        F.lit("2001-01-01").cast("date").alias("mm_date"), F.lit("AL").alias("ALIGN_STATUS_CODE"),
        F.col("c_nationkey").alias("market_id"),
        F.concat(F.lit("NPI"), F.col("c_nationkey").cast("string")).alias("prov_npi_nr"))
    out["mra_dce_cm_mapping"] = s.select(
        F.concat(F.lit("NPI"), F.col("s_nationkey").cast("string")).alias("provider_npi"),
        F.col("s_suppkey").cast("int").alias("cm_nr"),
        C.map_label(F.col("s_suppkey") % 4, dict(enumerate(ROLES))).alias("type"))
    out["personell"] = s.select(F.col("s_suppkey").cast("int").alias("nr"), F.col("s_name").alias("name"))

    clinical = o.filter(F.col("o_orderstatus").isin("F", "O"))
    out["adt_encounter"] = clinical.select(
        F.concat(F.lit("A"), F.col("o_orderkey").cast("string")).alias("encounter_nr"), pid.alias("origid"),
        F.col("o_orderpriority").alias("mos_type"), cls.alias("encounter_class_nr"),
        F.when(F.col("o_orderstatus") == "F", "closed").when(F.col("o_orderkey") % 2 == 0, "active").alias("encounter_status"),
        d.alias("encounter_date"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(d, cls)).alias("discharge_date"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("m_redmit_flag"))
    claims = o.filter(F.col("o_orderstatus") == "P")
    out["mra1_encounter"] = claims.select(
        F.concat(F.lit("M"), F.col("o_orderkey").cast("string")).alias("encounter_nr"),
        pid.alias("patient_id"),
        F.element_at(F.array(*map(F.lit, ALL_SETTINGS)), (F.col("o_orderkey") % 13 + 1).cast("int")).alias("enc_proc_type"),
        d.alias("enc_admit_date"), F.date_add(d, cls).alias("enc_disch_date"), d.alias("enc_date"),
        F.col("o_totalprice").alias("mh1_cal_amount"), (F.col("o_totalprice") * 2).alias("mc1_cal_amount"),
        F.date_add(d, 3).alias("m72hr_flwup_date"), F.date_add(d, 14).alias("tfu_followup_date"), cls.alias("m_cal_bed_days"),
        F.col("o_orderpriority").alias("dce_group_type"), F.col("o_orderstatus").alias("dce_sub_group_type"),
        (F.col("o_custkey") % 7).cast("string").alias("market_nr"), F.concat(F.lit("Market "), (F.col("o_custkey") % 7).cast("string")).alias("market_name"),
        (F.col("o_custkey") % 50).cast("string").alias("pt_facility_nr"), (F.col("o_orderkey") % 3).cast("string").alias("pt_facility_sub_nr"),
        F.concat(F.lit("NPI"), (F.col("o_orderkey") % 100).cast("string")).alias("m_provider_npi"),
        (F.col("o_orderkey") % 20).cast("string").alias("hospital_nr"), F.concat(F.lit("Hospital "), (F.col("o_orderkey") % 20).cast("string")).alias("hospital_name"),
        F.date_format("o_orderdate", "HH:mm").alias("enc_admit_time"), F.lower("o_orderpriority").alias("m_pos_txt"),
        *((F.col("o_orderkey") % n == 0).cast("int").alias(c) for n, c in enumerate(VISIT_FLAGS, start=2)))

    enc_nr = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("M"), F.col("l_orderkey").cast("string"))) \
        .otherwise(F.concat(F.lit("A"), F.col("l_orderkey").cast("string")))
    keys, coded = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"), p.select("p_partkey", "p_brand", "p_type")
    if share_lines:
        read = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"]
        whole = _dealt(l.select(*read).join(coded, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey"), "l_orderkey")
        lines = whole.join(_dealt(keys, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    else:
        lines = l.join(keys, l.l_orderkey == o.o_orderkey).join(coded, l.l_partkey == p.p_partkey)
    lines = lines.withColumn("encounter_nr", enc_nr) \
        .withColumn("line_id", F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"))
    adt_lines = lines.filter(F.col("o_orderstatus") != "P")
    out["adt_encounter_icd_codes"] = adt_lines.select(
        F.col("line_id").alias("id"), "encounter_nr", F.col("p_brand").alias("diagnosis_code"),
        F.to_date("l_shipdate").alias("onset_date"), F.col("l_linenumber").alias("icd_order"),
        F.when(F.col("l_linestatus") == "O", "Active").alias("status"),
        (F.col("l_returnflag") == "A").cast("int").alias("is_comorbid"))
    # the newest of a condition is the odd lines', so a condition may have several
    out["mra_uamcc_details"] = lines.filter(F.col("o_orderstatus") == "P").select(
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")).alias("nr"),
        F.col("o_custkey").cast("string").alias("origid"), F.to_date("l_shipdate").alias("service_date"),
        F.col("p_type").alias("condition_category"), F.col("p_brand").alias("diagnosis_code"),
        F.col("l_returnflag").alias("claim_type"), F.col("l_linenumber").alias("version"),
        (F.col("l_linenumber") % 2).alias("is_most_recent_per_category"))
    out["mra1_encounter_icd_codes"] = lines.filter(F.col("o_orderstatus") == "P").select(
        "encounter_nr", F.col("p_brand").alias("diagnosis_code"))
    out["mra1_encounter_bill_cpts"] = lines.select(
        "encounter_nr",
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit(AWV_CODE))
        .otherwise(F.col("p_type")).alias("bb_Code"))
    out["cclf_encounter_patient_medication"] = lines.filter(F.col("l_returnflag") == "N").select(
        F.col("line_id").alias("id"), "encounter_nr", F.col("p_type").alias("medications"),
        F.col("l_shipdate").cast("timestamp").alias("start_date"))
    out["drfirst_patient_medications"] = lines.select(
        F.col("line_id").alias("id"), F.col("o_custkey").cast("string").alias("patientid"),
        F.col("p_brand").alias("medications"), F.col("l_shipdate").cast("timestamp").alias("start_date"),
        F.when(F.col("l_linestatus") == "F",
               F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int")).cast("timestamp"))
        .alias("stop_date"),
        F.when(F.col("l_returnflag") == "R", "y").otherwise("n").alias("delete_status"))
    out["cpoe_result"] = clinical.select(
        F.col("o_orderkey").alias("result_id"),
        F.concat(F.lit("A"), F.col("o_orderkey").cast("string")).alias("encounter_nr"),
        d.alias("result_date"), F.col("o_orderstatus").alias("result_status"))
    out["cpoe_result_values"] = adt_lines.select(
        F.col("l_orderkey").alias("result_id"), F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").cast("string").alias("notes"),
        F.when(F.col("l_returnflag") == "R", "H").when(F.col("l_returnflag") == "A", "L")
        .alias("notes_abnormality_flag"))
    out["cpoe_item"] = p.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("item_name"))
    codes = p.groupBy(F.col("p_brand").alias("diagnosis_code")).agg(
        F.min("p_type").alias("hcc"), F.min("p_type").alias("hcc_nr"),
        (F.max("p_retailprice") / 1000).alias("community_nondual_aged"))
    # each code also has a row that is no longer valid and one that isn't yet, of other categories
    out["mra_hcc_coefficients"] = codes.select("*", F.explode(F.array(*[
        F.struct(F.lit(n).alias("era"), F.lit(a).cast("timestamp").alias("active_date"), F.lit(b).cast("timestamp").alias("inactive_date"))
        for n, a, b in ERAS])).alias("e")).select(
        "diagnosis_code", F.concat("e.era", "hcc").alias("hcc"), F.concat("e.era", "hcc_nr").alias("hcc_nr"),
        "community_nondual_aged", "e.active_date", "e.inactive_date")

    ev = e.select("event_id", F.col("user_id").cast("string").alias("origid"), "event_type", "ts",
                  _k().alias("k"))
    out["mra_scorecard_alerts"] = ev.select(
        F.col("event_id").alias("nr"), "origid",
        F.when(F.col("event_type") == "error", "Hedis/Quality").otherwise(F.col("event_type")).alias("type"),
        F.concat(F.lit("M"), (F.col("k") % 10).cast("string")).alias("ref_description"),
        (F.col("k") % 10).cast("string").alias("ref_id"), F.to_date("ts").alias("added_date"),
        F.when(F.col("k") % 4 == 0, F.to_date("ts")).alias("resolved_date"),
        (F.col("k") % 6).alias("current_status"), (F.col("k") % 7).alias("original_status"))
    out["mra_raf_patient"] = o.select(
        pid.alias("origid"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "pmra").when(F.col("o_orderpriority") == "2-HIGH", "prmra")
        .otherwise("rmra").alias("type"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
        (F.col("o_totalprice") / 100000).alias("total_score"))
    views = ev.filter(F.col("event_type") == "view")
    out["mra_member_history_data"] = views.select(
        "origid", F.lit(15074).alias("history_nr"),
        C.map_label(F.col("k") % 3, dict(enumerate(ANSWERS))).alias("history_value"),
        F.col("ts").cast("timestamp").alias("created_date"))
    out["transportation_benefit"] = ev.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("nr"), F.col("origid").alias("orig_id"), F.to_date("ts").alias("date"))
    out["sdoh_meal_plan"] = ev.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("nr"), "origid", F.when(F.col("k") % 5 != 0, "ordered").otherwise("cancelled").alias("order_status"),
        F.when(F.col("k") % 3 == 1, F.date_add(F.lit("2001-07-01").cast("date"), F.col("k") % 60))
        .when(F.col("k") % 3 == 2, F.lit("2000-01-01").cast("date")).alias("end_date"),
        F.to_date("ts").alias("created_date"))
    out["chronic_disease_reward_program"] = ev.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("nr"), "origid", F.concat(F.lit("Program "), (F.col("k") % 3).cast("string")).alias("program"),
        F.to_date("ts").alias("date"), F.when(F.col("k") % 2 == 0, "yes").alias("gift_card_received"))
    out["mra_assessments_and_screenings"] = ev.filter(F.col("event_type") == "error").select(
        F.col("event_id").alias("nr"), "origid", F.concat(F.lit("Tool "), (F.col("k") % 4).cast("string")).alias("assessment_tools"),
        F.to_date("ts").alias("date_completed"), F.when(F.col("k") % 9 == 0, "n/a").otherwise(F.col("k").cast("string")).alias("score"))
    out["allergies_medications"] = ev.filter(F.col("event_type") == "signup").select(
        F.col("event_id").cast("string").alias("appointmentid"), "origid",
        F.date_format("ts", "yyyy-MM-dd").alias("encounterdate"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss+00:00").alias("appointmentstartdate"),
        F.lit("appointment").alias("type"), F.lit("Completed").alias("patientstatus"))
    shaped = {n: shape(df, n) for n, df in out.items()}
    for n in DOMAIN_DDL:
        if n not in shaped:
            shaped[n] = t.customer.sparkSession.createDataFrame([], table_schema(n))
    return {n: normalise(n, df) for n, df in shaped.items()}
