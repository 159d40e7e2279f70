import uuid

from pyspark.sql import functions as F

from carelake.plans import measure_defs as MD
from carelake.plans import sections as S
from carelake.plans.document import parse_documents, to_json
from carelake.plans.visits import visits, visits_sql
from carelake.session import shared_dir
from carelake.streaming.refresh import measure_trigger
from tests.fixtures import AS_OF


def test_visits_one_pass_and_sql(spark, tables):
    me = tables["mra1_encounter"]
    v = visits(me, ["SNF", "Emergency"], "2023-01-01", "2023-01-31")
    got = sorted((r.EncounterNr, r.setting) for r in v.collect())
    assert got == [("M1", "SNF")]      # the window holds for every setting
    ids = lambda **w: sorted(r.EncounterNr for r in visits(me, ["SNF", "Emergency"], **w).collect())
    assert ids(start="2022-01-01") == ["M1", "M2"] and ids(end="2022-12-31") == ["M2", "M3"]
    assert len(v.columns) == 55 and "dischargeDate" in v.columns
    me.createOrReplaceTempView("mra1_encounter_v")
    q = visits_sql(spark, "mra1_encounter_v", "SNF", "2023-01-01", "2023-01-31", facility="F1")
    assert [r.EncounterNr for r in q.collect()] == ["M1"]
    assert visits(me, ["SNF"], patient_id="P2").first().EncounterNr == "M3"


def test_parse_documents_round_trip(docs):
    js = to_json(docs)
    back = parse_documents(js, docs.schema["patient"].dataType)
    a = sorted(r.j for r in docs.select(F.to_json("patient").alias("j")).collect())
    b = sorted(r.j for r in back.select(F.to_json("patient").alias("j")).collect())
    assert a == b


def test_measure_dedupe_and_thresholds(spark, tables):
    extra = spark.createDataFrame(
        [(6, "P1", "Hedis/Quality", "Controlling High BP", "F1", "2023-02-01", 1)],
        "nr bigint, origid string, type string, ref_description string, ref_id string, added_date string, "
        "original_status int").withColumn("added_date", F.to_date("added_date"))
    t = dict(tables)
    t["mra_scorecard_alerts"] = tables["mra_scorecard_alerts"].unionByName(extra, allowMissingColumns=True)
    plain = S.hedis_measures(t, AS_OF).first()["hedis_measures"]
    dedup = S.hedis_measures(t, AS_OF, ("ref_description", "ref_id")).first()["hedis_measures"]
    assert len(plain) == 3 and len(dedup) == 2
    thr = spark.createDataFrame([("PHQ-9", 4.0)], "assessment_tools string, score_threshold double")
    a = S.assessments(tables, thr).first()["assessments"][0]
    assert a["score_numeric"] == 5.0 and a["above_threshold"] is True


def test_roster_through_cross_reference(spark, tables):
    t = dict(tables)
    t["dc_bene_alignment_rostr_m01"] = tables["dc_bene_alignment_rostr_m01"].withColumn(
        "mm_curr_mbi_id", F.concat(F.lit("MBI-"), "mm_curr_mbi_id"))
    xref = spark.createDataFrame([("MBI-P1", "P1"), ("MBI-P2", "P2")], "ref string, origid string")
    r = S.roster_latest(t, "v1", xref=xref)                  # cc_version compared case-insensitively
    assert sorted(x.origid for x in r.collect()) == ["P1", "P2"]


def test_measure_trigger_hook(spark, docs):
    out = shared_dir(spark, "test_hook", uuid.uuid4().hex)
    aff = spark.createDataFrame([("adt_encounter", "P1"), ("patient", "P2")], "table string, origid string")
    hook = measure_trigger(MD.htn_measure(), "2025-06-01", out)
    hook(docs, aff, 7)
    res = spark.read.parquet(out)
    assert [(r.origid, r.batch) for r in res.select("origid", "batch").collect()] == [("P1", 7)]
