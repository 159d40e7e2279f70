import json

from pyspark.sql import functions as F

from carelake.plans import checks
from carelake.plans.document import build_documents, to_json


def _doc(docs, origid):
    return json.loads(to_json(docs).filter(F.col("origid") == origid).first()["doc"])["patient"]


def test_one_document_per_aligned_person(docs):
    assert sorted(r.origid for r in docs.select("origid").collect()) == ["P1", "P2"]  # P3 not aligned
    assert checks.duplicates(docs, ["origid"]).count() == 0


def test_demographics_contact_care_team(docs):
    p = _doc(docs, "P1")
    assert p["demographics"]["age"] == 22 and p["demographics"]["sex"] == "Male"
    assert p["demographics"]["nursing_home_alert"] is True
    assert p["contact"]["phone_primary"] == "+15550100"
    assert p["contact"]["address"]["country"] == "US"
    ct = p["care_team"]
    assert ct["market_id"] == 7 and ct["care_manager"] == "Bob Care" and ct["outreach_worker"] == "Amy Out"
    assert p["enrollment"]["align_status_code"] == "AL"
    assert _doc(docs, "P2")["demographics"]["sex"] == "X"


def test_rule_flags(docs):
    f = _doc(docs, "P1")["rule_flags"]
    assert f["raf_score"] == 1.2346
    assert f["readmit_30d"] is True and f["open_inpatient"] is True
    assert f["last_admission_date"] == "2023-02-10" and f["last_discharge_date"] == "2023-02-15"
    assert f["awv_due"] is True and f["awv_last_date"] == "2021-12-01"   # lower-case code matched
    assert f["pcp_visit_overdue"] is True
    assert f["hedis_gaps_open"] == 2 and f["hedis_gap_measures"] == [None, "Controlling High BP"]
    assert f["active_alerts"] == 2                                        # NULL status dropped
    assert f["sdoh_food_insecurity"] is False                             # latest year negative
    assert f["care_plan_overdue_reassessment"] is True                    # '90 days'
    assert f["uamcc_eligible"] is True and f["uamcc_conditions"] == ["CHF", "DIAB"]
    assert f["hcc_capture_pct"] == 50.0 and f["hcc_gap_codes"] == ["HCC-226"]
    assert len(f) == 31
    f2 = _doc(docs, "P2")["rule_flags"]
    assert f2["open_inpatient"] is False                                  # status NULL != 'closed'
    assert f2["care_plan_overdue_reassessment"] is True                   # 'abc' → 0 days
    assert f2["hedis_gap_measures"] is None and f2["active_alerts"] == 0


def test_sections(docs):
    p = _doc(docs, "P1")
    cc = {c["icd_code"]: c for c in p["chronic_conditions"]}
    assert cc["I10"]["encounter_count"] == 2 and cc["I10"]["hcc_score"] == 0.4   # D6: latest active
    assert cc["I10"]["status"] == "Active" and cc["E11.9"]["condition_category"] == "DIAB"
    assert p["raf_profile"]["pmra"]["month"] == 2 and p["raf_profile"]["rmra"]["detail_score"] is None
    hc = p["hcc_capture"]
    assert (hc["eligible_hccs"], hc["captured_hccs"], hc["gap_hccs"]) == (2, 1, ["HCC-226"])
    assert p["uamcc"]["summary"]["icd_prefixes"] == ["E11", "I50"]
    assert p["medication_adherence"]["covered_days"] == 102
    assert p["medication_adherence"]["rx_adherence_pct"] == 175.86
    assert [m["measure_name"] for m in p["hedis_measures"]] == [None, "Controlling High BP"]
    assert p["labs"][0]["abnormal"] is True and p["labs"][0]["test_name"] == "Glucose"
    assert [m["id"] for m in p["medications"]] == [2, 1]
    assert p["alerts"][0]["status_desc"] == "Unknown"
    assert [y["assessment_year"] for y in p["sdoh"]["food_insecurity"]] == [2023, 2022]
    assert p["sdoh"]["food_insecurity"][1]["responses"] == "Often true, Sometimes true"
    assert p["sdoh"]["reward_programs"][0]["gift_card_received"] is True
    ap = p["emr_appointments"]
    assert len(ap) == 1 and ap[0]["appointment_start"] == "2023-02-01T09:30:00" and ap[0]["closed_date"] is None
    assert ap[0]["completed"] is True and ap[0]["account_id"] == "ACC1"
    assert p["_meta"]["schema_version"] == "2.0" and p["_meta"]["trigger_source"] == "initial_load"


def test_encounter_spine(docs):
    enc = _doc(docs, "P1")["encounters"]
    assert [e["encounter_nr"] for e in enc] == ["E1", "M1", "E3", "M2", "E5"]
    e1 = enc[0]
    assert e1["source_system"] == "adt" and e1["dates"]["tcm_7day_deadline"] == "2023-02-22"
    assert [d["icd_code"] for d in e1["diagnoses"]] == ["I10", "E11.9"]
    assert e1["diagnoses"][0]["source"] == "IP" and e1["diagnoses"][0]["hcc_number"] is None
    assert e1["enc_medications"][0]["start_date"] == "2023-02-10T08:00:00"
    assert e1["is_readmission"] is None                                   # claim field NULL on clinical rows
    e3 = enc[2]
    assert e3["dates"]["length_of_stay_days"] == 272 and e3["diagnoses"][0]["source"] == "emr"
    assert enc[1]["procedures"][0]["id"] == "99213_2023-01-05" and enc[1]["is_readmission"] is True
    assert enc[3]["diagnoses"] == [] and enc[3]["procedures"] == []       # no children → []
    p2 = _doc(docs, "P2")
    assert p2["labs"] is None and p2["medications"] is None               # none → NULL


def test_conformance_checks(spark, docs):
    js = to_json(docs)
    assert checks.validate(js, "origid").count() == 0
    broken = js.withColumn("doc", F.regexp_replace("doc", '"labs":', '"labz":'))
    found = {(r.kind, r.detail) for r in checks.validate(broken, "origid").collect()}
    assert ("patient", "labs") in found
    assert checks.missing_documents(spark.createDataFrame([("P1",), ("P9",)], "origid string"),
                                    docs, "origid").first()["origid"] == "P9"
    prof = checks.profile(docs.join(js, "origid"), "origid", ["encounters", "labs"], json_col="doc")
    row = prof.filter("origid = 'P2'").first()
    assert row["n_labs"] is None and row["doc_kb"] > 0


def test_staged_build_equals_direct(spark, tables, docs):
    import uuid

    from carelake.plans.document import build_documents
    from carelake.session import shared_dir
    from tests.fixtures import AS_OF
    staged = build_documents(tables, AS_OF, stage_dir=shared_dir(spark, "stage", uuid.uuid4().hex))
    to_s = lambda df: sorted(r.j for r in df.select(F.to_json("patient").alias("j")).collect())
    assert to_s(staged) == to_s(docs)


def test_parts_layout_splits_hot_person(spark, tables, docs):
    from carelake.plans.document import build_documents
    from tests.fixtures import AS_OF
    parts = build_documents(tables, AS_OF, part_size=2).cache()
    rows = parts.collect()
    p1 = [r for r in rows if r.origid == "P1"]
    assert {r.n_parts for r in p1} == {3} and 1 <= len(p1) <= 3          # 5 encounters / 2 per part
    assert all(len(r.patient.encounters or []) <= 5 for r in p1)
    got = sorted(e.encounter_nr for r in p1 for e in (r.patient.encounters or []))
    assert got == ["E1", "E3", "E5", "M1", "M2"]
    main = [r for r in p1 if r.part_no == 0][0]
    assert float(main.patient.rule_flags.raf_score) == 1.2346
    assert all(r.patient.rule_flags is None for r in p1 if r.part_no > 0)
    p2 = [r for r in rows if r.origid == "P2"]
    assert len(p2) == 1 and p2[0].n_parts == 1                            # small person: one row
    full = _doc(docs, "P2")
    assert json.loads(json.dumps(p2[0].patient.asDict(recursive=True), default=str))["labs"] == full["labs"]


def test_section_projection_and_population_profile(docs):
    sec = checks.section(docs, "origid", "care_team").filter("origid = 'P1'").first()
    assert sec.care_team.care_manager == "Bob Care"
    prof = checks.profile(docs, "origid", ["encounters", "alerts"])
    pop = checks.population_profile(prof, ["n_encounters"]).first()
    assert pop["n_encounters_max"] == 5 and len(pop["n_encounters_p50_p90_p99"]) == 3


def test_parts_layout_splits_nested_arrays(spark, tables, docs):
    from carelake.plans.document import build_documents
    from tests.fixtures import AS_OF
    rows = [r for r in build_documents(tables, AS_OF, part_size=1).collect() if r.origid == "P1"]
    details = sorted(d.id for r in rows if r.patient.uamcc for d in (r.patient.uamcc.details or []))
    assert details == [1, 2]                                              # 2 current details, 1 per part
    assert all(len(r.patient.uamcc.details or []) <= 2 for r in rows if r.patient.uamcc)
    main = [r for r in rows if r.part_no == 0][0]
    assert main.patient.uamcc.summary.condition_count == 2
    assert sum(len(r.patient.sdoh.meal_plans or []) for r in rows if r.patient.sdoh) == 1


def test_members_of_a_care_team_join_after_the_gather(tables):
    """Persons × members must not be shuffled: the roles join above the union of all parts."""
    d = build_documents(tables, "2026-01-15", sections=["care_team"])
    plan = d._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, x in enumerate(plan) if "Join LeftOuter" in x and "provider_npi" in x)
    assert join < next(i for i, x in enumerate(plan) if "Union" in x)
    team = {r.origid: r.patient.care_team for r in d.collect()}["P1"]
    assert team.care_manager == "Bob Care" and team.member_nrs == sorted(team.member_nrs)
