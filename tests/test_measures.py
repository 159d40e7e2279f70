from pyspark.sql import functions as F

from carelake.plans import measure_defs as MD
from carelake.plans import measures as M
from tests.fixtures import AS_OF


def _eval(docs, measure, as_of=AS_OF):
    d = M.enrich_age(docs, as_of, root="patient")
    return {r.origid: r for r in M.evaluate(d, measure, as_of, root="patient").collect()}


def test_htn_measure_on_records(docs):
    m = MD.htn_measure(field_paths=MD.DOC_FIELDS)
    out = _eval(docs, m, "2025-06-01")   # inside the activation period
    p1 = out["P1"]
    assert p1["pc001_age_eligible"] and p1["pc001_has_hypertension_dx"]   # I10 on encounter and problem list
    assert not p1["pc001_has_exclusion_proc"] and p1["pc001_candidate"]
    assert p1["pc001_bp_measurement_present"] is False                     # no 3077F/3080F
    assert not out["P2"]["pc001_has_hypertension_dx"] and not out["P2"]["pc001_candidate"]
    # outside the activation period nobody is a candidate
    assert not _eval(docs, m, AS_OF)["P1"]["pc001_candidate"]


def test_null_array_semantics(spark):
    schema = "origid string, encounters array<struct<procedures:array<struct<billing_code:string,procedure_date:date>>>>"
    df = spark.createDataFrame([("A", None), ("B", [{"procedures": None}]),
                                ("C", [{"procedures": [{"billing_code": "g8950", "procedure_date": None}]}])],
                               schema)
    p = [M.Path("encounters[].procedures[].billing_code", "procedure_date")]
    none_of = M.Element("x", "excl", p, "not_contains", ["G8950"], case_sensitive=False)
    any_of = M.Element("y", "any", p, "contains", ["G8950"], case_sensitive=False)
    out = {r.origid: r for r in M.evaluate(df, M.Measure("m", "", [none_of, any_of]), AS_OF).collect()}
    assert out["A"]["x"] is True and out["A"]["y"] is False     # NULL array: none-of passes, any-of fails
    assert out["B"]["x"] is True and out["B"]["y__data"] is False
    assert out["C"]["x"] is False and out["C"]["y"] is True     # case-insensitive


def test_latest_vs_single_and_window(spark):
    schema = "origid string, encounters array<struct<procedures:array<struct<billing_code:string,procedure_date:date>>>>"
    import datetime as dt
    rows = [("A", [{"procedures": [{"billing_code": "EXC", "procedure_date": dt.date(2020, 1, 1)}]},
                   {"procedures": [{"billing_code": "OK", "procedure_date": dt.date(2022, 1, 1)}]}])]
    df = spark.createDataFrame(rows, schema)
    p = [M.Path("encounters[].procedures[].billing_code", "procedure_date")]
    single = M.Element("s", "", p, "not_contains", ["EXC"])
    latest = M.Element("l", "", p, "not_contains", ["EXC"], value_mode="latest")
    window = M.Element("w", "", p, "contains", ["EXC"], date_from="2021-01-01")
    r = M.evaluate(df, M.Measure("m", "", [single, latest, window]), AS_OF).first()
    assert r["s"] is False and r["l"] is True and r["w"] is False


def test_same_element_vs_separate(docs):
    same = MD.gap_check_element(["Controlling High BP"])
    out = _eval(docs, M.Measure("g", "", [same]))
    assert out["P1"]["gap-check"] is True and out["P2"]["gap-check"] is False


def test_two_way_nested_equals_relational(tables, docs):
    """The any-of rule over nested records equals a relational semi-join."""
    el = M.Element("dx", "dx", MD.DOC_FIELDS["problem_code"], "contains", ["I10"])
    nested = {r.origid for r in M.evaluate(docs, M.Measure("m", "", [el]), AS_OF, root="patient")
              .filter("dx").collect()}
    icd = tables["adt_encounter_icd_codes"].filter(F.col("diagnosis_code") == "I10")
    rel = tables["adt_encounter"].join(icd, "encounter_nr", "left_semi").select("origid") \
        .join(docs.select("origid"), "origid", "left_semi")
    assert nested == {r.origid for r in rel.collect()}


def test_report_rate_worklist(docs):
    m = MD.htn_measure()
    ev = M.evaluate(M.enrich_age(docs, "2025-06-01"), m, "2025-06-01", root="patient")
    rep = {(r.origid, r.element_id): r.outcome for r in M.report(ev, m).collect()}
    assert rep[("P1", "de-2")] == "pass" and rep[("P2", "de-2")] == "blocked"
    rate = M.rate(ev, m, []).first()
    assert (rate.denominator, rate.numerator, rate.rate, rate.meets_goal) == (2, 1, 50.0, False)
    assert [r.origid for r in M.worklist(ev, m).collect()] == ["P1"]


def test_parts_evaluation_equals_whole(spark, tables, docs):
    from carelake.plans.document import build_documents
    m = MD.htn_measure()
    whole = {r.origid: r.asDict() for r in M.evaluate(docs, m, "2025-06-01", root="patient").collect()}
    parts = build_documents(tables, AS_OF, part_size=2)
    split = {r.origid: r.asDict() for r in M.evaluate_parts(parts, m, "2025-06-01", root="patient").collect()}
    assert whole == split
    el = M.Element("x", "", [M.Path("encounters[].diagnoses[].icd_code", "onset_date")], "contains", ["I10"],
                   value_mode="latest")
    a = {r.origid: r.x for r in M.evaluate(docs, M.Measure("m", "", [el]), AS_OF, root="patient").collect()}
    b = {r.origid: r.x for r in M.evaluate_parts(parts, M.Measure("m", "", [el]), AS_OF, root="patient").collect()}
    assert a == b


def _rows(df, *drop):
    return sorted((tuple(sorted((k, v) for k, v in r.asDict().items() if k not in drop)) for r in df.collect()), key=repr)


ELEMENTS = [
    M.Element("dx", "", MD.DOC_FIELDS["problem_code"], "contains", ["i10"], case_sensitive=False, flag="f", flag_on="match"),
    M.Element("dx-latest", "", MD.DOC_FIELDS["problem_code"], "contains", ["I10"], value_mode="latest"),
    M.Element("none", "", MD.DOC_FIELDS["procedure_code"], "not_contains", ["99213"]),
    M.Element("none-latest", "", MD.DOC_FIELDS["procedure_code"], "not_contains", ["99213"], value_mode="latest", null_handling="include"),
    M.Element("since", "", MD.DOC_FIELDS["procedure_code"], "contains", ["99213"], date_from="2023-01-01", date_to="2023-01-31"),
    M.Element("null-fails", "", [M.Path("hedis_measures[].measure_name")], "eq", "Controlling High BP"),
    M.Element("null-passes", "", [M.Path("hedis_measures[].measure_name")], "eq", "nothing like it", null_handling="include"),
    M.Element("no-data-passes", "", [M.Path("chronic_conditions[].icd_code", "last_seen_date")], "eq", "x", null_handling="include"),
    M.Element("same", "", [M.Path("hedis_measures[].measure_name")], "contains", ["Controlling High BP"], also=[("gap_open", "eq", True)]),
    M.Element("age", "", [M.Path("demographics.age")], "between", 18, 60, required=False),
    M.Element("flat-or-array", "", [M.Path("demographics.sex"), M.Path("chronic_conditions[].icd_code")], "contains", ["X", "I10"]),
]


def test_items_equal_nested_records(tables, docs):
    """Terms of item rows and of nested records give the same outcomes, element by element."""
    from carelake.plans.measure_sources import item_sources, measure_persons
    m = M.Measure("all", "", ELEMENTS, ungated=["since"])
    nested = M.evaluate(docs, m, AS_OF, root="patient")
    items = M.evaluate_items(measure_persons(tables, AS_OF), item_sources(tables, AS_OF), m, AS_OF)
    assert _rows(items) == _rows(nested)
    whole = MD.htn_measure()
    a = M.evaluate(docs, whole, "2025-06-01", root="patient")
    b = M.evaluate_items(measure_persons(tables, AS_OF), item_sources(tables, AS_OF), whole, "2025-06-01")
    assert _rows(a) == _rows(b) and b.where("pc001_candidate").count() == 1


def test_items_need_one_shuffle_on_the_person(spark, tables):
    """Item rows that carry the person go through one exchange."""
    from carelake.plans.measure_sources import measure_persons
    rows = spark.range(1000).selectExpr("cast(id % 7 as string) origid", "cast(id as string) measure_name", "id % 2 = 0 gap_open")
    m = M.Measure("g", "", [MD.gap_check_element(["3"])])
    persons = measure_persons(tables, AS_OF).select("origid").checkpoint()
    plan = M.evaluate_items(persons, {"hedis_measures[]": rows}, m, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and "collect_list" not in plan


def test_newest_of_two_sources(spark):
    import datetime as dt
    d = lambda y: dt.date(y, 1, 1)
    el = M.Element("x", "", [M.Path("a[].v", "d"), M.Path("b[].v", "d")], "contains", ["yes"], value_mode="latest")
    m = M.Measure("m", "", [el])
    schema = "origid string, a array<struct<v:string,d:date>>, b array<struct<v:string,d:date>>"
    people = [("old yes", [("yes", d(2020))], [("no", d(2021))]), ("new yes", [("no", d(2020))], [("yes", d(2021))]),
              ("tie", [("no", d(2020))], [("yes", d(2020))]), ("one", [("yes", None)], None), ("none", None, [])]
    df = spark.createDataFrame(people, schema)
    want = {"old yes": False, "new yes": True, "tie": True, "one": True, "none": False}
    assert {r.origid: r.x for r in M.evaluate(df, m, AS_OF).collect()} == want
    rows = {f"{c}[]": df.select("origid", F.explode(c).alias("e")).select("origid", "e.*") for c in "ab"}
    assert {r.origid: r.x for r in M.evaluate_items(df.select("origid"), rows, m, AS_OF).collect()} == want


def test_population_of_a_definition(docs):
    import pytest
    team = lambda n: M.from_definition(MD.htn_definition({"type": "individual", "selection": str(n)}), MD.DOC_FIELDS)
    people = lambda m: sorted(r.origid for r in M.evaluate(docs, m, "2025-06-01", root="patient").collect())
    assert team(2).filters["careTeam"] == 2 and team(2).performance_year == 2026
    assert people(team(1)) == ["P1"] and people(team(2)) == ["P1", "P2"] and people(team(116)) == []
    d = MD.htn_definition()
    for bad in ({"populationType": "acute"}, {"performanceYear": 2031}, {"careTeam": {"type": "group", "selection": "1"}}):
        with pytest.raises(ValueError):
            M.from_definition({**d, "measureInfo": {**d["measureInfo"], "filteringHierarchy": bad}}, MD.DOC_FIELDS)
    d["dataElements"] = [dict(e, effectiveDateField="other_date", allowNull="1") for e in d["dataElements"]]
    m = M.from_definition(d, MD.DOC_FIELDS)
    assert {p.date for e in m.elements for p in e.paths if p.parts[0]} == {"other_date"} and {e.null_handling for e in m.elements} == {"include"}
