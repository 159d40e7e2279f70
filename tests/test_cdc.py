import datetime as dt
import re

from pyspark.sql import functions as F

from carelake.plans import cdc
from carelake.plans.document import build_documents, replace_documents
from carelake.plans.routing import ROUTES
from carelake.sources.tables import only_persons
from tests.fixtures import AS_OF

TS = dt.datetime(2023, 2, 28, 12, 0)


def _changes(spark, rows):
    return spark.createDataFrame(
        [(i, i, TS, t, op, b, a) for i, (t, op, b, a) in enumerate(rows, 1)], cdc.CHANGE_SCHEMA)


def test_routing_hops_and_deletes(spark, tables):
    ch = _changes(spark, [
        ("cpoe_item", "U", None, {"item_id": "7"}),                       # 3 hops (C7, C9)
        ("mra_scorecard_alerts", "D", {"origid": "P2"}, None),            # delete: before image (C12)
        ("personell", "U", None, {"nr": "2"}),                            # fan-out (C8)
        ("mra_member_history_data", "I", None, {"origid": "P1", "history_nr": "99"}),  # filtered (C4)
        ("unknown_table", "I", None, {"origid": "P1"}),
    ])
    aff = cdc.affected(ch, ROUTES, tables)
    got = {(r.table, r.origid) for r in aff.select("table", "origid").distinct().collect()}
    assert got == {("cpoe_item", "P1"), ("mra_scorecard_alerts", "P2"),
                   ("personell", "P1"), ("personell", "P2")}
    sec = {r.section for r in aff.filter(F.col("table") == "mra_scorecard_alerts").collect()}
    assert sec == {"alerts", "hedis_measures", "rule_flags"}
    todo = {r.origid: r for r in cdc.persons_to_rebuild(aff).collect()}
    assert set(todo) == {"P1", "P2"} and todo["P2"].cdc_sequence == 3


def test_reference_layout_parser():
    cfg = {"a": {"patient_id_col": "origid", "change_date_col": "d", "procedures": ["x"]},
           "b": {"patient_id_col": None, "join": {"fk_col": "fk", "table": "a", "ref_col": "id",
                                                   "patient_id_col": "origid", "extra_filter": {"k": 1},
                                                   "filter": "s IN ('A')"}, "procedures": ["y"]}}
    r = cdc.from_reference_layout(cfg)
    # the filter of a join is a predicate on the changed row, not on the parent
    assert r[0].key_col == "origid" and r[1].row_eq == {"k": 1}
    assert r[1].hops[0].filter is None and r[1].row_filter == "s IN ('A')" and r[1].row_cols == ("s",)


def test_both_images_are_routed(spark):
    """A row that moves from one person to another, or out of a filter, concerns both sides."""
    parents = {"a": spark.createDataFrame([("1", "P1"), ("2", "P2")], "id string, origid string")}
    routes = cdc.from_reference_layout({
        "t": {"patient_id_col": "origid", "procedures": ["x"]},
        "b": {"patient_id_col": None, "join": {"fk_col": "fk", "table": "a", "ref_col": "id", "patient_id_col": "origid",
                                               "filter": "s IN ('A')"}, "procedures": ["y"]}})
    ch = _changes(spark, [("t", "U", {"origid": "P8"}, {"origid": "P9"}), ("b", "U", {"fk": "1", "s": "A"}, {"fk": "1", "s": "Z"}),
                          ("b", "U", {"fk": "2", "s": "Z"}, {"fk": "2", "s": "Y"})])
    assert {(r.table, r.origid) for r in cdc.affected(ch, routes, parents).collect()} == {("t", "P8"), ("t", "P9"), ("b", "P1")}


def test_last_writer_wins(spark):
    ch = _changes(spark, [("t", "I", None, {"k": "1", "v": "a"}), ("t", "U", {"k": "1"}, {"k": "1", "v": "b"}),
                          ("t", "D", {"k": "1", "v": "b"}, None)])
    last = cdc.latest_changes(ch, ["k"]).first()
    assert last.op == "D" and last.sequence == 3


def test_incremental_rebuild_equals_full(spark, tables, docs):
    """Rebuilding only the routed persons from semi-joined tables gives the
    same record as the full build; replace keeps everyone else."""
    ch = _changes(spark, [("adt_encounter_icd_codes", "U", None, {"encounter_nr": "E1"})])
    todo = cdc.persons_to_rebuild(cdc.affected(ch, ROUTES, tables, prune=True)).checkpoint()
    assert [r.origid for r in todo.collect()] == ["P1"]
    fresh = build_documents(only_persons(tables, todo), AS_OF).cache()
    to_s = lambda df: sorted(r.j for r in df.select(F.to_json("patient").alias("j")).collect())
    assert to_s(fresh) == to_s(docs.filter("origid = 'P1'"))
    merged = replace_documents(docs.filter("origid = 'P2'"), fresh)
    assert sorted(r.origid for r in merged.select("origid").collect()) == ["P1", "P2"]


def test_changed_rows_only(spark):
    old = spark.createDataFrame([("a", True), ("b", None)], "k string, f boolean")
    new = spark.createDataFrame([("a", True), ("b", False)], "k string, f boolean")
    assert [r.k for r in cdc.changed_rows(old, new, "k", ["f"]).collect()] == ["b"]


def test_change_time_from_year_column(spark, tables):
    """C17: a year-valued change-date column becomes Jan 1 of that year."""
    ch = _changes(spark, [("mra_raf_patient", "I", None, {"origid": "P1", "year": "2022"})])
    aff = cdc.affected(ch, ROUTES, tables, prune=True)
    assert {r.change_ts.isoformat() for r in aff.collect()} == {"2022-01-01T00:00:00"}


def test_new_year_flips_capture_without_data_change(spark, tables):
    """Dec 31 → Jan 1: the same data gives a different capture result, and
    the date-driven refresh (C11) reports exactly the persons that changed."""
    from carelake.plans import sections as S
    old = S.hcc_capture_counts(tables, "2022-12-31")
    new = S.hcc_capture_counts(tables, "2023-01-01")
    o = {r.origid: (r.eligible_hccs, r.captured_hccs, r.gap_hccs) for r in old.collect()}
    n = {r.origid: (r.eligible_hccs, r.captured_hccs, r.gap_hccs) for r in new.collect()}
    assert o["P1"] == (2, 2, None) and n["P1"] == (2, 1, ["HCC-226"])
    flipped = cdc.changed_rows(old, new, "origid", ["captured_hccs", "gap_hccs"])
    assert [r.origid for r in flipped.collect()] == ["P1"]


def test_only_the_last_hop_makes_its_pairs_distinct(spark):
    """Repeated parent rows multiply nothing, though pairs of a hop before the
    last aren't shuffled and hashed for it: the next hop's collapse merges them."""
    ch = _changes(spark, [("codes", "U", None, {"code": "c1"}), ("codes", "D", {"code": "c1"}, None), ("codes", "I", None, {"code": "c2"})])
    parents = {"lines": spark.createDataFrame([("c1", "e1"), ("c1", "e1"), ("c1", "e2"), ("c2", "e2"), ("c2", None)], "code string, enc string"),
               "encounters": spark.createDataFrame([("e1", "P1"), ("e1", "P1"), ("e2", "P2"), (None, "P3")], "enc string, origid string")}
    route = cdc.Route("codes", "code", (cdc.Hop("lines", "code", "enc"), cdc.Hop("encounters", "enc", "origid")), ("a", "b"))
    aff = cdc.affected(ch, [route], parents)
    got = sorted((r.event_id, r.sequence, r.table, r.op, r.origid, r.section) for r in aff.collect())
    assert got == [(i, i, "codes", op, p, s) for i, op, p in [(2, "D", "P1"), (3, "I", "P2")] for s in "ab"]
    assert aff.schema.names == ["event_id", "sequence", "table", "op", "change_ts", "origid", "section"]
    plan = aff._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Aggregate \[_ref#\d+, _next#\d+\]", plan)) == 1
