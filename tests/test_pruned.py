"""Refreshes that read only the partitions of what changed, and routes through a cross-reference."""

import re
import uuid

import pytest
from pyspark.sql import functions as F

from carelake.plans.cdc import affected
from carelake.plans.document import build_documents
from carelake.plans.routing import with_xref
from carelake.session import shared_dir
from carelake.sources.tables import PART_KEYS, PartitionedTables, only_persons, write_partitioned
from tests.fixtures import AS_OF


@pytest.fixture(scope="module")
def stored(spark, tables):
    base = shared_dir(spark, "pruned", uuid.uuid4().hex)
    write_partitioned(tables, base, n_parts=32)
    return PartitionedTables(spark, base)


def _text(df):
    return sorted(r[0] for r in df.select(F.to_json("patient")).collect())


def test_partitioned_tables_are_the_tables(stored, tables):
    assert set(stored) == set(tables) and len(stored) == len(tables)
    for n in ("patient", "adt_encounter_icd_codes", "personell"):
        assert sorted(map(str, stored[n].select(tables[n].columns).collect())) == sorted(map(str, tables[n].collect()))
    with pytest.raises(KeyError):
        stored["no such table"]


def test_a_refresh_scans_the_partitions_of_its_persons(spark, stored, docs):
    one = spark.createDataFrame([("P1",)], "origid string")
    own = only_persons(stored, one)
    built = build_documents(own, AS_OF)
    assert _text(built) == _text(docs.where("origid = 'P1'"))
    for name in PART_KEYS:
        if name not in stored:
            continue
        plan = own[name]._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]*_part", plan), name
    # one person's rows stand in one partition of 32; both persons' files are there
    alone = stored.scan("mra_scorecard_alerts", stored.parts(one))
    assert 0 < len(alone.inputFiles()) <= len(stored["mra_scorecard_alerts"].inputFiles())
    assert stored.parts(one) == stored.parts(one.union(one)) and len(stored.parts(one)) == 1


def test_nobody_to_rebuild(spark, stored):
    none = spark.createDataFrame([], "origid string")
    assert build_documents(only_persons(stored, none), AS_OF, sections=["labs", "alerts"]).count() == 0


def test_records_through_a_cross_reference(spark, tables, docs):
    t = dict(tables)
    t["dc_bene_alignment_rostr_m01"] = tables["dc_bene_alignment_rostr_m01"].withColumn("mm_curr_mbi_id", F.concat(F.lit("MBI-"), "mm_curr_mbi_id"))
    t["person_xref"] = tables["patient"].select(F.concat(F.lit("MBI-"), "origid").alias("ref"), "origid")
    own = only_persons(t, spark.createDataFrame([("P2",)], "origid string"), xref="person_xref")
    assert own["dc_bene_alignment_rostr_m01"].select("mm_curr_mbi_id").distinct().collect() == [("MBI-P2",)]
    built = build_documents(own, AS_OF, xref=own["person_xref"])
    assert _text(built) == _text(docs.where("origid = 'P2'"))


def test_roster_changes_reach_persons_of_both_images(spark, tables):
    t = dict(tables)
    t["person_xref"] = spark.createDataFrame([("X1", "P1"), ("X2", "P2"), ("X2", "P3")], "ref string, origid string")
    schema = "event_id bigint, sequence bigint, change_ts timestamp, `table` string, op string, before map<string,string>, after map<string,string>"
    al = {"ALIGN_STATUS_CODE": "AL"}
    roster = "dc_bene_alignment_rostr_m01"
    ch = spark.createDataFrame([
        (1, 1, None, roster, "U", {"mm_curr_mbi_id": "X1", **al}, {"mm_curr_mbi_id": "X2", **al}),
        (2, 2, None, roster, "I", None, {"mm_curr_mbi_id": "X9", **al}),
        (3, 3, None, "person_xref", "U", {"ref": "X5", "origid": "P7"}, {"ref": "X5", "origid": "P8"})], schema)
    got = {(r.table, r.origid) for r in affected(ch, with_xref(), t).collect()}
    assert got == {(roster, "P1"), (roster, "P2"), (roster, "P3"), ("person_xref", "P7"), ("person_xref", "P8")}
