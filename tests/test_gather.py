"""The union-and-aggregate assembly against joins, and its plan."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from carelake.operators.gather import gather, item_rows
from carelake.plans.document import build_documents
from tests.fixtures import AS_OF


@pytest.fixture(scope="module")
def frames(spark):
    present = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    one = spark.createDataFrame([("a", 1, None), ("b", None, None), ("x", 9, "not present")], "k string, n int, t string")
    many = spark.createDataFrame([("a", i, f"v{i}") for i in range(7)] + [("b", None, "null order"), ("x", 1, "gone")], "k string, o int, v string")
    return present, one, many


def test_gather(frames):
    present, one, many = frames
    g = gather(present, "k", {"one": one}, {"up": item_rows(many, "k", ["o"], ["v"], "up"), "down": item_rows(many, "k", ["o"], ["v"], "down")}, desc={"up": False})
    got = {r["k"]: r for r in g.collect()}
    assert set(got) == {"a", "b", "c", None}
    assert tuple(got["a"]["one"]) == (1, None) and tuple(got["b"]["one"]) == (None, None)
    assert got["c"]["one"] is None and got["c"]["up"] is None and got[None]["down"] is None
    assert [x["v"] for x in got["a"]["up"]] == [f"v{i}" for i in range(7)] == [x["v"] for x in got["a"]["down"]][::-1]


def test_gather_splits_a_hot_key(frames):
    present, one, many = frames
    rows = gather(present, "k", {"one": one}, {"items": item_rows(many, "k", ["o"], ["v"], "items")}, part_size=2).collect()
    parts = defaultdict(list)
    for r in rows:
        parts[r["k"]].append(r)
    assert set(parts) == {"a", "b", "c", None} and {r["n_parts"] for r in parts["a"]} == {4}
    assert sorted(x["v"] for r in parts["a"] for x in r["items"] or []) == [f"v{i}" for i in range(7)]
    assert [r["part_no"] for r in parts["a"] if r["one"]] == [0]
    assert len(parts["b"]) == 1 and parts["b"][0]["n_parts"] == 1


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sections_meet_in_one_aggregate(spark, tables):
    """No section is joined onto the persons, whichever way Spark joins."""
    docs = build_documents(tables, "2023-02-27")     # another day than the cached records
    joins = re.findall(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join \[(\w+)#", _plan(docs))
    # the roster meets the patients, appointments the account; encounters meet their codes and results
    assert joins.count("origid") <= 3


def test_small_memory_and_no_broadcast(spark, tables, docs):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        as_text = lambda d: sorted(r[0] for r in d.select(F.to_json("patient")).collect())
        assert as_text(build_documents(tables, AS_OF)) == as_text(docs)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_chosen_sections_read_their_tables_alone(spark, tables, docs):
    some = ["labs", "rule_flags", "uamcc", "_meta"]
    part = build_documents(tables, AS_OF, sections=some)
    assert set(part.schema["patient"].dataType.names) == set(some)
    as_text = lambda d: sorted(r[0] for r in d.select(F.to_json(F.struct("origid", *[f"patient.{s}" for s in some]))).collect())
    assert as_text(part) == as_text(docs)
    lone = build_documents({k: v for k, v in tables.items() if k in ("patient", "dc_bene_alignment_rostr_m01", "sdoh_meal_plan")}, AS_OF, sections=["demographics"])
    assert lone.select("patient.demographics.age").count() == 2      # no other table is asked for
    with pytest.raises(ValueError, match="no such sections"):
        build_documents(tables, AS_OF, sections=["labz"])


def test_gather_by_the_name_of_its_rows(frames):
    """Keys that one of the rows holds need no mark; a row of NULLs alone is one too."""
    present, one, many = frames
    items = {"items": item_rows(many, "k", ["o"], ["v"], "items")}
    as_text = lambda d: sorted(map(str, d.collect()))
    for size in (None, 2):
        assert as_text(gather("one", "k", {"one": one}, items, part_size=size)) == as_text(gather(one.select("k"), "k", {"one": one}, items, part_size=size)) != []


def test_gather_unpacks_sort_keys(frames):
    """An element can be made of its item's sort keys, which needn't be in the payload, and items can hold the keys."""
    present, one, many = frames
    items = {"items": item_rows(many, "k", ["o", "v"], [], "items")}
    g = gather("items", "k", {"one": one}, items, unpack={"items": lambda x: F.struct(x["_o1"].alias("v"), x["_o0"].alias("o"))})
    got = {r["k"]: [tuple(x) for x in r["items"]] for r in g.collect()}
    assert got == {"a": [(f"v{i}", i) for i in reversed(range(7))], "b": [("null order", None)], "x": [("gone", 1)]}
