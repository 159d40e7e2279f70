"""Joins of many narrow rows keep the session's shuffle partitions, so a task's memory doesn't grow with the data."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from carelake.plans import analogs as A
from carelake.sources.driver import Tables

SF = "/root/testdata/sf0.001"


@pytest.fixture
def merging(spark):
    """Without broadcasts, adaptive execution makes one partition of tables as small as these."""
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    old = {k: spark.conf.get(k, None) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_diagnoses(merging):
    n = int(merging.conf.get("spark.sql.shuffle.partitions"))
    assert A.diagnoses(Tables(merging, SF)).rdd.getNumPartitions() == n > 1


def test_files_are_written_gzipped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(A, "shared_dir", lambda *parts: str(tmp_path / "files"))
    df = A.doc_files(spark, SF)
    files = [f for f in (tmp_path / "files").rglob("*.json*") if f.name[0] != "."]
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert df.count() == Tables(spark, SF).customer.count()


def _plan(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_split_records_join_narrow_rows_only(merging):
    """An encounter that has its lines isn't joined any more: not before the gather by person, nor after it."""
    plan = _plan(merging, A.person_records(Tables(merging, SF), part_size=3)).split("ObjectHashAggregate")
    assert len(plan) > 4 and not any("Join" in between for between in plan[:3])


def test_split_records_hold_the_items_of_whole_ones(spark):
    t = Tables(spark, SF)
    parts, whole = A.person_records(t, part_size=4).cache(), A.person_records(t).cache()
    assert parts.where("part_no >= n_parts").count() == 0 and parts.where("part_no = 0").count() == whole.count()
    assert parts.groupBy("origid").agg(F.count_distinct("n_parts").alias("n")).where("n > 1").count() == 0
    for a in ("encounters", "chronic_conditions", "hedis_measures"):
        items = lambda d: sorted(map(str, d.select("origid", F.explode(a).alias("x")).collect()))
        assert items(parts) == items(whole) != []


def test_texts_of_an_encounter_are_made_after_the_last_exchange(merging):
    """Dates cross the exchanges as dates, and a procedure without its id and day."""
    from carelake.plans import sections as S
    from carelake.sources.derived import AS_OF, derive
    e = S.encounters(derive(Tables(merging, SF)), AS_OF, S.ITEMS).select("encounters._v.*").schema
    assert e["dates"].dataType["discharge_date"].dataType.typeName() == "date" and "tcm_7day_deadline" not in e["dates"].dataType.names
    assert e["procedures"].dataType.elementType.names == ["billing_code", "cpt_modifier", "revenue_code"]
    assert e["enc_medications"].dataType.elementType["start_date"].dataType.typeName() == "timestamp"


def test_hot_keys_share_the_exchanges_of_their_items(merging):
    """The parts of a person's conditions come from the rows that are dealt to them, not from a second join of lines and orders."""
    plan = _plan(merging, A.person_records(Tables(merging, SF), part_size=3))
    own = [x for x in plan.splitlines() if re.search(r"Exchange hashpartitioning\(origid#\d+L?, code#", x) and "Reused" not in x]
    assert len(own) == 1


def test_conditions_of_split_records_keep_the_partitions(merging):
    plan = _plan(merging, A.person_records(Tables(merging, SF), part_size=3))
    assert re.search(r"Exchange hashpartitioning\(origid#\d+L?, \d+\), REPARTITION_BY_NUM", plan)


def test_an_encounter_marks_itself(merging):
    """No rows cross to the encounter just to say that it's there."""
    t = Tables(merging, SF)
    assert "_here" not in _plan(merging, A.person_records(t, part_size=3)) + _plan(merging, A.person_records(t))


def test_coded_lines(merging):
    n = int(merging.conf.get("spark.sql.shuffle.partitions"))
    assert A.coded_lines(Tables(merging, SF)).rdd.getNumPartitions() == n > 1


def test_parts_are_made_in_all_partitions(merging):
    """A few bytes a person become a row for each of their parts, so these tasks aren't merged by their bytes."""
    plan = _plan(merging, A.person_records(Tables(merging, SF), part_size=3)).splitlines()
    at = next(i for i, x in enumerate(plan) if "explode(sequence" in x)
    assert "REPARTITION_BY_NUM" in next(x for x in plan[at:] if "Exchange" in x)


def test_lines_meet_their_orders_once(merging):
    """A person's conditions come from the encounters that have their lines: one scan of the lines, moved to part and to encounter."""
    plan = _plan(merging, A.person_records(Tables(merging, SF), part_size=3))
    assert plan.count("FileScan parquet [l_orderkey") == 1 and not re.search(r"Exchange hashpartitioning\(l_orderkey#", plan)


def test_conditions_are_counted_where_they_are_dealt(merging):
    """The count of a person's conditions reads the exchange that deals them; only its result moves."""
    plan = _plan(merging, A.person_records(Tables(merging, SF), part_size=3))
    assert re.search(r"ReusedExchange \[origid#\d+L?, code#.*REPARTITION_BY_NUM", plan)


def test_sort_keys_cross_once(merging):
    """What an item is sorted by isn't in its payload too."""
    plan = _plan(merging, A.person_records(Tables(merging, SF), part_size=3))
    assert "_v, struct(icd_code, code#" in plan and not re.search(r"_v, struct\((id, |icd_code, code#\d+, (onset_date|last_seen_date))", plan)


def test_an_order_key_of_two_persons(spark, tmp_path):
    """Lines count for every order with their key, as the SQL joins them."""
    from carelake.plans.registry import ORACLES
    con = duckdb.connect()
    for name in ("customer", "part", "lineitem", "events", "orders"):
        rows = f"SELECT * FROM '{SF}/{name}.parquet'"
        if name == "orders":
            rows += f" UNION ALL SELECT * REPLACE (1 + o_custkey % (SELECT max(c_custkey) FROM '{SF}/customer.parquet') AS o_custkey) FROM '{SF}/orders.parquet'"
        con.execute(f"COPY ({rows}) TO '{tmp_path}/{name}.parquet'")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    want = sorted(con.execute(ORACLES["measure_full_parts"]).fetchall())
    assert sorted(tuple(r) for r in A.measure_full_parts(spark, str(tmp_path)).collect()) == want != []


def test_encounters_cross_once_without_their_children(merging):
    """To the encounter go its keys and the children's own columns; the rest of an encounter goes to the person, and no
    exchange stands above a union of parts that are dealt already."""
    from carelake.plans.document import build_documents
    from carelake.sources.derived import AS_OF, derive
    plan = _plan(merging, build_documents(derive(Tables(merging, SF)), AS_OF, sections=["encounters"]))
    to_encounter = [x for x in plan.splitlines() if re.search(r"Exchange hashpartitioning\(encounter_nr#\d+, \d+\), REPARTITION_BY_NUM", x)]
    assert len(to_encounter) == 4 and not re.search(r"Exchange hashpartitioning\((origid|encounter_nr)#\d+, \d+\), ENSURE_REQUIREMENTS[^\n]*\n[^\n]*Aggregate\(keys=\[\w+#\d+\], functions=\[partial_collect", plan)


def test_encounters_apart_equal_whole_ones(spark):
    from carelake.plans import sections as S
    from carelake.plans.document import build_documents
    from carelake.sources.derived import AS_OF, derive
    t = derive(Tables(spark, SF))
    whole = S.encounters(t, AS_OF, 10**6).select("origid", F.explode("encounters").alias("x"))
    for size in (None, 3):
        apart = build_documents(t, AS_OF, sections=["encounters"], part_size=size).select("origid", F.explode("patient.encounters").alias("x"))
        assert apart.schema["x"].dataType.names == whole.schema["x"].dataType.names
        text = lambda d: sorted(map(str, d.select("origid", F.to_json("x")).collect()))
        assert text(apart) == text(whole) != []


def test_tables_of_lines_share_one_exchange(merging):
    """Lines are dealt to their orders once for all tables made of them, with the same rows in each."""
    from carelake.plans.document import build_documents
    from carelake.sources.derived import AS_OF, derive
    shared, own = derive(Tables(merging, SF), share_lines=True), derive(Tables(merging, SF))
    plan = _plan(merging, build_documents(shared, AS_OF, sections=["encounters", "labs", "medications"]))
    dealt = [x for x in plan.splitlines() if re.search(r"Exchange hashpartitioning\(l_orderkey#", x) and "Reused" not in x]
    assert len(dealt) == 1 and plan.count("ReusedExchange") >= 4
    for n in ("adt_encounter_icd_codes", "mra_uamcc_details", "cclf_encounter_patient_medication", "drfirst_patient_medications", "cpoe_result_values"):
        hashed = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
        assert hashed(shared[n]) == hashed(own[n]) and hashed(own[n])[0] > 0


def test_labs_and_medications_cross_once(spark):
    """Items hold the source's columns, dates as dates and none twice; the elements made of them are those of whole arrays."""
    from carelake.plans import sections as S
    from carelake.plans.document import build_documents
    from carelake.sources.derived import AS_OF, derive
    t = derive(Tables(spark, SF))
    d = build_documents(t, AS_OF, sections=["labs", "medications"]).select("origid", "patient.*")
    for name, items, whole in (("labs", S.labs(t, S.ITEMS), S.labs(t)), ("medications", S.medications(t, AS_OF, S.ITEMS), S.medications(t, AS_OF))):
        item = items.schema[name].dataType
        assert not set(item["_v"].dataType.names) & {"id", "result_id", "item_id", "result_date", "start_date"}
        text = lambda df: sorted(map(str, df.where(F.col(name).isNotNull()).select("origid", F.to_json(name)).collect()))  # noqa: B023, E731
        assert d.schema[name].dataType.elementType.names == whole.schema[name].dataType.elementType.names
        assert text(d) == text(whole) != []
