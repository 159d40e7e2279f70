import uuid

from carelake.session import sizing
from carelake.sources.tables import read_bucketed, write_bucketed


def test_bucketed_tables_avoid_source_shuffle(spark, tables):
    write_bucketed(tables, "carelake_test", 4)
    t = read_bucketed(spark, "carelake_test")
    agg = t["adt_encounter"].groupBy("origid").count()
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan                 # the bucketed scan already has the distribution
    assert agg.count() == tables["adt_encounter"].select("origid").distinct().count()


def test_sizing():
    conf = sizing(100 << 40, 1000, 8)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert int(sizing(1 << 20, 10, 4)["spark.sql.shuffle.partitions"]) == 80


def test_records_from_bucketed_tables(spark, tables, docs):
    from pyspark.sql import functions as F

    from carelake.plans.document import build_documents
    from tests.fixtures import AS_OF
    write_bucketed(tables, "carelake_test2", 4)
    b = build_documents(read_bucketed(spark, "carelake_test2"), AS_OF)
    to_s = lambda df: sorted(r.j for r in df.select(F.to_json("patient").alias("j")).collect())
    assert to_s(b) == to_s(docs)


def test_build_job(spark, tables, tmp_path):
    """The batch job end to end on the fixtures written as Parquet folders."""
    from carelake import jobs
    src = tmp_path / "extract"
    raw = {"mra1_encounter": "patient_id", "drfirst_patient_medications": "patientid",
           "transportation_benefit": "orig_id"}
    for name, df in tables.items():
        (df.withColumnRenamed("origid", raw[name]) if name in raw else df).write.parquet(str(src / name))
    out = tmp_path / "out"
    jobs.build(jobs.argparse.Namespace(
        master=None, bucketed=None, tables=str(src), fmt="parquet", out=str(out), as_of="2023-02-28",
        cc_version=None, part_size=20000, buckets=4, how="inner"))
    assert spark.read.json(str(out / "records")).count() == 2
    assert spark.read.parquet(str(out / "findings")).count() == 0
    assert spark.read.parquet(str(out / "duplicates")).count() == 0


def test_visits_and_measure_jobs(spark, tables, tmp_path):
    import json

    from carelake import jobs
    from carelake.plans import measure_defs as MD
    src = tmp_path / "extract"
    tables["mra1_encounter"].withColumnRenamed("origid", "patient_id").write.parquet(str(src / "mra1_encounter"))
    jobs.visits(jobs.argparse.Namespace(master=None, tables=str(src), fmt="parquet", out=str(tmp_path / "v"),
                                        settings="SNF,Emergency", start="2023-01-01", end="2023-01-31",
                                        patient_id=None, facility=None))
    v = spark.read.parquet(str(tmp_path / "v"))
    assert sorted(r.EncounterNr for r in v.collect()) == ["M1"]
    from carelake.plans.document import build_documents
    from tests.fixtures import AS_OF
    recs = tmp_path / "records"
    build_documents(tables, AS_OF, part_size=2).write.parquet(str(recs))
    d = tmp_path / "measure.json"
    d.write_text(json.dumps(MD.htn_definition()))
    jobs.measure(jobs.argparse.Namespace(master=None, definition=str(d), records=str(recs),
                                         out=str(tmp_path / "m"), as_of="2025-06-01", ungated="de-3"))
    wl = spark.read.parquet(str(tmp_path / "m" / "worklist"))
    assert [r.origid for r in wl.collect()] == ["P1"]


def test_refresh_job_once(spark, tables, tmp_path):
    """The change-stream job end to end: fixture tables as Parquet folders,
    one change file, ``--once`` (available-now trigger)."""
    from carelake import jobs
    from carelake.streaming.refresh import RecordStore
    src = tmp_path / "extract"
    raw = {"mra1_encounter": "patient_id", "drfirst_patient_medications": "patientid",
           "transportation_benefit": "orig_id"}
    for name, df in tables.items():
        (df.withColumnRenamed("origid", raw[name]) if name in raw else df).write.parquet(str(src / name))
    ch = spark.createDataFrame([(1, 1, "2023-02-28 10:00:00", "mra_scorecard_alerts", "I", None, {"origid": "P1"})],
                               "event_id bigint, sequence bigint, change_ts string, `table` string, "
                               "op string, before map<string,string>, after map<string,string>")
    ch.write.json(str(tmp_path / "changes"))
    q = jobs.refresh(jobs.argparse.Namespace(master=None, changes=str(tmp_path / "changes"), tables=str(src),
                                             fmt="parquet", store=str(tmp_path / "store"), as_of="2023-02-28",
                                             buckets=4, every="1 minute", once=True,
                                             name=f"refresh-{uuid.uuid4().hex[:8]}"))
    q.awaitTermination()
    got = RecordStore(spark, str(tmp_path / "store"), n_buckets=4).read()
    assert [r.origid for r in got.select("origid").collect()] == ["P1"]
