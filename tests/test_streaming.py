import uuid

from pyspark.sql import functions as F

from carelake.plans.document import build_documents
from carelake.plans.routing import ROUTES
from carelake.session import shared_dir
from carelake.sources.tables import only_persons
from carelake.streaming.refresh import RecordStore, start
from tests.fixtures import AS_OF


def test_stream_refresh_matches_batch(spark, tables):
    base = shared_dir(spark, "test_stream", uuid.uuid4().hex)
    full = build_documents(tables, AS_OF)
    store = RecordStore(spark, f"{base}/records")
    store.write(build_documents(tables, "2022-01-01"), "init")
    rows = [(1, 1, "2023-02-28 10:00:00", "mra_scorecard_alerts", "I", None, {"origid": "P1"}),
            (1, 1, "2023-02-28 10:00:00", "mra_scorecard_alerts", "I", None, {"origid": "P1"}),  # replay
            (2, 2, "2023-02-28 10:01:00", "patient", "U", {"origid": "P2"}, {"origid": "P2"})]
    ch = spark.createDataFrame(rows, "event_id bigint, sequence bigint, change_ts string, `table` string, "
                                     "op string, before map<string,string>, after map<string,string>")
    ch.write.json(f"{base}/changes")

    def build(t, todo):
        return build_documents(only_persons(t, todo), AS_OF, trigger="cdc")

    q = start(spark, f"{base}/changes", store=store, load_tables=lambda: tables, build=build, routes=ROUTES,
              name=f"t{uuid.uuid4().hex[:6]}", available_now=True)
    q.awaitTermination()
    got = store.read()
    strip = lambda df: sorted(r.j for r in df.select(F.to_json(F.col("patient").dropFields("_meta")).alias("j")).collect())
    assert strip(got) == strip(full)
    prov = {r.origid: (r.t, r.s) for r in got.select(
        "origid", F.col("patient._meta.trigger_source").alias("t"),
        F.col("patient._meta.cdc_sequence").alias("s")).collect()}
    assert prov == {"P1": ("mra_scorecard_alerts", 1), "P2": ("patient", 2)}     # C15, C16


def test_record_store_rewrites_only_touched_buckets(spark):
    root = shared_dir(spark, "test_store", uuid.uuid4().hex)
    store = RecordStore(spark, root, n_buckets=8, keep_manifests=2)
    base = spark.range(200).select(F.col("id").cast("string").alias("origid"), F.lit(0).alias("v"))
    store.write(base, "init")
    before = store.manifest()
    fresh = spark.createDataFrame([("7", 1), ("300", 1)], "origid string, v int")
    store.replace(fresh, "b1")
    after = store.manifest()
    changed = {b for b in after if after[b] != before.get(b)}
    touched = {r.b for r in fresh.select(store.bucket().alias("b")).collect()}
    assert changed == {str(b) for b in touched}
    got = {r.origid: r.v for r in store.read().collect()}
    assert len(got) == 201 and got["7"] == 1 and got["300"] == 1 and got["8"] == 0
    assert store.applied("b1") and not store.applied("b2")
    store.replace(spark.createDataFrame([("9", 2)], "origid string, v int"), "b2")
    store.replace(spark.createDataFrame([("10", 3)], "origid string, v int"), "b3")
    assert len(store._manifests()) == 2 and store.read().count() == 201


def test_deleted_person_loses_record(spark, tables):
    base = shared_dir(spark, "test_delete", uuid.uuid4().hex)
    store = RecordStore(spark, f"{base}/records", n_buckets=4)
    store.write(build_documents(tables, AS_OF), "init")
    after_delete = dict(tables)
    after_delete["patient"] = tables["patient"].filter("origid <> 'P2'")
    ch = spark.createDataFrame([(9, 9, "2023-02-28 11:00:00", "patient", "D", {"origid": "P2"}, None)],
                               "event_id bigint, sequence bigint, change_ts string, `table` string, "
                               "op string, before map<string,string>, after map<string,string>")
    ch.write.json(f"{base}/changes")
    q = start(spark, f"{base}/changes", store=store, load_tables=lambda: after_delete,
              build=lambda t, todo: build_documents(only_persons(t, todo), AS_OF),
              routes=ROUTES, name=f"d{uuid.uuid4().hex[:6]}", available_now=True)
    q.awaitTermination()
    assert sorted(r.origid for r in store.read().select("origid").collect()) == ["P1"]
