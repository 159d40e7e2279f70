"""The record store: deltas, tombstones, compaction."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from carelake.session import shared_dir
from carelake.streaming.store import RecordStore

SCHEMA = "origid string, v int, s struct<a:array<int>,b:string>"


def _store(spark, **kw):
    return RecordStore(spark, shared_dir(spark, "store", uuid.uuid4().hex), **{"n_buckets": 4, "max_ratio": 1e9, "max_deltas": 99, **kw})


def _df(spark, rows):
    return spark.createDataFrame([(k, v, None if v is None else ([v, None], str(v))) for k, v in rows], SCHEMA)


def _ids(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "origid string")


def _got(store):
    df = store.read()
    return {} if df is None else {r.origid: r.v for r in df.collect()}


def test_a_replace_writes_nobody_else(spark):
    store = _store(spark)
    store.write(_df(spark, [(str(i), 0) for i in range(500)]))
    store.replace(_df(spark, [("7", 1)]), "b1")
    written = spark.read.parquet(f"{store.root}/batch=b1")
    assert [(r.origid, r.v) for r in written.collect()] == [("7", 1)]
    store.replace(_df(spark, []), "b2", persons=_ids(spark, ["8", "9"]))          # deleted at the source
    assert sorted(r.origid for r in spark.read.parquet(f"{store.root}/batch=b2").collect()) == ["8", "9"]
    got = _got(store)
    assert len(got) == 498 and got["7"] == 1 and got["10"] == 0 and "8" not in got


def test_random_histories(spark):
    """Any order of replaces, deletes and compactions reads as a dictionary does."""
    rng = random.Random(5)
    store = _store(spark, keep_manifests=2)
    want = {str(i): 0 for i in range(30)}
    store.write(_df(spark, want.items()))
    for step in range(8):
        ids = [str(rng.randrange(40)) for _ in range(6)]
        fresh = {i: step + 1 for i in ids if rng.random() < 0.7}
        store.replace(_df(spark, fresh.items()), f"b{step}", persons=_ids(spark, ids + ids[:2]))
        for i in ids:
            want.pop(i, None)
        want.update(fresh)
        if step % 3 == 2:
            before = store.due(0.1)
            assert store.compact(0.1) == before and not store.due(0.1)
        assert _got(store) == want
        assert store.applied(f"b{step}") and not store.applied(f"b{step + 1}")
    store.compact(0.0)
    assert _got(store) == want and all(not e["deltas"] for e in store.state()["buckets"].values())
    nested = {r.origid: r.s for r in store.read().collect()}
    assert all(nested[i].a == [v, None] and nested[i].b == str(v) for i, v in want.items())


def test_due_by_rows_and_by_deltas(spark):
    store = _store(spark, n_buckets=1, max_ratio=0.5, max_deltas=3)
    store.write(_df(spark, [(str(i), 0) for i in range(100)]))
    for n in range(3):
        store.replace(_df(spark, [("1", n)]), f"b{n}")
    assert store.due() == []                                   # three rows, three deltas
    store.replace(_df(spark, [("1", 9)]), "b3")
    assert store.due() == ["0"] and store.compact() == ["0"] and store.due() == []
    store.replace(_df(spark, [(str(i), 1) for i in range(60)]), "b4")
    assert store.due() == ["0"]                                # 60 rows of 100


def test_all_persons_of_a_bucket_go(spark):
    store = _store(spark, n_buckets=2)
    store.write(_df(spark, [("a", 1), ("b", 1), ("c", 1), ("d", 1)]))
    store.replace(_df(spark, []), "gone", persons=_ids(spark, ["a", "b", "c", "d"]))
    assert _got(store) == {}
    store.compact(0.0)
    assert store.state()["buckets"] == {} and store.read() is None
    store.replace(_df(spark, [("a", 2)]), "back")
    assert _got(store) == {"a": 2}


def test_unused_folders_go_and_a_reader_keeps_its_state(spark):
    store = _store(spark, keep_manifests=2, n_buckets=1)
    store.write(_df(spark, [("a", 1), ("b", 1)]))
    reading = store.read()
    store.replace(_df(spark, [("a", 2)]), "b1")
    assert sorted(r.v for r in reading.collect()) == [1, 1]     # the state of the manifest it took
    store.compact(0.0)
    store.replace(_df(spark, [("a", 3)]), "b2")
    store.replace(_df(spark, [("a", 4)]), "b3")
    folders = {r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(store.root).select(
        F.regexp_extract("path", "batch=([^/]*)/", 1)).distinct().collect()}
    assert "init" not in folders and "b1" not in folders and {"b2", "b3"} <= folders


def test_a_hot_bucket_is_written_by_several_tasks(spark):
    """A person with a third of all rows: files of one bucket come from more than one task."""
    from carelake.plans.document import write_documents
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100k"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        path = shared_dir(spark, "hot", uuid.uuid4().hex)
        df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("origid"),
                                        F.sha2(F.col("id").cast("string"), 256).alias("t"), "id")
        write_documents(df, path, n_buckets=4, fmt="parquet")
        back = spark.read.parquet(path)
        assert sorted(map(tuple, back.select("origid", "t", "id").collect())) == sorted(map(tuple, df.collect()))
        hot = back.where("origid = 'hot'").select(F.input_file_name()).distinct().count()
        assert hot > 1
    finally:
        for k in conf:
            spark.conf.unset(k)


@pytest.mark.parametrize("name", ["stream_compact", "stream_trigger"])
def test_streams_against_batches(spark, name):
    from carelake.plans.registry import QUERIES
    sf = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{sf}/orders.parquet").groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_orderdate").alias("d")).collect()
    got = {r.origid: r for r in QUERIES[name](spark, sf).collect()}
    if name == "stream_compact":
        assert {k: r.n_orders for k, r in got.items()} == {str(r.o_custkey): r.n for r in orders}
    else:
        late = {str(r.o_custkey): r.n >= 10 for r in orders if str(r.d) >= "1998"}
        assert {k: r.busy for k, r in got.items()} == late and all(r.once for r in got.values())
