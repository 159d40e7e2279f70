"""Keeping person records current from a stream of table changes
(S6, S9, C13, C15, C17, M23) with Structured Streaming.

``readStream`` of change files → per micro-batch (``foreachBatch``):
route the changes to persons (parents re-read
each batch, so a hop never misses a parent written after the stream
started), rebuild those persons' records from the current tables with the
same batch function, and replace them in the record table.

The record table (:class:`~carelake.streaming.store.RecordStore`) is bucketed by
person hash on the shared file system: a batch appends the records of the
persons it touches and then swaps a small manifest; the writer is the single
``foreachBatch`` sink, and a batch already committed is skipped when it is
re-run after a failure.  Checkpoints live under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.plans.cdc import CHANGE_SCHEMA, Route, affected, persons_to_rebuild
from carelake.session import shared_dir
from carelake.streaming.store import RecordStore


def stamp_provenance(fresh: DataFrame, todo: DataFrame, key: str = "origid") -> DataFrame:
    """Write the change that caused the rebuild into the record's ``_meta``
    (C15 sequence, C16 trigger source), when the records have one."""
    if "patient" not in fresh.columns:
        return fresh
    src = todo.select(key, F.col("trigger_source").alias("_src"), F.col("cdc_sequence").alias("_seq"))
    meta = F.col("patient._meta")
    stamped = F.when(meta.isNotNull(), meta.withField("trigger_source", F.col("_src"))
                     .withField("cdc_sequence", F.col("_seq")))
    return fresh.join(src, key, "left").withColumn(
        "patient", F.col("patient").withField("_meta", stamped)).drop("_src", "_seq")


def refresh_batch(changes: DataFrame, batch_id: int, *, store: RecordStore,
                  load_tables: Callable[[], Mapping[str, DataFrame]],
                  build: Callable[[Mapping[str, DataFrame], DataFrame], DataFrame],
                  routes: Sequence[Route], key: str = "origid",
                  after: Callable[[DataFrame, DataFrame, str], None] | None = None,
                  version: str | None = None) -> None:
    """One micro-batch: route → distinct persons → rebuild → replace.

    ``version`` names the batch in the store (default: the batch id; the
    stream passes ``<query name>-<batch id>``, stable across restarts of the
    same query but distinct between queries).  A version already in the
    manifest is not written again, so a re-run after a failure never reads and
    overwrites its own folder; its hook runs again."""
    version = version or str(batch_id)
    done = store.applied(version)
    if done and after is None:
        return
    tables = load_tables()
    # materialise what the changes reach in the shared checkpoint folder: the
    # rebuild set, the store and the hook all read it, and must not re-run routing
    aff = affected(changes, routes, tables, key, prune=True).checkpoint()
    todo = persons_to_rebuild(aff, key).checkpoint()
    if todo.isEmpty():
        return
    if not done:
        fresh = stamp_provenance(build(tables, todo), todo, key)
        store.replace(fresh, version, persons=todo)
    # a batch that was committed before a crash still owes its hook, which is
    # idempotent per batch
    current = store.read() if after is not None else None
    if current is not None:
        # the hook reads the committed records, not a re-computation
        after(current.join(todo.select(key), key, "left_semi"), aff, version)
    if not done:
        store.compact()


def start(spark: SparkSession, change_dir: str, *, store: RecordStore,
          load_tables: Callable[[], Mapping[str, DataFrame]],
          build: Callable[[Mapping[str, DataFrame], DataFrame], DataFrame],
          routes: Sequence[Route], name: str = "record-refresh",
          available_now: bool = False, processing_time: str | None = None, fmt: str = "json",
          max_files_per_trigger: int | None = None,
          after: Callable[[DataFrame, DataFrame, int], None] | None = None):
    """Start the refresh query.  There is no watermark and no de-duplication:
    a person is rebuilt from the current tables, so a replayed change is
    harmless, and a late one, or one that shares its ``event_id`` with another
    table's, still reaches its persons."""
    ckpt = shared_dir(spark, "streams", name)
    reader = spark.readStream.schema(CHANGE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(change_dir)

    def sink(df: DataFrame, batch_id: int) -> None:
        refresh_batch(df, batch_id, store=store, load_tables=load_tables, build=build, routes=routes,
                      after=after, version=f"{name}-{batch_id}")

    w = src.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def measure_trigger(measure, as_of, out_dir: str, root: str | None = "patient",
                    trigger_tables: Sequence[str] = ("adt_encounter", "mra1_encounter"),
                    key: str = "origid", enrich: bool = True) -> Callable[[DataFrame, DataFrame, str], None]:
    """Event trigger (M23): after a batch, re-evaluate ``measure`` for the
    persons whose change came from an encounter table ("encounter start")
    and write the results under ``out_dir/batch=<version>``.  The version
    names the stream and the batch, so a re-run overwrites its own output and
    no other stream's: every triggered person stands there once."""
    from carelake.plans import measures as M

    def hook(docs: DataFrame, aff: DataFrame, version: str) -> None:
        hit = aff.filter(F.col("table").isin(list(trigger_tables))).select(key).distinct()
        d = docs.join(hit, key, "left_semi")
        d = M.enrich_age(d, as_of, root=root) if enrich else d
        M.evaluate(d, measure, as_of, root=root, keep=(key,)).write.mode("overwrite").parquet(f"{out_dir}/batch={version}")
    return hook
