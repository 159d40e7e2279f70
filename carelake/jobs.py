"""Batch job entry point (``spark-submit -m carelake.jobs …`` or
``python -m carelake.jobs``): build the records of all persons, check them,
write them.

    python -m carelake.jobs build --tables s3://…/extract --out s3://…/records \\
        --as-of 2026-05-19 --cc-version 20260519 [--store s3://…/store] [--part-size 20000] [--bucketed db]

One row per person; ``--part-size`` splits array sections above that many
items over several rows.  ``--store`` also loads the records into the store
that ``refresh`` keeps current, which has one row per person.

Writes ``<out>/records`` (JSON lines bucketed by person), ``<out>/records_parquet``
(the same records for further jobs), ``<out>/findings`` (conformance findings,
must be empty) and ``<out>/profile`` (per-person sizes).

Other commands: ``visits`` (listing by care setting), ``measure`` (a measure
definition file against stored records), ``refresh`` (the change stream),
``layout`` (sources partitioned by key, so that a refresh scans only the
partitions of the persons it rebuilds), ``refresh-due`` (the records whose
values change on a day without any change event).
Intermediate sections go to ``spark.checkpoint.dir`` (lineage cut).
"""

from __future__ import annotations

import argparse
import uuid

from carelake.plans import checks
from carelake.plans.document import build_documents, to_json, write_documents
from carelake.session import build_session, shared_dir
from carelake.sources.schemas import XREF_DDL
from carelake.sources.tables import read_bucketed, read_tables

ARRAYS = ["encounters", "labs", "medications", "assessments", "alerts", "hedis_measures",
          "chronic_conditions", "transport_benefits", "emr_appointments"]


def build(args) -> None:
    spark = build_session(args.master, app="carelake-build")
    t = read_bucketed(spark, args.bucketed) if args.bucketed else read_tables(spark, args.tables, fmt=args.fmt)
    stage = shared_dir(spark, "build", uuid.uuid4().hex)
    docs = build_documents(t, args.as_of, cc_version=args.cc_version, stage_dir=stage,
                           part_size=args.part_size or None, how=args.how)
    docs.write.mode("overwrite").parquet(f"{args.out}/records_parquet")
    docs = spark.read.parquet(f"{args.out}/records_parquet")
    if getattr(args, "store", None):
        if args.part_size:
            raise SystemExit("--store keeps one row per person; leave --part-size out")
        from carelake.streaming.store import RecordStore
        RecordStore(spark, args.store, n_buckets=args.store_buckets).write(docs)
    key_cols = ["origid", "part_no"] if args.part_size else ["origid"]
    write_documents(docs, f"{args.out}/records", n_buckets=args.buckets)
    js = to_json(docs.filter("part_no = 0") if args.part_size else docs)
    checks.validate(js, "origid").write.mode("overwrite").parquet(f"{args.out}/findings")
    checks.duplicates(docs, key_cols).write.mode("overwrite").parquet(f"{args.out}/duplicates")
    prof = checks.profile(docs, "origid", ARRAYS)
    prof.write.mode("overwrite").parquet(f"{args.out}/profile")


def visits(args) -> None:
    """Visit listing of the given settings (all 13 by default), one pass,
    written partitioned by setting."""
    from carelake.plans.visits import ALL_SETTINGS, visits as visit_rows, write_by_setting
    spark = build_session(args.master, app="carelake-visits")
    t = read_tables(spark, args.tables, ["mra1_encounter"], fmt=args.fmt)
    enc = t["mra1_encounter"].withColumnRenamed("origid", "patient_id")
    settings = args.settings.split(",") if args.settings else ALL_SETTINGS
    write_by_setting(visit_rows(enc, settings, args.start, args.end, args.patient_id, args.facility), args.out)


def measure(args) -> None:
    """Evaluate a measure definition (the reference's JSON layout) against
    stored records: flags per person, per-element report, worklist, rates."""
    import json

    from carelake.plans import measures as M
    from carelake.plans.measure_defs import DOC_FIELDS
    spark = build_session(args.master, app="carelake-measure")
    with open(args.definition) as f:          # small configuration file, read on the driver
        m = M.from_definition(json.load(f), DOC_FIELDS, ungated=args.ungated.split(",") if args.ungated else ())
    docs = spark.read.parquet(args.records)
    docs = M.enrich_age(docs, args.as_of, root="patient")
    if "part_no" in docs.columns:
        ev = M.evaluate_parts(docs, m, args.as_of, root="patient",
                              keep=[("market", docs["patient.care_team.market_id"])])
    else:
        ev = M.evaluate(docs, m, args.as_of, root="patient",
                        keep=["origid", docs["patient.care_team.market_id"].alias("market")])
    ev.write.mode("overwrite").parquet(f"{args.out}/flags")
    ev = spark.read.parquet(f"{args.out}/flags")
    M.report(ev, m).write.mode("overwrite").parquet(f"{args.out}/report")
    M.worklist(ev, m).write.mode("overwrite").parquet(f"{args.out}/worklist")
    M.rate(ev, m, ["market"]).write.mode("overwrite").parquet(f"{args.out}/rates")


def layout(args) -> None:
    """Save the source tables partitioned by key, for ``refresh --partitioned``."""
    from carelake.sources.tables import write_partitioned
    spark = build_session(args.master, app="carelake-layout")
    t = read_tables(spark, args.tables, fmt=args.fmt)
    if args.xref:
        t["person_xref"] = spark.read.schema(XREF_DDL).format(args.fmt).load(f"{args.tables}/person_xref")
    write_partitioned(t, args.out, args.parts)


def refresh(args):
    """Start the change stream that keeps the records current."""
    from carelake.plans.routing import ROUTES, with_xref
    from carelake.sources.tables import PartitionedTables, only_persons
    from carelake.streaming.refresh import start
    from carelake.streaming.store import RecordStore
    spark = build_session(args.master, app="carelake-refresh")
    store = RecordStore(spark, args.store, n_buckets=args.buckets)
    option = lambda name, default: getattr(args, name, default)
    xref = "person_xref" if option("xref", False) else None

    def load_tables():
        if option("partitioned", False):
            return PartitionedTables(spark, args.tables)
        t = read_tables(spark, args.tables, fmt=args.fmt)
        if xref:
            t[xref] = spark.read.schema(XREF_DDL).format(args.fmt).load(f"{args.tables}/{xref}")
        return t

    def build(tab, todo):
        own = only_persons(tab, todo, xref=xref)
        return build_documents(own, args.as_of, trigger="cdc", cc_version=option("cc_version", None), how=option("how", "inner"),
                               xref=own[xref] if xref else None)

    return start(spark, args.changes, store=store, routes=with_xref() if xref else ROUTES, name=args.name, load_tables=load_tables, build=build,
                 available_now=args.once, processing_time=None if args.once else args.every)


def refresh_due(args) -> int:
    """Build the records again whose day has come (C11); returns their number.
    A record carries that day, so nobody else's is read beyond it."""
    from pyspark.sql import functions as F

    from carelake.sources.tables import PartitionedTables, only_persons
    from carelake.streaming.store import RecordStore
    spark = build_session(args.master, app="carelake-refresh-due")
    store = RecordStore(spark, args.store, n_buckets=args.buckets)
    version = f"due-{args.as_of}"
    current = store.read()
    if current is None or store.applied(version):
        return 0
    due = current.where(F.col("patient._meta.next_due") <= args.as_of).select("origid").checkpoint()
    n = due.count()
    if n:
        t = PartitionedTables(spark, args.tables) if args.partitioned else read_tables(spark, args.tables, fmt=args.fmt)
        fresh = build_documents(only_persons(t, due), args.as_of, trigger="date", cc_version=args.cc_version, how=args.how)
        store.replace(fresh, version, persons=due)
        store.compact()
    return n


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="carelake.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("build", help="build, check and write the person records")
    b.add_argument("--tables", help="folder with one sub-folder per source table")
    b.add_argument("--bucketed", help="catalog database written by write_bucketed")
    b.add_argument("--fmt", default="parquet")
    b.add_argument("--out", required=True)
    b.add_argument("--as-of", required=True)
    b.add_argument("--cc-version")
    b.add_argument("--part-size", type=int, default=0,
                   help="split array sections above this many items (0 = one row per person always)")
    b.add_argument("--store", help="record store to load for refresh")
    b.add_argument("--store-buckets", type=int, default=4096)
    b.add_argument("--buckets", type=int, default=4096)
    b.add_argument("--how", default="inner", choices=["inner", "left"])
    b.add_argument("--master")
    v = sub.add_parser("visits", help="visit listing by care setting")
    v.add_argument("--tables", required=True)
    v.add_argument("--fmt", default="parquet")
    v.add_argument("--out", required=True)
    v.add_argument("--settings")
    v.add_argument("--start")
    v.add_argument("--end")
    v.add_argument("--patient-id")
    v.add_argument("--facility")
    v.add_argument("--master")
    m = sub.add_parser("measure", help="evaluate a measure definition against stored records")
    m.add_argument("--definition", required=True)
    m.add_argument("--records", required=True, help="Parquet records written by build")
    m.add_argument("--out", required=True)
    m.add_argument("--as-of", required=True)
    m.add_argument("--ungated")
    m.add_argument("--master")
    r = sub.add_parser("refresh", help="start the change stream")
    r.add_argument("--changes", required=True)
    r.add_argument("--tables", required=True)
    r.add_argument("--fmt", default="parquet")
    r.add_argument("--store", required=True)
    r.add_argument("--as-of", required=True)
    r.add_argument("--cc-version")
    r.add_argument("--partitioned", action="store_true", help="--tables was written by layout")
    r.add_argument("--xref", action="store_true", help="roster ids lead to persons through the table person_xref")
    r.add_argument("--how", default="inner", choices=["inner", "left"])
    r.add_argument("--buckets", type=int, default=4096)
    r.add_argument("--every", default="1 minute")
    r.add_argument("--once", action="store_true")
    r.add_argument("--name", default="record-refresh",
                   help="stream name: its checkpoint under spark.checkpoint.dir/streams/<name> is resumed")
    r.add_argument("--master")
    d = sub.add_parser("refresh-due", help="build the records again whose values change on this day without a change event")
    d.add_argument("--tables", required=True)
    d.add_argument("--fmt", default="parquet")
    d.add_argument("--partitioned", action="store_true")
    d.add_argument("--store", required=True)
    d.add_argument("--buckets", type=int, default=4096)
    d.add_argument("--as-of", required=True)
    d.add_argument("--cc-version")
    d.add_argument("--how", default="inner", choices=["inner", "left"])
    d.add_argument("--master")
    y = sub.add_parser("layout", help="save the source tables partitioned by key")
    y.add_argument("--tables", required=True)
    y.add_argument("--fmt", default="parquet")
    y.add_argument("--out", required=True)
    y.add_argument("--parts", type=int, default=4096)
    y.add_argument("--xref", action="store_true")
    y.add_argument("--master")
    args = ap.parse_args(argv)
    from pyspark.sql import SparkSession
    if args.cmd == "build":
        build(args)
    elif args.cmd == "visits":
        visits(args)
    elif args.cmd == "measure":
        measure(args)
    elif args.cmd == "refresh-due":
        refresh_due(args)
    elif args.cmd == "layout":
        layout(args)
    elif args.cmd == "refresh":
        refresh(args).awaitTermination()
    SparkSession.active().stop()


if __name__ == "__main__":
    main()
