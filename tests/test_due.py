"""The day on which a record changes by itself."""

import uuid

import pytest
from pyspark.sql import functions as F

from carelake import jobs
from carelake.plans.document import build_documents
from carelake.session import shared_dir
from carelake.streaming.store import RecordStore

SECTIONS = ["demographics", "rule_flags", "medications", "_meta"]


def _values(t, day):
    """The values that don't count days, and the day the record is due."""
    d = build_documents(t, day, sections=SECTIONS)
    flags = F.col("patient.rule_flags").dropFields("pcp_days_since_visit", "last_updated", "rx_adherence_pct", "rx_adherence_flag", "hcc_capture_pct")
    return {r.origid: (r.v, r.due) for r in d.select(
        "origid", F.to_json(F.struct("patient.demographics", "patient.medications", flags.alias("f"))).alias("v"),
        F.col("patient._meta.next_due").alias("due")).collect()}


@pytest.mark.parametrize("day", ["2023-02-28", "2023-03-10", "2023-12-30"])
def test_due_is_the_first_day_with_other_values(tables, day):
    import datetime as dt
    today = _values(tables, day)
    for due in sorted({d for _, d in today.values()}):
        before = str(dt.date.fromisoformat(due) - dt.timedelta(days=1))
        eve, then = _values(tables, before), _values(tables, due)
        for person, (values, d) in today.items():
            if d >= due:
                assert eve[person][0] == values, (person, before)     # nothing changes before its day
            if d == due and not due.endswith("-01-01"):
                assert then[person][0] != values, (person, due)
    assert all(day < d <= f"{int(day[:4]) + 1}-01-01" for _, d in today.values())


def test_the_due_job_builds_those_records_alone(spark, tables, tmp_path):
    src = tmp_path / "extract"
    raw = {"mra1_encounter": "patient_id", "drfirst_patient_medications": "patientid", "transportation_benefit": "orig_id"}
    for name, df in tables.items():
        (df.withColumnRenamed("origid", raw[name]) if name in raw else df).write.parquet(str(src / name))
    day = "2023-02-28"
    first = build_documents(tables, day)
    due = {r.origid: r.due for r in first.select("origid", F.col("patient._meta.next_due").alias("due")).collect()}
    store = RecordStore(spark, shared_dir(spark, "due", uuid.uuid4().hex), n_buckets=4)
    store.write(first)
    then = min(due.values())
    args = jobs.argparse.Namespace(master=None, tables=str(src), fmt="parquet", partitioned=False, store=store.root, buckets=4, as_of=then, cc_version=None, how="inner")
    now = [p for p, d in due.items() if d == then]
    assert jobs.refresh_due(args) == len(now) and jobs.refresh_due(args) == 0       # the second run of a day finds it done
    got = {r.origid: (r.trigger, r.due) for r in store.read().select(
        "origid", F.col("patient._meta.trigger_source").alias("trigger"), F.col("patient._meta.next_due").alias("due")).collect()}
    assert {p for p, (trigger, _) in got.items() if trigger == "date"} == set(now)
    assert all(d > then for _, d in got.values()) and set(got) == set(due)
