"""Assembly of the nested person record and its JSON sink.

``build_documents`` is one Spark job graph for all persons.  Every section
contributes plain rows: one row per person with what it needs from a table, or
one row per array item.  All of them are one union, gathered by one aggregate
on the person (:func:`carelake.operators.gather.gather`), and the 21 sections
are expressions over the result, so no join chain grows with the number of
sections.  JSON text is produced only at the sink.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.gather import gather
from carelake.plans import flags as FL
from carelake.plans import sections as S

SECTION_ORDER = [
    "id", "origid", "demographics", "contact", "care_team", "enrollment", "rule_flags",
    "chronic_conditions", "raf_profile", "hcc_capture", "risk_scores", "uamcc", "medication_adherence",
    "hedis_measures", "encounters", "labs", "medications", "assessments", "alerts", "sdoh",
    "transport_benefits", "emr_appointments", "_meta",
]
#: what a section reads beside an array of its own name; the flags' needs are those of flags.flag_parts
NEEDS = {"demographics": ["patient"], "contact": ["patient"], "care_team": ["roster", "patient"], "enrollment": ["patient", "roster"],
         "raf_profile": ["raf"], "hcc_capture": ["capture"], "uamcc": ["uamcc_summary", "details"], "medication_adherence": ["adherence"],
         "encounters": ["encounters", "encounter_children"], "sdoh": ["food", "rides", "food_insecurity", "meal_plans", "reward_programs"], "_meta": FL.DUE_PARTS}
#: arrays inside a section
NESTED = {"uamcc": ["details"], "sdoh": ["meal_plans", "reward_programs"]}


def persons_with_roster(t, cc_version: str | None = None, how: str = "inner",
                        xref: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Base join (J1, decisions D1–D3): persons with their latest aligned
    roster row; ``how='left'`` keeps persons without one."""
    roster = S.roster_latest(t, cc_version, xref=xref)
    persons = t["patient"].select("origid").join(roster.select("origid"), "origid", how)
    return persons.distinct() if how != "inner" else persons, roster


def stage(df: DataFrame, path: str | None) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back:
    cuts the lineage (a lost executor recomputes one stage, not the whole
    record) and keeps the final assembly plan small.  ``None`` = no staging."""
    if path is None:
        return df
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def build_documents(t, as_of, cc_version: str | None = None, run_ts=None, how: str = "inner",
                    trigger: Column | str = "initial_load", sequence: Column | None = None,
                    source_db: str | None = None, xref: DataFrame | None = None,
                    measure_dedupe_keys=None, score_thresholds: DataFrame | None = None,
                    stage_dir: str | None = None, part_size: int | None = None, capture_level: str = "hcc",
                    merge_overlaps: bool = False, sections: Sequence[str] | None = None) -> DataFrame:
    """``(origid, patient struct)`` — one row per person (V4 holds by
    construction: one aggregate keyed by ``origid``).

    ``sections`` chooses some of :data:`SECTION_ORDER` (P16, C5): only their
    source tables are read, and the struct holds only them.

    ``stage_dir`` (a folder under ``spark.checkpoint.dir``) materialises the
    rows of every section as Parquet before they are gathered.

    ``part_size`` switches to the hot-person-safe layout ``(origid, part_no,
    n_parts, patient)``: a person whose array section holds more than
    ``part_size`` items gets it split over several rows, so no task ever
    assembles an unbounded array; everyone else still has exactly one row.

    ``capture_level`` and ``merge_overlaps`` choose the variants of
    :func:`sections.hcc_capture_counts` and :func:`sections.adherence_counts`."""
    as_of = as_of if isinstance(as_of, str) else as_of.isoformat()
    run = run_ts or f"{as_of} 00:00:00"
    sp = (lambda name: f"{stage_dir}/{name}") if stage_dir else (lambda name: None)
    persons, roster = persons_with_roster(t, cc_version, how, xref)
    roster = stage(roster, sp("roster"))
    persons = stage(persons, sp("persons"))
    wanted = [n for n in SECTION_ORDER if sections is None or n in sections]
    if sections is not None and set(sections) - set(SECTION_ORDER):
        raise ValueError(f"no such sections: {sorted(set(sections) - set(SECTION_ORDER))}")
    flag_rows = FL.flag_parts(t, as_of)
    rows = {**flag_rows, "capture": lambda: S.hcc_capture_counts(t, as_of, capture_level),
            "adherence": lambda: S.adherence_counts(t, as_of, merge_overlaps), "roster": lambda: roster,
            "raf": lambda: S.raf_rows(t, as_of), "stops": lambda: FL.next_stop(t, as_of)}
    items = {
        "chronic_conditions": lambda: S.chronic_conditions(t, as_of, S.ITEMS),
        "hedis_measures": lambda: S.hedis_measures(t, as_of, measure_dedupe_keys, S.ITEMS),
        "encounters": lambda: S.encounter_heads(t, as_of), "encounter_children": lambda: S.encounter_kids(t, as_of), "labs": lambda: S.labs(t, S.ITEMS),
        "medications": lambda: S.medications(t, as_of, S.ITEMS), "assessments": lambda: S.assessments(t, score_thresholds, S.ITEMS),
        "alerts": lambda: S.alerts(t, S.ITEMS), "transport_benefits": lambda: S.transport_benefits(t, S.ITEMS),
        "emr_appointments": lambda: S.emr_appointments(t, S.ITEMS), "details": lambda: S.uamcc_details(t, S.ITEMS),
        "meal_plans": lambda: S.meal_plans(t, S.ITEMS), "reward_programs": lambda: S.reward_programs(t, S.ITEMS),
        "food_insecurity": lambda: S.food_insecurity(t, S.ITEMS),
    }
    needed = {p for n in wanted for p in (flag_rows if n == "rule_flags" else NEEDS.get(n, [n]))}
    rows = {k: stage(build(), sp(f"rows_{k}")) for k, build in rows.items() if k in needed}
    items = {k: stage(build(), sp(f"items_{k}")) for k, build in items.items() if k in needed}
    unpack = {n: f for n, f in S.late(as_of).items() if n in items}
    g = gather(persons, "origid", rows, items, part_size, unpack=unpack, apart=True)
    if "care_team" in wanted:
        g = S.with_care_roles(t, g)
    values = {
        "id": lambda: F.col("origid"), "origid": lambda: F.col("origid"),
        "demographics": lambda: S.demographics_section(as_of), "contact": S.contact_section,
        "care_team": lambda: S.care_team_section(as_of), "enrollment": S.enrollment_section,
        "rule_flags": lambda: F.struct(*FL.flag_columns(as_of, run)), "raf_profile": lambda: S.raf_section(as_of),
        "encounters": S.encounters_section, "hcc_capture": lambda: S.hcc_capture_section(as_of), "risk_scores": lambda: S.risk_scores_section(as_of),
        "uamcc": lambda: S.uamcc_section(as_of), "medication_adherence": lambda: S.adherence_section(as_of), "sdoh": S.sdoh_section,
        "_meta": lambda: S.meta_section(run, trigger, sequence, source_db, FL.next_due(as_of)),
    }
    values = {n: values[n]() if n in values else F.col(n) for n in wanted}
    if part_size:
        values = {n: c if n in ("id", "origid") or n in items else _first_part(n, c, g) for n, c in values.items()}
    fields = [c.alias(n) for n, c in values.items()]
    if not part_size:
        return g.select("origid", F.struct(*fields).alias("patient"))
    return g.select("origid", "part_no", "n_parts", F.struct(*fields).alias("patient"))


def _first_part(name: str, section: Column, gathered: DataFrame) -> Column:
    """A section on split records: whole in part 0; further parts hold only
    their slices of the arrays inside it (other fields NULL), or nothing."""
    first = F.col("part_no") == 0
    if name not in NESTED:
        return F.when(first, section)
    stype = gathered.select(section.alias(name)).schema[name].dataType
    kept = NESTED[name]
    rest = F.struct(*[(F.col(f.name) if f.name in kept else F.lit(None)).cast(f.dataType).alias(f.name) for f in stype.fields])
    some = reduce(lambda a, b: a | b, [F.col(k).isNotNull() for k in kept])
    return F.when(first, section).when(some, rest)


def to_json(docs: DataFrame, keep_nulls: bool = True) -> DataFrame:
    """``(origid, doc)`` JSON text per person (S7): ``{"patient": {...}}``
    with NULL fields kept, as ``JSON_OBJECT`` does."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return docs.select("origid", F.to_json(F.struct("patient"), opts).alias("doc"))


def bucket_col(n_buckets: int, key: str = "origid") -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_buckets)).alias("bucket")


def write_documents(docs: DataFrame, path: str, n_buckets: int = 64, fmt: str = "json", compression: str | None = None) -> None:
    """Document files partitioned by a hash bucket of the person key (S8):
    one JSON object per line, NULL fields kept; a later replace of some
    persons rewrites only their buckets.  ``compression`` (e.g. ``gzip``) is
    that of the files; readers tell it by their names."""
    out = docs.withColumn("bucket", bucket_col(n_buckets))
    # a bucket beyond the advisory partition size is split over several tasks and files
    w = out.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket")
    if compression:
        w = w.option("compression", compression)
    if fmt == "json":
        w.option("ignoreNullFields", "false").json(path)
    else:
        w.format(fmt).save(path)


def read_documents(spark, path: str, schema, fmt: str = "json") -> DataFrame:
    """Documents read back with an explicit schema (S5) — never inferred."""
    return spark.read.schema(schema).format(fmt).load(path)


def parse_documents(df: DataFrame, schema, json_col: str = "doc", key: str = "origid") -> DataFrame:
    """JSON text column (e.g. index contents) → nested record (S5) with an
    explicit schema of the ``patient`` object; malformed text gives NULL."""
    from pyspark.sql.types import StructField, StructType
    wrapped = StructType([StructField("patient", schema)])
    return df.select(key, F.from_json(json_col, wrapped)["patient"].alias("patient"))


def replace_documents(current: DataFrame, fresh: DataFrame, key: str = "origid",
                      persons: DataFrame | None = None) -> DataFrame:
    """Full-document replace keyed on the person (S9): the records of
    ``persons`` (default: those in ``fresh``) are replaced by ``fresh`` —
    ``anti-join ∪ fresh``; a routed person with no fresh record (deleted at
    the source, C12) is removed."""
    ids = (persons if persons is not None else fresh).select(key)
    return current.join(ids, key, "left_anti").unionByName(fresh)


def default_run_ts(as_of) -> str:
    d = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))
    return f"{d.isoformat()} 00:00:00"
