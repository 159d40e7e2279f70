"""Change-data-capture routing: which persons (and which record sections) a
batch of table changes affects (C1–C17).

A change row is ``(event_id, sequence, change_ts, table, op, before, after)``
with the row images as ``map<string,string>``.  A route says how a changed
row of one table reaches the person key: directly (C1) or through a chain of
parent lookups (C2, C6, C7, C8, C9, C10), with equality filters on the
changed row (C3) and SQL filters on a parent (C4).  All routes compile into
one plan — a union of per-route joins — so a micro-batch is resolved by one
Spark job; parents are passed in per batch, never cached across batches.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.operators.latest import latest_row

_KEYWORDS = {"AND", "OR", "NOT", "IN", "IS", "NULL", "LIKE", "BETWEEN", "TRUE", "FALSE", "CAST", "AS", "INT", "STRING", "DATE"}

CHANGE_SCHEMA = ("event_id BIGINT, sequence BIGINT, change_ts TIMESTAMP, `table` STRING, op STRING, "
                 "before MAP<STRING,STRING>, after MAP<STRING,STRING>")


@dataclass(frozen=True)
class Hop:
    """Parent lookup: ``parent[ref_col] = key`` → new key ``parent[next_col]``.
    ``filter`` is a SQL predicate on the parent row (C4)."""

    table: str
    ref_col: str
    next_col: str
    filter: str | None = None


@dataclass(frozen=True)
class Route:
    table: str
    key_col: str                                # column of the changed row that starts the chain
    hops: tuple[Hop, ...] = ()                  # () = the key is the person key (C1)
    sections: tuple[str, ...] = ()              # record sections to rebuild (C5)
    change_date_col: str | None = None          # event time (C17)
    change_date_is_year: bool = False
    row_eq: Mapping[str, object] = field(default_factory=dict)   # equality filters on the row (C3)
    row_filter: str | None = None               # SQL predicate over the row's columns (C4)
    row_cols: tuple[str, ...] = ()              # row columns the predicate reads
    collapse: bool = True                       # one row per key (latest change) before each hop


def row_value(col: str) -> Column:
    """Value of a column of the changed row: the after-image, except for a
    delete, whose key lives only in the before-image (C12)."""
    b, a = F.col("before")[col], F.col("after")[col]
    return F.when(F.col("op") == "D", b).otherwise(F.coalesce(a, b))


def images(changes: DataFrame) -> DataFrame:
    """Each change once per row image it has, as ``after``: an update that
    moves a row from one key to another, or out of a filter, concerns both
    sides (C12)."""
    both = F.array(F.when(F.col("op") != "D", F.coalesce("after", "before")), F.when(F.col("op") != "I", F.col("before")))
    kept = F.array_compact(both)
    once = F.when((F.size(kept) == 2) & (F.to_json(kept[0]) == F.to_json(kept[1])), F.slice(kept, 1, 1)).otherwise(kept)
    return changes.withColumn("after", F.explode(once)).withColumn("before", F.col("after"))


def change_time(route: Route) -> Column:
    """Event time of a change: the table's change-date column, a year
    column read as Jan 1 of that year (C17); else the change timestamp."""
    if not route.change_date_col:
        return F.col("change_ts")
    v = row_value(route.change_date_col)
    if route.change_date_is_year:
        t = F.make_date(v.try_cast("int"), F.lit(1), F.lit(1)).cast("timestamp")
    else:
        t = F.try_to_timestamp(v)
    return F.coalesce(t, F.col("change_ts"))


def _route_plan(changes: DataFrame, route: Route, parents: Mapping[str, DataFrame],
                person_col: str) -> DataFrame:
    c = images(changes.filter(F.col("table") == route.table))
    for k, v in route.row_eq.items():
        c = c.filter(row_value(k) == F.lit(str(v)))
    if route.row_filter:
        exposed = c.select("*", *[row_value(x).alias(x) for x in route.row_cols])
        c = exposed.filter(F.expr(route.row_filter)).select(*changes.columns)
    cur = c.select("event_id", "sequence", "op", change_time(route).alias("change_ts"), row_value(route.key_col).alias("_key"))
    for i, hop in enumerate(route.hops, 1):
        if route.collapse:
            # Many changes pointing at one key need one lookup: keep the
            # latest change per key before fanning out (partial aggregate),
            # so a mass change (C9) multiplies distinct keys, not events.
            cur = cur.groupBy("_key").agg(F.max(F.struct("sequence", "event_id", "op", "change_ts")).alias("_m")).select("_key", "_m.*")
        p = parents[hop.table]
        if hop.filter:
            p = p.filter(F.expr(hop.filter))
        p = p.select(F.col(hop.ref_col).cast("string").alias("_ref"),
                     F.col(hop.next_col).cast("string").alias("_next"))
        # Only parent rows a change of this batch points at: a semi-join with
        # the batch's (small) key set, so the parent is filtered during its
        # scan instead of being shuffled whole.
        keys = cur.select(F.col("_key").alias("_ref")).distinct()
        p = p.join(keys, "_ref", "left_semi")
        # the next hop's collapse merges equal pairs anyway, at the key they lead to
        if i == len(route.hops) or not route.collapse:
            p = p.distinct()
        cur = cur.join(p, cur["_key"] == p["_ref"]).drop("_ref", "_key") \
            .withColumnRenamed("_next", "_key")
    cur = cur.select("event_id", "sequence", F.lit(route.table).alias("table"), "op", "change_ts", "_key")
    out = cur.filter(F.col("_key").isNotNull()).withColumnRenamed("_key", person_col)
    secs = F.array(*[F.lit(s) for s in route.sections]) if route.sections else F.array(F.lit(None).cast("string"))
    return out.withColumn("section", F.explode(secs))


def affected(changes: DataFrame, routes: Sequence[Route], parents: Mapping[str, DataFrame],
             person_col: str = "origid", prune: bool = False) -> DataFrame:
    """``(event_id, sequence, table, op, change_ts, origid, section)`` for every
    change × reached person × section (routes with ``collapse`` keep only
    the latest change per intermediate key); tables without a route are
    ignored.
    The parent lookups are de-duplicated on (ref, next) so a one-to-many
    hop (C8) multiplies rows only by distinct targets.

    ``prune=True`` compiles only the routes of tables present in the batch:
    one distinct over the ``table`` column, whose size is bounded by the
    routing configuration (not by the data), keeps the plan small."""
    if prune:
        present = {r[0] for r in changes.select("table").distinct().collect()}
        routes = [r for r in routes if r.table in present]
        if not routes:
            return _route_plan(changes.limit(0), Route("", "_none"), parents, person_col)
    plans = [_route_plan(changes, r, parents, person_col) for r in routes]
    out = plans[0]
    for p in plans[1:]:
        out = out.unionByName(p)
    return out


def persons_to_rebuild(aff: DataFrame, person_col: str = "origid") -> DataFrame:
    """One rebuild per person per batch (C13), with the provenance of the
    latest change (C15, C16)."""
    last = latest_row(aff, [person_col], ["sequence", "event_id"], ["table", "sequence", "change_ts"])
    return last.select(person_col, F.col("table").alias("trigger_source"),
                       F.col("sequence").alias("cdc_sequence"), "change_ts")


def latest_changes(changes: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Last writer wins per source row key (C14, C15): the change with the
    highest sequence per key; a delete as the last change removes the row."""
    keyed = changes.select("*", *[row_value(k).alias(k) for k in key_cols])
    return latest_row(keyed, list(key_cols), ["sequence", "event_id"])


def changed_rows(old: DataFrame, new: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Date-driven refresh (C11): rows whose values differ between two
    evaluations (NULL-safe), keyed; only these records need re-indexing."""
    o = old.select(key, *[F.col(c).alias(f"old_{c}") for c in cols])
    n = new.select(key, *[F.col(c).alias(f"new_{c}") for c in cols])
    j = o.join(n, key, "full_outer")
    same = None
    for c in cols:
        eq = F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
        same = eq if same is None else same & eq
    return j.filter(~same)


def _columns(predicate: str | None) -> tuple[str, ...]:
    """Names in a SQL predicate (words outside quotes that aren't keywords or functions)."""
    if not predicate:
        return ()
    plain = re.sub(r"'[^']*'", " ", predicate)
    words = re.findall(r"[A-Za-z_]\w*(?!\w*\s*\()", plain)
    return tuple(dict.fromkeys(w for w in words if w.upper() not in _KEYWORDS))


def from_reference_layout(config: Mapping | str) -> list[Route]:
    """Routes from a routing file in the reference's layout:
    ``{table: {patient_id_col, change_date_col, join: {fk_col, table, ref_col,
    patient_id_col, change_date_col, extra_filter, filter}, procedures}}``."""
    if isinstance(config, str):
        config = json.loads(config)
    routes = []
    for table, spec in config.items():
        sections = tuple(spec.get("procedures") or ())
        j = spec.get("join")
        if spec.get("patient_id_col"):
            routes.append(Route(table, spec["patient_id_col"], (), sections, spec.get("change_date_col")))
        elif j:
            hop = Hop(j["table"], j["ref_col"], j["patient_id_col"])
            # the filter of a join is a predicate on the changed row
            text = j.get("filter")
            routes.append(Route(table, j["fk_col"], (hop,), sections, spec.get("change_date_col"),
                                row_eq=dict(j.get("extra_filter") or {}), row_filter=text, row_cols=_columns(text)))
    return routes


def table_changes(df: DataFrame, table: str, seq: Column, ts: Column, op: Column | None = None,
                  cols: Sequence[str] | None = None) -> DataFrame:
    """Shape rows of a table as change events (insert images by default) —
    used for initial loads, replays and tests."""
    cols = list(cols or df.columns)
    image = F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("string"))])
    op = op if op is not None else F.lit("I")
    return df.select(
        seq.cast("long").alias("event_id"), seq.cast("long").alias("sequence"),
        ts.cast("timestamp").alias("change_ts"), F.lit(table).alias("table"), op.alias("op"),
        F.when(op != "I", image).alias("before"), F.when(op != "D", image).alias("after"))
