"""Data-driven quality measures over nested person records.

A measure definition (a list of typed elements) is compiled on the driver
into four terms per element: ``t`` some value passes, ``u`` some test is NULL,
``h`` there is data, ``n`` the newest value with its outcome (``latest`` mode,
over all sources of the element).  The terms are the same in three layouts:

*   :func:`evaluate`, nested records: higher-order functions over the arrays,
    an ordinary projection of the record table without a shuffle;
*   :func:`evaluate_parts`, records split over rows: terms per row, one
    aggregate on the person;
*   :func:`evaluate_items`, no records at all: the rows of the sources, each
    with its terms, one aggregate on the person.  Nothing nested is built, and
    a person with a third of all rows is pre-aggregated like any other.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions.columns import as_date, full_years, pct

NUMERIC_OPS = {"between", "gte", "gt", "lte", "lt"}


@dataclass(frozen=True)
class Path:
    """Document path such as ``encounters[].diagnoses[].icd_code``; ``[]``
    marks an array level.  ``date`` names the field of the innermost element
    used by ``latest`` mode and date windows."""

    expr: str
    date: str | None = None

    @property
    def parts(self) -> tuple[list[str], str]:
        segs = self.expr.split("[].")
        return segs[:-1], segs[-1]


@dataclass
class Element:
    id: str
    name: str
    paths: Sequence[Path]                      # alternatives, OR-ed (M25)
    operator: str                              # between|contains|not_contains|gte|gt|lte|lt|eq|ne
    value: object = None
    value_end: object = None
    value_mode: str = "single"                 # single | latest (M15)
    null_handling: str = "exclude"             # exclude → NULL or no data fails; include → it passes (M16)
    case_sensitive: bool = True                # M17
    required: bool = True                      # M18: not required → reported, not gating
    is_active: bool = True                     # M18
    sort_order: int = 0
    date_from: object = None                   # M19 element date window
    date_to: object = None
    also: Sequence[tuple[str, str, object]] = ()  # extra tests on the same element (M6)
    flag: str | None = None                    # output flag name (M13)
    flag_on: str = "pass"                      # pass | match: not_contains flags the match


# Record paths of the names in a definition's filtering hierarchy (M21).  The
# path of a care team is an array of its members' numbers.
POPULATION_PATHS = {"market": "care_team.market_id", "group": "care_team.facility_nr",
                    "subgroup": "care_team.subgroup_id", "provider": "care_team.dce_provider_npi",
                    "careTeam": "care_team.member_nrs"}


@dataclass
class Measure:
    id: str
    title: str
    elements: list[Element]
    version: str = "1.0"
    status: str = "draft"
    performance_goal: float | None = None      # M22
    active_from: object = None                 # M20
    active_to: object = None
    filters: Mapping[str, object] = field(default_factory=dict)   # M21: name or path → value, None = all
    filter_paths: Mapping[str, str] = field(default_factory=lambda: dict(POPULATION_PATHS))
    performance_year: int | None = None        # M21: must meet the activation period
    ungated: Sequence[str] = ()                # element ids evaluated but not gating (D8)
    candidate_flag: str = "candidate"

    def active_elements(self) -> list[Element]:
        return sorted([e for e in self.elements if e.is_active], key=lambda e: (e.sort_order, e.id))

    def gating(self) -> list[Element]:
        return [e for e in self.active_elements() if e.required and e.id not in set(self.ungated)]


# ── parsing a definition in the reference's JSON layout (M14, F19) ─────────

def _as_bool(x) -> bool:
    return str(x).strip().lower() in ("1", "true", "yes")


def from_definition(defn: Mapping, field_paths: Mapping[str, Sequence[Path]],
                    ungated: Sequence[str] = (), flags: Mapping[str, tuple[str, str]] | None = None,
                    modes: Mapping[str, str] | None = None) -> Measure:
    """Typed :class:`Measure` from a definition with ``measureInfo`` and
    ``dataElements``.  ``field_paths`` maps each ``selectedField`` to the
    document paths it stands for (the hand mapping of the reference);
    comma-separated ``comparisonValue`` lists become code lists.  ``modes``
    overrides the value mode of elements by id."""
    info = defn.get("measureInfo", {})
    act = info.get("activationPeriod") or {}
    hier = info.get("filteringHierarchy") or {}
    elements = []
    for de in defn.get("dataElements", []):
        op = de.get("comparisonOperator")
        val = de.get("comparisonValue")
        if op in ("contains", "not_contains") and isinstance(val, str):
            val = [v.strip() for v in val.split(",") if v.strip()]
        f, on = (flags or {}).get(de["id"], (None, "pass"))
        paths = list(field_paths[de["selectedField"]])
        if de.get("effectiveDateField"):       # the date that windows and latest mode go by (M19)
            paths = [replace(p, date=de["effectiveDateField"]) if p.parts[0] else p for p in paths]
        elements.append(Element(
            id=de["id"], name=de.get("name", de["id"]), paths=paths,
            operator=op, value=val, value_end=de.get("comparisonValueEnd") or None,
            value_mode=(modes or {}).get(de["id"]) or de.get("valueMode") or "single",
            null_handling="include" if _as_bool(de.get("allowNull", "0")) else de.get("nullHandling") or "exclude",
            case_sensitive=_as_bool(de.get("caseSensitive", "1")),
            required=_as_bool(de.get("required", "1")), is_active=_as_bool(de.get("isActive", "1")),
            sort_order=int(de.get("sortOrder") or 0),
            date_from=de.get("dateRangeStart"), date_to=de.get("dateRangeEnd"),
            flag=f, flag_on=on))
    filters = {k: v for k, v in hier.items() if k in ("market", "group", "subgroup", "provider")}
    team = hier.get("careTeam") or {}
    if team.get("selection") not in (None, ""):
        if team.get("type") != "individual":
            raise ValueError(f"care team of type {team.get('type')}: only single members can be selected")
        filters["careTeam"] = int(team["selection"])
    if hier.get("populationType"):
        raise ValueError(f"population type {hier['populationType']}: records hold no type")
    year = hier.get("performanceYear")
    if year and not (str(act.get("startDate") or year)[:4] <= str(year) <= str(act.get("endDate") or year)[:4]):
        raise ValueError(f"performance year {year} is outside the activation period")
    return Measure(
        id=info.get("id", "measure"), title=info.get("title", ""), elements=elements,
        version=info.get("version", "1.0"), status=info.get("status", "draft"),
        performance_goal=info.get("performanceGoal"),
        active_from=act.get("startDate"), active_to=act.get("endDate"),
        filters=filters, performance_year=int(year) if year else None, ungated=list(ungated))


# ── compilation ───────────────────────────────────────────────────────────

def _get(x: Column | None, dotted: str) -> Column:
    """A field of an array element, or (``x`` None) of an item row."""
    if x is None:
        return F.col(dotted)
    for p in dotted.split("."):
        x = x[p]
    return x


def _root(root: str | None, name: str) -> Column:
    return F.col(f"{root}.{name}") if root else F.col(name)


def _norm(v: Column, el: Element) -> Column:
    return v if el.case_sensitive else F.upper(v.cast("string"))


def _norm_list(values, el: Element) -> list:
    vals = values if isinstance(values, (list, tuple)) else [values]
    return list(vals) if el.case_sensitive else [str(v).upper() for v in vals]


def _compare(v: Column, op: str, value, value_end, el: Element) -> Column:
    """Scalar test of one value (M1 range, M2 membership, M9 term, M27)."""
    if op in NUMERIC_OPS:
        n = v.cast("double")
        if op == "between":
            return n.between(float(value), float(value_end))
        return {"gte": n >= float(value), "gt": n > float(value),
                "lte": n <= float(value), "lt": n < float(value)}[op]
    if op in ("contains", "not_contains", "in"):
        return _norm(v, el).isin(_norm_list(value, el))
    if op == "eq":
        return v == F.lit(value) if isinstance(value, bool) else _norm(v, el) == _norm_list(value, el)[0]
    if op == "ne":
        return _norm(v, el) != _norm_list(value, el)[0]
    raise ValueError(f"unknown operator {op}")


def _element_test(x: Column | None, leaf: str, el: Element) -> Column:
    """All tests on one array element: the leaf test and the same-element
    extra tests (M6) — inside one lambda."""
    op = "contains" if el.operator == "not_contains" else el.operator
    conds = [_compare(_get(x, leaf), op, el.value, el.value_end, el)]
    for f, o, v in el.also:
        conds.append(_compare(_get(x, f), o, v, None, el))
    return reduce(lambda a, b: a & b, conds)


def _flatten(root: str | None, arrays: list[str]) -> Column:
    """All innermost elements of a nested array path as one array."""
    def child(name):
        return lambda x: x[name]
    arr = _root(root, arrays[0])
    for name in arrays[1:]:
        arr = F.flatten(F.filter(F.transform(arr, child(name)), lambda a: a.isNotNull()))
    return arr


def _exists_path(root: str | None, arrays: list[str], test) -> Column:
    """Nested EXISTS (M4, M5): exists(a, x -> exists(x.b, y -> test(y)))."""
    def go(arr: Column, rest: list[str]) -> Column:
        if not rest:
            return F.exists(arr, test)
        return F.exists(arr, lambda x: go(x[rest[0]], rest[1:]))
    return go(_root(root, arrays[0]), arrays[1:])


def _window(x: Column, date_field: str, el: Element) -> Column:
    d = _get(x, date_field).cast("date")
    c = F.lit(True)
    if el.date_from:
        c = c & (d >= as_date(el.date_from))
    if el.date_to:
        c = c & (d <= as_date(el.date_to))
    return F.coalesce(c, F.lit(False))


def _dated(x: Column | None, p: Path, el: Element) -> Column:
    """(date, value, outcome) of one element; the greatest is the newest."""
    leaf = p.parts[1]
    date = _get(x, p.date or leaf) if p.parts[0] else F.lit(None)
    return F.struct(date.cast("string").alias("d"), _get(x, leaf).cast("string").alias("v"), _element_test(x, leaf, el).alias("p"))


def _any(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, terms)


def record_terms(el: Element, root: str | None = None) -> dict[str, Column]:
    """The element's terms on a record row; arrays may be NULL."""
    t, u, h, n = [], [], [], []
    for p in el.paths:
        arrays, leaf = p.parts
        if not arrays:                                        # flat path (M1, M27)
            v = _root(root, leaf)
            m, has = _compare(v, "contains" if el.operator == "not_contains" else el.operator, el.value, el.value_end, el), v.isNotNull()
            newest = F.when(has, F.struct(F.lit(None).cast("string").alias("d"), v.cast("string").alias("v"), m.alias("p")))
        else:
            windowed = p.date and (el.date_from or el.date_to)
            flat = _flatten(root, arrays)
            if windowed:
                flat = F.filter(flat, lambda x: _window(x, p.date, el))
            has = F.coalesce(F.size(flat) > 0, F.lit(False))
            newest = F.array_max(F.transform(flat, lambda x: _dated(x, p, el)))
            m = None
            if el.value_mode != "latest":
                test = lambda x: _element_test(x, leaf, el)
                m = F.exists(flat, test) if windowed else _exists_path(root, arrays, test)
        h.append(has)
        if el.value_mode == "latest":
            n.append(newest)
        else:
            t.append(F.coalesce(m, F.lit(False)))
            u.append(has & m.isNull())
    if el.value_mode == "latest":
        return {"h": _any(h), "n": F.greatest(*n) if len(n) > 1 else n[0]}
    return {"t": _any(t), "u": _any(u), "h": _any(h)}


def row_terms(p: Path, el: Element) -> dict[str, Column]:
    """The element's terms on one item row of the path's source."""
    inside = _window(None, p.date, el) if p.parts[0] and p.date and (el.date_from or el.date_to) else F.lit(True)
    if not p.parts[0]:
        inside = F.col(p.parts[1]).isNotNull()
    if el.value_mode == "latest":
        return {"h": inside, "n": F.when(inside, _dated(None, p, el))}
    m = _element_test(None, p.parts[1], el)
    return {"t": F.coalesce(inside & m, F.lit(False)), "u": inside & m.isNull(), "h": inside}


def merged_terms(name: str, el: Element) -> list[Column]:
    """Partial aggregates of the term columns ``name_t`` … over rows."""
    kinds = ["h", "n"] if el.value_mode == "latest" else ["t", "u", "h"]
    return [(F.max if k == "n" else F.bool_or)(f"{name}_{k}").alias(f"{name}_{k}") for k in kinds]


def finish(el: Element, terms: Mapping[str, Column]) -> tuple[Column, Column, Column]:
    """(passes, matched, has_data) from an element's terms.

    ``matched`` is the raw test over all sources (M25).  ``passes`` applies the
    operator polarity and NULL handling: ``not_contains`` passes when nothing
    matches — vacuously without data (M3) — and other operators fail on a NULL
    test or no data under ``exclude`` and pass under ``include`` (M16)."""
    has = F.coalesce(terms["h"], F.lit(False))
    if el.value_mode == "latest":
        raw = terms["n"]["p"]
    else:
        raw = F.when(terms["t"], F.lit(True)).when(has & ~F.coalesce(terms["u"], F.lit(False)), F.lit(False))
    matched = F.coalesce(raw, F.lit(False))
    return (~matched if el.operator == "not_contains" else F.coalesce(raw, F.lit(el.null_handling == "include"))), matched, has


def should(preds: Sequence[Column], minimum: int = 1) -> Column:
    """``bool.should`` with ``minimum_should_match`` (M7)."""
    return reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(False)).cast("int") for p in preds]) >= minimum


def is_active(measure: Measure, as_of) -> bool:
    """Activation period gate (M20), decided on the driver from literals."""
    d = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))
    lo = _dt.date.fromisoformat(str(measure.active_from)) if measure.active_from else _dt.date.min
    hi = _dt.date.fromisoformat(str(measure.active_to)) if measure.active_to else _dt.date.max
    return lo <= d <= hi


def population(docs: DataFrame, measure: Measure, root: str | None = None) -> DataFrame:
    """Population filters (M21): equality on scalar paths, membership on
    arrays, ``None`` = no filter."""
    out = docs
    for path, value in population_values(measure).items():
        out = out.filter(_selected(docs, path, value, root))
    return out


def _selected(docs: DataFrame, path: str, value, root: str | None) -> Column:
    col = _root(root, path)
    is_array = docs.select(col.alias("c")).schema["c"].dataType.typeName() == "array"
    return F.array_contains(col, F.lit(value)) if is_array else col == F.lit(value)


def population_values(measure: Measure) -> dict[str, object]:
    """Record path → required value of the measure's population filters."""
    return {measure.filter_paths.get(name, name): v for name, v in measure.filters.items() if v is not None}


def enrich_age(docs: DataFrame, as_of, root: str = "patient",
               age: str = "demographics.age", dob: str = "demographics.dob") -> DataFrame:
    """Fill a missing age from the date of birth."""
    if root:
        cur = F.col(f"{root}.{age}")
        filled = F.coalesce(cur, full_years(F.try_to_date(F.col(f"{root}.{dob}").cast("string")), as_of))
        return docs.withColumn(root, F.col(root).withField(age, filled))
    cur = F.col(age)
    filled = F.coalesce(cur, full_years(F.try_to_date(F.col(dob).cast("string")), as_of))
    top, rest = age.split(".", 1)
    return docs.withColumn(top, F.col(top).withField(rest, filled))


def _outcomes(measure: Measure, as_of, terms: Callable[[int, Element], Mapping[str, Column]]) -> list[Column]:
    """Per active element its outcome (``<id>``), raw match and data presence,
    the element flags (M13), and the combined result (M8 M10).  Outside the
    activation period every person fails."""
    cols, passes = [], {}
    for i, el in enumerate(measure.active_elements()):
        p, m, d = finish(el, terms(i, el))
        passes[el.id] = p
        cols += [p.alias(el.id), m.alias(f"{el.id}__match"), d.alias(f"{el.id}__data")]
        if el.flag:
            cols.append((m if el.flag_on == "match" else p).alias(el.flag))
    gating = [passes[e.id] for e in measure.gating()]
    combined = reduce(lambda a, b: a & b, gating) if gating else F.lit(True)
    return cols + [(combined & F.lit(is_active(measure, as_of))).alias(measure.candidate_flag)]


def evaluate(docs: DataFrame, measure: Measure, as_of, root: str | None = None,
             keep: Sequence[str] = ("origid",)) -> DataFrame:
    """Outcomes per person of nested records, one row each."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keep]
    return population(docs, measure, root).select(*cols, *_outcomes(measure, as_of, lambda i, el: record_terms(el, root)))


def worklist(evaluated: DataFrame, measure: Measure, key: str = "origid") -> DataFrame:
    """Persons meeting the measure with the element ids they pass."""
    ids = [e.id for e in measure.active_elements()]
    passed = F.filter(F.array(*[F.when(F.col(i), F.lit(i)) for i in ids]), lambda x: x.isNotNull())
    return evaluated.filter(F.col(measure.candidate_flag)).select(key, passed.alias("passed_elements"))


def report(evaluated: DataFrame, measure: Measure, key: str = "origid") -> DataFrame:
    """One row per (person, element): pass / fail / blocked (no data), M26."""
    items = []
    for e in measure.active_elements():
        outcome = (F.when(~F.col(f"{e.id}__data") & (F.lit(e.operator) != "not_contains"), "blocked")
                   .when(F.col(e.id), "pass").otherwise("fail"))
        items.append(F.struct(F.lit(e.id).alias("element_id"), F.lit(e.name).alias("element_name"),
                              F.lit(e.required).alias("required"), outcome.alias("outcome")))
    return evaluated.select(key, F.explode(F.array(*items)).alias("r")).select(key, "r.*")


def rate(evaluated: DataFrame, measure: Measure, group: Sequence[str],
         denominator: str | None = None) -> DataFrame:
    """Performance rate per group vs goal (M22): numerator = candidates,
    denominator = persons (or those passing ``denominator``)."""
    den = F.col(denominator) if denominator else F.lit(True)
    agg = evaluated.groupBy(*group).agg(
        F.count_if(den).alias("denominator"),
        F.count_if(den & F.col(measure.candidate_flag)).alias("numerator"))
    r = pct("numerator", "denominator", 1)
    goal = measure.performance_goal
    return agg.select(*group, "denominator", "numerator", r.alias("rate"),
                      (F.coalesce(r >= F.lit(float(goal)), F.lit(False)) if goal is not None
                       else F.lit(None).cast("boolean")).alias("meets_goal"))


# ── evaluation by one aggregate on the person ────────────────────────────

def _combined(rows: DataFrame, measure: Measure, as_of, key: str, keep: Sequence[str]) -> DataFrame:
    """Outcomes from rows with term columns ``_e<i>_<kind>``, ``_here`` (the
    person is in the population) and the columns ``keep``."""
    elements = measure.active_elements()
    aggs = [F.bool_or("_here").alias("_here"), *[F.max(n).alias(n) for n in keep]]
    for i, el in enumerate(elements):
        aggs += merged_terms(f"_e{i}", el)
    g = rows.groupBy(key).agg(*aggs).where("_here")
    return g.select(key, *keep, *_outcomes(measure, as_of, lambda i, el: {
        k: F.col(f"_e{i}_{k}") for k in (("h", "n") if el.value_mode == "latest" else ("t", "u", "h"))}))


def evaluate_parts(docs: DataFrame, measure: Measure, as_of, root: str | None = None,
                   key: str = "origid", keep: Sequence = ()) -> DataFrame:
    """:func:`evaluate` for the split record layout ``(origid, part_no,
    n_parts, …)``: every part contributes its terms and one ``groupBy(person)``
    combines them, so a person split over many parts is never gathered in one
    task.  ``keep``: (output name, column) pairs; they and the population
    filters are taken from part 0, which alone has the person's scalars."""
    cols = [F.col(key)]
    for i, el in enumerate(measure.active_elements()):
        cols += [c.alias(f"_e{i}_{k}") for k, c in record_terms(el, root).items()]
    main = F.col("part_no") == 0
    here = [_selected(docs, path, value, root) for path, value in population_values(measure).items()]
    cols.append(F.coalesce(reduce(lambda a, b: a & b, here, main), F.lit(False)).alias("_here"))
    cols += [F.when(main, c).alias(name) for name, c in keep]
    return _combined(docs.select(*cols), measure, as_of, key, [name for name, _ in keep])


def evaluate_items(persons: DataFrame, sources: Mapping[str, DataFrame], measure: Measure, as_of,
                   key: str = "origid", keep: Sequence = ()) -> DataFrame:
    """Outcomes without records.  ``persons`` has one row per person with the
    flat paths as columns; ``sources`` maps an array path
    (``encounters[].diagnoses[]``) to its elements as rows ``(key, fields…)``.

    Each source is read once, for all elements that use it; its rows carry
    their terms into one union and one aggregate on the person.  Rows of
    persons who aren't in ``persons`` or its population count for nobody.
    ``keep``: (output name, column of ``persons``) pairs."""
    used: dict[str, list[tuple[int, Element, Path]]] = {}
    for i, el in enumerate(measure.active_elements()):
        for p in el.paths:
            used.setdefault("".join(f"{a}[]." for a in p.parts[0])[:-1], []).append((i, el, p))
    used.setdefault("", [])
    frames, names = [], {}
    for name, terms in used.items():
        cols: dict[str, Column] = {}
        for i, el, p in terms:
            for k, c in row_terms(p, el).items():
                at = f"_e{i}_{k}"      # two flat paths of one element share a row
                cols[at] = c if at not in cols else F.greatest(cols[at], c) if k == "n" else cols[at] | c
        if name == "":
            df = population(persons, measure)
            cols |= {"_here": F.lit(True), **{n: c for n, c in keep}}
        else:
            df = sources[name]
        frames.append(df.select(key, *[c.alias(n) for n, c in cols.items()]))
        names |= {f.name: f.dataType for f in frames[-1].schema.fields}
    none = {n: F.lit(None).cast(t).alias(n) for n, t in names.items()}
    wide = [df.select(*[n if n in df.columns else none[n] for n in names]) for df in frames]
    return _combined(reduce(DataFrame.union, wide), measure, as_of, key, [n for n, _ in keep])
