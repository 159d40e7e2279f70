"""Measure definitions.

``HYPERTENSION`` is the reference's measure (layout of its definition file);
``ANALOG`` is the same structure aimed at the driver's tables.
"""

from __future__ import annotations

from carelake.plans.measures import Element, Measure, Path, from_definition

# Fixed values of the reference measure: diagnosis codes, procedure codes
# (blood-pressure result) and exclusion codes, and the flag names written by
# its enrichment step.
HTN_DX_CODES = ["I10", "I11.0", "I11.9", "I12.0", "I12.9", "I13.0", "I13.10", "I13.11", "I13.2",
                "I13.9", "I15.0", "I15.1", "I15.2", "I15.8", "I15.9", "I16.0", "I16.1", "I16.9"]
HTN_PROC_CODES = ["3077F", "3080F"]
HTN_EXCLUSION_CODES = ["G8950", "G8952", "G8783", "G9745", "M1278", "M1279"]
HTN_FLAGS = {"age": "pc001_age_eligible", "dx": "pc001_has_hypertension_dx",
             "excl": "pc001_has_exclusion_proc", "proc": "pc001_bp_measurement_present",
             "candidate": "pc001_candidate"}
GAP_MEASURE_NAMES = ["Controlling High BP", "Controlling High Blood Pressure"]

# Record paths each definition field stands for.
DOC_FIELDS = {
    "patient_age": [Path("demographics.age")],
    "problem_code": [Path("encounters[].diagnoses[].icd_code", "onset_date"),
                     Path("chronic_conditions[].icd_code", "last_seen_date")],
    "procedure_code": [Path("encounters[].procedures[].billing_code", "procedure_date")],
}


def _de(i, name, field, op, value, end="", mode="single", active="1", required="1"):
    return {"id": i, "name": name, "selectedField": field, "comparisonOperator": op,
            "comparisonValue": value, "comparisonValueEnd": end, "valueMode": mode,
            "nullHandling": "exclude", "caseSensitive": "0", "isActive": active,
            "required": required, "sortOrder": "0", "dateRangeStart": None, "dateRangeEnd": None}


def htn_definition(care_team: dict | None = None) -> dict:
    return {
        "measureInfo": {"id": "PC-001", "title": "Hypertension Management", "version": "1.0.0",
                        "status": "draft", "performanceGoal": 85,
                        "activationPeriod": {"startDate": "2025-01-01", "endDate": "2026-12-31"},
                        "filteringHierarchy": {"performanceYear": 2026, "market": None, "group": None,
                                               "subgroup": None, "provider": None, **({"careTeam": care_team} if care_team else {})}},
        "dataElements": [
            _de("de-1", "Age", "patient_age", "between", "18", "85"),
            _de("de-2", "Problem/Diagnosis Code", "problem_code", "contains", ",".join(HTN_DX_CODES)),
            _de("de-3", "Procedure Code", "procedure_code", "contains", ",".join(HTN_PROC_CODES),
                mode="latest"),
            _de("de-4", "Procedure Code", "procedure_code", "not_contains",
                ",".join(HTN_EXCLUSION_CODES), mode="latest"),
        ]}


def htn_measure(ungated=("de-3",), field_paths=None, exclusion_mode: str = "single") -> Measure:
    """The reference measure; ``ungated`` reproduces its combined rule, which
    leaves the procedure element out (SURVEY D8).  The published query and
    script exclude a person for any procedure with an exclusion code
    (``single``); the definition file looks at the newest one (``latest``)."""
    m = from_definition(htn_definition(), field_paths or DOC_FIELDS, ungated=ungated, modes={"de-4": exclusion_mode},
                        flags={"de-1": (HTN_FLAGS["age"], "pass"), "de-2": (HTN_FLAGS["dx"], "pass"),
                               "de-3": (HTN_FLAGS["proc"], "pass"),
                               "de-4": (HTN_FLAGS["excl"], "match")})
    m.candidate_flag = HTN_FLAGS["candidate"]
    return m


def gap_check_element(names=GAP_MEASURE_NAMES) -> Element:
    """Open gap of a named quality measure on the same element."""
    return Element(id="gap-check", name="open quality gap", paths=[Path("hedis_measures[].measure_name")],
                   operator="contains", value=list(names), also=[("gap_open", "eq", True)])


# ── analogue on the driver tables ─────────────────────────────────────────
ANALOG_DX_CODES = ["brand#1", "brand#2", "brand#3"]          # case-insensitive on purpose
ANALOG_PROC_CODES = ["promo"]
ANALOG_EXCLUSION_CODES = ["economy", "small"]


def procedure_element(mode="latest", el_id="de-proc", date_from=None) -> Element:
    return Element(id=el_id, name="Procedure Code", paths=DOC_FIELDS["procedure_code"],
                   operator="contains", value=ANALOG_PROC_CODES, value_mode=mode,
                   case_sensitive=False, date_from=date_from)


def exclusion_element(mode="latest") -> Element:
    return Element(id="de-excl", name="Exclusion Code", paths=DOC_FIELDS["procedure_code"],
                   operator="not_contains", value=ANALOG_EXCLUSION_CODES, value_mode=mode,
                   case_sensitive=False)


def analog_definition() -> dict:
    d = {
        "measureInfo": {"id": "AN-001", "title": "Analogue measure", "version": "1.0.0",
                        "status": "draft", "performanceGoal": 85,
                        "activationPeriod": {"startDate": "2001-01-01", "endDate": "2001-12-31"},
                        "filteringHierarchy": {"market": None, "group": None}},
        "dataElements": [
            _de("de-age", "Age", "patient_age", "between", "18", "85"),
            _de("de-dx", "Problem/Diagnosis Code", "problem_code", "contains", ",".join(ANALOG_DX_CODES)),
            _de("de-proc", "Procedure Code", "procedure_code", "contains", ",".join(ANALOG_PROC_CODES),
                mode="latest"),
            _de("de-excl", "Exclusion Code", "procedure_code", "not_contains",
                ",".join(ANALOG_EXCLUSION_CODES), mode="latest"),
            _de("de-off", "Inactive element", "patient_age", "gte", "200", active="0"),
        ]}
    return d


def analog_element(el_id: str) -> dict:
    return next(e for e in analog_definition()["dataElements"] if e["id"] == el_id)


def analog_measure(exclusion_mode: str = "latest") -> Measure:
    m = from_definition(analog_definition(), DOC_FIELDS, ungated=("de-proc",), modes={"de-excl": exclusion_mode},
                        flags={"de-age": ("age_eligible", "pass"), "de-dx": ("has_dx", "pass"),
                               "de-proc": ("proc_present", "pass"),
                               "de-excl": ("has_exclusion", "match")})
    return m
