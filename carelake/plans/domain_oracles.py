"""SQL of :mod:`carelake.plans.domain_queries`, from the benchmark tables."""

from carelake.plans.oracles import pct_sql

_CLS = "CAST(regexp_extract(o_orderpriority, '^[0-9]+') AS INTEGER)"
#: tables as the derivation names them; D is the day of the records
BASE = f"""
d AS (SELECT DATE '2001-08-01' AS d),
ev AS (SELECT event_id, CAST(user_id AS VARCHAR) AS origid, event_type, ts, CAST(ts AS DATE) AS day, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
       FROM events WHERE user_id IN (SELECT c_custkey FROM customer)),
o AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS origid, o_orderstatus AS st, CAST(o_orderdate AS DATE) AS od, {_CLS} AS cls, o_orderpriority AS pr, o_totalprice AS price
      FROM orders),
l AS (SELECT o.*, l_orderkey, l_partkey, l_linenumber, l_quantity, l_returnflag AS rf, l_linestatus AS ls, CAST(l_shipdate AS DATE) AS sd, p_brand, p_type, p_name, upper(p_brand) AS code
      FROM lineitem JOIN o ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey),
code AS (SELECT upper(p_brand) AS code, min(p_type) AS hcc, ((CAST(round(max(p_retailprice) * 100) AS BIGINT) + 50) // 100) / 1000.0 AS score FROM part GROUP BY 1),
person AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS origid, * FROM customer),
alert AS (SELECT * FROM ev WHERE k % 7 NOT IN (4, 5)),
hcc AS (SELECT l.origid, hcc, bool_or(year(od) = 2001) AS seen, count(DISTINCT l.code) FILTER (year(od) = 2001) AS seen_codes
        FROM l JOIN code USING (code) WHERE st = 'P' GROUP BY ALL),
capture AS (SELECT origid, count(*) AS eligible, count(*) FILTER (seen) AS captured, CAST(sum(seen_codes) AS BIGINT) AS captured_codes,
                   string_agg('HCC-' || hcc, ',' ORDER BY 'HCC-' || hcc) FILTER (NOT seen) AS gaps, count(*) FILTER (NOT seen) AS n_gaps FROM hcc GROUP BY 1),
med AS (SELECT *, CASE WHEN ls = 'F' THEN sd + CAST(l_quantity AS INTEGER) END AS stop FROM l WHERE rf <> 'R'),
span AS (SELECT origid, sd AS a, least(COALESCE(stop, d), d) AS b FROM med, d),
adh AS (SELECT origid, CAST(sum(b - a) AS BIGINT) AS covered, min(a) AS f FROM span GROUP BY 1),
ua AS (SELECT origid, count(DISTINCT p_type) AS n, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS conditions, string_agg(DISTINCT left(code, 3), ',') AS prefixes
       FROM l WHERE st = 'P' AND l_linenumber % 2 = 1 GROUP BY 1),
ride AS (SELECT DISTINCT origid FROM ev WHERE event_type = 'click'),
food AS (SELECT origid, string_agg(a, ', ' ORDER BY t DESC, a DESC) AS responses, strftime(max(t), '%Y-%m-%d') AS latest, bool_or(a <> 'Never true') AS positive
         FROM (SELECT origid, CASE k % 3 WHEN 0 THEN 'Often true' WHEN 1 THEN 'Never true' ELSE 'Sometimes true' END AS a, max(ts) AS t FROM ev WHERE event_type = 'view' GROUP BY ALL)
         GROUP BY 1)"""

_PCT_ADH = pct_sql("COALESCE(adh.covered, 0)", "(DATE '2001-08-01' - adh.f)", 2)


def _raf(kind: str) -> str:
    test = {"pmra": "= '1-URGENT'", "prmra": "= '2-HIGH'", "rmra": "NOT IN ('1-URGENT', '2-HIGH')"}[kind]
    return (f"{kind} AS (SELECT origid, month(od) AS m, ((CAST(round(price * 100) AS BIGINT) + 500) // 1000) / 10000.0 AS s FROM o WHERE year(od) = 2001 AND pr {test} "
            "QUALIFY row_number() OVER (PARTITION BY origid ORDER BY month(od) DESC, price DESC) = 1)")


SQL = {}
SQL["doc_person"] = f"""WITH {BASE},
s AS (SELECT s_nationkey AS n, min(s_name) FILTER (s_suppkey % 4 = 0) AS a, min(s_name) FILTER (s_suppkey % 4 = 1) AS b, min(s_name) FILTER (s_suppkey % 4 = 2) AS c,
             min(s_name) FILTER (s_suppkey % 4 = 3) AS m, string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY s_suppkey) AS nrs FROM supplier GROUP BY 1),
p AS (SELECT *, make_date(1930 + c_nationkey, 1 + CAST(k % 12 AS INTEGER), 1 + CAST(k % 28 AS INTEGER)) AS b0 FROM person)
SELECT p.origid, c_name AS last_name, strftime(b0, '%Y-%m-%d') AS dob, CAST(date_sub('year', b0, DATE '2001-08-01') AS INTEGER) AS age,
       CASE WHEN p.k % 2 = 0 THEN 'Female' ELSE 'Male' END AS sex, '' AS phone, 'US' AS country, false AS verified, p.origid || '_care_team' AS team_id,
       c_nationkey AS market_id, 'NPI' || c_nationkey AS dce_provider_npi, s.a AS care_manager, s.b AS outreach_worker, s.c AS census_manager, s.m AS mos,
       s.nrs AS member_nrs, c_mktsegment AS status, 'AL' AS align_status_code, c_acctbal > 5000 AS ccm_enabled, CAST(p.k % 3 AS VARCHAR) AS ccm_level,
       p.k % 2 = 1 AS consent_on_file
FROM p LEFT JOIN s ON s.n = c_nationkey"""

SQL["doc_flags"] = f"""WITH {BASE},
clinic AS (SELECT *, CASE WHEN st = 'F' THEN od + cls END AS dis FROM o WHERE st IN ('F', 'O')),
stay AS (SELECT origid, bool_or(pr = '1-URGENT' AND dis >= d - 30) AS r30, bool_or(pr = '1-URGENT' AND dis >= d - 90) AS r90,
                max(od) FILTER (cls <= 4) AS adm, max(dis) FILTER (cls <= 4) AS dis, bool_or(cls <= 4 AND st = 'O' AND o_orderkey % 2 = 0) AS open FROM clinic, d GROUP BY 1),
awv AS (SELECT origid, max(od) AS v FROM l WHERE st <> 'P' AND rf = 'R' AND ls = 'F' GROUP BY 1),
al AS (SELECT origid, count(*) AS n, count(*) FILTER (event_type = 'error') AS g, string_agg(DISTINCT 'M' || (k % 10), ',' ORDER BY 'M' || (k % 10)) FILTER (event_type = 'error') AS gm,
              string_agg(DISTINCT CASE event_type WHEN 'error' THEN 'Hedis/Quality' ELSE event_type END, ','
                         ORDER BY CASE event_type WHEN 'error' THEN 'Hedis/Quality' ELSE event_type END) AS types FROM alert WHERE k % 4 <> 0 GROUP BY 1),
meal AS (SELECT DISTINCT origid FROM ev, d WHERE event_type = 'purchase' AND k % 5 <> 0 AND (k % 3 = 0 OR (k % 3 = 1 AND DATE '2001-07-01' + k % 60 >= d))),
raf AS (SELECT origid, ((CAST(round(price * 100) AS BIGINT) + 500) // 1000) / 10000.0 AS s FROM o WHERE pr = '2-HIGH'
        QUALIFY row_number() OVER (PARTITION BY origid ORDER BY year(od) DESC, month(od) DESC, price DESC) = 1),
pl AS (SELECT origid, k % 3 = 1 AS on1, k % 4 = 0 OR k % 60 - 30 >= 0 AS valid,
              CASE WHEN k % 5 = 0 THEN NULL ELSE CASE WHEN k % 5 = 1 THEN 0 ELSE k % 90 END END AS days,
              DATE '2001-05-01' + CAST(CASE WHEN k % 2 = 0 THEN k % 80 ELSE k % 60 END AS INTEGER) AS since FROM person)
SELECT p.origid, raf.s AS raf_score, COALESCE(r30, false) AS readmit_30d, COALESCE(r90, false) AS readmit_90d, strftime(stay.adm, '%Y-%m-%d') AS last_admission_date,
       strftime(stay.dis, '%Y-%m-%d') AS last_discharge_date, COALESCE(open, false) AS open_inpatient, v IS NULL OR d - v > 365 AS awv_due, strftime(v, '%Y-%m-%d') AS awv_last_date,
       p.k % 3 = 0 OR p.k % 800 > 365 AS pcp_visit_overdue, CAST(CASE WHEN p.k % 3 <> 0 THEN p.k % 800 END AS INTEGER) AS pcp_days_since_visit,
       COALESCE(g, 0) AS hedis_gaps_open, gm AS hedis_gap_measures, c_acctbal > 5000 AS ccm_enrolled, p.k % 2 = 1 AS ccm_consent_on_file, CAST(p.k % 3 AS VARCHAR) AS ccm_level,
       COALESCE(food.positive, false) AS sdoh_food_insecurity, ride.origid IS NOT NULL AS sdoh_transport_barrier, meal.origid IS NOT NULL AS sdoh_meal_plan_active,
       on1 AND valid AS care_plan_active, on1 AND days IS NOT NULL AND since + CAST(days AS INTEGER) < d AS care_plan_overdue_reassessment,
       COALESCE(ua.n, 0) >= 2 AS uamcc_eligible, ua.conditions AS uamcc_conditions, COALESCE(ua.n, 0) AS uamcc_condition_count, COALESCE(al.n, 0) AS active_alerts,
       al.types AS unresolved_alert_types, '2001-08-01T00:00:00Z' AS last_updated, {pct_sql('captured', 'eligible', 1)} AS hcc_capture_pct,
       COALESCE(n_gaps, 0) AS hcc_gaps_open, gaps AS hcc_gap_codes, {_PCT_ADH} AS rx_adherence_pct,
       CASE WHEN {_PCT_ADH} >= 80 THEN 'Adequate' ELSE 'Inadequate' END AS rx_adherence_flag
FROM person p CROSS JOIN d JOIN pl USING (origid) LEFT JOIN raf USING (origid) LEFT JOIN stay USING (origid) LEFT JOIN awv USING (origid) LEFT JOIN al USING (origid)
LEFT JOIN food ON food.origid = p.origid LEFT JOIN ride ON ride.origid = p.origid LEFT JOIN meal ON meal.origid = p.origid LEFT JOIN ua ON ua.origid = p.origid
LEFT JOIN capture ON capture.origid = p.origid LEFT JOIN adh ON adh.origid = p.origid"""

SQL["doc_scores"] = f"""WITH {BASE}, {_raf('pmra')}, {_raf('prmra')}, {_raf('rmra')}
SELECT p.origid, pmra.s AS pmra_score, pmra.m AS pmra_month, prmra.s AS prmra_score, prmra.m AS prmra_month, rmra.s AS rmra_score, rmra.m AS rmra_month,
       2001 AS raf_year, p.origid || '_2001_v28' AS capture_id, COALESCE(eligible, 0) AS eligible_hccs, captured AS captured_hccs,
       {pct_sql('captured', 'eligible', 1)} AS capture_pct, gaps AS gap_hccs, 0 AS n_uha, CAST(NULL AS DOUBLE) AS cdi_score, COALESCE(ua.n, 0) AS condition_count,
       COALESCE(ua.n, 0) >= 2 AS program_eligible, ua.conditions, ua.prefixes AS icd_prefixes, COALESCE(adh.covered, 0) AS covered_days, {_PCT_ADH} AS rx_adherence_pct,
       CASE WHEN {_PCT_ADH} >= 80 THEN 'Adequate' ELSE 'Inadequate' END AS adherence_flag, '2.0' AS schema_version, 'initial_load' AS trigger_source,
       '2001-08-01T00:00:00Z' AS created_at
FROM person p LEFT JOIN pmra USING (origid) LEFT JOIN prmra USING (origid) LEFT JOIN rmra USING (origid) LEFT JOIN capture USING (origid) LEFT JOIN ua USING (origid)
LEFT JOIN adh USING (origid)"""

SQL["doc_variants"] = f"""WITH {BASE},
days AS (SELECT DISTINCT origid, unnest(generate_series(a, b - 1, INTERVAL 1 DAY)) AS day FROM span WHERE b > a),
m AS (SELECT origid, count(*) AS covered FROM days GROUP BY 1)
SELECT p.origid, COALESCE(eligible, 0) AS eligible_hccs, captured_codes AS captured_hccs, COALESCE(m.covered, 0) AS covered_days,
       {_PCT_ADH.replace('adh.covered', 'm.covered')} AS rx_adherence_pct
FROM person p LEFT JOIN capture USING (origid) LEFT JOIN adh USING (origid) LEFT JOIN m USING (origid)"""

SQL["doc_chronic"] = f"""WITH {BASE},
cat AS (SELECT origid, code, p_type FROM l WHERE st = 'P'
        QUALIFY row_number() OVER (PARTITION BY origid, code ORDER BY sd DESC, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey DESC) = 1),
c AS (SELECT origid, code, bool_or(rf = 'A') AS comorbid, min(od) AS a, max(od) AS b, count(DISTINCT l_orderkey) AS n FROM l WHERE st <> 'P' GROUP BY ALL)
SELECT c.origid, c.code AS icd_code, hcc AS hcc_number, score AS hcc_score, cat.p_type AS condition_category, comorbid AS is_comorbid, 'Active' AS status,
       strftime(a, '%Y-%m-%d') AS first_onset_date, strftime(b, '%Y-%m-%d') AS last_seen_date, CAST(d - b AS INTEGER) AS days_since_last_seen, n AS encounter_count,
       year(b) < 2001 AS recapture_needed
FROM c CROSS JOIN d JOIN code USING (code) LEFT JOIN cat ON cat.origid = c.origid AND cat.code = c.code"""

SQL["doc_encounters"] = f"""WITH {BASE},
k AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (rf = 'N') AS m, count(*) FILTER (rf = 'A') AS a FROM l GROUP BY 1)
SELECT origid, CASE st WHEN 'P' THEN 'M' ELSE 'A' END || o_orderkey AS encounter_nr, CASE st WHEN 'P' THEN 'mra1' ELSE 'adt' END AS source_system,
       CASE st WHEN 'P' THEN ['Acute Hospital', 'Long Term Care Hospital', 'Observation', 'Psychiatric', 'Rehabilitation', 'SNF', 'Emergency', 'HHA', 'Hospice', 'Part B',
                              'Part C', 'Part D', 'Part DME'][1 + o_orderkey % 13] ELSE pr END AS setting,
       CASE WHEN st = 'F' THEN 'closed' WHEN st = 'O' AND o_orderkey % 2 = 0 THEN 'active' END AS encounter_status,
       strftime(od, '%Y-%m-%d') AS admitted, strftime(CASE WHEN st <> 'O' THEN od + cls END, '%Y-%m-%d') AS discharged,
       CAST(CASE WHEN st <> 'O' THEN cls ELSE d - od END AS INTEGER) AS days, strftime(CASE WHEN st <> 'O' THEN od + cls + 7 END, '%Y-%m-%d') AS tcm_7day,
       CASE st WHEN 'P' THEN o_orderkey % 3 = 0 ELSE pr = '1-URGENT' END AS readmit,
       CASE st WHEN 'P' THEN 'Market ' || CAST(origid AS BIGINT) % 7 END AS market_name, CASE st WHEN 'P' THEN o_orderkey % 3 = 0 END AS is_readmission,
       CAST(CASE st WHEN 'P' THEN 0 ELSE COALESCE(n, 0) END AS INTEGER) AS n_diagnoses, CAST(COALESCE(n, 0) AS INTEGER) AS n_procedures,
       CAST(COALESCE(m, 0) AS INTEGER) AS n_medications, CAST(CASE st WHEN 'P' THEN 0 ELSE COALESCE(a, 0) END AS INTEGER) AS n_comorbid,
       CAST(NULL AS VARCHAR) AS specialty, CAST(NULL AS VARCHAR) AS specialty_code
FROM o CROSS JOIN d LEFT JOIN k ON l_orderkey = o_orderkey"""

SQL["doc_labs"] = f"""WITH {BASE}
SELECT o.origid, 'A' || o.o_orderkey AS encounter_nr, strftime(o.od, '%Y-%m-%d') AS result_date, l_partkey AS item_id, p_name AS test_name,
       CAST(l_quantity AS VARCHAR) AS result_value, CASE rf WHEN 'R' THEN 'H' WHEN 'A' THEN 'L' END AS alert_flag, COALESCE(rf IN ('R', 'A'), false) AS abnormal,
       o.st AS result_status
FROM o LEFT JOIN l ON l_orderkey = o.o_orderkey WHERE o.st <> 'P'"""

SQL["doc_medications"] = f"""WITH {BASE}
SELECT origid, p_brand AS medication_name, strftime(sd, '%Y-%m-%d') AS start_date, strftime(stop, '%Y-%m-%d') AS stop_date, stop IS NULL OR stop >= d AS active,
       'DrFirst' AS source, 'n' AS delete_status FROM med, d"""

SQL["doc_alerts"] = f"""WITH {BASE}
SELECT origid, 'alert' AS kind, CAST(event_id AS VARCHAR) AS id, CASE event_type WHEN 'error' THEN 'Hedis/Quality' ELSE event_type END AS name,
       COALESCE(['New', 'Red', 'Yellow', 'Acknowledged', 'Resolved'][1 + k % 6], 'Unknown') AS status, k % 4 <> 0 AS open, strftime(day, '%Y-%m-%d') AS date FROM alert
UNION ALL SELECT origid, 'hedis', '_2001', 'M' || (k % 10), CASE WHEN k % 4 = 0 THEN 'Compliant' ELSE 'Gap' END, k % 4 <> 0, NULL FROM alert WHERE event_type = 'error'"""

SQL["doc_sdoh"] = f"""WITH {BASE},
m AS (SELECT origid, count(*) AS n, count(*) FILTER (k % 2 = 0) AS g FROM ev WHERE event_type = 'purchase' GROUP BY 1)
SELECT p.origid, COALESCE(responses, '') AS responses, COALESCE(latest, '') AS latest, COALESCE(positive, false) AS food_insecurity_flag,
       ride.origid IS NOT NULL AS transport_barrier_flag, CAST(COALESCE(m.n, 0) AS INTEGER) AS n_meal_plans, CAST(m.g AS INTEGER) AS n_gift_cards
FROM person p LEFT JOIN food USING (origid) LEFT JOIN ride ON ride.origid = p.origid LEFT JOIN m ON m.origid = p.origid"""

SQL["doc_lists"] = f"""WITH {BASE}, e AS (SELECT *, CAST(event_id AS VARCHAR) AS id, strftime(day, '%Y-%m-%d') AS date FROM ev)
SELECT origid, 'assessments' AS section, id, date, 'Tool ' || (k % 4) || '|' || CASE WHEN k % 9 = 0 THEN 'n/a' ELSE CAST(k AS VARCHAR) END AS text FROM e WHERE event_type = 'error'
UNION ALL SELECT origid, 'transport_benefits', id, date, '' FROM e WHERE event_type = 'click'
UNION ALL SELECT origid, 'emr_appointments', id, date, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '|' || origid || '|true' FROM e WHERE event_type = 'signup'
UNION ALL SELECT origid, 'meal_plans', id, date, concat_ws('|', CASE WHEN k % 5 <> 0 THEN 'ordered' ELSE 'cancelled' END,
    CASE k % 3 WHEN 1 THEN strftime(DATE '2001-07-01' + k % 60, '%Y-%m-%d') WHEN 2 THEN '2000-01-01' END) FROM e WHERE event_type = 'purchase'
UNION ALL SELECT origid, 'reward_programs', id, date, 'Program ' || (k % 3) FROM e WHERE event_type = 'purchase'
UNION ALL SELECT origid, 'details', CAST((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS VARCHAR), strftime(sd, '%Y-%m-%d'), p_type || '|' || code || '|' || rf
    FROM l WHERE st = 'P' AND l_linenumber % 2 = 1"""

SQL["refresh_pruned"] = f"""WITH {BASE},
who AS (SELECT DISTINCT origid FROM ev WHERE event_type = 'signup' AND k % 10 = 7)
SELECT origid, CAST((SELECT count(*) FROM o WHERE o.origid = who.origid) AS INTEGER) AS n_encounters,
       CAST((SELECT count(*) FROM o LEFT JOIN l ON l_orderkey = o.o_orderkey WHERE o.origid = who.origid AND o.st <> 'P') AS INTEGER) AS n_labs,
       CAST((SELECT count(*) FROM alert WHERE alert.origid = who.origid) AS INTEGER) AS n_alerts
FROM who"""

SQL["cdc_roster_xref"] = """
WITH p AS (SELECT c_custkey AS k, c_nationkey AS n FROM customer), r AS (SELECT 'dc_bene_alignment_rostr_m01' AS t)
SELECT t AS "table", CAST(k AS VARCHAR) AS origid FROM p, r WHERE k % 10 IN (0, 1, 3) AND (k % 10 <> 1 OR k - 1 IN (SELECT k FROM p))
UNION SELECT 'person_xref', CAST(k AS VARCHAR) FROM p WHERE k % 50 = 7
UNION SELECT 'person_xref', CAST(k + 1 AS VARCHAR) FROM p WHERE k % 50 = 7
UNION SELECT 'personell', CAST(k AS VARCHAR) FROM p WHERE n = (SELECT s_nationkey FROM supplier WHERE s_suppkey = 4)"""

# the values themselves on every day up to the new year, and the first day on which one differs from the day before
SQL["cdc_due"] = f"""WITH {BASE},
day AS (SELECT CAST(unnest(generate_series(DATE '2001-08-01', DATE '2002-01-01', INTERVAL 1 DAY)) AS DATE) AS t),
stay AS (SELECT origid, od + cls AS dis FROM o WHERE st = 'F' AND pr = '1-URGENT'),
awv AS (SELECT origid, max(od) AS v FROM l WHERE st <> 'P' AND rf = 'R' AND ls = 'F' GROUP BY 1),
meal AS (SELECT origid, CASE k % 3 WHEN 1 THEN DATE '2001-07-01' + k % 60 WHEN 2 THEN DATE '2000-01-01' END AS e FROM ev WHERE event_type = 'purchase' AND k % 5 <> 0),
f AS (
  SELECT t, origid, 1 AS rule, CAST(max(dis) >= t - 30 AS INTEGER) AS v FROM day, stay GROUP BY t, origid
  UNION ALL SELECT t, origid, 2, CAST(max(dis) >= t - 90 AS INTEGER) FROM day, stay GROUP BY t, origid
  UNION ALL SELECT t, origid, 3, CAST(t - v > 365 AS INTEGER) FROM day, awv
  UNION ALL SELECT t, origid, 4, CAST(t - (DATE '2001-08-01' - CAST(k % 800 AS INTEGER)) > 365 AS INTEGER) FROM day, person WHERE k % 3 <> 0
  UNION ALL SELECT t, origid, 5, CAST(bool_or(e IS NULL OR e >= t) AS INTEGER) FROM day, meal GROUP BY t, origid
  UNION ALL SELECT t, origid, 6, CAST(k % 4 = 0 OR DATE '2001-08-01' + CAST(k % 60 - 30 AS INTEGER) >= t AS INTEGER) FROM day, person WHERE k % 3 = 1
  UNION ALL SELECT t, origid, 7, CAST(DATE '2001-05-01' + CAST(CASE WHEN k % 2 = 0 THEN k % 80 ELSE k % 60 END + CASE WHEN k % 5 = 1 THEN 0 ELSE k % 90 END AS INTEGER) < t AS INTEGER)
            FROM day, person WHERE k % 3 = 1 AND k % 5 <> 0
  UNION ALL SELECT t, origid, 8, CAST(date_sub('year', make_date(1930 + c_nationkey, 1 + CAST(k % 12 AS INTEGER), 1 + CAST(k % 28 AS INTEGER)), t) AS INTEGER) FROM day, person
  UNION ALL SELECT t, origid, 9, CAST(count(*) FILTER (stop >= t) AS INTEGER) FROM day, med WHERE stop IS NOT NULL GROUP BY t, origid
  UNION ALL SELECT t, origid, 10, CAST(year(t) AS INTEGER) FROM day, person),
c AS (SELECT origid, t, v <> lag(v) OVER (PARTITION BY origid, rule ORDER BY t) AS changed FROM f)
SELECT origid, strftime(min(t), '%Y-%m-%d') AS next_due FROM c WHERE changed GROUP BY 1"""
