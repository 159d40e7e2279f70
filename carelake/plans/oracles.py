"""Independent SQL (DuckDB dialect) for each registered query.

Written from the reference semantics, not from the Spark code: correlated
subqueries, EXISTS / NOT EXISTS and window functions where the Spark plan
uses aggregates and joins.
"""

AS_OF = "DATE '2001-08-01'"
EV_AS_OF = "DATE '2024-01-31'"

_CLS = ("COALESCE(TRY_CAST(NULLIF(regexp_extract(trim(o_orderpriority), '^[0-9]+', 0), '') "
        "AS INTEGER), 0)")

ENC = f"""enc AS (
  SELECT o_custkey AS origid, o_orderkey AS encounter_nr,
         CAST(o_orderdate AS DATE) AS enc_date, {_CLS} AS class_nr,
         CASE o_orderstatus WHEN 'P' THEN 'closed' WHEN 'O' THEN 'open' END AS enc_status,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + {_CLS} END AS discharge_date,
         o_orderstatus AS status, o_orderpriority AS priority, o_totalprice AS amount
  FROM orders)"""

ALERTS = """alerts AS (
  SELECT event_id AS nr, user_id AS origid, event_type AS type, ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 6 AS current_status,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 AS original_status,
         'M' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS VARCHAR) AS ref_description,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS VARCHAR) AS ref_id,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 = 0
              THEN CAST(ts AS DATE) END AS resolved_date,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS k3
  FROM events)"""

DX = """dx AS (
  SELECT o.o_custkey AS origid, l.l_orderkey AS encounter_nr, CAST(o.o_orderdate AS DATE) AS enc_date,
         l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_returnflag, l.l_linestatus,
         CAST(l.l_shipdate AS DATE) AS ship_date, p.p_brand AS code, p.p_type, p.p_name
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN part p ON p.p_partkey = l.l_partkey)"""

LOOKUP = """lookup AS (
  SELECT p_brand AS code, min(p_type) AS hcc, CAST(round(CAST(max(p_retailprice) AS DECIMAL(18,2)) * 0.001, 3) AS DOUBLE) AS coefficient
  FROM part GROUP BY p_brand)"""

SQL = {}

SQL["flag_awv"] = f"""
WITH v AS (
  SELECT o.o_custkey AS k, max(CAST(o.o_orderdate AS DATE)) AS last_date
  FROM orders o
  WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
                AND l.l_returnflag = 'R' AND l.l_linestatus = 'F')
  GROUP BY o.o_custkey)
SELECT c.c_custkey AS origid, strftime(v.last_date, '%Y-%m-%d') AS last_visit,
       (v.last_date IS NULL OR date_diff('day', v.last_date, {AS_OF}) > 365) AS visit_due,
       date_diff('day', v.last_date, {AS_OF}) AS days_since
FROM customer c LEFT JOIN v ON v.k = c.c_custkey"""

SQL["flag_recent_30_90"] = f"""
SELECT c.c_custkey AS origid,
  EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F'
          AND CAST(o.o_orderdate AS DATE) >= {AS_OF} - 30) AS recent_30,
  EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F'
          AND CAST(o.o_orderdate AS DATE) >= {AS_OF} - 90) AS recent_90
FROM customer c"""

SQL["flag_open_encounter"] = f"""
WITH {ENC}
SELECT c.c_custkey AS origid,
  (SELECT strftime(max(enc_date), '%Y-%m-%d') FROM enc WHERE enc.origid = c.c_custkey
     AND class_nr IN (1,2,3,4)) AS last_admission,
  (SELECT strftime(max(discharge_date), '%Y-%m-%d') FROM enc WHERE enc.origid = c.c_custkey
     AND class_nr IN (1,2,3,4) AND discharge_date IS NOT NULL) AS last_discharge,
  EXISTS (SELECT 1 FROM enc WHERE enc.origid = c.c_custkey AND class_nr IN (1,2,3,4)
     AND discharge_date IS NULL AND enc_status != 'closed') AS open_encounter
FROM customer c"""

SQL["flag_alert_counts"] = f"""
WITH {ALERTS},
open_a AS (SELECT * FROM alerts WHERE resolved_date IS NULL AND original_status NOT IN (4, 5))
SELECT c.c_custkey AS origid,
  (SELECT count(*) FROM open_a a WHERE a.origid = c.c_custkey) AS active_alerts,
  (SELECT count(*) FROM open_a a WHERE a.origid = c.c_custkey AND a.type = 'error') AS gaps_open,
  (SELECT string_agg(DISTINCT a.type, ',' ORDER BY a.type) FROM open_a a
     WHERE a.origid = c.c_custkey) AS alert_types,
  (SELECT string_agg(DISTINCT a.ref_description, ',' ORDER BY a.ref_description) FROM open_a a
     WHERE a.origid = c.c_custkey AND a.type = 'error') AS gap_measures
FROM customer c"""

SQL["flag_latest_year_answer"] = """
SELECT c.c_custkey AS origid, y.latest_year,
  COALESCE((SELECT sum(CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END)
            FROM orders o WHERE o.o_custkey = c.c_custkey
              AND year(o.o_orderdate) = y.latest_year) > 0, false) AS urgent_latest,
  (SELECT sum(CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END)
            FROM orders o WHERE o.o_custkey = c.c_custkey
              AND year(o.o_orderdate) = y.latest_year) AS n_urgent_latest
FROM customer c
LEFT JOIN (SELECT o_custkey, max(year(o_orderdate)) AS latest_year FROM orders GROUP BY 1) y
  ON y.o_custkey = c.c_custkey"""

SQL["flag_overdue_interval"] = f"""
WITH p AS (
  SELECT o_custkey AS origid,
    CAST(o_orderdate AS DATE) + COALESCE(TRY_CAST(NULLIF(regexp_extract(trim(
      CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE substr(o_orderpriority, 3, 100) END),
      '^[0-9]+', 0), '') AS INTEGER), 0) AS due
  FROM orders WHERE o_orderstatus IN ('O', 'P'))
SELECT c.c_custkey AS origid,
  EXISTS (SELECT 1 FROM p WHERE p.origid = c.c_custkey AND p.due < {AS_OF}) AS overdue,
  (SELECT strftime(max(due), '%Y-%m-%d') FROM p WHERE p.origid = c.c_custkey) AS next_due
FROM customer c"""

SQL["flag_distinct_threshold"] = f"""
WITH {DX},
agg AS (SELECT origid, count(DISTINCT p_type) AS n, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types
        FROM dx GROUP BY origid)
SELECT c.c_custkey AS origid, COALESCE(agg.n, 0) AS n_types, COALESCE(agg.n, 0) >= 2 AS eligible,
       agg.types
FROM customer c LEFT JOIN agg ON agg.origid = c.c_custkey"""

SQL["flag_latest_score"] = """
SELECT origid, score_year, score_month, score FROM (
  SELECT o_custkey AS origid, year(o_orderdate) AS score_year, month(o_orderdate) AS score_month,
         CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 0.001, 4) AS DOUBLE) AS score,
         row_number() OVER (PARTITION BY o_custkey
                            ORDER BY year(o_orderdate) DESC, month(o_orderdate) DESC,
                                     o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1"""


def pct_sql(num: str, den: str, scale: int = 1) -> str:
    """Exact ROUND(100*num/den, scale) on integers, halves away from zero;
    NULL when den = 0."""
    m = 10 ** scale
    nn = f"(CAST({num} AS BIGINT) * sign(CAST({den} AS BIGINT)))"
    dd = f"abs(CAST({den} AS BIGINT))"
    a = f"(abs({nn}) * {200 * m} + {dd})"
    b = f"(2 * {dd})"
    return (f"CASE WHEN CAST({den} AS BIGINT) <> 0 THEN "
            f"sign({nn}) * CAST((({a}) - ((({a}) % {b}) + {b}) % {b}) // {b} AS DOUBLE) / {m}.0 END")


SQL["roster_latest"] = """
SELECT c.c_custkey AS origid, c.c_name, r.o_orderkey AS roster_key,
       strftime(CAST(r.o_orderdate AS DATE), '%Y-%m-%d') AS roster_date, r.o_orderpriority AS market
FROM customer c
JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn
      FROM orders WHERE o_orderstatus IN ('F', 'O')) r
  ON r.o_custkey = c.c_custkey AND r.rn = 1"""

_ROLE = """(SELECT min(p.s_name) FROM supplier m JOIN supplier p ON p.s_suppkey = m.s_suppkey
   WHERE m.s_nationkey = c.c_nationkey AND m.s_suppkey % 4 = {i})"""
SQL["roster_latest"] = SQL["roster_latest"]
SQL["role_lookup"] = f"""
SELECT c.c_custkey AS origid, {_ROLE.format(i=0)} AS care_manager, {_ROLE.format(i=1)} AS outreach,
       {_ROLE.format(i=2)} AS census_notes, {_ROLE.format(i=3)} AS census_mos
FROM customer c"""

SQL["visits_by_setting"] = """
SELECT event_id AS "EncounterNr", user_id AS "patientId",
       strftime(CAST(ts AS DATE), '%Y-%m-%d') AS "dischargeDate", value AS amount,
       event_type AS setting
FROM events
WHERE event_type IN ('purchase', 'view', 'signup')
  AND CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"""

SQL["spine_union"] = f"""
WITH {ENC}
SELECT 'orders' AS source_system, encounter_nr, origid,
       strftime(enc_date, '%Y-%m-%d') AS enc_date, strftime(discharge_date, '%Y-%m-%d') AS discharge_date,
       priority AS setting, status, round(amount, 2) AS amount,
       date_diff('day', enc.enc_date, COALESCE(enc.discharge_date, {EV_AS_OF})) AS los_days,
       strftime(enc.discharge_date + 7, '%Y-%m-%d') AS tcm_7day,
       strftime(enc.discharge_date + 14, '%Y-%m-%d') AS tcm_14day
FROM enc
UNION ALL
SELECT 'events', event_id, user_id, strftime(CAST(ts AS DATE), '%Y-%m-%d'),
       strftime(CAST(ts AS DATE), '%Y-%m-%d'), event_type, NULL, round(value, 2), 0,
       strftime(CAST(ts AS DATE) + 7, '%Y-%m-%d'), strftime(CAST(ts AS DATE) + 14, '%Y-%m-%d')
FROM events"""

SQL["child_arrays"] = """
SELECT o.o_orderkey, COALESCE(c.n, 0) AS n_lines, COALESCE(c.parts, '') AS parts
FROM orders o LEFT JOIN (
  SELECT l_orderkey, count(*) AS n,
         string_agg(CAST(l_partkey AS VARCHAR), ','
                    ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS parts
  FROM lineitem GROUP BY l_orderkey) c ON c.l_orderkey = o.o_orderkey"""

SQL["chronic"] = f"""
WITH {DX}, {LOOKUP},
cc AS (SELECT origid, code, min(enc_date) AS f, max(enc_date) AS l,
              count(DISTINCT encounter_nr) AS n FROM dx GROUP BY origid, code)
SELECT cc.origid, cc.code, strftime(cc.f, '%Y-%m-%d') AS first_seen,
       strftime(cc.l, '%Y-%m-%d') AS last_seen, cc.n AS encounter_count,
       date_diff('day', cc.l, {AS_OF}) AS days_since_last_seen, lk.hcc, lk.coefficient,
       (lk.hcc IS NOT NULL AND year(cc.l) < year({AS_OF})) AS recapture_needed
FROM cc LEFT JOIN lookup lk ON lk.code = cc.code"""

_RAF = ""
for _ty, _nm in (("1-URGENT", "urgent"), ("2-HIGH", "high"), ("3-MEDIUM", "medium")):
    _RAF += (f", max(CASE WHEN r.type = '{_ty}' THEN r.score END) AS {_nm}_score"
             f", max(CASE WHEN r.type = '{_ty}' THEN r.month END) AS {_nm}_month")
SQL["raf_pivot"] = f"""
WITH r AS (
  SELECT o_custkey AS origid, o_orderpriority AS type, month(o_orderdate) AS month,
         CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 0.001, 4) AS DOUBLE) AS score,
         row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                            ORDER BY month(o_orderdate) DESC, o_orderkey DESC) AS rn
  FROM orders
  WHERE year(o_orderdate) = year({AS_OF}) AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))
SELECT c.c_custkey AS origid{_RAF}
FROM customer c LEFT JOIN r ON r.origid = c.c_custkey AND r.rn = 1
GROUP BY c.c_custkey"""

SQL["hcc_capture"] = f"""
WITH {DX}, {LOOKUP},
el AS (SELECT DISTINCT d.origid, lk.hcc FROM dx d JOIN lookup lk ON lk.code = d.code),
cap AS (SELECT DISTINCT d.origid, lk.hcc FROM dx d JOIN lookup lk ON lk.code = d.code
        WHERE year(d.enc_date) = year({AS_OF})),
s AS (
  SELECT c.c_custkey AS origid,
         (SELECT count(*) FROM el WHERE el.origid = c.c_custkey) AS eligible,
         (SELECT count(*) FROM cap WHERE cap.origid = c.c_custkey) AS captured,
         (SELECT string_agg('HCC-' || el.hcc, ',' ORDER BY 'HCC-' || el.hcc) FROM el
          WHERE el.origid = c.c_custkey
            AND NOT EXISTS (SELECT 1 FROM cap WHERE cap.origid = el.origid AND cap.hcc = el.hcc))
           AS gap_hccs
  FROM customer c)
SELECT origid, eligible, captured, {pct_sql('captured', 'eligible', 1)} AS capture_pct, gap_hccs FROM s"""

SQL["hcc_gaps"] = f"""
WITH {DX}, {LOOKUP}
SELECT DISTINCT d.origid, 'HCC-' || d.code AS gap
FROM dx d
WHERE d.code IN (SELECT code FROM lookup)
  AND NOT EXISTS (SELECT 1 FROM dx d2 WHERE d2.origid = d.origid AND d2.code = d.code
                  AND year(d2.enc_date) = year({AS_OF}))"""

SQL["uamcc_summary"] = f"""
WITH {DX},
u AS (SELECT * FROM dx WHERE ship_date > {AS_OF} - 365 AND ship_date <= {AS_OF}),
agg AS (SELECT origid, count(DISTINCT p_type) AS n,
               string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS categories,
               string_agg(DISTINCT left(p_name, 3), ',' ORDER BY left(p_name, 3)) AS prefixes
        FROM u GROUP BY origid)
SELECT c.c_custkey AS origid, COALESCE(agg.n, 0) AS n_categories, agg.categories, agg.prefixes,
       COALESCE(agg.n, 0) >= 2 AS eligible
FROM customer c LEFT JOIN agg ON agg.origid = c.c_custkey"""

SQL["adherence"] = f"""
WITH m AS (
  SELECT o.o_custkey AS origid, CAST(l.l_shipdate AS DATE) AS start_date,
         CASE WHEN l.l_linestatus = 'F'
              THEN CAST(l.l_shipdate AS DATE) + CAST(l.l_quantity AS INTEGER) END AS stop_date
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  WHERE l.l_returnflag <> 'R' AND l.l_shipdate IS NOT NULL),
agg AS (SELECT origid,
               COALESCE(sum(date_diff('day', start_date, least(COALESCE(stop_date, {AS_OF}), {AS_OF}))), 0) AS covered,
               date_diff('day', min(start_date), {AS_OF}) AS span
        FROM m GROUP BY origid),
s AS (SELECT c.c_custkey AS origid, COALESCE(agg.covered, 0) AS covered, agg.span
      FROM customer c LEFT JOIN agg ON agg.origid = c.c_custkey)
SELECT origid, covered AS covered_days, {pct_sql('covered', 'span', 2)} AS adherence_pct,
       CASE WHEN {pct_sql('covered', 'span', 2)} >= 80 THEN 'Adequate' ELSE 'Inadequate' END AS adherence_label
FROM s"""

SQL["hedis_status"] = f"""
WITH {ALERTS},
h AS (SELECT origid, type AS measure_name, year(ts) AS measure_year, ref_id AS frows_nr, nr, ts,
             resolved_date,
             row_number() OVER (PARTITION BY origid, type, year(ts), ref_id ORDER BY ts DESC, nr DESC) AS rn
      FROM alerts WHERE original_status NOT IN (4, 5))
SELECT origid, measure_name, measure_year, frows_nr, nr AS event_id,
       COALESCE(frows_nr, '') || '_' || CAST(measure_year AS VARCHAR) AS measure_id,
       CASE WHEN resolved_date IS NOT NULL THEN 'Compliant' ELSE 'Gap' END AS status,
       resolved_date IS NULL AS gap_open, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS last_date
FROM h WHERE rn = 1"""

SQL["labs_chain"] = """
SELECT o.o_custkey AS origid, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
       strftime(CAST(l.l_shipdate AS DATE), '%Y-%m-%d') AS result_date, p.p_name AS test_name,
       s.s_name AS item_name, COALESCE(l.l_returnflag IN ('A', 'R'), false) AS abnormal
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN part p ON p.p_partkey = l.l_partkey
LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey"""

SQL["alerts_map"] = f"""
WITH {ALERTS}
SELECT nr, origid, type, current_status AS status_code,
       CASE current_status WHEN 0 THEN 'New' WHEN 1 THEN 'Red' WHEN 2 THEN 'Yellow'
            WHEN 3 THEN 'Acknowledged' WHEN 4 THEN 'Resolved' ELSE 'Unknown' END AS status_desc,
       resolved_date IS NULL AS open, CAST(original_status AS VARCHAR) AS original_status
FROM alerts WHERE original_status NOT IN (4, 5)"""

SQL["food_by_year"] = """
WITH h AS (SELECT o_custkey AS origid, year(o_orderdate) AS y, o_orderpriority AS v,
                  CAST(o_orderdate AS DATE) AS d
           FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority IS NOT NULL
             AND o_orderpriority <> ''),
pv AS (SELECT origid, y, v, max(d) AS last_d FROM h GROUP BY origid, y, v)
SELECT origid, y AS assessment_year, strftime(max(last_d), '%Y-%m-%d') AS latest_date,
       string_agg(v, ', ' ORDER BY last_d DESC, v DESC) AS responses
FROM pv GROUP BY origid, y"""

SQL["appointments"] = """
SELECT e.event_id, e.user_id AS origid, c.c_name AS account_id,
       NULLIF(left(CAST(e.ts AS VARCHAR), 19), '') AS appointment_start,
       CASE CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 3
            WHEN 0 THEN 'Completed' WHEN 1 THEN 'checked_out' ELSE 'Scheduled' END AS patient_status,
       (CASE CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 3
            WHEN 0 THEN 'Completed' WHEN 1 THEN 'checked_out' ELSE 'Scheduled' END)
         IN ('Checked Out', 'Completed', 'checked_out') AS completed
FROM events e JOIN customer c ON c.c_custkey = e.user_id
WHERE e.event_type IN ('click', 'view')"""

SQL["demographics"] = f"""
SELECT o.o_orderkey, o.o_custkey AS origid, strftime(CAST(o.o_orderdate AS DATE), '%Y-%m-%d') AS dob,
       year({AS_OF}) - year(o.o_orderdate)
         - CAST(strftime({AS_OF}, '%m%d') < strftime(o.o_orderdate, '%m%d') AS INTEGER) AS age,
       c.c_name || ' (' || c.c_mktsegment || ')' AS display_name,
       COALESCE(CAST(c.c_nationkey AS VARCHAR), '') || COALESCE(c.c_mktsegment, '') AS phone_primary,
       COALESCE(n.n_name, 'US') AS country,
       CAST(round(CAST(c.c_acctbal AS DECIMAL(18,2)), 1) AS DOUBLE) AS balance
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey"""


# ── measures: written relationally (EXISTS / latest row) over the lines ───
MEAS = f"""lines AS (
  SELECT o.o_custkey AS origid, upper(p.p_brand) AS ucode, upper(p.p_type) AS utype,
         CAST(l.l_shipdate AS DATE) AS sd, l.l_linestatus AS status
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey),
first_o AS (SELECT o_custkey AS origid, min(CAST(o_orderdate AS DATE)) AS fd FROM orders GROUP BY 1),
person AS (
  SELECT c.c_custkey AS origid, c.c_mktsegment AS market,
         COALESCE(CASE WHEN c.c_acctbal >= 0 THEN CAST(floor(c.c_acctbal / 100) AS INTEGER) END,
                  year({AS_OF}) - year(f.fd) - CAST(strftime({AS_OF}, '%m%d') < strftime(f.fd, '%m%d') AS INTEGER)) AS age
  FROM customer c LEFT JOIN first_o f ON f.origid = c.c_custkey),
latest AS (
  SELECT origid, utype FROM (
    SELECT origid, utype, row_number() OVER (PARTITION BY origid ORDER BY sd DESC, utype DESC) AS rn
    FROM lines) WHERE rn = 1),
ev AS (
  SELECT p.origid, p.market, p.age,
         COALESCE(p.age BETWEEN 18 AND 85, false) AS de_age,
         EXISTS (SELECT 1 FROM lines l WHERE l.origid = p.origid
                 AND l.ucode IN ('BRAND#1', 'BRAND#2', 'BRAND#3')) AS de_dx,
         COALESCE((SELECT utype = 'PROMO' FROM latest lt WHERE lt.origid = p.origid), false) AS de_proc,
         COALESCE((SELECT utype IN ('ECONOMY', 'SMALL') FROM latest lt WHERE lt.origid = p.origid), false) AS excl_match,
         EXISTS (SELECT 1 FROM lines l WHERE l.origid = p.origid) AS has_lines
  FROM person p)"""

SQL["measure_range"] = f"WITH {MEAS} SELECT origid, age, de_age AS age_ok FROM ev"
SQL["measure_any_of"] = f"WITH {MEAS} SELECT origid, de_dx AS has_dx FROM ev"
SQL["measure_none_of"] = f"""WITH {MEAS}
SELECT origid, NOT EXISTS (SELECT 1 FROM lines l WHERE l.origid = ev.origid
                           AND l.utype IN ('ECONOMY', 'SMALL')) AS no_exclusion FROM ev"""
SQL["measure_nested2"] = f"""WITH {MEAS}
SELECT origid,
  EXISTS (SELECT 1 FROM lines l WHERE l.origid = ev.origid
          AND l.ucode IN ('BRAND#1', 'BRAND#2', 'BRAND#3') AND l.status = 'F') AS same_element,
  (EXISTS (SELECT 1 FROM lines l WHERE l.origid = ev.origid AND l.ucode IN ('BRAND#1', 'BRAND#2', 'BRAND#3'))
   AND EXISTS (SELECT 1 FROM lines l WHERE l.origid = ev.origid AND l.status = 'F')) AS separate
FROM ev"""
SQL["measure_should"] = f"""WITH {MEAS}
SELECT origid, CAST(de_age AS INTEGER) + CAST(de_dx AS INTEGER) + CAST(de_proc AS INTEGER) AS n_true,
       CAST(de_age AS INTEGER) + CAST(de_dx AS INTEGER) + CAST(de_proc AS INTEGER) >= 2 AS passes
FROM ev"""
SQL["measure_latest_mode"] = f"""WITH {MEAS}
SELECT origid, de_proc AS latest_promo, NOT excl_match AS no_exclusion_latest,
  EXISTS (SELECT 1 FROM lines l WHERE l.origid = ev.origid AND l.utype = 'PROMO'
          AND l.sd >= DATE '2000-01-01') AS promo_since_2000
FROM ev"""
SQL["measure_full"] = f"""WITH {MEAS}
SELECT origid, de_age AS age_eligible, de_dx AS has_dx, excl_match AS has_exclusion,
       de_proc AS proc_present, de_age AND de_dx AND NOT excl_match AS candidate
FROM ev"""
SQL["measure_exclusion_any"] = f"""WITH {MEAS},
x AS (SELECT ev.*, EXISTS (SELECT 1 FROM lines l WHERE l.origid = ev.origid AND l.utype IN ('ECONOMY', 'SMALL')) AS any_excl FROM ev)
SELECT origid, any_excl AS has_exclusion, de_age AND de_dx AND NOT any_excl AS candidate FROM x"""
SQL["measure_population"] = f"""WITH {MEAS}
SELECT origid, de_dx AS has_dx, de_age AND de_dx AND NOT excl_match AS candidate FROM ev WHERE market = 'BUILDING'"""
SQL["measure_latest_two"] = """
WITH l AS (
  SELECT o.o_custkey AS origid, p.p_brand AS brand, p.p_type AS type, CAST(l.l_shipdate AS DATE) AS sd, CAST(o.o_orderdate AS DATE) AS od
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey),
dx AS (
  SELECT origid, brand, row_number() OVER (PARTITION BY origid ORDER BY d DESC, brand DESC) AS rn FROM (
    SELECT origid, brand, sd AS d FROM l UNION ALL SELECT origid, brand, max(od) + 60 FROM l GROUP BY 1, 2)),
pr AS (SELECT origid, type, row_number() OVER (PARTITION BY origid ORDER BY od DESC, type DESC) AS rn FROM l)
SELECT c.c_custkey AS origid,
       COALESCE((SELECT upper(brand) IN ('BRAND#1', 'BRAND#2', 'BRAND#3') FROM dx WHERE dx.origid = c.c_custkey AND rn = 1), false) AS newest_dx,
       COALESCE((SELECT upper(type) = 'PROMO' FROM pr WHERE pr.origid = c.c_custkey AND rn = 1), false) AS newest_encounter_promo,
       COALESCE((SELECT bool_or(upper(type) = 'PROMO') FROM l WHERE l.origid = c.c_custkey AND sd >= DATE '2001-01-01'), true) AS promo_or_none
FROM customer c"""

SQL["measure_report"] = f"""WITH {MEAS}
SELECT origid, 'de-age' AS element_id, 'Age' AS element_name, true AS required,
       CASE WHEN age IS NULL THEN 'blocked' WHEN de_age THEN 'pass' ELSE 'fail' END AS outcome FROM ev
UNION ALL
SELECT origid, 'de-dx', 'Problem/Diagnosis Code', true,
       CASE WHEN NOT has_lines THEN 'blocked' WHEN de_dx THEN 'pass' ELSE 'fail' END FROM ev
UNION ALL
SELECT origid, 'de-excl', 'Exclusion Code', true,
       CASE WHEN NOT excl_match THEN 'pass' ELSE 'fail' END FROM ev
UNION ALL
SELECT origid, 'de-proc', 'Procedure Code', true,
       CASE WHEN NOT has_lines THEN 'blocked' WHEN de_proc THEN 'pass' ELSE 'fail' END FROM ev"""
SQL["measure_rate"] = f"""WITH {MEAS},
g AS (SELECT market, count(*) AS denominator,
             count(*) FILTER (WHERE de_age AND de_dx AND NOT excl_match) AS numerator
      FROM ev GROUP BY market)
SELECT market, denominator, numerator, {pct_sql('numerator', 'denominator', 1)} AS rate,
       COALESCE({pct_sql('numerator', 'denominator', 1)} >= 85, false) AS meets_goal
FROM g"""
SQL["measure_worklist"] = f"""WITH {MEAS}
SELECT origid, concat_ws(',', CASE WHEN de_age THEN 'de-age' END, CASE WHEN de_dx THEN 'de-dx' END,
                         CASE WHEN NOT excl_match THEN 'de-excl' END,
                         CASE WHEN de_proc THEN 'de-proc' END) AS passed_elements
FROM ev WHERE de_age AND de_dx AND NOT excl_match"""
SQL["measure_gap_check"] = f"""WITH {ALERTS}
SELECT c.c_custkey AS origid,
  EXISTS (SELECT 1 FROM alerts a WHERE a.origid = c.c_custkey AND a.original_status NOT IN (4, 5)
          AND a.type = 'error' AND a.resolved_date IS NULL) AS corroborated
FROM customer c"""


# ── change-data capture ───────────────────────────────────────────────────
_OP = ("CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 WHEN 0 THEN 'I' "
       "WHEN 1 THEN 'U' ELSE 'D' END")

SQL["cdc_direct"] = f"""
SELECT e.event_id, 'events' AS "table", {_OP} AS op, CAST(e.user_id AS VARCHAR) AS origid, s.section
FROM events e CROSS JOIN (VALUES ('alerts'), ('hedis_measures'), ('rule_flags')) s(section)"""

SQL["cdc_hop1"] = """
SELECT DISTINCT 'lineitem' AS "table", CAST(o.o_custkey AS VARCHAR) AS origid, s.section
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey AND o.o_orderstatus IN ('F', 'O')
CROSS JOIN (VALUES ('encounters'), ('chronic_conditions')) s(section)
WHERE l.l_linestatus = 'F'"""

SQL["cdc_hop2"] = """
SELECT DISTINCT 'line_detail' AS "table", CAST(o.o_custkey AS VARCHAR) AS origid, 'labs' AS section
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey"""

SQL["cdc_fanout"] = """
SELECT DISTINCT 'supplier' AS "table", CAST(o.o_custkey AS VARCHAR) AS origid, 'care_team' AS section
FROM supplier s JOIN lineitem l ON l.l_suppkey = s.s_suppkey JOIN orders o ON o.o_orderkey = l.l_orderkey"""

SQL["cdc_mass"] = """
SELECT DISTINCT 'code_lookup' AS "table", CAST(o.o_custkey AS VARCHAR) AS origid, s.section
FROM orders o
CROSS JOIN (VALUES ('chronic_conditions'), ('hcc_capture')) s(section)
WHERE EXISTS (SELECT 1 FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
              WHERE l.l_orderkey = o.o_orderkey AND p.p_brand IN (SELECT p_brand FROM part))"""

SQL["cdc_xref"] = f"""
SELECT e.event_id, {_OP} AS op, CAST(c.c_custkey AS VARCHAR) AS origid
FROM events e JOIN customer c ON c.c_name = printf('Customer#%09d', e.user_id)"""

SQL["cdc_dedup_latest"] = """
SELECT CAST(user_id AS VARCHAR) AS origid, 'events' AS trigger_source, max(event_id) AS cdc_sequence
FROM events GROUP BY user_id"""

SQL["cdc_last_writer"] = f"""
SELECT user_id, event_type, event_id, op FROM (
  SELECT CAST(user_id AS VARCHAR) AS user_id, event_type, event_id, {_OP} AS op,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS rn
  FROM events) WHERE rn = 1"""

_DUE = """(NOT EXISTS (SELECT 1 FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
          WHERE o.o_custkey = c.c_custkey AND l.l_returnflag = 'R' AND l.l_linestatus = 'F'
            AND CAST(o.o_orderdate AS DATE) >= DATE '{d}' - 365))"""
_REC = """EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F'
          AND CAST(o.o_orderdate AS DATE) >= DATE '{d}' - {n})"""
SQL["cdc_time_refresh"] = f"""
WITH s AS (
  SELECT c.c_custkey AS origid,
         {_DUE.format(d='2001-07-01')} AS old_visit_due, {_DUE.format(d='2001-08-01')} AS new_visit_due,
         {_REC.format(d='2001-07-01', n=30)} AS old_recent_30, {_REC.format(d='2001-08-01', n=30)} AS new_recent_30,
         {_REC.format(d='2001-07-01', n=90)} AS old_recent_90, {_REC.format(d='2001-08-01', n=90)} AS new_recent_90
  FROM customer c)
SELECT * FROM s
WHERE old_visit_due <> new_visit_due OR old_recent_30 <> new_recent_30 OR old_recent_90 <> new_recent_90"""


# ── documents ─────────────────────────────────────────────────────────────
SQL["doc_json"] = """
WITH n AS (SELECT o_custkey, count(*) AS n_enc,
                  arg_max(strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d'), (CAST(o_orderdate AS DATE), o_orderkey)) AS latest,
                  strftime(min(CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS dob
           FROM orders GROUP BY o_custkey),
cc AS (SELECT o.o_custkey, count(DISTINCT p.p_brand) AS n_cc
       FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey
       GROUP BY o.o_custkey)
SELECT c.c_custkey AS origid, n.n_enc AS n_encounters, n.latest AS latest_encounter,
       cc.n_cc AS n_conditions, n.dob, '2.0' AS schema_version
FROM customer c LEFT JOIN n ON n.o_custkey = c.c_custkey LEFT JOIN cc ON cc.o_custkey = c.c_custkey"""

SQL["doc_profile"] = """
WITH n AS (SELECT o_custkey, count(*) AS n_enc,
                  string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS all_keys
           FROM orders GROUP BY o_custkey),
cc AS (SELECT o.o_custkey, count(DISTINCT p.p_brand) AS n_cc
       FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey
       GROUP BY o.o_custkey),
h AS (SELECT user_id, count(*) AS n_h FROM events
      WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) % 7 NOT IN (4, 5) GROUP BY user_id)
SELECT c.c_custkey AS origid, n.n_enc AS n_encounters, h.n_h AS n_hedis, cc.n_cc AS n_conditions,
       array_to_string(string_split(n.all_keys, ',')[1:3], ',') AS first_encounters
FROM customer c LEFT JOIN n ON n.o_custkey = c.c_custkey LEFT JOIN cc ON cc.o_custkey = c.c_custkey
LEFT JOIN h ON h.user_id = c.c_custkey"""

SQL["doc_missing_keys"] = """
SELECT e.event_id, r.k AS missing_key
FROM events e CROSS JOIN (VALUES ('k'), ('source'), ('version')) r(k)
WHERE json_extract(e.props, '$.' || r.k) IS NULL"""

SQL["doc_cardinality"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

SQL["doc_missing"] = """
SELECT c_custkey AS origid FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey)"""

SQL["stream_replace"] = """
SELECT CAST(o_custkey AS VARCHAR) AS origid, count(*) AS n_orders,
       CAST(round(CAST(sum(o_totalprice) AS DECIMAL(18,2)), 2) AS DOUBLE) AS total,
       strftime(max(CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS last_order
FROM orders GROUP BY o_custkey"""

SQL["stream_compact"] = SQL["stream_replace"]

SQL["stream_trigger"] = """
SELECT CAST(o_custkey AS VARCHAR) AS origid, count(*) >= 10 AS busy, true AS once
FROM orders GROUP BY o_custkey HAVING max(o_orderdate) >= TIMESTAMP '1998-01-01'"""

SQL["doc_files"] = """
WITH n AS (SELECT o_custkey, count(*) AS n_enc, strftime(min(CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS dob
           FROM orders GROUP BY o_custkey),
cc AS (SELECT o.o_custkey, count(DISTINCT p.p_brand) AS n_cc
       FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey
       GROUP BY o.o_custkey)
SELECT c.c_custkey AS origid, n.n_enc AS n_encounters, n.dob, cc.n_cc AS n_conditions
FROM customer c LEFT JOIN n ON n.o_custkey = c.c_custkey LEFT JOIN cc ON cc.o_custkey = c.c_custkey"""

SQL["ext_flags"] = f"""
WITH cap AS ({SQL['hcc_capture']}),
adh AS ({SQL['adherence']})
SELECT cap.origid, cap.capture_pct AS hcc_capture_pct,
       COALESCE(len(string_split(cap.gap_hccs, ',')), 0) AS hcc_gaps_open, cap.gap_hccs AS hcc_gap_codes,
       adh.adherence_pct AS rx_adherence_pct, adh.adherence_label AS rx_adherence_flag
FROM cap JOIN adh ON adh.origid = cap.origid"""

SQL["ext_threshold"] = """
WITH thr(tool, score_threshold) AS (VALUES ('1-URGENT', 300000.0), ('2-HIGH', 250000.0),
                                           ('3-MEDIUM', 200000.0), ('4-NOT SPECIFIED', 150000.0))
SELECT o.o_orderkey, o.o_totalprice AS score_numeric, CAST(thr.score_threshold AS DOUBLE) AS score_threshold,
       o.o_totalprice >= thr.score_threshold AS above_threshold,
       COALESCE(CASE WHEN o.o_orderstatus <> 'P' THEN o.o_orderpriority END, o.o_orderstatus) AS specialty
FROM orders o LEFT JOIN thr ON thr.tool = o.o_orderpriority"""

SQL["doc_parts"] = """
SELECT o_custkey AS origid, CAST(greatest(1, ceil(count(*) / 4.0)) AS INTEGER) AS n_parts,
       count(*) AS n_encounters
FROM orders GROUP BY o_custkey"""

SQL["measure_full_parts"] = SQL["measure_full"]

SQL["doc_domain"] = """
WITH ev AS (SELECT user_id, event_type, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
p AS (SELECT c_custkey, make_date(1930 + c_nationkey, 1 + CAST(c_custkey % 12 AS INTEGER),
                                  1 + CAST(c_custkey % 28 AS INTEGER)) AS b FROM customer),
enc AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
chronic AS (SELECT o.o_custkey, count(DISTINCT pa.p_brand) AS n
            FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey AND o.o_orderstatus IN ('F', 'O')
            JOIN part pa ON pa.p_partkey = l.l_partkey GROUP BY 1),
awv AS (SELECT o.o_custkey, strftime(max(CAST(o.o_orderdate AS DATE)), '%Y-%m-%d') AS d FROM orders o
        WHERE o.o_orderstatus IN ('F', 'O') AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
              AND l.l_returnflag = 'R' AND l.l_linestatus = 'F') GROUP BY 1),
al AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS g FROM ev
       WHERE k % 4 <> 0 AND k % 7 NOT IN (4, 5) GROUP BY 1),
food AS (SELECT user_id, bool_or(k % 3 IN (0, 2)) AS f FROM ev WHERE event_type = 'view'
         AND year(ts) = (SELECT max(year(ts)) FROM ev e2 WHERE e2.user_id = ev.user_id AND e2.event_type = 'view')
         GROUP BY 1),
ride AS (SELECT DISTINCT user_id FROM ev WHERE event_type = 'click'),
hcc AS (SELECT o.o_custkey, count(DISTINCT lk.h) AS n
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey AND o.o_orderstatus = 'P'
        JOIN part pa ON pa.p_partkey = l.l_partkey
        JOIN (SELECT p_brand, min(p_type) AS h FROM part GROUP BY 1) lk ON lk.p_brand = pa.p_brand GROUP BY 1),
labs AS (SELECT o.o_custkey, sum(greatest(COALESCE(x.n, 0), 1)) AS n
         FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) x
           ON x.l_orderkey = o.o_orderkey
         WHERE o.o_orderstatus IN ('F', 'O') GROUP BY 1)
SELECT CAST(c.c_custkey AS VARCHAR) AS origid,
       year(DATE '2001-08-01') - year(p.b) - CAST(strftime(DATE '2001-08-01', '%m%d') < strftime(p.b, '%m%d') AS INTEGER) AS age,
       enc.n AS n_encounters, chronic.n AS n_chronic, awv.d AS awv_last_date,
       COALESCE(al.n, 0) AS active_alerts, COALESCE(al.g, 0) AS hedis_gaps_open,
       COALESCE(food.f, false) AS food_insecurity, ride.user_id IS NOT NULL AS transport_barrier,
       COALESCE(hcc.n, 0) AS eligible_hccs, labs.n AS n_labs
FROM customer c JOIN p ON p.c_custkey = c.c_custkey
LEFT JOIN enc ON enc.o_custkey = c.c_custkey LEFT JOIN chronic ON chronic.o_custkey = c.c_custkey
LEFT JOIN awv ON awv.o_custkey = c.c_custkey LEFT JOIN al ON al.user_id = c.c_custkey
LEFT JOIN food ON food.user_id = c.c_custkey LEFT JOIN ride ON ride.user_id = c.c_custkey
LEFT JOIN hcc ON hcc.o_custkey = c.c_custkey LEFT JOIN labs ON labs.o_custkey = c.c_custkey"""


SQL["visits_domain"] = f"""
SELECT 'M' || CAST(o_orderkey AS VARCHAR) AS "EncounterNr", CAST(o_orderdate AS DATE) AS "admitDate",
       strftime(o_orderdate, '%H:%M') AS "admitTime", CAST(o_orderdate AS DATE) + {_CLS} AS "dischargeDate",
       o_orderpriority AS "groupType", o_orderstatus AS "subGroupType",
       CAST(o_custkey % 7 AS VARCHAR) AS "marketId", 'Market ' || CAST(o_custkey % 7 AS VARCHAR) AS "marketName",
       CAST(o_custkey % 50 AS VARCHAR) AS "facilityId", CAST(o_orderkey % 3 AS VARCHAR) AS "facilitySubId",
       'NPI' || CAST(o_orderkey % 100 AS VARCHAR) AS "providerNpi",
       CAST(o_totalprice AS DECIMAL(14,2)) AS "mh1CalculatedAmount", CAST(o_totalprice * 2 AS DECIMAL(14,2)) AS "mc1CalculatedAmount",
       CAST(o_orderkey % 2 = 0 AS INTEGER) AS "isReferenceAdmitDate",
       CAST(o_orderkey % 3 = 0 AS INTEGER) AS "isReadmission",
       CAST(o_orderkey % 4 = 0 AS INTEGER) AS "isC2Readmission",
       CAST(o_orderkey % 5 = 0 AS INTEGER) AS "isTransferredEncounter",
       CAST(o_orderkey % 6 = 0 AS INTEGER) AS "isSnfRecord",
       CAST(o_orderkey % 7 = 0 AS INTEGER) AS "isSnfAdmitDateReference",
       CAST(o_orderkey % 8 = 0 AS INTEGER) AS "isEmergencyRoomVisit",
       CAST(o_orderkey % 9 = 0 AS INTEGER) AS "isPrimaryCareVisit",
       CAST(o_orderkey % 10 = 0 AS INTEGER) AS "isOfficeVisitRecord",
       CAST(o_orderkey % 11 = 0 AS INTEGER) AS "isOfficeVisitSecondaryRecord",
       CAST(o_orderkey % 12 = 0 AS INTEGER) AS "followUpFlag",
       CAST(o_orderkey % 13 = 0 AS INTEGER) AS "is72HourFollowUp",
       CAST(o_orderkey % 14 = 0 AS INTEGER) AS "is7DayFollowUp",
       CAST(o_orderkey % 15 = 0 AS INTEGER) AS "is14DayFollowUp",
       CAST(o_orderkey % 16 = 0 AS INTEGER) AS "isGlobal14DayFollowUp",
       CAST(o_orderkey % 17 = 0 AS INTEGER) AS "emergencyRoomFollowUp",
       CAST(o_orderkey % 18 = 0 AS INTEGER) AS "observationFollowUp",
       CAST(o_orderkey % 19 = 0 AS INTEGER) AS "isBcdaMatch",
       CAST(o_orderkey % 20 = 0 AS INTEGER) AS "tfuDenominator",
       CAST(o_orderkey % 21 = 0 AS INTEGER) AS "tfuNumerator",
       CAST(o_orderkey % 22 = 0 AS INTEGER) AS "acrNumerator",
       CAST(o_orderkey % 23 = 0 AS INTEGER) AS "acrDenominator",
       CAST(o_orderkey % 24 = 0 AS INTEGER) AS "uamccNumerator",
       CAST(o_orderdate AS DATE) + 3 AS "followUp72HourDate", CAST(o_orderdate AS DATE) + 14 AS "followUpDate",
       CAST(o_orderkey % 20 AS VARCHAR) AS "hospitalId", 'Hospital ' || CAST(o_orderkey % 20 AS VARCHAR) AS "hospitalName",
       CAST({_CLS} AS INTEGER) AS "calculatedBedDays", lower(o_orderpriority) AS "placeOfService",
       CAST(NULL AS VARCHAR) AS "dischargeTime",
       CAST(NULL AS VARCHAR) AS "providerId",
       CAST(NULL AS VARCHAR) AS "facilityName",
       CAST(NULL AS VARCHAR) AS "facilitySubName",
       CAST(NULL AS VARCHAR) AS "primaryPhysician",
       CAST(NULL AS VARCHAR) AS "alignedStatus",
       CAST(NULL AS VARCHAR) AS "secondaryAlignedStatus",
       CAST(NULL AS VARCHAR) AS "hospitalTaxonomy",
       CAST(NULL AS VARCHAR) AS "dischargeType",
       CAST(NULL AS VARCHAR) AS "dischargeText",
       CAST(NULL AS VARCHAR) AS "providerName",
       CAST(NULL AS VARCHAR) AS "providerSpecialty",
       CASE o_orderkey % 13 WHEN 0 THEN 'Acute Hospital' WHEN 1 THEN 'Long Term Care Hospital' WHEN 2 THEN 'Observation'
            WHEN 3 THEN 'Psychiatric' WHEN 4 THEN 'Rehabilitation' WHEN 5 THEN 'SNF' WHEN 6 THEN 'Emergency' WHEN 7 THEN 'HHA'
            WHEN 8 THEN 'Hospice' WHEN 9 THEN 'Part B' WHEN 10 THEN 'Part C' WHEN 11 THEN 'Part D' ELSE 'Part DME' END AS setting
FROM orders
WHERE o_orderstatus = 'P' AND CAST(o_orderdate AS DATE) + {_CLS} BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'"""
