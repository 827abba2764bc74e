"""The same results in plain SQL, written from the meaning of each job.

Every query is a chain of named steps; ``sql`` puts the steps it needs in front
of the final select. Lookups are correlated subqueries or self joins on purpose,
so that they share nothing with the window and aggregate forms of the jobs.
"""

from __future__ import annotations

import re

from spanbill.sources.fixtures import edited_row, wide_row
from spanbill.sources.tables import AUDITED, types


def pname(c: str) -> str:
    return (
        f"CASE WHEN lower({c}) = 'gtc' THEN 'GtC' WHEN lower({c}) IN ('ytc','yes','map') THEN 'YtC' ELSE 'na' END"
    )


def canon(c: str) -> str:
    return f"CASE lower({c}) WHEN 'ytc' THEN 'YtC' WHEN 'gtc' THEN 'GtC' ELSE lower({c}) END"


def gnum(c: str) -> str:
    return f"'G' || repeat('0', greatest(8 - length(CAST({c} AS VARCHAR)), 0)) || CAST({c} AS VARCHAR)"


def pyear(c: str) -> str:
    first = f"(year({c}) - CASE WHEN quarter({c}) < 3 THEN 1 ELSE 0 END)"
    return f"CAST({first} AS VARCHAR) || '-' || CAST({first} + 1 AS VARCHAR)"


def years(a: str, b: str) -> str:
    return (
        f"(year({b}) - year({a}) - CASE WHEN month({b}) * 100 + day({b}) < month({a}) * 100 + day({a})"
        f" THEN 1 ELSE 0 END)"
    )


PCT = """CASE p_type WHEN 'STANDARD' THEN {0} WHEN 'ECONOMY' THEN {1} WHEN 'MEDIUM' THEN {2}
 WHEN 'PROMO' THEN {3} WHEN 'LARGE' THEN {4} WHEN 'SMALL' THEN {5} END"""


def pct(*v: str) -> str:
    return "CAST(" + PCT.format(*v) + " AS DECIMAL(5,3))"


PCTS = ("ind_percent", "small_percent", "inter_percent", "large_percent")
P4 = ", ".join(PCTS)


def amt(every: int, value: str) -> str:
    return f"CASE WHEN o_orderkey % {every} = 0 THEN CAST({value} AS DECIMAL(10,4)) END"


STEPS = {
    "ev": "SELECT event_id, user_id, event_type, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "status": """SELECT event_id AS status_id, user_id AS person_id,
  CAST(CASE event_type WHEN 'signup' THEN 2
    WHEN 'error' THEN CASE WHEN event_id % 3 = 0 THEN 12 ELSE 3 END
    WHEN 'purchase' THEN 13 + event_id % 4 WHEN 'click' THEN 6 + event_id % 2
    ELSE CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 4 ELSE 5 END END AS INTEGER) AS kind,
  CASE WHEN k % 20 = 13 THEN 'rtp' ELSE CASE k % 5 WHEN 0 THEN 'gtc' WHEN 1 THEN 'ytc' WHEN 2 THEN 'YES'
    WHEN 3 THEN 'Map' ELSE 'GTC' END END AS program,
  DATE '2012-01-01' + CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 80 + hour(ts) AS INTEGER) AS status_date,
  CASE WHEN k % 10 = 0 THEN event_id END AS undone_by,
  CASE WHEN k % 7 = 0 THEN '' WHEN k % 7 > 1 THEN 'note ' || CAST(k AS VARCHAR) END AS notes FROM ev""",
    "contact": f"""SELECT c_custkey AS person_id, {gnum('c_custkey')} AS g_number,
  CASE WHEN c_custkey % 50 = 0 THEN 'test' ELSE c_mktsegment END AS first_name,
  CASE WHEN c_custkey % 50 = 25 THEN 'testSD' ELSE c_name END AS last_name,
  CASE WHEN c_custkey % 3 = 0 THEN 'M' END AS middle_name,
  DATE '1990-01-01' + CAST(c_custkey * 37 % 7000 AS INTEGER) AS dob,
  CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS gender,
  'p' || CAST(c_custkey AS VARCHAR) || '@school.example' AS email_main,
  'p' || CAST(c_custkey AS VARCHAR) || '@home.example' AS email_alt,
  'S' || CAST(c_custkey AS VARCHAR) AS ssid, 'HS ' || CAST(c_nationkey AS VARCHAR) AS last_school,
  CAST(c_custkey % 25 AS DECIMAL(6,2)) AS hs_credits, CAST((c_custkey % 40) * 0.1 AS DECIMAL(4,2)) AS hs_gpa
  FROM customer""",
    "districts": "SELECT n_nationkey AS district_id, n_name AS district_name FROM nation",
    "kinds": """SELECT * FROM (VALUES (13, 'YtC Credit'), (14, 'YtC ELL Credit'), (15, 'YtC ELL Attendance'),
  (16, 'YtC Attendance')) AS t(kind, kind_text)""",
    "reasons": """SELECT n_nationkey + 1 AS reason_id, CASE n_nationkey WHEN 0 THEN 'Graduated'
  WHEN 1 THEN 'Moved out of District/State (Specify District/State)' WHEN 2 THEN '10 Days Absent'
  WHEN 3 THEN 'Accepted/No Show' WHEN 4 THEN 'Transfer to other school' ELSE n_name END AS reason_text,
  CASE WHEN n_nationkey < 15 THEN n_nationkey + 1 ELSE n_nationkey + 36 END AS reason_num FROM nation""",
    "status_reason": """SELECT event_id AS status_id, k % 20 + 1 AS reason_id FROM ev WHERE event_type = 'error' AND k % 4 <> 0
  UNION ALL SELECT event_id, k % 20 + 3 FROM ev WHERE event_type = 'error' AND k % 8 = 1""",
    "secondary": """SELECT event_id AS status_id, k % 25 + 1 AS reason_id FROM ev WHERE event_type = 'error' AND k % 3 = 1
  UNION ALL SELECT event_id, k * 7 % 25 + 1 FROM ev WHERE event_type = 'error' AND k % 3 = 1""",
    "status_district": """SELECT event_id AS status_id, k % 25 AS district_id, 'D' || CAST(k AS VARCHAR) AS district_student_number
  FROM ev WHERE event_type = 'click' AND event_id % 2 = 1""",
    "coaches": "SELECT s_suppkey AS coach_id, s_name AS coach_name FROM supplier",
    "status_coach": "SELECT event_id AS status_id, event_id % 10 AS coach_id FROM ev WHERE event_type = 'click' AND event_id % 2 = 0",
    "risks": "SELECT DISTINCT o_custkey AS person_id, CAST(o_orderpriority[1:1] AS INTEGER) AS risk_id FROM orders",
    "risk_factors": "SELECT DISTINCT CAST(o_orderpriority[1:1] AS INTEGER) AS risk_id, substring(o_orderpriority, 3, 20) AS risk_name FROM orders",
    "comments": """SELECT event_id AS comment_id, user_id AS person_id, 'comment ' || CAST(k AS VARCHAR) AS comment_text
  FROM ev WHERE event_type = 'view'""",
    # --- calendar, bills, items
    "od": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
  CAST(o_orderdate + INTERVAL 17 YEAR AS DATE) AS day FROM orders""",
    "calendar": f"""SELECT year(b) * 100 + quarter(b) AS term, {pyear('b')} AS program_year,
  (quarter(b) + 1) % 4 + 1 AS program_quarter, b AS term_begin,
  CAST(b + INTERVAL 3 MONTH AS DATE) - 11 AS term_end, CAST(b + INTERVAL 3 MONTH AS DATE) AS next_begin
  FROM (SELECT DISTINCT CAST(date_trunc('quarter', day) AS DATE) AS b FROM od)""",
    "bills": f"""SELECT o_orderkey AS bill_id, person_id, pidm, g_number, program, term, start_date, end_date,
  start_date - CAST(person_id % 60 AS INTEGER) AS enrolled_date,
  CASE WHEN o_orderkey % 3 = 0 THEN end_date + CAST(o_orderkey % 20 AS INTEGER) END AS exit_date,
  CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS include_flag, CAST(o_orderkey % 2 AS INTEGER) AS reviewed_flag,
  {amt(19, '5')} AS adjusted_days, {amt(5, '9')} AS max_days_period, {amt(4, '15')} AS max_days_month,
  {amt(6, '4.5')} AS generated_amount, {amt(6, '0')} AS generated_over,
  {amt(11, '3.25')} AS corrected_units, {amt(11, '1.5')} AS corrected_over_units,
  {amt(11, '3.25')} AS corrected_amount, {amt(11, '0.75')} AS corrected_over,
  {amt(13, '2.5')} AS final_units, {amt(13, '0.5')} AS final_over_units, {amt(13, '2.55')} AS final_amount,
  {amt(13, '0.25')} AS final_over, {amt(17, '1.25')} AS post_amount, {amt(17, '0')} AS post_over,
  c_nationkey AS district_id FROM (
  SELECT *, o_custkey AS person_id, CASE WHEN o_custkey % 97 <> 3 THEN o_custkey * 10 + o_orderkey % 2 END AS pidm,
    {gnum('o_custkey')} AS g_number, year(day) * 100 + quarter(day) AS term,
    CASE CAST(o_orderpriority[1:1] AS INTEGER) WHEN 1 THEN 'YtC Attendance' WHEN 2 THEN 'YtC ELL Attendance'
      WHEN 3 THEN 'YtC Credit' WHEN 4 THEN 'YtC ELL Credit' ELSE 'GtC' END AS program,
    CASE WHEN o_orderpriority[1:1] IN ('1','2') THEN CAST(date_trunc('month', day) AS DATE)
        + CASE WHEN day(day) > 15 AND month(day) % 4 = 0 THEN 15 ELSE 0 END
      ELSE CAST(date_trunc('quarter', day) AS DATE) END AS start_date,
    CASE WHEN o_orderpriority[1:1] IN ('1','2') THEN last_day(day)
      ELSE CAST(date_trunc('quarter', day) + INTERVAL 3 MONTH AS DATE) - 1 END AS end_date
  FROM od) b JOIN customer ON c_custkey = b.person_id""",
    "cycles": f"""SELECT CASE billing_type WHEN 'Attendance' THEN year(start_date) * 10000 + month(start_date) * 100 + day(start_date)
    ELSE term END AS cycle_id, billing_type, start_date, term, program_year,
  CASE WHEN start_date < DATE '2016-01-01' THEN start_date + 40 END AS close_date,
  CASE billing_type WHEN 'Attendance' THEN CAST(10 + month(start_date) % 5 AS DECIMAL(10,4)) END AS max_days_period,
  CASE billing_type WHEN 'Term' THEN CAST(12 AS DECIMAL(10,4)) END AS max_credits,
  CASE billing_type WHEN 'Term' THEN CAST(175 AS DECIMAL(10,4)) END AS max_days_year
  FROM (SELECT DISTINCT CASE WHEN program LIKE '%Attendance%' THEN 'Attendance' ELSE 'Term' END AS billing_type,
    start_date, term, {pyear('start_date')} AS program_year FROM bills)""",
    "scen": f"""SELECT p_partkey AS crn, p_type AS scenario_name, {pct('1','0','0','0','0.5','NULL')} AS ind_percent,
  {pct('0','1','0','0','0.5','0')} AS small_percent, {pct('0','0','1','0','0','0.25')} AS inter_percent,
  {pct('0','0','0','1','0','0.75')} AS large_percent, p_type AS scenario_id FROM part""",
    "items": f"""SELECT item_id, bill_id, i.crn, attendance, credits, include_flag,
  CASE state WHEN 1 THEN s.scenario_name WHEN 2 THEN 'old' END AS scenario_name,
  {', '.join(f'CASE WHEN state = 1 THEN s.{p} END AS {p}' for p in PCTS)}
  FROM (SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(n AS VARCHAR) AS item_id,
    (l_orderkey * 10 + l_linenumber + n - 1) % 4 AS state, l_orderkey AS bill_id, l_partkey AS crn,
    CAST(CAST(l_quantity AS DECIMAL(12,2)) * 0.1 AS DECIMAL(12,3)) AS attendance, CAST(l_linenumber AS DECIMAL(6,2)) AS credits,
    CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END AS include_flag
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity,
      l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS n FROM lineitem)) i JOIN scen s ON s.crn = i.crn""",
    # --- courses and scores
    "courses": f"""SELECT {gnum('o_custkey')} AS student, year(day) * 100 + quarter(day) AS term, l_partkey AS crn,
  CASE l_partkey % 6 WHEN 0 THEN 'ESOL' WHEN 1 THEN 'ESL' WHEN 2 THEN 'MTH' WHEN 3 THEN 'WR' WHEN 4 THEN 'esol' ELSE 'RD' END AS subject,
  CAST(l_linenumber AS VARCHAR) AS course_number, CASE l_suppkey % 2 WHEN 0 THEN 'CR' ELSE 'NC' END AS course_level,
  CASE WHEN l_partkey % 6 < 2 THEN 'Level ' || CAST(l_partkey % 9 AS VARCHAR) || ' Academic ' ||
    CASE l_partkey % 2 WHEN 0 THEN 'Reading' ELSE 'Writing' END ELSE 'Course ' || CAST(l_partkey AS VARCHAR) END AS title,
  CAST(l_linenumber AS DECIMAL(6,2)) AS credits,
  CASE l_partkey % 7 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'D' WHEN 4 THEN 'F' WHEN 5 THEN 'P' END AS grade,
  CASE WHEN l_partkey % 7 < 4 THEN 'Y' ELSE 'N' END AS passed FROM lineitem JOIN od ON l_orderkey = o_orderkey""",
    "results": """SELECT student, term, CAST(round(CAST(CAST(sum(length(title)) AS DOUBLE) / count(*) AS DECIMAL(18,6)), 2) AS DOUBLE) AS gpa,
  CAST(sum(credits) AS DOUBLE) AS attempted, CAST(sum(CASE WHEN passed = 'Y' THEN credits END) AS DOUBLE) AS earned
  FROM courses GROUP BY student, term""",
    "gtc": """SELECT c_custkey AS person_id, CAST(c_custkey % 10 AS DECIMAL(6,2)) AS interview_score,
  CAST(c_custkey % 7 AS DECIMAL(6,2)) AS essay_score, CAST(c_custkey % 5 AS DECIMAL(6,2)) AS grammar_score,
  CAST(c_custkey % 11 AS DECIMAL(6,2)) AS math_score, CAST(c_custkey % 13 AS DECIMAL(6,2)) AS reading_score
  FROM customer WHERE c_custkey % 3 <> 0""",
    "ytc": """SELECT person_id, CAST(base + person_id % 7 AS INTEGER) AS social_score, other AS science_score, other AS math_score,
  other AS literature_score, other AS writing_score, other AS language_score, f AS social_date, f + 10 AS science_date,
  f + 20 AS math_date, CASE WHEN person_id % 9 <> 4 THEN f + 5 END AS literature_date, f + 15 AS writing_date,
  f + 30 AS language_date, CASE WHEN person_id % 5 <> 0 THEN f + 45 END AS completion_date FROM (
  SELECT c_custkey AS person_id, CASE WHEN c_custkey % 2 = 0 THEN 405 ELSE 140 END AS base,
    CAST(CASE WHEN c_custkey % 2 = 0 THEN 410 ELSE 146 END AS INTEGER) AS other,
    DATE '2012-03-01' + CAST(c_custkey * 13 % 1800 AS INTEGER) AS f FROM customer WHERE c_custkey % 4 <> 3)""",
    "yes": """SELECT person_id, CAST(s AS INTEGER) AS social_score, CAST(s + 1 AS INTEGER) AS science_score,
  CAST(s + 2 AS INTEGER) AS math_score, CAST(s + 3 AS INTEGER) AS literature_score, CAST(s + 4 AS INTEGER) AS writing_score,
  f AS social_date, f + 3 AS science_date, f + 6 AS math_date, CASE WHEN person_id % 10 <> 7 THEN f + 9 END AS literature_date,
  f + 2 AS writing_date, f + 12 AS completion_date FROM (
  SELECT c_custkey AS person_id, 405 + c_custkey % 9 AS s, DATE '2013-01-01' + CAST(c_custkey * 7 % 1500 AS INTEGER) AS f
  FROM customer WHERE c_custkey % 3 = 1)""",
    "sis": f"""SELECT {gnum('c_custkey')} AS student, CAST(c_custkey % 40 AS DOUBLE) AS overall_gpa,
  CAST(c_custkey % 90 AS DOUBLE) AS overall_attempted, CAST(c_custkey % 80 AS DOUBLE) AS overall_earned,
  c_mktsegment AS reported_race, CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS gender,
  {', '.join(f"CASE WHEN c_custkey % {m} = 0 THEN 'Y' ELSE 'N' END AS {n}" for n, m in
   [('asian', 2), ('native', 3), ('black', 4), ('hispanic', 5), ('islander', 6), ('white', 7)])}
  FROM customer WHERE c_custkey % 10 <> 9""",
    "awards": f"""SELECT {gnum('c_custkey')} AS student, CASE c_custkey % 5 WHEN 0 THEN c_mktsegment WHEN 1 THEN '' END AS major
  FROM customer WHERE c_custkey % 5 < 3""",
    "cohort": f"""SELECT c_custkey AS person_id, {gnum('c_custkey')} AS g_number,
  CASE WHEN c_custkey % 2 = 0 THEN 'done' END AS exit_reason, CAST(2012 + c_custkey % 5 AS INTEGER) AS cohort,
  'Coach ' || CAST(c_custkey % 10 AS VARCHAR) AS coach FROM customer WHERE c_custkey % 3 = 0""",
    "enroll_results": f"""SELECT {gnum('c_custkey')} AS g_number, CAST((2012 + c_custkey % 4) * 100 + 1 + c_custkey % 4 AS INTEGER) AS first_term,
  CASE WHEN c_custkey % 6 <> 0 THEN CAST((2015 + c_custkey % 3) * 100 + 1 + c_custkey % 3 AS INTEGER) END AS last_term,
  CASE c_custkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END AS yes_passed,
  CASE c_custkey % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'Y' WHEN 2 THEN 'N' END AS ytc_passed,
  CASE WHEN c_custkey % 3 = 0 THEN '201302' ELSE '' END AS yes_term, CASE WHEN c_custkey % 4 = 1 THEN '201403' END AS ytc_term
  FROM customer""",
    # --- intervals
    "tests": "SELECT person_id FROM contact WHERE lower(first_name) = 'test' OR lower(last_name) IN ('test', 'testsd')",
    "sx": f"SELECT person_id, status_id, status_date, notes FROM status WHERE kind IN (3, 12) AND undone_by IS NULL AND {pname('program')} <> 'na'",
    "en": f"""SELECT person_id, {pname('program')} AS program, status_date, status_id FROM status WHERE kind = 2
  AND undone_by IS NULL AND {pname('program')} <> 'na' AND person_id <> 0 AND person_id NOT IN (SELECT person_id FROM tests)""",
    "de": """SELECT person_id, kind, program, status_date, status_id,
  CAST(row_number() OVER (PARTITION BY person_id ORDER BY status_date, status_id) AS INTEGER) AS seq FROM status WHERE kind IN (13, 14, 15, 16)
  AND undone_by IS NULL AND person_id <> 0 AND person_id NOT IN (SELECT person_id FROM tests)""",
    "dn": """SELECT a.*, b.status_date AS next_date FROM de a LEFT JOIN de b ON a.person_id = b.person_id
  AND a.seq + 1 = b.seq AND a.kind <> b.kind""",
    "gen": """SELECT g.*, (SELECT min(status_id) FROM sx x WHERE x.person_id = g.person_id AND x.status_date = g.exit_date) AS end_id
  FROM (SELECT DISTINCT e.person_id, e.program, e.status_date AS start_date,
    (SELECT min(x.status_date) FROM sx x WHERE x.person_id = e.person_id AND x.status_date >= e.status_date) AS exit_date FROM en e) g""",
    "pairs": f"""SELECT d.person_id, d.kind, {canon('d.program')} AS program, d.status_date AS start_date, x.status_date AS x_date,
  CASE WHEN x.status_date IS NULL OR d.next_date < x.status_date THEN d.next_date ELSE x.status_date END AS cand_date,
  CASE WHEN x.status_date IS NULL OR d.next_date < x.status_date THEN CASE WHEN d.next_date IS NOT NULL THEN 0 END
    ELSE x.status_id END AS cand_id
  FROM dn d LEFT JOIN sx x ON x.person_id = d.person_id AND x.status_date >= d.status_date""",
    "det": """SELECT person_id, kind, program, start_date, min(x_date) OVER (PARTITION BY person_id, kind, program, start_date) AS exit_date,
  cand_date AS end_date, cand_id AS end_id FROM pairs
  QUALIFY row_number() OVER (PARTITION BY person_id, kind, program, start_date ORDER BY cand_date NULLS LAST, cand_id NULLS LAST) = 1""",
    "merged": """SELECT g.person_id, coalesce(k.kind_text, g.program) AS program_detail, g.program,
  CASE WHEN d.start_date < g.start_date THEN d.start_date ELSE g.start_date END AS start_date,
  coalesce(d.end_date, g.exit_date) AS end_date, coalesce(d.end_id, g.end_id) AS end_id
  FROM gen g LEFT JOIN det d ON g.person_id = d.person_id AND ((g.exit_date = d.exit_date AND lower(g.program) = lower(d.program))
    OR (g.exit_date IS NULL AND d.exit_date IS NULL AND g.program = 'YtC')) LEFT JOIN kinds k ON k.kind = d.kind""",
    "unmatched": """SELECT d.person_id, k.kind_text AS program_detail, d.program, d.start_date, d.exit_date AS end_date, d.end_id
  FROM det d JOIN kinds k ON k.kind = d.kind WHERE NOT EXISTS (SELECT 1 FROM gen g WHERE g.person_id = d.person_id
    AND (g.exit_date = d.exit_date OR (g.exit_date IS NULL AND d.exit_date IS NULL AND g.program = 'YtC')))""",
    "ordered": """SELECT *, CAST(row_number() OVER (PARTITION BY person_id ORDER BY start_date, end_date NULLS LAST,
    program_detail, program, end_id NULLS FIRST) AS INTEGER) AS seq FROM (
  SELECT DISTINCT person_id, program_detail, program, start_date, end_date, nullif(end_id, 0) AS end_id
  FROM (SELECT * FROM merged UNION ALL SELECT * FROM unmatched))""",
    "near": """SELECT o.*, n.person_id AS n_person, n.start_date AS n_start, n.program AS n_program, n.program_detail AS n_detail,
  p.start_date AS p_start, p.end_date AS p_end, p.program AS p_program, p.program_detail AS p_detail
  FROM ordered o LEFT JOIN ordered n ON n.person_id = o.person_id AND n.seq = o.seq + 1
  LEFT JOIN ordered p ON p.person_id = o.person_id AND p.seq = o.seq - 1""",
    "clipped": """SELECT * EXCLUDE (end_date), end_date AS raw_end, CASE WHEN end_date IS NULL THEN n_start WHEN n_start IS NULL THEN end_date
  WHEN end_date > n_start AND start_date <> n_start THEN n_start ELSE end_date END AS end_date FROM near""",
    "typed": """SELECT *, CASE WHEN n_person IS NULL AND end_date IS NOT NULL THEN 'Left PCC Links'
  WHEN n_person IS NOT NULL AND end_date IS NOT NULL THEN 'Transitioned' ELSE 'None' END AS exit_type FROM clipped""",
    "reason_of": "SELECT status_id, min(reason_id) AS reason_id FROM status_reason GROUP BY status_id",
    "second_of": """SELECT status_id, string_agg(reason_text, ',' ORDER BY reason_text DESC) AS secondary_reason
  FROM secondary JOIN reasons USING (reason_id) WHERE status_id <> 0 GROUP BY status_id""",
    "reasoned": """SELECT t.*, r.reason_id AS exit_reason_id, r.reason_text AS exit_reason, s.secondary_reason, x.notes AS end_note
  FROM typed t LEFT JOIN status x ON x.status_id = t.end_id LEFT JOIN reason_of q ON q.status_id = t.end_id LEFT JOIN reasons r ON r.reason_id = q.reason_id
  LEFT JOIN second_of s ON s.status_id = t.end_id""",
    "repair": """SELECT person_id, program, program_detail, start_date, min(p_end) AS new_start FROM near
  WHERE start_date = p_start GROUP BY ALL""",
    "repaired": """SELECT t.* EXCLUDE (start_date), CASE WHEN r.person_id IS NOT NULL THEN r.new_start ELSE t.start_date END AS start_date
  FROM reasoned t LEFT JOIN repair r ON r.person_id = t.person_id AND r.program = t.program
   AND r.program_detail = t.program_detail AND r.start_date = t.start_date""",
    "iv0": """SELECT r.*, c.g_number,
  (SELECT s.status_id FROM status s WHERE s.kind = 7 AND s.undone_by IS NULL AND s.person_id = r.person_id
     AND (s.status_date < r.end_date OR r.end_date IS NULL) ORDER BY s.status_date DESC, s.status_id DESC LIMIT 1) AS d_status,
  (SELECT s.status_id FROM status s WHERE s.kind = 6 AND s.undone_by IS NULL AND s.person_id = r.person_id
     AND (s.status_date < r.end_date OR r.end_date IS NULL) ORDER BY s.status_date DESC, s.status_id DESC LIMIT 1) AS c_status
  FROM repaired r JOIN contact c ON c.person_id = r.person_id""",
    "iv": """SELECT i.person_id, i.seq, i.g_number, i.program, i.program_detail, i.start_date, i.end_date, i.exit_type,
  i.exit_reason_id, i.exit_reason, i.secondary_reason, i.end_note AS exit_note, d.district_id, d.district_name,
  sd.district_student_number, co.coach_id, co.coach_name, i.n_program AS next_program, i.n_detail AS next_detail,
  i.p_program AS previous_program, i.p_detail AS previous_detail
  FROM iv0 i LEFT JOIN status_district sd ON sd.status_id = i.d_status LEFT JOIN districts d ON d.district_id = sd.district_id
  LEFT JOIN status_coach sc ON sc.status_id = i.c_status LEFT JOIN coaches co ON co.coach_id = sc.coach_id""",
    "cur": """SELECT *, CASE WHEN end_date IS NULL THEN coalesce(program_detail, program) ELSE 'Exited' END AS current_status
  FROM iv i WHERE seq = (SELECT max(seq) FROM iv j WHERE j.person_id = i.person_id)""",
    # --- attendance billing
    "att": "SELECT * FROM bills WHERE lower(program) LIKE '%attendance%'",
    "course_scen": """SELECT DISTINCT i.crn, b.term, s.scenario_id FROM items i JOIN bills b ON b.bill_id = i.bill_id
  JOIN scen s ON s.crn = i.crn WHERE i.crn % 10 <> 9""",
    "scen_dim": f"SELECT DISTINCT scenario_id, scenario_name, {P4} FROM scen",
    "scen_new": f"""SELECT i.item_id, s.scenario_name, {', '.join('s.' + p for p in PCTS)}
  FROM items i JOIN att b ON b.bill_id = i.bill_id
  JOIN course_scen c ON c.crn = i.crn AND c.term = b.term JOIN scen_dim s ON s.scenario_id = c.scenario_id
  WHERE i.include_flag = 1 AND b.district_id IN (SELECT district_id FROM districts)""",
    "items2": f"""SELECT i.item_id, i.bill_id, i.attendance, i.include_flag,
  {', '.join(f'CASE WHEN n.item_id IS NOT NULL THEN n.{p} ELSE i.{p} END AS {p}' for p in ('scenario_name', *PCTS))}
  FROM items i LEFT JOIN scen_new n ON n.item_id = i.item_id""",
}


def _attendance_steps(tag: str, included: str, cap: str, hours: str, case: str) -> dict[str, str]:
    return {
        f"per{tag}": """SELECT b.* EXCLUDE (max_days_period), CASE WHEN lower(b.program) LIKE '%attendance%'
    THEN coalesce((SELECT min(c.max_days_period) FROM cycles c WHERE c.billing_type = 'Attendance' AND c.start_date = b.start_date),
      b.max_days_period) ELSE b.max_days_period END AS max_days_period FROM bills b""",
        f"mon{tag}": f"""SELECT person_id, max(start_date) AS start_date, sum(max_days_period) AS total FROM per{tag}
    WHERE lower(program) LIKE '%attendance%' {included} GROUP BY person_id, year(start_date), month(start_date)""",
        f"capd{tag}": f"""SELECT p.* EXCLUDE (max_days_month), CAST(coalesce(m.total, p.max_days_month) AS DECIMAL(12,4)) AS max_days_month
    FROM per{tag} p LEFT JOIN mon{tag} m ON m.person_id = p.person_id AND m.start_date = p.start_date""",
        f"hrs{tag}": f"""SELECT b.bill_id, b.max_days_month, b.adjusted_days,
    CAST(sum(i.attendance * coalesce(ind_percent, 0)) AS DECIMAL(20,6)) AS ind_hours,
    CAST(sum(i.attendance * coalesce(small_percent, 0)) AS DECIMAL(20,6)) AS small_hours,
    CAST(sum(i.attendance * coalesce(inter_percent, 0)) AS DECIMAL(20,6)) AS inter_hours,
    CAST(sum(i.attendance * coalesce(large_percent, 0)) AS DECIMAL(20,6)) AS large_hours
    FROM capd{tag} b JOIN items2 i ON i.bill_id = b.bill_id WHERE i.include_flag = 1 AND lower(b.program) LIKE '%attendance%'
      AND b.district_id IN (SELECT district_id FROM districts) GROUP BY ALL""",
        f"amt{tag}": f"""SELECT *, CAST(ind_hours + small_hours * 0.333 + inter_hours * 0.222 + large_hours * 0.167
      + (ind_hours + small_hours + inter_hours + large_hours) * 0.0167 AS DECIMAL(28,10)) AS billed, {cap} AS cap FROM hrs{tag}""",
        f"cg{tag}": f"""SELECT bill_id, round(CASE WHEN billed > cap THEN CAST(cap AS DECIMAL(28,10)) ELSE billed END, 2) AS generated_amount,
    round(CASE WHEN billed > cap THEN CAST(billed - cap AS DECIMAL(28,10)) ELSE 0 END, 2) AS generated_over,
    0.333 AS small_weight, 0.222 AS inter_weight, 0.167 AS large_weight, {case} AS case_weight, {hours} AS adjusted_ind_hours
    FROM amt{tag}""",
        f"ab{tag}": f"""SELECT b.* EXCLUDE (generated_amount, generated_over), CASE WHEN g.bill_id IS NOT NULL THEN g.generated_amount ELSE b.generated_amount END AS generated_amount,
    CASE WHEN g.bill_id IS NOT NULL THEN g.generated_over ELSE b.generated_over END AS generated_over, g.adjusted_ind_hours
    FROM capd{tag} b LEFT JOIN cg{tag} g ON g.bill_id = b.bill_id""",
    }


_HOURS = """CASE WHEN billed > max_days_month THEN
   CAST(CAST(max_days_month - 0.3497 * small_hours - 0.2387 * inter_hours - 0.1837 * large_hours AS DECIMAL(28,10)) AS DOUBLE) / 1.0167 END"""
STEPS |= _attendance_steps("", "AND include_flag = 1", "coalesce(adjusted_days, max_days_month)", f"round(CAST({_HOURS} AS DECIMAL(28,10)), 2)", "0.167")
STEPS |= _attendance_steps("17", "", "max_days_month", f"CAST({_HOURS} AS DECIMAL(28,10))", "0.0167")

STEPS |= {
    # --- term billing
    "tb": """SELECT b.*, c.program_year, i.n AS credits FROM bills b JOIN calendar c ON c.term = b.term
  JOIN (SELECT bill_id, sum(credits) AS n FROM items WHERE include_flag = 1 GROUP BY bill_id) i ON i.bill_id = b.bill_id
  WHERE b.include_flag = 1 AND lower(b.program) NOT LIKE '%attendance%'""",
    "ytd": """SELECT person_id, program, program_year, term, credits_term, credits_to_date, bill_id FROM (
  SELECT t.person_id, t.program, t.program_year, t.term,
    (SELECT sum(x.credits) FROM tb x WHERE x.person_id = t.person_id AND x.program = t.program AND x.program_year = t.program_year AND x.term = t.term) AS credits_term,
    (SELECT sum(x.credits) FROM tb x WHERE x.person_id = t.person_id AND x.program = t.program AND x.program_year = t.program_year AND x.term <= t.term) AS credits_to_date,
    (SELECT max(x.bill_id) FROM tb x WHERE x.person_id = t.person_id AND x.program = t.program AND x.program_year = t.program_year AND x.term <= t.term) AS bill_id
  FROM (SELECT DISTINCT person_id, program, program_year, term FROM tb) t) z
  WHERE EXISTS (SELECT 1 FROM tb x WHERE x.bill_id = z.bill_id AND x.term = z.term)""",
    "ytd17": """SELECT y.person_id, y.program_year, b.term, y.credits_to_date,
  (SELECT sum(x.credits) FROM tb x WHERE x.person_id = y.person_id AND x.program_year = y.program_year AND x.term = b.term) AS credits_term, y.bill_id
  FROM (SELECT person_id, program_year, sum(credits) AS credits_to_date, max(bill_id) AS bill_id FROM tb GROUP BY person_id, program_year) y
  JOIN bills b ON b.bill_id = y.bill_id""",
}


def _units(tag: str, source: str) -> dict[str, str]:
    return {
        f"un{tag}": f"""SELECT *, CAST(credits_term - generated_units AS DECIMAL(18,4)) AS generated_over_units FROM (
    SELECT y.bill_id, y.term, y.credits_term, CAST(CASE WHEN credits_to_date >= max_credits THEN
      CASE WHEN max_credits - (credits_to_date - credits_term) < 0 THEN 0 ELSE max_credits - (credits_to_date - credits_term) END
      ELSE credits_term END AS DECIMAL(18,4)) AS generated_units, max_credits, max_days_year
    FROM {source} y JOIN cycles c ON c.term = y.term AND c.billing_type = 'Term')""",
        f"unit{tag}": f"""SELECT bill_id, term, generated_units, generated_over_units,
    CAST(round(CAST(CAST(generated_units AS DOUBLE) * 175 / 12 AS DECIMAL(28,10)), 4) AS DECIMAL(18,4)) AS generated_amount,
    CAST(round(CAST(CAST(generated_over_units AS DOUBLE) * 175 / 12 AS DECIMAL(28,10)), 4) AS DECIMAL(18,4)) AS generated_over, max_credits, max_days_year FROM un{tag}""",
        f"tbill{tag}": f"""SELECT b.* EXCLUDE (generated_amount, generated_over), u.generated_units, u.generated_over_units,
    CASE WHEN u.bill_id IS NOT NULL THEN u.generated_amount ELSE CAST(b.generated_amount AS DECIMAL(18,4)) END AS generated_amount,
    CASE WHEN u.bill_id IS NOT NULL THEN u.generated_over ELSE CAST(b.generated_over AS DECIMAL(18,4)) END AS generated_over
    FROM bills b LEFT JOIN unit{tag} u ON u.bill_id = b.bill_id""",
    }


STEPS |= _units("", "ytd") | _units("17", "ytd17")
STEPS |= {
    "ta": """SELECT t.*, c.program_year, c.program_quarter, generated_units AS cr, generated_over_units AS cro,
  generated_amount AS dy, generated_over AS dyo FROM tbill t JOIN calendar c ON c.term = t.term
  WHERE include_flag = 1 AND (generated_amount <> 0 OR generated_over <> 0)""",
    "ta17": """SELECT * FROM (SELECT t.*, c.program_year, c.program_quarter, coalesce(final_units, corrected_units, generated_units) AS cr,
  coalesce(final_over_units, corrected_over_units, generated_over_units) AS cro,
  coalesce(post_amount, final_amount, corrected_amount, generated_amount) AS dy,
  coalesce(post_over, final_over, corrected_over, generated_over) AS dyo FROM tbill17 t JOIN calendar c ON c.term = t.term
  WHERE include_flag = 1) WHERE dy <> 0 OR dyo <> 0""",
    "oth": """SELECT a.person_id, a.district_id, a.program_year, a.program, (SELECT sum(b.dy) FROM ta b WHERE b.person_id = a.person_id
    AND b.district_id = a.district_id AND b.program_year = a.program_year AND b.program <> a.program) AS other_days
  FROM (SELECT DISTINCT person_id, district_id, program_year, program FROM ta) a""",
    "oth17": """SELECT a.person_id, a.district_id, a.program_year, a.program, (SELECT sum(b.dy) FROM ta17 b WHERE b.person_id = a.person_id
    AND b.district_id = a.district_id AND b.program_year = a.program_year AND b.program <> a.program) AS other_days
  FROM (SELECT DISTINCT person_id, district_id, program_year, program FROM ta17) a""",
    # --- exits on bills
    "xb": """SELECT b.bill_id, b.person_id, b.g_number, e.program_detail AS program, e.start_date AS enrolled_date, b.start_date, b.end_date, b.exit_date,
  CASE WHEN b.bill_id % 3 = 1 THEN 7 END AS exit_code, CASE WHEN b.bill_id % 4 = 0 THEN b.bill_id % 20 + 1 END AS exit_status_reason_id,
  b.district_id, b.include_flag, CAST(b.adjusted_days AS DOUBLE) AS adjusted_days FROM bills b
  JOIN (SELECT b.bill_id, i.start_date, i.program_detail FROM bills b JOIN iv i ON i.person_id = b.person_id AND i.start_date < b.end_date
    QUALIFY row_number() OVER (PARTITION BY b.bill_id ORDER BY i.start_date DESC, i.seq DESC) = 1) e ON e.bill_id = b.bill_id""",
    "since": """SELECT min(term_begin) AS since FROM calendar WHERE program_year =
  (SELECT max(program_year) FROM calendar WHERE term_begin <= DATE '2014-02-15')""",
    "fit": """SELECT b.bill_id, b.exit_date, b.exit_code, i.end_date AS i_end, i.exit_reason_id AS i_reason FROM xb b
  JOIN iv i ON i.person_id = b.person_id AND i.start_date = b.enrolled_date AND lower(i.program_detail) = lower(b.program)
  WHERE b.start_date >= (SELECT since FROM since) AND CASE WHEN lower(b.program) LIKE '%attendance%'
    THEN year(i.end_date) * 12 + month(i.end_date) = year(b.start_date) * 12 + month(b.start_date)
    ELSE year(i.end_date) * 12 + month(i.end_date) BETWEEN year(b.start_date) * 12 + month(b.start_date)
      AND year(b.end_date) * 12 + month(b.end_date) END""",
    "xb_date": """SELECT b.* EXCLUDE (exit_date), coalesce(b.exit_date, (SELECT min(f.i_end) FROM fit f WHERE f.bill_id = b.bill_id)) AS exit_date FROM xb b""",
    "xb_code": """SELECT b.* EXCLUDE (exit_code), coalesce(b.exit_code, (SELECT min(r.reason_num) FROM fit f JOIN reasons r ON r.reason_id = f.i_reason
    WHERE f.bill_id = b.bill_id AND r.reason_num IN (1,2,3,4,5,6,7,8,9,10,11,12,13,51,52,53))) AS exit_code FROM xb_date b""",
    # --- reporting tables
    "scores": """SELECT coalesce(a.person_id, b.person_id) AS person_id, ytc_test_date, ytc_passed, social_score, science_score, math_score,
  literature_score, writing_score, language_score, yes_test_date, yes_passed FROM (
  SELECT *, (SELECT max(v) FROM (VALUES (social_date), (science_date), (math_date), (literature_date), (writing_date), (language_date)) t(v)) AS ytc_test_date,
    CASE WHEN social_score >= 410 AND science_score >= 410 AND math_score >= 410 AND literature_score >= 410 AND writing_score >= 410
      AND social_date < DATE '2014-01-01' AND science_date < DATE '2014-01-01' AND math_date < DATE '2014-01-01'
      AND literature_date < DATE '2014-01-01' AND writing_date < DATE '2014-01-01' THEN 'Passed'
     WHEN social_score >= 145 AND science_score >= 145 AND math_score >= 145 AND language_score >= 145
      AND social_date IS NOT NULL AND science_date IS NOT NULL AND math_date IS NOT NULL AND language_date IS NOT NULL
      AND (social_date >= DATE '2014-01-01' OR science_date >= DATE '2014-01-01' OR math_date >= DATE '2014-01-01' OR language_date >= DATE '2014-01-01')
      THEN 'Passed' END AS ytc_passed FROM ytc) a
  FULL OUTER JOIN (SELECT person_id, CASE WHEN social_date IS NULL OR science_date IS NULL OR math_date IS NULL OR literature_date IS NULL
      OR writing_date IS NULL THEN NULL ELSE (SELECT max(v) FROM (VALUES (social_date), (science_date), (math_date), (literature_date), (writing_date)) t(v)) END AS yes_test_date,
    CASE WHEN social_score >= 410 AND science_score >= 410 AND math_score >= 410 AND literature_score >= 410 AND writing_score >= 410
      THEN 'Passed' END AS yes_passed FROM yes) b ON a.person_id = b.person_id""",
    "passed": """SELECT person_id, CASE WHEN coalesce(ytc_passed, yes_passed) = 'Passed' THEN 'Y' ELSE 'N' END AS passed_yn,
  coalesce(ytc_test_date, yes_test_date) AS last_test_date FROM scores""",
    "outcome": """SELECT i.*, CASE WHEN i.end_date IS NULL THEN 'Still Attending' WHEN lower(i.exit_reason) = 'graduated' THEN 'Graduated'
  WHEN i.next_program = 'YtC' AND p.passed_yn = 'Y' THEN 'Transferred to Yes & Earned GED'
  WHEN i.program = i.next_program THEN 'Re-enrolled in ' || i.program WHEN i.program <> i.next_program THEN 'Transferred to ' || i.next_program
  WHEN lower(i.exit_reason) LIKE '%transfer%' THEN 'Transferred to another school'
  WHEN i.exit_reason = 'Moved out of District/State (Specify District/State)' THEN 'Moved out of district'
  WHEN i.exit_reason = '10 Days Absent' THEN '10 Days Absent' ELSE 'Exited Program' END AS outcome,
  CASE WHEN i.end_date IS NULL THEN 'Still Attending' WHEN lower(i.exit_reason) = 'graduated' THEN 'Graduated' ELSE 'Exited' END AS basic_outcome
  FROM iv i LEFT JOIN passed p ON p.person_id = i.person_id""",
    "bounds": """SELECT i.person_id, i.seq, min(c.term) AS term_enrolled, max(c.term) AS term_exit,
  max(CASE WHEN upper(k.subject) IN ('ESL', 'ESOL') THEN 'Y' ELSE 'N' END) AS esl_class_yn,
  max(CASE WHEN upper(k.subject) = 'ESOL' AND k.course_level = 'CR' THEN c.term END) AS esol_last_term
  FROM iv i JOIN calendar c ON i.start_date < c.term_begin + 15 AND (i.end_date > c.term_begin OR i.end_date IS NULL)
  JOIN courses k ON k.student = i.g_number AND k.term = c.term GROUP BY i.person_id, i.seq""",
    "flags": """SELECT person_id, seq, CASE WHEN seq = 1 THEN 'Y' ELSE 'N' END AS first_enrollment_yn,
  CASE WHEN seq = 1 AND (date_diff('day', start_date, end_date) < 31 OR lower(exit_reason) = 'accepted/no show') THEN 'Y' ELSE 'N' END AS dropped_in_30_days_yn
  FROM iv""",
    "prof": """SELECT c.person_id, c.g_number, last_name, first_name, middle_name, dob, gender, CAST(hs_credits AS DOUBLE) AS hs_credits,
  CAST(hs_gpa AS DOUBLE) AS hs_gpa, last_school, coalesce(p.passed_yn, 'N') AS passed_yn, p.last_test_date,
  coalesce(y.completion_date, s.completion_date) AS completion_date, coalesce(y.social_score, s.social_score) AS test_social_score,
  coalesce(y.science_score, s.science_score) AS test_science_score, coalesce(y.math_score, s.math_score) AS test_math_score,
  coalesce(y.writing_score, s.writing_score) AS test_writing_score, y.language_score AS test_language_score,
  CAST(g.reading_score AS DOUBLE) AS reading_score, CAST(g.essay_score AS DOUBLE) AS essay_score,
  CAST(g.grammar_score AS DOUBLE) AS grammar_score, CAST(g.math_score AS DOUBLE) AS math_score,
  CAST(g.interview_score AS DOUBLE) AS interview_score, overall_gpa, overall_attempted, overall_earned, reported_race, esol_completion,
  (SELECT k.term FROM calendar k WHERE p.last_test_date >= k.term_begin AND p.last_test_date < k.next_begin) AS passed_term
  FROM contact c LEFT JOIN gtc g ON g.person_id = c.person_id LEFT JOIN ytc y ON y.person_id = c.person_id
  LEFT JOIN yes s ON s.person_id = c.person_id LEFT JOIN passed p ON p.person_id = c.person_id
  LEFT JOIN (SELECT DISTINCT student, overall_gpa, overall_attempted, overall_earned, reported_race FROM sis) z ON z.student = c.g_number
  LEFT JOIN (SELECT student, max(CASE WHEN title IN ('Level 8 Academic Reading', 'Level 8 Academic Writing') AND passed = 'Y' THEN 'Y' ELSE 'N' END) AS esol_completion
    FROM courses GROUP BY student) e ON e.student = c.g_number""",
    "later": """SELECT i.person_id, i.seq,
  CAST(sum(CASE WHEN p.passed_term < k.term AND k.term <= b.term_exit AND grade IN ('A','B','C','D','F') THEN k.credits END) AS DOUBLE) AS post_credits,
  CAST(sum(CASE WHEN p.passed_term < k.term AND k.term <= b.term_exit THEN k.credits *
    CASE grade WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 2 WHEN 'D' THEN 1 WHEN 'F' THEN 0 END END) AS DOUBLE) AS post_points,
  count(CASE WHEN k.term = p.passed_term AND (b.term_exit IS NULL OR k.term <= b.term_exit) THEN 1 END) AS course_rows_in_pass_term
  FROM iv i LEFT JOIN bounds b ON b.person_id = i.person_id AND b.seq = i.seq JOIN prof p ON p.person_id = i.person_id
  JOIN courses k ON k.student = p.g_number GROUP BY i.person_id, i.seq""",
    "ivt": """SELECT i.person_id, i.program, c.term, c.program_year, c.term_begin, c.term_end, c.next_begin, min(i.seq) AS first_seq, max(i.seq) AS last_seq
  FROM iv i JOIN calendar c ON i.start_date <= c.term_end AND (i.end_date >= c.term_begin OR i.end_date IS NULL) GROUP BY ALL""",
    "pexit": """SELECT person_id, program, term, program_year, term_begin, term_end, next_begin, first_seq, last_seq, student, exit_date,
  CASE WHEN exit_date IS NOT NULL THEN exit_reason END AS exit_reason, CASE WHEN exit_date IS NOT NULL THEN secondary_reason END AS secondary_reason,
  CASE WHEN exit_date IS NULL THEN 1 ELSE 0 END AS is_active FROM (
  SELECT *, CASE WHEN term = max_term AND in_term IS NULL AND end_date IS NOT NULL THEN term_end ELSE in_term END AS exit_date FROM (
  SELECT t.*, e.g_number AS student, e.end_date, e.exit_reason, e.secondary_reason,
    CASE WHEN e.end_date > t.next_begin THEN NULL ELSE e.end_date END AS in_term,
    (SELECT max(r.term) FROM results r JOIN calendar c ON c.term = r.term WHERE r.student = e.g_number
      AND (e.end_date >= c.term_begin OR e.end_date IS NULL)) AS max_term
  FROM ivt t JOIN iv e ON e.person_id = t.person_id AND e.seq = t.last_seq) WHERE term <= max_term)""",
    "lv": """SELECT *, CASE WHEN upper(subject) = 'ESOL' AND lower(left(title, 5)) = 'level' THEN substring(title, 7, 1) END AS lvl FROM courses""",
    "entry": f"""SELECT i.person_id, i.seq AS first_seq, i.g_number AS student, i.district_name, i.program_detail AS program_name,
  i.district_student_number, i.start_date AS enrolled_date, i.coach_name, {years('c.dob', 'i.start_date')} AS age_at_entry,
  CAST(c.hs_credits AS DOUBLE) AS hs_credits, c.last_school, c.first_name, c.last_name FROM iv i JOIN contact c ON c.person_id = i.person_id""",
    "first_t": """SELECT i.person_id, min(c.term) AS first_term, min(c.term_begin) AS first_term_begin FROM iv i JOIN calendar c
  ON i.start_date <= c.term_end AND (i.end_date >= c.term_begin OR i.end_date IS NULL) WHERE c.term IN (SELECT term FROM courses) GROUP BY i.person_id""",
    "pterm": """SELECT x.person_id, x.program, x.term, x.program_year, x.term_begin, x.term_end, x.student, x.exit_date, x.exit_reason, x.secondary_reason, x.is_active,
  e.district_name, e.program_name, e.district_student_number, e.enrolled_date, e.coach_name, e.age_at_entry, e.hs_credits, e.last_school,
  e.first_name, e.last_name, k.max_esol_level, k.min_esol_level, k.max_esol_level_passed, r.gpa, r.attempted, r.earned,
  (SELECT max(1) FROM lv l WHERE l.student = x.student AND upper(l.subject) = 'ESOL' AND l.term <= x.term) AS esol_student,
  (SELECT max(l.lvl) FROM lv l WHERE l.student = x.student AND l.term < x.term) AS incoming_esol_level,
  f.first_term, f.first_term_begin, CASE WHEN x.term = f.first_term THEN 1 WHEN x.term <> f.first_term THEN 0 END AS is_new
  FROM pexit x JOIN entry e ON e.person_id = x.person_id AND e.first_seq = x.first_seq
  JOIN (SELECT student, term, max(lvl) AS max_esol_level, min(lvl) AS min_esol_level, max(CASE WHEN passed = 'Y' THEN lvl END) AS max_esol_level_passed
    FROM lv GROUP BY student, term) k ON k.student = x.student AND k.term = x.term
  JOIN results r ON r.student = x.student AND r.term = x.term LEFT JOIN first_t f ON f.person_id = x.person_id""",
}


def _scored(name: str, source: str, begin: str, end: str, label: str, last: str) -> dict[str, str]:
    tests = ("social", "science", "math", "literature", "writing", "language")
    return {
        f"{name}_s": f"""SELECT p.*, {', '.join(f'y.{t}_score' for t in tests)}, coalesce(y.ytc_passed, s.yes_passed) AS passed_code,
    coalesce(y.ytc_test_date, s.yes_test_date) AS tested FROM {source} p
    LEFT JOIN scores y ON y.person_id = p.person_id AND y.ytc_test_date <= p.{end}
    LEFT JOIN scores s ON s.person_id = p.person_id AND s.yes_test_date <= p.{end}""",
        f"{name}_d": f"""SELECT *, CASE WHEN passed_code IS NULL THEN 'None' WHEN tested < {begin} THEN 'Prior{label}'
    WHEN tested BETWEEN {begin} AND {end} THEN 'During{label}' ELSE 'None' END AS completed_code,
    CASE WHEN tested < DATE '2017-07-01' THEN tested END AS last_test_date FROM {name}_s""",
        f"{name}_g": f"""SELECT d.*, CAST(round(CAST(CAST(g.points AS DOUBLE) / nullif(CAST(g.credits AS DOUBLE), 0) AS DECIMAL(18,8)), 2) AS DOUBLE) AS post_gpa, g.post_terms FROM {name}_d d
    LEFT JOIN (SELECT q.student, q.last_test_date, q.{last}, count(DISTINCT k.term) AS post_terms,
      sum(CASE WHEN grade IN ('A','B','C','D','F') THEN k.credits ELSE 0 END) AS credits,
      sum(k.credits * CASE grade WHEN 'A' THEN 4 WHEN 'B' THEN 3 WHEN 'C' THEN 2 WHEN 'D' THEN 1 WHEN 'F' THEN 0 END) AS points
      FROM (SELECT DISTINCT student, last_test_date, {last} FROM {name}_d) q JOIN calendar c ON c.term_begin >= q.last_test_date AND c.term <= q.{last}
      JOIN courses k ON k.student = q.student AND k.term = c.term GROUP BY ALL) g
    ON g.student = d.student AND g.last_test_date = d.last_test_date AND g.{last} = d.{last}""",
    }


STEPS |= _scored("pt", "pterm_y", "term_begin", "term_end", "Term", "term")
STEPS |= {
    "pterm_y": "SELECT * FROM pterm WHERE program = 'YtC'",
    "yb": """SELECT program_year, min(term_begin) AS year_begin, max(term_end) AS year_end, min(term) AS year_first_term,
  max(term) AS year_last_term FROM calendar GROUP BY program_year""",
    "ivy": """SELECT y.*, b.year_begin, b.year_end, b.year_first_term, b.year_last_term, e.exit_date,
  CASE WHEN e.exit_date IS NOT NULL THEN e.exit_reason END AS exit_reason, CASE WHEN e.exit_date IS NOT NULL THEN e.secondary_reason END AS secondary_reason,
  CASE WHEN e.exit_date IS NULL THEN 1 ELSE 0 END AS is_active FROM (
  SELECT i.person_id, i.program, c.program_year, min(i.seq) AS first_seq, max(i.seq) AS last_seq, min(c.term) AS min_term, max(c.term) AS max_term
  FROM iv i JOIN calendar c ON i.start_date <= c.term_end AND (i.end_date >= c.term_begin OR i.end_date IS NULL)
  GROUP BY i.person_id, i.program, c.program_year) y JOIN yb b ON b.program_year = y.program_year
  JOIN LATERAL (SELECT CASE WHEN l.end_date > b.year_end THEN NULL ELSE l.end_date END AS exit_date, l.exit_reason, l.secondary_reason
    FROM iv l WHERE l.person_id = y.person_id AND l.seq = y.last_seq) e ON true""",
    "pyear": """SELECT x.* EXCLUDE (program), e.* EXCLUDE (person_id, first_seq), k.max_esol_level, k.min_esol_level, k.max_esol_level_passed,
  (SELECT max(1) FROM lv l WHERE l.student = e.student AND upper(l.subject) = 'ESOL' AND l.term <= x.year_last_term) AS esol_student,
  (SELECT max(l.lvl) FROM lv l WHERE l.student = e.student AND l.term < x.year_first_term) AS incoming_esol_level
  FROM ivy x JOIN entry e ON e.person_id = x.person_id AND e.first_seq = x.first_seq
  JOIN (SELECT l.student, c.program_year, max(lvl) AS max_esol_level, min(lvl) AS min_esol_level, max(CASE WHEN passed = 'Y' THEN lvl END) AS max_esol_level_passed
    FROM lv l JOIN calendar c ON c.term = l.term GROUP BY ALL) k ON k.student = e.student AND k.program_year = x.program_year
  WHERE x.program = 'YtC'""",
}
STEPS |= _scored("py", "pyear", "year_begin", "year_end", "ProgramYear", "max_term")
STEPS |= {
    # --- audit snapshots
    "old_b": "SELECT o_orderkey AS bill_id, o_orderstatus AS state, CAST(o_totalprice AS DECIMAL(12,2)) AS amount, o_orderpriority AS priority, o_custkey AS person_id FROM orders WHERE o_orderkey % 10 <> 3",
    "new_b": """SELECT o_orderkey AS bill_id, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN lower(o_orderstatus) WHEN 2 THEN '' ELSE o_orderstatus END AS state,
  CASE WHEN o_orderkey % 5 = 0 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 1 AS DECIMAL(12,2)) WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS amount,
  CASE WHEN o_orderkey % 9 = 0 THEN o_orderpriority || '!' ELSE o_orderpriority END AS priority, o_custkey AS person_id FROM orders""",
    "two": """SELECT o.bill_id, o.state AS o_state, n.state AS n_state, o.amount AS o_amount, n.amount AS n_amount,
  o.priority AS o_priority, n.priority AS n_priority, o.person_id AS o_person_id, n.person_id AS n_person_id FROM old_b o JOIN new_b n ON n.bill_id = o.bill_id""",
}


def sql(final: str) -> str:
    """The final select behind the steps it refers to, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b(?:FROM|JOIN)\s+(?:LATERAL\s+)?([a-z_0-9]+)", text)):
            if word in STEPS and word not in needed:
                visit(STEPS[word])
                if word not in needed:
                    needed.append(word)

    visit(final)
    if not needed:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({STEPS[n]})" for n in needed) + "\n" + final


def _audit(mode: str) -> str:
    parts = []
    for c, text in (("state", True), ("amount", False), ("priority", True), ("person_id", False)):
        o, n = (f"lower(o_{c})", f"lower(n_{c})") if text else (f"o_{c}", f"n_{c}")
        differ = f"coalesce({o} <> {n}, false)"
        test = {
            "null_safe": f"{differ} OR (o_{c} IS NULL) <> (n_{c} IS NULL)",
            "length": f"{differ} OR length(coalesce(CAST(o_{c} AS VARCHAR), '')) <> length(coalesce(CAST(n_{c} AS VARCHAR), ''))",
            "plain": differ,
        }[mode]
        parts.append(
            f"SELECT 'bill' AS table_name, 'bill_id' AS id_column, bill_id AS id_value, '{c}' AS column_name, "
            f"CAST(o_{c} AS VARCHAR) AS old_value, CAST(n_{c} AS VARCHAR) AS new_value, 'UPDATE' AS action, "
            f"'clerk' AS changed_by, '{mode}' AS mode FROM two WHERE {test}"
        )
    return " UNION ALL ".join(parts)


def _wide_audit(table: str, key: str, name: str) -> str:
    """The old rows and the edited ones side by side, then one branch a column."""
    kinds, columns, parts = types(table), AUDITED[table], []
    now = ", ".join(f"{e} AS n_{c}" for c, e in edited_row(table, key).items())
    old = ", ".join(f"{e} AS {c}" for c, e in wide_row(table).items())
    for c in columns:
        o, n = (f"lower({c})", f"lower(n_{c})") if kinds[c] == "string" else (c, f"n_{c}")
        longer = f"length(coalesce(CAST({c} AS VARCHAR), '')) <> length(coalesce(CAST(n_{c} AS VARCHAR), ''))"
        parts.append(
            f"SELECT '{name}' AS table_name, '{key}' AS id_column, {key} AS id_value, '{c}' AS column_name, CAST({c} AS VARCHAR) AS old_value, "
            f"CAST(n_{c} AS VARCHAR) AS new_value, 'UPDATE' AS action, 'clerk' AS changed_by FROM pairs WHERE coalesce({o} <> {n}, false) OR {longer}"
        )
    return f"SELECT u.* FROM (WITH pairs AS (SELECT *, {now} FROM (SELECT {old} FROM {table})) " + " UNION ALL ".join(parts) + ") u"


_MONTHS = ["june", "july", "august", "september", "october", "november", "december", "january", "february", "march", "april", "may"]


def _month_sums(a: str) -> str:
    numbers = [6, 7, 8, 9, 10, 11, 12, 1, 2, 3, 4, 5]
    return ", ".join(
        f"CAST(sum(round(coalesce(CASE WHEN month(b.start_date) = {n} THEN {a} END, 0), 1)) AS DOUBLE) AS {m}"
        for n, m in zip(numbers, _MONTHS)
    )


def _quarters() -> str:
    out = [
        "CAST(sum(CASE WHEN program_quarter = 1 THEN cr ELSE 0 END) AS DOUBLE) AS summer_credits",
        "CAST(sum(CASE WHEN program_quarter = 1 THEN dy ELSE 0 END) AS DOUBLE) AS summer_days",
    ]
    for n, q in ((2, "fall"), (3, "winter"), (4, "spring")):
        for name, v in (("credits", "cr + cro"), ("credits_over", "cro"), ("days", "dy + dyo"), ("days_over", "dyo")):
            out.append(f"CAST(sum(CASE WHEN program_quarter = {n} THEN {v} ELSE 0 END) AS DOUBLE) AS {q}_{name}")
    return ", ".join(out)


def _term_report(tag: str, only: str = "") -> str:
    group = "exit_group" if not tag else "enrolled_date"
    left = "min(exit_group)" if not tag else "max(exit_date)"
    other = "max(other_days)" if not tag else "any_value(other_days)"
    extra = "" if not tag else ", other_days"
    exit_group = (
        "(SELECT min(z.exit_date) FROM bills z WHERE z.g_number = a.g_number AND z.start_date >= a.start_date) AS exit_group"
    )
    return f"""SELECT min(person_id) AS person_id, g_number, first_name, last_name, program, district_name, program_year,
  min(start_date) AS entry_date, {left} AS exit_date, {_quarters()}, CAST({other} AS DOUBLE) AS other_days_billed,
  CAST(sum(cr + cro) AS DOUBLE) AS year_credits, CAST(sum(cr) AS DOUBLE) AS year_credits_billed,
  CAST(sum(dy + dyo) + coalesce({other}, 0) AS DOUBLE) AS year_days,
  CAST(CASE WHEN sum(dy) + coalesce({other}, 0) > 175 THEN 175 ELSE sum(dy) + coalesce({other}, 0) END AS DOUBLE) AS year_days_billed
  FROM (SELECT a.*, p.first_name, p.last_name, d.district_name, o.other_days, {exit_group}
    FROM ta{tag} a JOIN contact p ON p.person_id = a.person_id JOIN districts d ON d.district_id = a.district_id
    LEFT JOIN oth{tag} o ON o.person_id = a.person_id AND o.district_id = a.district_id AND o.program_year = a.program_year AND o.program = a.program
    WHERE lower(a.program) NOT LIKE '%attendance%' {only})
  GROUP BY first_name, last_name, {group}, g_number, program, district_name, program_year{extra}"""


def _attendance_report(tag: str, only: str = "") -> str:
    amount = "b.generated_amount" if not tag else "coalesce(post_amount, final_amount, corrected_amount, generated_amount)"
    group = "exit_group" if not tag else "enrolled_date"
    left = "min(exit_group)" if not tag else "max(exit_date)"
    zero = "AND generated_amount <> 0" if not tag else ""
    return f"""SELECT min(person_id) AS person_id, g_number, first_name, last_name, program, district_name, program_year,
  min(start_date) AS entry_date, {left} AS exit_date, {_month_sums('amount')},
  CAST(sum(round(coalesce(amount, 0), 1)) AS DOUBLE) AS total_attendance,
  CAST(sum(coalesce(adjusted_days, max_days_month, 0)) AS DOUBLE) AS total_enrollment FROM (
  SELECT b.*, c.program_year, p.first_name, p.last_name, d.district_name, {amount} AS amount,
    (SELECT min(z.exit_date) FROM bills z WHERE z.g_number = b.g_number AND z.start_date >= b.start_date) AS exit_group
  FROM ab{tag} b JOIN contact p ON p.person_id = b.person_id JOIN districts d ON d.district_id = b.district_id JOIN calendar c ON c.term = b.term
  WHERE lower(b.program) LIKE '%attendance%' AND include_flag = 1 {zero} {only}) b
  GROUP BY last_name, first_name, g_number, {group}, district_name, program, program_year"""


def _numbered(report: str) -> str:
    order = "last_name, first_name, g_number, program_year, program, district_name, exit_date NULLS FIRST, entry_date"
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS row_no FROM ({report})"


def _last(kind: str, column: str) -> str:
    return f"(SELECT arg_max({column}, cycle_id) FROM cycles WHERE billing_type = '{kind}')"


def _filed(report: str, kind: str, run: int) -> str:
    return f"SELECT r.*, {_last(kind, 'cycle_id')} AS cycle_id, CAST({run} AS BIGINT) AS report_id, 'clerk' AS created_by FROM ({report}) r"


_LABELLED = {
    "row_no": "Row", "g_number": "Student Number", "first_name": "First Name", "last_name": "Last Name", "email_main": "Email",
    "email_alt": "Other Email", "district_name": "District in Range", "ssid": "District Student Number", "start_in_range": "Enrolled in Range",
    "end_in_range": "Left in Range", "program_detail": "Program in Range", "coach_name": "Coach in Range", "current_status": "Status Now",
    "current_start": "Enrolled Now", "current_end": "Left Now", "last_school": "Last School",
}

IV = """person_id, seq, g_number, program, program_detail, start_date, end_date, exit_type, exit_reason_id, exit_reason, secondary_reason,
 exit_note, district_id, district_name, district_student_number, coach_id, coach_name"""
PERSON = "p.person_id, p.g_number, p.first_name, p.last_name, p.email_main, p.email_alt"
CURRENT = "c.current_status, strftime(c.start_date, '%Y-%m-%d') AS current_start, strftime(c.end_date, '%Y-%m-%d') AS current_end"
CAPS = """CAST(small_weight AS DOUBLE) AS small_weight, CAST(inter_weight AS DOUBLE) AS inter_weight,
 CAST(large_weight AS DOUBLE) AS large_weight, CAST(case_weight AS DOUBLE) AS case_weight"""
UNITS = """CAST(generated_units AS DOUBLE) AS generated_units, CAST(generated_over_units AS DOUBLE) AS generated_over_units,
 CAST(generated_amount AS DOUBLE) AS generated_amount, CAST(generated_over AS DOUBLE) AS generated_over,
 CAST(max_credits AS DOUBLE) AS max_credits, CAST(max_days_year AS DOUBLE) AS max_days_year"""
PTERM = """person_id, term, program_year, student, exit_date, exit_reason, secondary_reason, is_active, district_name, program_name,
 district_student_number, enrolled_date, coach_name, age_at_entry, hs_credits, last_school, first_name, last_name, max_esol_level,
 min_esol_level, max_esol_level_passed, gpa, attempted, earned, esol_student, incoming_esol_level, first_term, first_term_begin, is_new"""

FINAL = {
    "exit_events": "SELECT person_id, status_id, status_date FROM sx",
    "enroll_events_no_test": "SELECT person_id, program, status_date, status_id FROM en",
    "next_exit_asof": """SELECT e.*, (SELECT min(x.status_date) FROM sx x WHERE x.person_id = e.person_id AND x.status_date >= e.status_date) AS next_date,
  (SELECT x.status_id FROM sx x WHERE x.person_id = e.person_id AND x.status_date >= e.status_date ORDER BY x.status_date, x.status_id LIMIT 1) AS next_id FROM en e""",
    "detail_enroll_numbered": "SELECT person_id, kind, program, status_date, status_id, seq FROM de",
    "next_transition": "SELECT person_id, kind, program, status_date, status_id, next_date FROM dn",
    "earliest_end": f"SELECT person_id, kind, program, start_date, exit_date, end_date, end_id FROM det",
    "interval_merge": f"SELECT person_id, program_detail, program, start_date, end_date, end_id FROM merged",
    "interval_unmatched_append": f"""SELECT person_id, program_detail, program, start_date, end_date, end_id FROM merged
  UNION ALL SELECT person_id, program_detail, program, start_date, end_date, end_id FROM unmatched""",
    "interval_dedupe_number": "SELECT person_id, seq, program_detail, program, start_date, end_date, end_id FROM ordered",
    "interval_clip": "SELECT person_id, seq, start_date, raw_end AS raw_end_date, end_date FROM clipped",
    "interval_exit_type": "SELECT person_id, seq, end_date, exit_type FROM typed",
    "exit_reason_attach": "SELECT person_id, seq, end_id, exit_reason_id, exit_reason, secondary_reason, end_note AS exit_note FROM reasoned",
    "exit_reasons_all": """SELECT t.person_id, t.seq, t.end_id, r.reason_id AS exit_reason_id, r.reason_text AS exit_reason, s.secondary_reason, x.notes AS exit_note
  FROM typed t LEFT JOIN status x ON x.status_id = t.end_id
  LEFT JOIN (SELECT q.status_id, n.reason_id, n.reason_text FROM status_reason q JOIN reasons n ON n.reason_id = q.reason_id) r ON r.status_id = t.end_id
  LEFT JOIN second_of s ON s.status_id = t.end_id""",
    "same_start_repair": "SELECT person_id, seq, program, program_detail, start_date, end_date FROM repaired",
    "asof_district": "SELECT person_id, seq, end_date, district_id, district_name, district_student_number FROM iv",
    "asof_coach": "SELECT person_id, seq, end_date, coach_id, coach_name FROM iv",
    "build_intervals": f"SELECT {IV} FROM iv",
    "current_state": f"SELECT {IV}, current_status FROM cur",
    "latest_before_date": """SELECT s.person_id, s.status_date, s.status_id, d.district_id, d.district_name, sd.district_student_number FROM status s
  JOIN status_district sd ON sd.status_id = s.status_id JOIN districts d ON d.district_id = sd.district_id
  WHERE s.kind = 7 AND s.undone_by IS NULL AND s.status_date < DATE '2016-06-30' AND NOT EXISTS (SELECT 1 FROM status z
    WHERE z.person_id = s.person_id AND z.kind = 7 AND z.undone_by IS NULL AND z.status_date < DATE '2016-06-30'
      AND (z.status_date > s.status_date OR (z.status_date = s.status_date AND z.status_id > s.status_id)))""",
    "coach_before_date": """SELECT s.person_id, s.status_date, s.status_id, sc.coach_id FROM status s JOIN status_coach sc ON sc.status_id = s.status_id
  WHERE s.kind = 6 AND s.undone_by IS NULL AND s.status_date < DATE '2016-06-30' AND NOT EXISTS (SELECT 1 FROM status z
    WHERE z.person_id = s.person_id AND z.kind = 6 AND z.undone_by IS NULL AND z.status_date < DATE '2016-06-30'
      AND (z.status_date > s.status_date OR (z.status_date = s.status_date AND z.status_id > s.status_id)))""",
    "reason_list": "SELECT status_id, secondary_reason FROM second_of",
    "current_exit": """SELECT p.person_id, p.first_name, p.last_name, p.g_number, c.start_date, c.end_date, c.program_detail
  FROM cur c JOIN contact p ON p.person_id = c.person_id""",
    "students_to_bill": """SELECT i.person_id, i.seq, i.program_detail AS program, i.start_date, p.last_name, p.first_name, p.g_number, i.end_date,
  i.district_name, i.district_id, b.pidm FROM iv i JOIN contact p ON p.person_id = i.person_id
  LEFT JOIN (SELECT DISTINCT person_id, pidm FROM bills) b ON b.person_id = i.person_id
  WHERE (i.end_date IS NULL OR i.end_date >= DATE '2013-01-01') AND i.start_date < DATE '2017-01-01'""",
    "active_during": f"""SELECT {PERSON}, i.district_name, p.ssid, strftime(i.start_date, '%Y-%m-%d') AS start_in_range,
  strftime(i.end_date, '%Y-%m-%d') AS end_in_range, i.program_detail, i.coach_name, {CURRENT}, p.last_school
  FROM iv i JOIN contact p ON p.person_id = i.person_id JOIN cur c ON c.person_id = i.person_id
  WHERE i.seq = (SELECT max(z.seq) FROM iv z WHERE z.person_id = i.person_id AND z.start_date < DATE '2016-01-01'
    AND (z.end_date >= DATE '2014-01-01' OR z.end_date IS NULL))""",
    "enrolled_during": f"""SELECT {PERSON}, i.district_name, i.district_student_number, strftime(i.start_date, '%Y-%m-%d') AS start_in_range,
  i.program_detail, {CURRENT}, p.last_school
  FROM iv i JOIN contact p ON p.person_id = i.person_id JOIN cur c ON c.person_id = i.person_id
  WHERE i.seq = (SELECT min(z.seq) FROM iv z WHERE z.person_id = i.person_id AND z.start_date BETWEEN DATE '2014-01-01' AND DATE '2016-01-01'
    AND z.program = 'YtC')""",
    "exit_during": f"""SELECT {PERSON}, i.district_name, p.ssid, i.exit_reason, i.secondary_reason, i.exit_note, p.dob, i.coach_name,
  strftime(i.end_date, '%Y-%m-%d') AS end_in_range, i.program_detail, {CURRENT}, r.risk_factors
  FROM iv i JOIN contact p ON p.person_id = i.person_id JOIN cur c ON c.person_id = i.person_id
  LEFT JOIN (SELECT person_id, string_agg(risk_name, ',' ORDER BY risk_name) AS risk_factors FROM risks JOIN risk_factors f USING (risk_id)
    GROUP BY person_id) r ON r.person_id = i.person_id
  WHERE i.seq = (SELECT max(z.seq) FROM iv z WHERE z.person_id = i.person_id AND z.end_date BETWEEN DATE '2014-01-01' AND DATE '2016-01-01')""",
    "still_applicant": f"""SELECT {PERSON}, p.ssid, 'GtC' AS program, CAST(p.hs_credits AS DOUBLE) AS hs_credits, CAST(p.hs_gpa AS DOUBLE) AS hs_gpa,
  CAST(g.interview_score AS DOUBLE) AS interview_score, CAST(g.essay_score AS DOUBLE) AS essay_score, CAST(g.grammar_score AS DOUBLE) AS grammar_score,
  CAST(g.math_score AS DOUBLE) AS math_score, CAST(g.reading_score AS DOUBLE) AS reading_score, min(d.district_name) AS district_name,
  CAST(round(CAST(sum(g.grammar_score + g.essay_score) AS DOUBLE) / 2, 0) AS DOUBLE) AS avg_writing,
  CAST(round(CAST(sum(g.grammar_score + g.essay_score + g.reading_score + g.math_score) AS DOUBLE) / 4, 0) AS DOUBLE) AS avg_all,
  strftime(s.status_date, '%Y-%m-%d') AS application_date
  FROM status s JOIN contact p ON p.person_id = s.person_id JOIN gtc g ON g.person_id = s.person_id
  LEFT JOIN (SELECT z.person_id, dd.district_name FROM (SELECT person_id, status_id FROM status WHERE kind = 7 AND undone_by IS NULL
      AND status_date < DATE '2017-12-31' QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY status_date DESC, status_id DESC) = 1) z
    JOIN status_district sd ON sd.status_id = z.status_id JOIN districts dd ON dd.district_id = sd.district_id) d ON d.person_id = s.person_id
  WHERE s.kind = 1 AND s.undone_by IS NULL AND s.person_id > 0 AND lower(p.first_name) <> 'test' AND lower(p.last_name) NOT IN ('test', 'testsd')
  AND s.status_date BETWEEN DATE '2017-01-01' AND DATE '2017-12-31' AND {pname('s.program')} = 'GtC'
  AND NOT EXISTS (SELECT 1 FROM status x WHERE x.person_id = s.person_id AND x.kind IN (2,3,4,5,13,14,15,16) AND x.undone_by IS NULL
    AND x.status_date BETWEEN DATE '2017-01-01' AND DATE '2017-12-31' AND x.status_date >= s.status_date)
  GROUP BY {PERSON}, p.ssid, p.hs_credits, p.hs_gpa, g.interview_score, g.essay_score, g.grammar_score, g.math_score, g.reading_score, s.status_date""",
    "scenario_refresh": f"""SELECT n.item_id, n.scenario_name, {', '.join(f'CAST(n.{p} AS DOUBLE) AS {p}' for p in PCTS)} FROM scen_new n JOIN items i ON i.item_id = n.item_id
  WHERE {' OR '.join(f'n.{p} IS DISTINCT FROM i.{p}' for p in ('scenario_name', *PCTS))}""",
    "month_cap": """SELECT bill_id, person_id, start_date, CAST(max_days_period AS DOUBLE) AS max_days_period,
  CAST(max_days_month AS DOUBLE) AS max_days_month FROM capd""",
    "billed_amount": """SELECT bill_id, CAST(billed AS DOUBLE) AS billed, CAST(small_hours AS DOUBLE) AS small_hours, CAST(inter_hours AS DOUBLE) AS inter_hours,
  CAST(large_hours AS DOUBLE) AS large_hours FROM amt""",
    "cap_overage": f"""SELECT bill_id, CAST(generated_amount AS DOUBLE) AS generated_amount, CAST(generated_over AS DOUBLE) AS generated_over, {CAPS},
  CAST(adjusted_ind_hours AS DOUBLE) AS adjusted_ind_hours FROM cg""",
    "cap_overage_2017": f"""SELECT bill_id, CAST(generated_amount AS DOUBLE) AS generated_amount, CAST(generated_over AS DOUBLE) AS generated_over, {CAPS},
  CAST(adjusted_ind_hours AS DOUBLE) AS adjusted_ind_hours FROM cg17""",
    "attendance_update": """SELECT c.bill_id, CAST(c.max_days_period AS DOUBLE) AS max_days_period, CAST(c.max_days_month AS DOUBLE) AS max_days_month,
  CAST(CASE WHEN g.bill_id IS NOT NULL THEN g.generated_amount WHEN c.bill_id % 3 = 0 THEN coalesce(b.generated_amount, 0) + 1
    ELSE b.generated_amount END AS DOUBLE) AS generated_amount,
  CAST(CASE WHEN g.bill_id IS NOT NULL THEN g.generated_over ELSE b.generated_over END AS DOUBLE) AS generated_over,
  CASE WHEN g.bill_id IS NOT NULL AND c.bill_id % 3 = 0 THEN 'again' WHEN g.bill_id IS NOT NULL
    OR c.max_days_period IS DISTINCT FROM b.max_days_period OR c.max_days_month IS DISTINCT FROM b.max_days_month THEN 'first' END AS updated_by
  FROM capd c JOIN bills b ON b.bill_id = c.bill_id LEFT JOIN cg g ON g.bill_id = c.bill_id""",
    "split_month_cycles": """SELECT c.cycle_id, c.billing_type, c.start_date, c.program_year,
  CASE WHEN f.n > 1 AND c.start_date = f.lo THEN f.hi_id END AS ending_cycle_id, CASE WHEN f.n > 1 AND c.start_date = f.hi THEN f.lo_id END AS starting_cycle_id,
  CASE WHEN f.n > 1 THEN f.hi_id ELSE c.cycle_id END AS bill_on_cycle_id
  FROM cycles c LEFT JOIN (SELECT program_year, month(start_date) AS m, min(start_date) AS lo, max(start_date) AS hi, count(DISTINCT start_date) AS n,
    min(cycle_id) AS lo_id, max(cycle_id) AS hi_id FROM cycles WHERE billing_type = 'Attendance' GROUP BY ALL) f
  ON c.billing_type = 'Attendance' AND f.program_year = c.program_year AND f.m = month(c.start_date)""",
    "attendance_report": _attendance_report(""),
    "attendance_report_2017": _attendance_report("17"),
    "exit_group_date": """SELECT b.bill_id, b.g_number, b.start_date, (SELECT min(z.exit_date) FROM bills z WHERE z.g_number = b.g_number
  AND z.start_date >= b.start_date) AS exit_group_date FROM bills b""",
    "ytd_credits": """SELECT person_id, program, program_year, term, CAST(credits_term AS DOUBLE) AS credits_term,
  CAST(credits_to_date AS DOUBLE) AS credits_to_date, bill_id FROM ytd""",
    "term_units": f"SELECT bill_id, term, {UNITS} FROM unit",
    "term_units_2017": f"SELECT bill_id, term, {UNITS} FROM unit17",
    "term_update": """SELECT b.bill_id, CAST(u.generated_units AS DOUBLE) AS generated_units, CAST(u.generated_over_units AS DOUBLE) AS generated_over_units,
  CAST(CASE WHEN u.bill_id IS NOT NULL THEN u.generated_amount WHEN b.bill_id % 3 = 0 THEN coalesce(b.generated_amount, 0) + 1
    ELSE b.generated_amount END AS DOUBLE) AS generated_amount,
  CAST(CASE WHEN u.bill_id IS NOT NULL THEN u.generated_over ELSE b.generated_over END AS DOUBLE) AS generated_over,
  CAST(u.max_credits AS DOUBLE) AS max_credits, CAST(u.max_days_year AS DOUBLE) AS max_days_year,
  CASE WHEN u.bill_id IS NOT NULL AND b.bill_id % 3 = 0 THEN 'again' WHEN u.bill_id IS NOT NULL THEN 'first' END AS updated_by
  FROM bills b LEFT JOIN unit u ON u.bill_id = b.bill_id""",
    "changed_only": f"""SELECT u.bill_id, u.term, {UNITS.replace('CAST(gen', 'CAST(u.gen').replace('CAST(max', 'CAST(u.max')} FROM unit u JOIN bills b ON b.bill_id = u.bill_id
  WHERE coalesce(u.generated_over, 0) <> coalesce(b.generated_over, 0) OR coalesce(u.generated_amount, 0) <> coalesce(b.generated_amount, 0)""",
    "other_program_days": "SELECT person_id, district_id, program_year, program, CAST(other_days AS DOUBLE) AS other_days FROM oth",
    "term_report": _term_report(""),
    "term_report_2017": _term_report("17"),
    "billing_status": """SELECT b.bill_id, CASE WHEN pidm IS NULL THEN 'Missing Banner Attribute' WHEN include_flag = 0 AND closed IS NOT NULL THEN 'Excluded'
  WHEN include_flag = 0 THEN 'Excluded from Billing' WHEN closed IS NOT NULL THEN 'Billed' WHEN n = 0 THEN 'No Classes'
  WHEN reviewed_flag = 1 THEN 'Reviewed' ELSE 'In Progress' END AS billing_status FROM (
  SELECT b.*, (SELECT max(c.close_date) FROM cycles c WHERE c.start_date = b.start_date AND c.billing_type =
      CASE WHEN lower(b.program) LIKE '%attendance%' THEN 'Attendance' ELSE 'Term' END) AS closed,
    (SELECT count(*) FROM items i WHERE i.bill_id = b.bill_id) AS n FROM bills b) b""",
    "exit_backfill": "SELECT bill_id, person_id, program, start_date, exit_date FROM xb_date",
    "exit_code_backfill": "SELECT bill_id, person_id, program, start_date, exit_code FROM xb_code",
    "exit_reconcile": """SELECT b.bill_id, strftime(b.start_date, '%Y-%m-%d') AS start_date, strftime(b.end_date, '%Y-%m-%d') AS end_date,
  strftime(b.exit_date, '%Y-%m-%d') AS exit_date, b.exit_code, x.reason_text AS exit_code_text, b.exit_status_reason_id, b.adjusted_days,
  strftime(CASE WHEN c.end_date < (SELECT since FROM since) THEN NULL ELSE c.end_date END, '%Y-%m-%d') AS current_end,
  c.exit_reason_id AS current_reason_id, c.exit_reason AS current_reason, c.secondary_reason AS current_secondary_reason,
  CASE WHEN length(c.exit_note) = 0 THEN (SELECT m.comment_text FROM comments m WHERE m.person_id = b.person_id ORDER BY m.comment_id DESC LIMIT 1)
    ELSE c.exit_note END AS current_note, h.attendance, b.program, d.district_name,
  p.first_name, p.last_name, b.g_number, b.person_id
  FROM xb_code b JOIN contact p ON p.person_id = b.person_id JOIN cur c ON c.person_id = b.person_id JOIN districts d ON d.district_id = b.district_id
  JOIN (SELECT bill_id, CAST(sum(attendance) AS DOUBLE) AS attendance FROM items GROUP BY bill_id) h ON h.bill_id = b.bill_id
  LEFT JOIN reasons x ON x.reason_num = b.exit_code
  WHERE b.start_date >= (SELECT since FROM since) AND b.bill_id = (SELECT max(z.bill_id) FROM xb z WHERE z.person_id = b.person_id AND z.include_flag = 1)""",
    "interval_outcome": "SELECT person_id, seq, program, next_program, next_detail, previous_program, previous_detail, outcome, basic_outcome FROM outcome",
    "term_bounds": "SELECT person_id, seq, term_enrolled, term_exit, esl_class_yn, esol_last_term FROM bounds",
    "first_enroll_drop": "SELECT person_id, seq, first_enrollment_yn, dropped_in_30_days_yn FROM flags",
    "age_at": f"""SELECT i.person_id, i.seq, {years('c.dob', 'i.start_date')} AS age_at_entry, {years('c.dob', 'i.end_date')} AS age_at_exit
  FROM iv i JOIN contact c ON c.person_id = i.person_id""",
    "person_summary": f"""SELECT c.person_id, {', '.join('c.' + n for n in ('seq', 'g_number', 'program', 'program_detail', 'start_date', 'end_date', 'exit_type', 'exit_reason_id', 'exit_reason', 'secondary_reason', 'exit_note', 'district_id', 'district_name', 'coach_id', 'coach_name'))}, c.current_status,
  (SELECT min(start_date) FROM iv i WHERE i.person_id = c.person_id) AS min_start_date, (SELECT max(end_date) FROM iv i WHERE i.person_id = c.person_id) AS max_end_date,
  (SELECT min(term_enrolled) FROM bounds b WHERE b.person_id = c.person_id) AS min_term_enrolled, (SELECT max(term_exit) FROM bounds b WHERE b.person_id = c.person_id) AS max_term_exit,
  (SELECT count(*) FROM iv i WHERE i.person_id = c.person_id) AS enrollments,
  (SELECT count(*) FROM iv i WHERE i.person_id = c.person_id AND i.program = 'YtC') AS ytc_enrollments,
  (SELECT count(*) FROM iv i WHERE i.person_id = c.person_id AND i.program = 'GtC') AS gtc_enrollments,
  (SELECT min(start_date) FROM iv i WHERE i.person_id = c.person_id AND i.program = 'YtC') AS min_ytc_start, (SELECT max(end_date) FROM iv i WHERE i.person_id = c.person_id AND i.program = 'YtC') AS max_ytc_end,
  (SELECT min(start_date) FROM iv i WHERE i.person_id = c.person_id AND i.program = 'GtC') AS min_gtc_start, (SELECT max(end_date) FROM iv i WHERE i.person_id = c.person_id AND i.program = 'GtC') AS max_gtc_end,
  coalesce((SELECT sum(post_credits) FROM later l WHERE l.person_id = c.person_id), 0.0) AS post_credits, coalesce((SELECT sum(post_points) FROM later l WHERE l.person_id = c.person_id), 0.0) AS post_points
  FROM cur c""",
    "contact_profile": "SELECT * FROM prof",
    "date_to_term": """SELECT o_orderkey AS order_id, day AS at, (SELECT c.term FROM calendar c WHERE day >= c.term_begin AND day < c.next_begin) AS term FROM od""",
    "post_event_gpa": "SELECT i.person_id, i.seq, post_credits, post_points, course_rows_in_pass_term FROM iv i LEFT JOIN later l ON l.person_id = i.person_id AND l.seq = i.seq",
    "interval_by_term": "SELECT * FROM ivt",
    "term_exit_adjust": "SELECT * EXCLUDE (student) FROM pexit",
    "person_term": f"SELECT {PTERM} FROM pterm WHERE program = 'GtC'",
    "running_level": """SELECT q.student, q.term, CASE WHEN lv2.n > 0 THEN 1 END AS esol_student, lv2.incoming_esol_level FROM (SELECT DISTINCT student, term FROM courses) q
  JOIN LATERAL (SELECT count(*) FILTER (WHERE upper(l.subject) = 'ESOL' AND l.term <= q.term) AS n, max(CASE WHEN l.term < q.term THEN l.lvl END) AS incoming_esol_level
    FROM lv l WHERE l.student = q.student) lv2 ON true""",
    "first_term": "SELECT person_id, first_term, first_term_begin FROM first_t",
    "person_term_scores": f"""SELECT {PTERM}, social_score, science_score, math_score, literature_score, writing_score, language_score, passed_code, completed_code,
  last_test_date, post_gpa, post_terms FROM pt_g""",
    "pass_rule": "SELECT * FROM scores",
    "post_pass_gpa": "SELECT person_id, student, last_test_date, term, post_gpa, post_terms FROM pt_g",
    "year_bounds": "SELECT program_year, year_begin, year_end, year_first_term, year_last_term FROM yb",
    "interval_by_year": "SELECT * FROM ivy",
    "person_year": """SELECT g.* EXCLUDE (first_seq, last_seq, year_begin, year_end, year_first_term, year_last_term, tested),
  s.gender, s.reported_race, s.asian, s.native, s.black, s.hispanic, s.islander, s.white FROM py_g g LEFT JOIN sis s ON s.student = g.student""",
    "cohort_term": """SELECT z.*, min(term) OVER (PARTITION BY person_id) AS first_term, min(term_begin) OVER (PARTITION BY person_id) AS first_term_begin FROM (
  SELECT DISTINCT f.person_id, f.g_number, f.exit_reason, f.coach, c.program_year, c.term, c.term_begin, c.term_end, r.gpa, r.attempted, r.earned, f.cohort
  FROM cohort f JOIN contact p ON p.person_id = f.person_id JOIN calendar c ON c.term >= f.cohort * 100 + 4
  JOIN courses k ON k.student = f.g_number AND k.term = c.term JOIN results r ON r.student = f.g_number AND r.term = c.term) z""",
    "course_fact": """SELECT e.*, e.first_term // 100 * 4 + e.first_term % 10 AS first_term_number, e.last_term // 100 * 4 + e.last_term % 10 AS last_term_number,
  CAST(yes_passed = 'Y' OR ytc_passed = 'Y' AS INTEGER) AS passed, CASE WHEN length(yes_term) > 0 THEN yes_term ELSE ytc_term END AS pass_term,
  CASE WHEN length(yes_term) > 0 THEN CAST(yes_term[1:4] AS INTEGER) * 4 + CAST(yes_term[6:6] AS INTEGER)
    ELSE CAST(ytc_term[1:4] AS INTEGER) * 4 + CAST(ytc_term[6:6] AS INTEGER) END AS pass_term_number,
  CASE WHEN a.earned > 0 THEN 1 ELSE 0 END AS earned_award, s.esl_check, k.term, k.crn, k.subject, k.course_number, k.course_level, k.title,
  CAST(k.credits AS DOUBLE) AS credits, k.grade, k.passed AS course_passed, k.term // 100 * 4 + k.term % 10 AS term_number
  FROM enroll_results e LEFT JOIN (SELECT student, max(CASE WHEN length(major) > 1 THEN 1 ELSE 0 END) AS earned FROM awards GROUP BY student) a ON a.student = e.g_number
  LEFT JOIN (SELECT student, max(CASE WHEN upper(subject) IN ('ESL', 'ESOL') THEN 1 ELSE 0 END) AS esl_check FROM courses GROUP BY student) s ON s.student = e.g_number
  LEFT JOIN (SELECT DISTINCT * FROM courses) k ON k.student = e.g_number""",
    "audit_update": "SELECT * EXCLUDE (mode) FROM (" + _audit("null_safe") + ")",
    "report_register": """SELECT cycle_id, billing_type, start_date, CASE WHEN cycle_id = (SELECT max(cycle_id) FROM cycles WHERE billing_type = 'Attendance')
  THEN CAST(1 AS BIGINT) WHEN cycle_id = (SELECT max(cycle_id) FROM cycles WHERE billing_type = 'Term') THEN CAST(2 AS BIGINT) END AS latest_report_id,
  CASE WHEN cycle_id IN (SELECT max(cycle_id) FROM cycles WHERE billing_type IN ('Attendance', 'Term') GROUP BY billing_type) THEN 'clerk' END AS created_by
  FROM cycles""",
    "audit_feed": "SELECT * EXCLUDE (mode) FROM (" + _audit("null_safe") + ")",
    "audit_modes": " UNION ALL ".join(_audit(m) for m in ("null_safe", "length", "plain")),
    "audit_insert": """SELECT 'bill' AS table_name, 'bill_id' AS id_column, bill_id AS id_value, u.c AS column_name, CAST(NULL AS VARCHAR) AS old_value,
  CASE u.c WHEN 'bill_id' THEN CAST(bill_id AS VARCHAR) WHEN 'state' THEN state WHEN 'amount' THEN CAST(amount AS VARCHAR) WHEN 'priority' THEN priority
    ELSE CAST(person_id AS VARCHAR) END AS new_value, 'INSERT' AS action, 'clerk' AS changed_by
  FROM new_b n, (VALUES ('bill_id'), ('state'), ('amount'), ('priority'), ('person_id')) AS u(c) WHERE n.bill_id NOT IN (SELECT bill_id FROM old_b)""",
    "audit_items": f"""SELECT 'item' AS table_name, 'item_id' AS id_column, item_id AS id_value, column_name, old_value, new_value, 'UPDATE' AS action, 'clerk' AS changed_by FROM (
  SELECT i.item_id, 'scenario_name' AS column_name, i.scenario_name AS old_value, n.scenario_name AS new_value, lower(i.scenario_name) IS DISTINCT FROM lower(n.scenario_name) AS hit
    FROM items i JOIN items2 n ON n.item_id = i.item_id
  {' '.join(f"UNION ALL SELECT i.item_id, '{p}', CAST(i.{p} AS VARCHAR), CAST(n.{p} AS VARCHAR), i.{p} IS DISTINCT FROM n.{p} FROM items i JOIN items2 n ON n.item_id = i.item_id" for p in PCTS)})
  WHERE hit""",
    "grade_band": """SELECT person_id, dob, CASE WHEN dob < DATE '1995-09-01' THEN 'Over' WHEN dob < DATE '1999-09-01' THEN '12'
  WHEN dob < DATE '2000-09-01' THEN '11' WHEN dob < DATE '2001-09-01' THEN '10' WHEN dob < DATE '2002-09-01' THEN '9' END AS grade FROM contact""",
    "program_map": f"SELECT status_id, program, {pname('program')} AS program_name FROM status",
    "term_label": """SELECT bill_id, term, CAST(term AS VARCHAR) || CASE term % 10 WHEN 1 THEN '-Winter' WHEN 2 THEN '-Spring' WHEN 3 THEN '-Summer'
  WHEN 4 THEN '-Fall' END AS label FROM bills""",
}


FINAL |= {
    "attendance_report_sorted": _numbered(FINAL["attendance_report"]),
    "attendance_run": _filed(
        _attendance_report("", f"AND c.program_year = {_last('Attendance', 'program_year')} AND b.start_date <= {_last('Attendance', 'start_date')}"), "Attendance", 7
    ),
    "term_run": _filed(_term_report("", f"AND a.program_year = {_last('Term', 'program_year')}"), "Term", 8),
    "reporting_rebuild": FINAL["person_summary"],
    "audit_bills_wide": _wide_audit("bills", "bill_id", "bill"),
    "audit_items_wide": _wide_audit("items", "item_id", "item"),
    "audit_feed_stream": FINAL["audit_feed"],
    "active_report": "SELECT " + ", ".join(f'{c} AS "{label}"' for c, label in _LABELLED.items())
    + f" FROM (SELECT *, row_number() OVER (ORDER BY last_name, first_name, person_id) AS row_no FROM ({FINAL['active_during']}))",
}


def oracle_sql() -> dict[str, str]:
    return {name: sql(text) for name, text in FINAL.items()}
