"""SQL fragments shared by the DuckDB oracles.

They restate each operator's semantics in plain SQL, independent of the Spark code, so a
mismatch points at one side or the other.
"""

from __future__ import annotations

from sparkrisk.fixtures import CTE_ESTABLISHMENTS, CTE_INSPECTIONS

# Event rows of the history job: P1 filter, C2 training clean, F5 parse of the event time.
_EVENTS_TEMPLATE = (
    CTE_INSPECTIONS
    + """,
ev AS (
  SELECT {key} AS property_id,
         try_strptime(resultdttm_raw, '%Y-%m-%d %H:%M:%S') AS resultdttm,
         issdttm, lower(state) AS state, location, licensecat, descript,
         replace(replace(coalesce(lower(city), 'boston'), '/', ''), '  ', ' ') AS city,
         coalesce(zip, '02116') AS zip, violstatus
  FROM fx_inspections
  WHERE viollevel <> '1919' AND property_id IS NOT NULL AND violstatus <> ' '
)"""
)
CTE_EVENTS = _EVENTS_TEMPLATE.format(key="property_id")

# One entity holding about a third of the rows: every entity id divisible by 3 becomes '0'.
HOT_KEY_SQL = "CASE WHEN CAST(property_id AS BIGINT) % 3 = 0 THEN '0' ELSE property_id END"
CTE_EVENTS_HOT = _EVENTS_TEMPLATE.format(key=HOT_KEY_SQL)

# One visit holding about a third of the rows: those rows also have one time.
HOT_VISIT = "2001-01-01 00:00:00"
CTE_EVENTS_HOT_VISIT = CTE_EVENTS_HOT.replace(
    "try_strptime(resultdttm_raw, '%Y-%m-%d %H:%M:%S')",
    f"CASE WHEN CAST(property_id AS BIGINT) % 3 = 0 THEN TIMESTAMP '{HOT_VISIT}' "
    "ELSE try_strptime(resultdttm_raw, '%Y-%m-%d %H:%M:%S') END",
)

HIST_ORDER = (
    "PARTITION BY property_id ORDER BY resultdttm NULLS FIRST, issdttm NULLS FIRST, "
    "state NULLS FIRST, location NULLS FIRST, licensecat NULLS FIRST, descript NULLS FIRST, "
    "city NULLS FIRST, zip NULLS FIRST"
)

LATEST_ORDER = (
    "PARTITION BY property_id ORDER BY resultdttm DESC NULLS LAST, issdttm DESC NULLS LAST, "
    "state DESC NULLS LAST, location DESC NULLS LAST, licensecat DESC NULLS LAST, "
    "descript DESC NULLS LAST, city DESC NULLS LAST, zip DESC NULLS LAST"
)

# C3 history in SQL: distinct tuples, visit counts joined back, windows.
_HISTORY_TAIL = (
    f""",
d AS (SELECT DISTINCT property_id, issdttm, state, location, licensecat, descript, city, zip, resultdttm FROM ev),
v AS (
  SELECT property_id, resultdttm,
         count(*) FILTER (WHERE violstatus = 'Fail') AS viol_fail,
         count(*) FILTER (WHERE violstatus = 'Pass') AS viol_pass
  FROM ev GROUP BY property_id, resultdttm
),
j AS (
  SELECT d.*, coalesce(v.viol_fail, 0) AS viol_fail, coalesce(v.viol_pass, 0) AS viol_pass
  FROM d LEFT JOIN v ON d.property_id = v.property_id AND d.resultdttm = v.resultdttm
),
hist AS (
  SELECT property_id, resultdttm, issdttm, state, location, licensecat, descript, city, zip,
         CAST(row_number() OVER w AS INTEGER) AS inspections_so_far,
         lag(resultdttm) OVER w AS last_inspections,
         CAST(coalesce(date_diff('day', lag(resultdttm) OVER w, resultdttm), 99999999) AS INTEGER)
           AS days_since_last_inspect,
         viol_fail, viol_pass,
         CASE WHEN viol_fail > 0 THEN 1 ELSE 0 END AS fail,
         CAST(coalesce(lag(viol_fail) OVER w, 99999999) AS BIGINT) AS last_viol_fail,
         CAST(coalesce(lag(viol_pass) OVER w, 99999999) AS BIGINT) AS last_viol_pass
  FROM j WINDOW w AS ({HIST_ORDER})
)"""
)
CTE_HISTORY = CTE_EVENTS + _HISTORY_TAIL
CTE_HISTORY_HOT = CTE_EVENTS_HOT + _HISTORY_TAIL
CTE_HISTORY_HOT_VISIT = CTE_EVENTS_HOT_VISIT + _HISTORY_TAIL

# C5 scoring features in SQL.
CTE_FEATURES = (
    CTE_HISTORY
    + ",\n"
    + CTE_ESTABLISHMENTS
    + f""",
lt AS (
  SELECT property_id, CAST(inspections_so_far AS INTEGER) AS inspections_so_far,
         CAST(date_diff('day', resultdttm, DATE '2001-09-01') AS INTEGER) AS days_since_last_inspect,
         CAST(viol_fail AS INTEGER) AS last_viol_fail, CAST(viol_pass AS INTEGER) AS last_viol_pass
  FROM (SELECT *, row_number() OVER ({LATEST_ORDER}) AS rn FROM hist) WHERE rn = 1
),
ents AS (
  SELECT _id, Property_ID AS property_id, BusinessName, State, LICENSECAT AS licensecat,
         DESCRIPT AS descript,
         CASE WHEN c2 IN ('', ' ') THEN 'boston' ELSE c2 END AS city,
         coalesce(ZIP, '02116') AS zip
  FROM (SELECT *, replace(replace(replace(lower(CITY), '/', ''), 'downtownfinancial', 'financial'), '  ', ' ') AS c2
        FROM fx_establishments)
),
feat AS (
  SELECT ents.*,
         coalesce(lt.inspections_so_far, 0) AS inspections_so_far,
         coalesce(lt.days_since_last_inspect, 99999999) AS days_since_last_inspect,
         coalesce(lt.last_viol_fail, 0) AS last_viol_fail,
         coalesce(lt.last_viol_pass, 0) AS last_viol_pass
  FROM ents LEFT JOIN lt ON ents.property_id = lt.property_id
)"""
)
