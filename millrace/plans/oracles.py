"""SQL oracles (DuckDB dialect) for the registered queries.

The oracles compute the *truth* straight from the driver's columns — the
instant before it was rendered as text, the code before it was spelled
differently — so they check the parsers and conformance joins instead of
repeating them.  Fragments below are CTE bodies shared by several oracles.
"""

from __future__ import annotations

from millrace.functions.parse import round_half_up_sql as rhu

TZ = "'America/Chicago'"


def utc_of_local(expr: str) -> str:
    return f"timezone('UTC', timezone({TZ}, {expr}))"


def local_of_utc(expr: str) -> str:
    return f"timezone({TZ}, timezone('UTC', {expr}))"


EQUIPMENT_XREF = """equipment_xref AS (
  SELECT * FROM (VALUES
    ('EQP-101', 'EQ-101', 'A-101', 'Line 1 Filler', 'Filling Machine', 1, 'A', TRUE),
    ('EQP-102', 'EQ-102', 'A-102', 'Line 1 Capper', 'Capping Machine', 1, 'A', TRUE),
    ('EQP-103', 'EQ-103', 'A-103', 'Line 1 Labeler', 'Labeler', 1, 'B', TRUE),
    ('EQP-104', 'EQ-104', 'A-104', 'Line 1 Pasteurizer', 'Pasteurizer', 1, 'A', TRUE),
    ('EQP-105', 'EQ-105', 'A-105', 'Line 1 Conveyor System', 'Conveyor', 1, 'B', TRUE),
    ('EQP-106', 'EQ-106', 'A-106', 'Line 1 Case Packer', 'Case Packer', 1, 'B', TRUE),
    ('EQP-107', 'EQ-107', 'A-107', 'Line 1 Palletizer', 'Palletizer', 1, 'C', TRUE),
    ('EQP-108', 'EQ-108', 'A-108', 'Line 1 Rinser', 'Rinser', 1, 'B', TRUE),
    ('EQP-109', 'EQ-109', 'A-109', 'CIP Skid 1', 'CIP Unit', 1, 'A', TRUE),
    ('EQP-201', 'EQUIP_201', 'A-201', 'Line 2 Filler', 'Filling Machine', 2, 'A', TRUE),
    ('EQP-202', 'EQUIP_202', 'A-202', 'Line 2 Capper', 'Capping Machine', 2, 'A', TRUE),
    ('EQP-203', 'EQUIP_203', 'A-203', 'Line 2 Labeler', 'Labeler', 2, 'B', TRUE),
    ('EQP-204', 'EQUIP_204', 'A-204', 'Line 2 Conveyor System', 'Conveyor', 2, 'B', TRUE),
    ('EQP-205', 'EQUIP_205', 'A-205', 'Line 2 Case Packer', 'Case Packer', 2, 'B', TRUE),
    ('EQP-206', 'EQUIP_206', 'A-206', 'Line 2 Palletizer', 'Palletizer', 2, 'C', TRUE),
    ('EQP-207', 'EQUIP_207', 'A-207', 'Line 2 Rinser', 'Rinser', 2, 'B', TRUE),
    ('EQP-208', 'EQUIP_208', 'A-208', 'CIP Skid 2', 'CIP Unit', 2, 'A', TRUE),
    ('EQP-301', '301', 'A-301', 'Line 3 Filler', 'Filling Machine', 3, 'A', TRUE),
    ('EQP-302', '302', 'A-302', 'Line 3 Capper', 'Capping Machine', 3, 'A', TRUE),
    ('EQP-303', '303', 'A-303', 'Line 3 Labeler', 'Labeler', 3, 'B', TRUE),
    ('EQP-304', '304', 'A-304', 'Line 3 Pasteurizer', 'Pasteurizer', 3, 'A', TRUE),
    ('EQP-305', '305', 'A-305', 'Line 3 Conveyor System', 'Conveyor', 3, 'B', TRUE),
    ('EQP-306', '306', 'A-306', 'Line 3 Case Packer', 'Case Packer', 3, 'B', TRUE),
    ('EQP-307', '307', 'A-307', 'Line 3 Palletizer', 'Palletizer', 3, 'B', TRUE),
    ('EQP-308', '308', 'A-308', 'Line 3 Rinser', 'Rinser', 3, 'B', TRUE),
    ('EQP-309', '309', 'A-309', 'CIP Skid 3', 'CIP Unit', 3, 'A', TRUE),
    ('EQP-110', 'EQ-110', 'A-110', 'Depalletizer 1', 'Depalletizer', 1, 'B', FALSE),
    ('EQP-111', 'EQ-111', 'A-111', 'Depalletizer 1 (New)', 'Depalletizer', 1, 'B', TRUE),
    ('EQP-209', 'EQUIP_209', 'A-209', 'Depalletizer 2', 'Depalletizer', 2, 'B', TRUE),
    ('EQP-310', '310', 'A-310', 'Depalletizer 3', 'Depalletizer', 3, 'B', TRUE)
  ) t(equipment_key, source_equipment_id, sap_asset_number, equipment_name, equipment_type,
      line_id, criticality, is_active)
)"""

# runs: truth per order (local start, minutes, status, units)
T_RUNS = f"""t_runs0 AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS run_id,
         o_orderkey,
         CAST(o_custkey % 3 + 1 AS INTEGER) AS line_id,
         'SKU-' || CAST(o_orderkey % 5 AS VARCHAR) AS product_sku,
         CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(3 + o_orderkey % 21 AS BIGINT)) AS start_ts_local,
         CAST(30 + (o_orderkey * 7) % 600 AS BIGINT) AS run_minutes,
         CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'RUNNING'
              WHEN 'P' THEN 'SCHEDULED' ELSE 'ON_HOLD' END AS run_status,
         CAST(floor(o_totalprice) AS BIGINT) AS total_units,
         CAST(floor(o_totalprice) AS BIGINT) * (o_orderkey % 7) // 200 AS scrap_units,
         o_orderkey % 4 AS unit_sel
  FROM orders
),
t_runs AS (
  SELECT *, total_units - scrap_units AS good_units,
         {utc_of_local('start_ts_local')} AS start_ts,
         CASE WHEN run_status = 'COMPLETED'
              THEN {utc_of_local('start_ts_local')} + to_minutes(run_minutes) END AS end_ts
  FROM t_runs0
)"""

T_WO = f"""t_wo0 AS (
  SELECT 'WO-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS work_order_id,
         l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity,
         'EQP-' || CAST(CASE WHEN l_suppkey % 11 < 4 THEN 101 + l_suppkey % 11
                             WHEN l_suppkey % 11 < 8 THEN 197 + l_suppkey % 11
                             ELSE 293 + l_suppkey % 11 END AS VARCHAR) AS equipment_key,
         CASE l_linenumber % 4 WHEN 0 THEN 'PREVENTIVE' WHEN 1 THEN 'PREVENTIVE'
              WHEN 2 THEN 'CORRECTIVE' ELSE 'BREAKDOWN' END AS maintenance_type,
         CASE WHEN l_linenumber % 4 >= 2 THEN 'UNPLANNED' ELSE 'PLANNED' END AS planning_category,
         CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(3 + l_orderkey % 21 AS BIGINT)) AS created_ts_local,
         CASE WHEN l_linestatus = 'F' THEN 'COMPLETED'
              ELSE CASE l_linenumber % 3 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'IN_PROGRESS' ELSE 'CANCELLED' END
         END AS work_order_status,
         CASE l_returnflag WHEN 'R' THEN 'Critical' WHEN 'A' THEN 'High' WHEN 'N' THEN 'Low'
              ELSE 'Medium' END AS priority,
         CAST(l_quantity * 5 AS INTEGER) AS downtime_minutes,
         'T-' || CAST(l_suppkey % 6 AS VARCHAR) AS technician,
         'P-' || CAST(l_partkey AS VARCHAR) AS parts_used,
         l_linestatus
  FROM lineitem
),
t_wo1 AS (
  SELECT *, {utc_of_local('created_ts_local')} AS created_ts,
         CASE WHEN l_linestatus = 'F'
              THEN {utc_of_local('created_ts_local')} + to_hours(CAST(l_quantity AS BIGINT)) END AS completed_ts
  FROM t_wo0
),
t_wo AS (
  SELECT *, {local_of_utc('completed_ts')} AS completed_ts_local FROM t_wo1
)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


ORACLES: dict[str, str] = {}

# minutes and units of completed runs, and minutes of unplanned stops, as rows of one kind
ORACLES["gold_oee_daily"] = with_ctes(T_RUNS, T_WO, """line_minutes AS (
  SELECT line_id, CAST(start_ts_local AS DATE) AS production_date, run_minutes AS ran, NULL AS stood,
         total_units AS made, good_units AS good
  FROM t_runs WHERE run_status = 'COMPLETED'
  UNION ALL
  SELECT CAST(CASE WHEN l_suppkey % 11 < 4 THEN 1 WHEN l_suppkey % 11 < 8 THEN 2 ELSE 3 END AS INTEGER),
         CAST(created_ts_local AS DATE), NULL, downtime_minutes, NULL, NULL
  FROM t_wo WHERE planning_category = 'UNPLANNED'
)""", """line_day AS (
  SELECT line_id, production_date, CAST(SUM(ran) AS DOUBLE) AS ran, CAST(COALESCE(SUM(stood), 0) AS DOUBLE) AS stood,
         CAST(SUM(made) AS DOUBLE) AS made, CAST(SUM(good) AS DOUBLE) AS good,
         CASE line_id WHEN 1 THEN 600 WHEN 2 THEN 800 ELSE 500 END AS units_a_minute
  FROM line_minutes GROUP BY line_id, production_date HAVING COUNT(ran) > 0
)""") + f"""SELECT line_id, production_date, {rhu('ran / NULLIF(ran + stood, 0)', 4)} AS availability,
       {rhu('made / NULLIF(ran * units_a_minute, 0)', 4)} AS performance, {rhu('good / NULLIF(made, 0)', 4)} AS quality,
       {rhu('(ran / NULLIF(ran + stood, 0)) * (made / NULLIF(ran * units_a_minute, 0)) * (good / NULLIF(made, 0))', 4)} AS oee
FROM line_day"""

ORACLES["gold_reliability"] = with_ctes(T_WO, EQUIPMENT_XREF) + f"""SELECT w.equipment_key, e.equipment_name, e.line_id,
       CAST(date_trunc('month', w.created_ts_local) AS DATE) AS stop_month,
       COUNT(*) AS unplanned_stop_count,
       {rhu("CAST(date_sub('hour', MIN(w.created_ts), MAX(w.created_ts)) AS DOUBLE) / NULLIF(CAST(COUNT(*) - 1 AS DOUBLE), 0)", 1)} AS mtbf_hours,
       {rhu('AVG(w.downtime_minutes)', 1)} AS mttr_minutes
FROM t_wo w JOIN equipment_xref e USING (equipment_key)
WHERE w.planning_category = 'UNPLANNED'
GROUP BY 1, 2, 3, 4"""

ORACLES["gold_scrap_rate"] = with_ctes(T_RUNS) + f"""SELECT line_id, CAST(start_ts_local AS DATE) AS production_date,
       CAST(SUM(scrap_units) AS BIGINT) AS scrap_units, CAST(SUM(total_units) AS BIGINT) AS total_units,
       {rhu('CAST(SUM(scrap_units) AS DOUBLE) / NULLIF(CAST(SUM(total_units) AS DOUBLE), 0)', 4)} AS scrap_rate
FROM t_runs WHERE run_status = 'COMPLETED' GROUP BY 1, 2"""

# each line's completed runs as one list, zipped with the same list less its first run
ORACLES["gold_changeover"] = with_ctes(T_RUNS, """line_history AS (
  SELECT line_id, list({'sku': product_sku, 'began': start_ts, 'ended': end_ts} ORDER BY start_ts, run_id) AS runs
  FROM t_runs WHERE run_status = 'COMPLETED' GROUP BY line_id
)""", """neighbours AS (SELECT line_id, unnest(list_zip(runs, runs[2:])) AS pair FROM line_history)""") + """SELECT line_id,
       pair[1].sku AS from_product_sku, pair[2].sku AS to_product_sku,
       pair[1].ended AS changeover_start_ts, pair[2].began AS changeover_end_ts,
       CAST(date_sub('minute', pair[1].ended, pair[2].began) AS BIGINT) AS changeover_minutes
FROM neighbours WHERE pair[1].sku <> pair[2].sku AND pair[1].ended <= pair[2].began"""

T_QC = f"""t_qc0 AS (
  SELECT 'B-' || CAST(l.l_orderkey AS VARCHAR) AS batch_id,
         CASE l.l_linenumber % 3 WHEN 0 THEN 'incoming' WHEN 1 THEN 'in_process' ELSE 'final' END AS check_type,
         p.p_type AS parameter,
         l.l_quantity AS value,
         CAST(l.l_suppkey % 3 + 1 AS INTEGER) AS line_id,
         CASE WHEN l.l_quantity BETWEEN 5 AND 45 THEN 'PASS'
              WHEN l.l_quantity BETWEEN 3 AND 47 THEN 'MARGINAL' ELSE 'FAIL' END AS check_result,
         CAST(l.l_shipdate AS TIMESTAMP) + to_hours(CAST(3 + l.l_linenumber AS BIGINT))
             + to_minutes(CAST(l.l_partkey % 60 AS BIGINT)) AS check_ts_local,
         l.l_orderkey, l.l_suppkey, l.l_linenumber, l.l_extendedprice, l.l_tax, l.l_discount, l.l_partkey
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
t_qc AS (SELECT *, {utc_of_local('check_ts_local')} AS check_ts FROM t_qc0)"""

# the result that stands at the minimum of (time, check) in each combination
ORACLES["gold_first_pass_yield"] = with_ctes(T_QC, """judged AS (
  SELECT min_by({'line': line_id, 'day': CAST(check_ts_local AS DATE), 'ok': check_result = 'PASS'},
                {'a': check_ts, 'b': l_suppkey, 'c': l_linenumber, 'd': l_extendedprice, 'e': l_tax, 'f': l_discount}) AS j
  FROM t_qc GROUP BY batch_id, check_type, parameter
)""") + f"""SELECT j.line AS line_id, j.day AS check_date, COUNT(*) AS first_checks_total,
       COUNT(*) FILTER (WHERE j.ok) AS first_checks_passed,
       {rhu("CAST(COUNT(*) FILTER (WHERE j.ok) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)", 4)} AS first_pass_yield
FROM judged GROUP BY 1, 2"""

ORACLES["gold_critical_work_orders"] = with_ctes(T_WO) + f"""SELECT technician,
       CAST(date_trunc('week', completed_ts_local) AS DATE) AS resolved_week,
       COUNT(*) AS critical_work_orders_resolved,
       {rhu('AVG(downtime_minutes)', 1)} AS avg_downtime_minutes
FROM t_wo WHERE priority = 'Critical' AND work_order_status = 'COMPLETED'
GROUP BY 1, 2"""

# readings: one truth row per bronze row (replays included)
T_R = f"""t_r0 AS (
  SELECT e.event_id, e.user_id, e.event_type, e.value AS v0, e.ts
  FROM events e, (VALUES (0), (1)) c(copy)
  WHERE c.copy = 0 OR e.event_id % 50 = 0
),
t_r AS (
  SELECT event_id, user_id, event_type, ts, v0,
    CASE WHEN event_id % 97 = 0 THEN NULL
         WHEN event_id % 4 = 0 THEN date_trunc('millisecond', ts)
         WHEN event_id % 4 = 3 THEN date_trunc('minute', ts)
         ELSE date_trunc('second', ts) END AS reading_ts,
    CASE WHEN event_id % 97 = 0 THEN 'UNKNOWN' WHEN event_id % 4 = 0 THEN 'EPOCH_MS'
         WHEN event_id % 4 = 1 THEN 'ISO_UTC' WHEN event_id % 4 = 2 THEN 'ISO_NAKED'
         ELSE 'US_SLASH' END AS ts_format,
    CASE WHEN event_id % 97 = 0 THEN 'not-a-time'
         WHEN event_id % 4 = 0 THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
         WHEN event_id % 4 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
         WHEN event_id % 4 = 2 THEN strftime({local_of_utc('ts')}, '%Y-%m-%d %H:%M:%S')
         ELSE strftime({local_of_utc('ts')}, '%m/%d/%Y %H:%M') END AS raw_timestamp,
    CASE WHEN user_id % 12 < 4 THEN 'EQ-' || CAST(101 + user_id % 12 AS VARCHAR)
         WHEN user_id % 12 < 8 THEN 'EQUIP_' || CAST(197 + user_id % 12 AS VARCHAR)
         WHEN user_id % 12 < 11 THEN CAST(293 + user_id % 12 AS VARCHAR)
         ELSE 'EQ-999' END AS equipment_id,
    CASE WHEN user_id % 12 = 11 THEN NULL
         WHEN user_id % 12 < 4 THEN 'EQP-' || CAST(101 + user_id % 12 AS VARCHAR)
         WHEN user_id % 12 < 8 THEN 'EQP-' || CAST(197 + user_id % 12 AS VARCHAR)
         ELSE 'EQP-' || CAST(293 + user_id % 12 AS VARCHAR) END AS equipment_key,
    CASE WHEN event_type = 'error' THEN 'line_VIB_error' ELSE event_type END AS sensor_tag,
    CASE WHEN event_id % 53 = 0 OR event_id % 41 = 0 THEN NULL
         WHEN event_type = 'error' AND event_id % 37 = 0 THEN (CASE WHEN v0 > 0 THEN NULL ELSE -v0 END)
         ELSE v0 END AS value,
    CAST(CASE event_id % 10 WHEN 0 THEN 0 WHEN 1 THEN 64 ELSE 192 END AS INTEGER) AS opc_quality_code,
    CASE event_id % 10 WHEN 0 THEN '0' WHEN 1 THEN '64' ELSE '192' END AS quality,
    CASE event_id % 10 WHEN 0 THEN 'BAD' WHEN 1 THEN 'SUSPECT' ELSE 'GOOD' END AS reading_quality_status,
    CAST(user_id % 3 + 1 AS INTEGER) AS line_id,
    CASE event_id % 4 WHEN 0 THEN CAST(user_id % 3 + 1 AS VARCHAR)
         WHEN 1 THEN 'L' || CAST(user_id % 3 + 1 AS VARCHAR)
         WHEN 2 THEN 'Line ' || CAST(user_id % 3 + 1 AS VARCHAR)
         ELSE 'Line-' || CAST(user_id % 3 + 1 AS VARCHAR) END AS raw_line
  FROM t_r0
),
t_acc AS (SELECT * FROM t_r WHERE reading_ts IS NOT NULL AND equipment_key IS NOT NULL),
t_best AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY reading_ts, equipment_key, sensor_tag
                               ORDER BY opc_quality_code DESC, value DESC NULLS LAST, line_id DESC) AS rn,
         COUNT(*) OVER (PARTITION BY reading_ts, equipment_key, sensor_tag) AS copies
  FROM t_acc
),
t_silver_r AS (
  SELECT reading_ts, {local_of_utc('reading_ts')} AS reading_ts_local, equipment_key, sensor_tag, value,
         opc_quality_code, reading_quality_status, opc_quality_code = 192 AS is_good_quality, line_id, copies
  FROM t_best WHERE rn = 1
)"""

ORACLES["silver_readings"] = with_ctes(T_R) + """SELECT reading_ts, reading_ts_local, equipment_key, sensor_tag, value,
       opc_quality_code, reading_quality_status, is_good_quality, line_id
FROM t_silver_r"""

ORACLES["quarantine_readings"] = with_ctes(T_R) + """SELECT raw_timestamp AS "timestamp", equipment_id, sensor_tag, quality,
       reading_quality_status AS status, raw_line AS line_id, reading_ts, equipment_key,
       CASE WHEN reading_ts IS NULL THEN 'UNPARSEABLE_TIMESTAMP' ELSE 'UNKNOWN_EQUIPMENT_ID' END AS quarantine_reason
FROM t_r WHERE reading_ts IS NULL OR equipment_key IS NULL"""

ORACLES["quarantine_balance"] = with_ctes(T_R) + """SELECT
  (SELECT COUNT(*) FROM t_r) AS input_rows,
  (SELECT COUNT(*) FROM t_silver_r) AS accepted_rows,
  (SELECT COUNT(*) FROM t_r WHERE reading_ts IS NULL OR equipment_key IS NULL) AS quarantined_rows,
  (SELECT COUNT(*) FROM t_acc) - (SELECT COUNT(*) FROM t_silver_r) AS duplicate_rows,
  TRUE AS balanced"""

ORACLES["dedupe_readings"] = with_ctes(T_R) + """SELECT DISTINCT reading_ts, equipment_key, sensor_tag FROM t_acc"""

ORACLES["dedupe_best"] = with_ctes(T_R) + """SELECT reading_ts, equipment_key, sensor_tag, copies, opc_quality_code, value, line_id
FROM t_best WHERE rn = 1 AND copies > 1"""

ORACLES["sentinel_scrub"] = with_ctes(T_R) + """SELECT sensor_tag, COUNT(*) AS raw_rows,
  COUNT(*) FILTER (WHERE event_id % 53 = 0) AS sentinel_rows,
  COUNT(*) FILTER (WHERE event_id % 53 <> 0 AND event_id % 41 <> 0 AND event_type = 'error'
                   AND event_id % 37 = 0 AND v0 > 0) AS negative_vibration_rows,
  COUNT(*) FILTER (WHERE event_id % 53 <> 0 AND event_id % 41 = 0) AS empty_rows,
  CAST(0 AS BIGINT) AS non_numeric_rows,
  COUNT(*) FILTER (WHERE value IS NULL) AS scrubbed_null_rows
FROM t_r GROUP BY sensor_tag"""

ORACLES["quality_gate"] = with_ctes(T_R) + f"""SELECT line_id, equipment_key, sensor_tag, CAST(reading_ts_local AS DATE) AS reading_date,
  COUNT(*) AS readings,
  COUNT(*) FILTER (WHERE is_good_quality) AS good_readings,
  COUNT(*) FILTER (WHERE is_good_quality AND value IS NOT NULL) AS good_values,
  {rhu("CAST(SUM(CASE WHEN is_good_quality AND value IS NOT NULL THEN CAST(round(value * 100) AS BIGINT) END) AS DOUBLE) / NULLIF(CAST(COUNT(*) FILTER (WHERE is_good_quality AND value IS NOT NULL) * 100 AS DOUBLE), 0)", 4)} AS avg_good_value
FROM t_silver_r GROUP BY 1, 2, 3, 4"""

ORACLES["tag_range_rules"] = with_ctes(T_R, """rules AS (SELECT * FROM (VALUES
  ('view', 0.0, 400.0), ('click', 0.0, 400.0), ('signup', 0.0, 400.0), ('purchase', 0.0, 400.0),
  ('line_VIB_error', 0.0, 250.0)) t(sensor_tag, min_value, max_value))""") + """SELECT s.sensor_tag, COUNT(*) AS readings,
  COUNT(r.sensor_tag) AS with_rule,
  COUNT(*) FILTER (WHERE r.sensor_tag IS NOT NULL AND s.value IS NOT NULL
                   AND NOT (s.value BETWEEN r.min_value AND r.max_value)) AS out_of_range
FROM t_silver_r s LEFT JOIN rules r ON s.sensor_tag = r.sensor_tag GROUP BY 1"""

ORACLES["parse_multi_ts"] = with_ctes(T_R, T_RUNS, T_WO, """u AS (
  SELECT 'sensor_readings.timestamp' AS source_column, ts_format, reading_ts AS ts FROM t_r
  UNION ALL SELECT 'production_runs.start_time', 'ISO_NAKED', start_ts FROM t_runs
  UNION ALL SELECT 'production_runs.end_time', CASE WHEN end_ts IS NULL THEN 'EMPTY' ELSE 'ISO_UTC' END, end_ts FROM t_runs
  UNION ALL SELECT 'maintenance_logs.created_date', CASE WHEN l_partkey % 3 = 0 THEN 'US_SLASH' ELSE 'ISO_NAKED' END, created_ts FROM t_wo
  UNION ALL SELECT 'maintenance_logs.completed_date', CASE WHEN completed_ts IS NULL THEN 'EMPTY' ELSE 'ISO_UTC' END, completed_ts FROM t_wo
)""") + """SELECT source_column, ts_format, COUNT(*) AS raw_rows, COUNT(ts) AS parsed_rows,
       MIN(ts) AS min_ts, MAX(ts) AS max_ts
FROM u GROUP BY 1, 2"""

_VOL = """(CAST(total_units AS DOUBLE) * CAST(0.355 AS DOUBLE) / CAST(1000 AS DOUBLE))"""
_VOLG = f"""(CASE WHEN unit_sel >= 2 THEN {_VOL} / CAST(3.785 AS DOUBLE) ELSE {_VOL} END)"""
_FACT = """(CASE WHEN unit_sel >= 2 THEN CAST(3.785 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END)"""

ORACLES["silver_runs"] = with_ctes(T_RUNS) + f"""SELECT run_id, line_id, product_sku,
  'Drink ' || CAST(o_orderkey % 5 AS VARCHAR) || ' 355ml' AS product_name,
  start_ts, end_ts, start_ts_local,
  (CASE WHEN o_orderkey % 11 = 0 THEN {_VOLG} * CAST(1.2 AS DOUBLE) ELSE {_VOLG} END) * {_FACT} * CAST(1000 AS DOUBLE) AS actual_volume_l,
  {_VOLG} * {_FACT} * CAST(1000 AS DOUBLE) AS target_volume_l,
  run_status, total_units, good_units, scrap_units,
  CAST(o_orderkey % 20 + 80 AS DOUBLE) AS efficiency_pct,
  'OP-' || CAST(o_orderkey % 8 AS VARCHAR) AS operator_id
FROM t_runs"""

ORACLES["silver_work_orders"] = with_ctes(T_WO) + """SELECT work_order_id, equipment_key,
  CASE l_linenumber % 4 WHEN 0 THEN 'Preventive' WHEN 1 THEN 'PM' WHEN 2 THEN 'Corrective' ELSE 'Breakdown' END
    || ' service, part ' || CAST(l_partkey AS VARCHAR) AS description,
  work_order_status, priority, maintenance_type, planning_category, created_ts, created_ts_local,
  completed_ts, completed_ts_local, downtime_minutes, technician, parts_used
FROM t_wo"""

T_AL = f"""t_al AS (
  SELECT 'AL-' || CAST(event_id AS VARCHAR) AS alarm_id,
    date_trunc('second', ts) AS alarm_ts,
    CASE WHEN user_id % 12 = 11 THEN NULL
         WHEN user_id % 12 < 4 THEN 'EQP-' || CAST(101 + user_id % 12 AS VARCHAR)
         WHEN user_id % 12 < 8 THEN 'EQP-' || CAST(197 + user_id % 12 AS VARCHAR)
         ELSE 'EQP-' || CAST(293 + user_id % 12 AS VARCHAR) END AS equipment_key,
    'VIB_HIGH' AS alarm_tag, 'Vibration above limit' AS description,
    CASE event_id % 4 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' ELSE 'LOW' END AS severity_norm,
    CAST(event_id % 4 + 1 AS INTEGER) AS severity_rank,
    CASE event_id % 4 WHEN 0 THEN 'ACKNOWLEDGED' WHEN 1 THEN 'CLEARED' WHEN 2 THEN 'ACTIVE' ELSE 'SHELVED' END AS alarm_state,
    CASE WHEN event_id % 4 < 2 THEN 'OP-' || CAST(user_id % 6 AS VARCHAR) END AS acknowledged_by,
    CASE WHEN event_id % 4 < 2 THEN date_trunc('second', ts + to_minutes(CAST(event_id % 90 AS BIGINT))) END AS acknowledged_ts,
    CASE WHEN event_id % 4 = 2 THEN NULL ELSE CAST(event_id % 600 AS INTEGER) END AS duration_seconds,
    CAST(user_id % 3 + 1 AS INTEGER) AS line_id,
    event_id, user_id, ts
  FROM events WHERE event_type = 'error'
)"""

ORACLES["silver_alarms"] = with_ctes(T_AL) + """SELECT alarm_id, alarm_ts, equipment_key, alarm_tag, description,
  severity_norm, severity_rank, alarm_state, acknowledged_by, acknowledged_ts, duration_seconds, line_id
FROM t_al"""

ORACLES["silver_quality"] = with_ctes(T_QC) + """SELECT
  printf('QC-%010d-%08d-%02d-%012d-%03d-%03d', l_orderkey, l_suppkey, l_linenumber,
         CAST(round(l_extendedprice * 100) AS BIGINT), CAST(round(l_tax * 100) AS INTEGER),
         CAST(round(l_discount * 100) AS INTEGER)) AS check_id,
  batch_id, check_type, parameter, value, CAST(5 AS DOUBLE) AS lower_spec, CAST(45 AS DOUBLE) AS upper_spec,
  'units' AS unit, check_result, 'QA-' || CAST(l_partkey % 5 AS VARCHAR) AS checked_by,
  line_id, check_ts, check_ts_local, value BETWEEN 5 AND 45 AS in_spec
FROM t_qc"""

_REPORT = with_ctes(T_R, T_QC, """rep AS (
  SELECT 'sensor_readings' AS table_name, 'valid_timestamp' AS rule, 'drop' AS policy,
         COUNT(*) FILTER (WHERE reading_ts IS NULL) AS violations, COUNT(*) AS total_rows FROM t_r
  UNION ALL SELECT 'sensor_readings', 'known_equipment', 'drop', COUNT(*) FILTER (WHERE equipment_key IS NULL), COUNT(*) FROM t_r
  UNION ALL SELECT 'sensor_readings', 'value_present', 'warn', COUNT(*) FILTER (WHERE value IS NULL), COUNT(*) FROM t_r
  UNION ALL SELECT 'production_runs', 'valid_line', 'fail', 0, COUNT(*) FROM orders
  UNION ALL SELECT 'production_runs', 'unit_math_holds', 'warn', 0, COUNT(*) FROM orders
  UNION ALL SELECT 'maintenance_work_orders', 'known_asset', 'drop', 0, COUNT(*) FROM lineitem
  UNION ALL SELECT 'alarms', 'known_severity', 'drop', 0, COUNT(*) FROM events WHERE event_type = 'error'
  UNION ALL SELECT 'quality_checks', 'valid_line', 'fail', 0, COUNT(*) FROM t_qc
)""")

ORACLES["expectation_report"] = _REPORT + """SELECT table_name, rule, policy, CAST(violations AS BIGINT) AS violations,
  CAST(total_rows AS BIGINT) AS total_rows, (policy = 'fail' AND violations > 0) AS would_abort FROM rep"""

ORACLES["expectation_fail"] = _REPORT + """SELECT table_name, rule, CAST(violations AS BIGINT) AS violations,
  (violations > 0) AS would_abort FROM rep WHERE policy = 'fail'"""

# ------------------------------------------------------------------ SCD / change feeds
T_V = """t_v AS (
  SELECT 'EQP-' || CAST(o_custkey % 200 + 1000 AS VARCHAR) AS equipment_key,
         CAST(o_orderdate AS TIMESTAMP) AS change_ts, o_orderkey AS change_seq,
         o_orderpriority AS maintenance_class
  FROM orders
),
t_vl AS (
  SELECT *, LAG(maintenance_class) OVER w AS prev_class, ROW_NUMBER() OVER w AS rn
  FROM t_v WINDOW w AS (PARTITION BY equipment_key ORDER BY change_ts, change_seq)
),
t_vs AS (SELECT * FROM t_vl WHERE rn = 1 OR prev_class IS DISTINCT FROM maintenance_class),
t_dim0 AS (
  SELECT equipment_key, maintenance_class, change_ts AS valid_from,
         LEAD(change_ts) OVER (PARTITION BY equipment_key ORDER BY change_ts, change_seq) AS valid_to,
         change_seq AS version_seq
  FROM t_vs
),
t_dim AS (SELECT *, valid_to IS NULL AS is_current FROM t_dim0)"""

ORACLES["scd2_dim"] = with_ctes(T_V) + "SELECT * FROM t_dim"

ORACLES["scd2_asof_join"] = with_ctes(T_V, """f AS (
  SELECT l_orderkey, l_linenumber, 'EQP-' || CAST(l_suppkey % 200 + 1000 AS VARCHAR) AS equipment_key,
         CAST(l_shipdate AS TIMESTAMP) + INTERVAL 12 HOUR AS fact_ts
  FROM lineitem
)""") + """SELECT f.l_orderkey, f.l_linenumber, f.equipment_key, f.fact_ts, d.maintenance_class,
       d.valid_from AS version_valid_from
FROM f LEFT JOIN t_dim d ON f.equipment_key = d.equipment_key AND f.fact_ts >= d.valid_from
                         AND (f.fact_ts < d.valid_to OR d.valid_to IS NULL)"""

T_ACK = """t_ack AS (
  SELECT 'AL-' || CAST(e.event_id AS VARCHAR) AS alarm_id, s.change_seq,
         CASE WHEN s.change_seq = 3 THEN 'DELETE' ELSE 'UPSERT' END AS op,
         'OP-' || CAST((e.user_id + s.change_seq - 1) % 6 AS VARCHAR) AS acknowledged_by,
         e.ts + to_minutes(CAST(e.event_id % 90 AS BIGINT)) + to_minutes(CAST((s.change_seq - 1) * 5 AS BIGINT)) AS change_ts,
         'note ' || CAST(s.change_seq AS VARCHAR) AS note
  FROM events e, (VALUES (1), (2), (3)) s(change_seq)
  WHERE e.event_type = 'error' AND e.event_id % 4 < 2 AND (s.change_seq < 3 OR e.event_id % 5 = 0)
),
t_ack_cur AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY alarm_id ORDER BY change_seq DESC) AS rn FROM t_ack)
  WHERE rn = 1 AND op <> 'DELETE'
)"""

ORACLES["apply_changes"] = with_ctes(T_ACK) + "SELECT alarm_id, change_seq, op, acknowledged_by, change_ts, note FROM t_ack_cur"

ORACLES["unacked_alarms"] = with_ctes(T_AL, T_ACK) + """SELECT alarm_id, alarm_ts, equipment_key, severity_norm, alarm_state, line_id
FROM t_al WHERE alarm_id NOT IN (SELECT alarm_id FROM t_ack_cur)"""

# ------------------------------------------------------------------ intervals
T_DONE = """t_done AS (SELECT run_id, line_id, product_sku, start_ts, end_ts FROM t_runs WHERE run_status = 'COMPLETED')"""

ORACLES["overlap_adjacent"] = with_ctes(T_RUNS, T_DONE, """o AS (
  SELECT *, LAG(run_id) OVER w AS prev_run_id, LAG(end_ts) OVER w AS prev_end_ts
  FROM t_done WINDOW w AS (PARTITION BY line_id ORDER BY start_ts, run_id)
)""") + """SELECT line_id, run_id, prev_run_id, start_ts, prev_end_ts,
       CAST(date_sub('minute', start_ts, prev_end_ts) AS BIGINT) AS overlap_minutes
FROM o WHERE start_ts < prev_end_ts"""

ORACLES["overlap_pairs"] = with_ctes(T_RUNS, T_DONE) + """SELECT a.line_id, a.run_id AS run_id_a, b.run_id AS run_id_b,
       greatest(a.start_ts, b.start_ts) AS overlap_start, least(a.end_ts, b.end_ts) AS overlap_end,
       CAST(date_sub('minute', greatest(a.start_ts, b.start_ts), least(a.end_ts, b.end_ts)) AS BIGINT) AS overlap_minutes
FROM t_done a JOIN t_done b ON a.line_id = b.line_id AND a.run_id < b.run_id
                           AND a.start_ts < b.end_ts AND b.start_ts < a.end_ts"""

ORACLES["changeover_net"] = with_ctes(T_RUNS, T_WO, T_DONE, """o AS (
  SELECT *, LAG(product_sku) OVER w AS prev_sku, LAG(end_ts) OVER w AS prev_end
  FROM t_done WINDOW w AS (PARTITION BY line_id ORDER BY start_ts, run_id)
)""", """co AS (
  SELECT line_id, run_id, prev_sku AS from_product_sku, product_sku AS to_product_sku,
         prev_end AS changeover_start_ts, start_ts AS changeover_end_ts,
         CAST(date_sub('minute', prev_end, start_ts) AS BIGINT) AS changeover_minutes
  FROM o WHERE prev_sku IS NOT NULL AND product_sku <> prev_sku AND start_ts >= prev_end
)""", """dt AS (
  SELECT CAST(CASE WHEN l_suppkey % 11 < 4 THEN 1 WHEN l_suppkey % 11 < 8 THEN 2 ELSE 3 END AS INTEGER) AS line_id,
         created_ts AS s, created_ts + to_minutes(CAST(downtime_minutes AS BIGINT)) AS e
  FROM t_wo WHERE planning_category = 'UNPLANNED' AND downtime_minutes > 0
)""", """dw AS (
  SELECT *, MAX(e) OVER (PARTITION BY line_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm
  FROM dt
)""", """di AS (
  SELECT *, SUM(CASE WHEN pm IS NULL OR s > pm THEN 1 ELSE 0 END)
             OVER (PARTITION BY line_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS isl
  FROM dw
)""", """islands AS (SELECT line_id, MIN(s) AS s, MAX(e) AS e FROM di GROUP BY line_id, isl)""", """cov AS (
  SELECT co.line_id, co.run_id,
         SUM(date_sub('minute', greatest(co.changeover_start_ts, i.s), least(co.changeover_end_ts, i.e))) AS m
  FROM co JOIN islands i ON co.line_id = i.line_id AND i.s < co.changeover_end_ts AND co.changeover_start_ts < i.e
  GROUP BY 1, 2
)""") + """SELECT co.*, CAST(COALESCE(cov.m, 0) AS BIGINT) AS downtime_overlap_minutes,
       co.changeover_minutes - CAST(COALESCE(cov.m, 0) AS BIGINT) AS net_changeover_minutes
FROM co LEFT JOIN cov USING (line_id, run_id)"""

_CHECK_ID = """printf('QC-%010d-%08d-%02d-%012d-%03d-%03d', l_orderkey, l_suppkey, l_linenumber,
         CAST(round(l_extendedprice * 100) AS BIGINT), CAST(round(l_tax * 100) AS INTEGER),
         CAST(round(l_discount * 100) AS INTEGER))"""

T_B2R = f"""t_b2r AS (
  SELECT {_CHECK_ID} AS check_id, q.batch_id, q.line_id, q.check_ts,
         COUNT(c.run_id) AS match_count,
         CASE WHEN COUNT(c.run_id) = 1 THEN MIN(c.run_id) END AS matched_run_id
  FROM t_qc q LEFT JOIN t_done c ON q.line_id = c.line_id AND q.check_ts >= c.start_ts AND q.check_ts < c.end_ts
  GROUP BY 1, 2, 3, 4
)"""

ORACLES["batch_to_run"] = with_ctes(T_RUNS, T_DONE, T_QC, T_B2R) + "SELECT * FROM t_b2r"

ORACLES["q_fill_weight_matches"] = with_ctes(T_RUNS, T_DONE, T_QC, f"""n AS (
  SELECT {_CHECK_ID} AS check_id, q.parameter, COUNT(c.run_id) AS n
  FROM t_qc q LEFT JOIN t_done c ON q.line_id = c.line_id AND q.check_ts >= c.start_ts AND q.check_ts < c.end_ts
  GROUP BY 1, 2
)""") + """SELECT parameter, COUNT(*) AS checks, COUNT(*) FILTER (n = 1) AS matched_checks,
  COUNT(*) FILTER (n > 1) AS ambiguous_checks, COUNT(*) FILTER (n = 0) AS unmatched_checks
FROM n GROUP BY 1"""

# ------------------------------------------------------------------ designed marts
ORACLES["reliability_alltime"] = f"""SELECT equipment_key, equipment_name, line_id,
  CAST(SUM(unplanned_stop_count) AS BIGINT) AS unplanned_stop_count_all_time,
  COUNT(*) AS months_with_stops
FROM ({ORACLES['gold_reliability']}) r GROUP BY 1, 2, 3"""

ORACLES["alarm_summary"] = with_ctes(T_AL) + f"""SELECT line_id, CAST({local_of_utc('alarm_ts')} AS DATE) AS alarm_date,
  severity_norm, severity_rank, COUNT(*) AS alarms,
  COUNT(*) FILTER (WHERE acknowledged_ts IS NULL) AS unacknowledged,
  CAST(SUM(duration_seconds) AS BIGINT) AS total_duration_seconds,
  {rhu("CAST(SUM(date_sub('second', alarm_ts, acknowledged_ts)) AS DOUBLE) / NULLIF(CAST(COUNT(acknowledged_ts) AS DOUBLE), 0)", 1)} AS avg_ack_delay_seconds
FROM t_al GROUP BY 1, 2, 3, 4"""

ORACLES["tag_completeness"] = with_ctes(T_R, """ex AS (SELECT line_id, COUNT(DISTINCT sensor_tag) AS tags_expected FROM t_silver_r GROUP BY 1)""", """ac AS (
  SELECT line_id, date_trunc('hour', reading_ts) AS hour_start, COUNT(DISTINCT sensor_tag) AS n
  FROM t_silver_r GROUP BY 1, 2
)""", """hr AS (
  SELECT unnest(generate_series((SELECT MIN(hour_start) FROM ac), (SELECT MAX(hour_start) FROM ac), INTERVAL 1 HOUR)) AS hour_start
)""") + f"""SELECT ex.line_id, hr.hour_start, COALESCE(n, 0) AS tags_reporting, tags_expected,
  {rhu('CAST(COALESCE(n, 0) AS DOUBLE) / CAST(tags_expected AS DOUBLE)', 4)} AS completeness
FROM ex CROSS JOIN hr LEFT JOIN ac ON ac.line_id = ex.line_id AND ac.hour_start = hr.hour_start"""

ORACLES["ingest_lag"] = with_ctes(T_R, T_RUNS, T_WO, T_QC, T_AL, """u AS (
  SELECT 'sensor_readings' AS source, MAX(reading_ts) AS max_event_ts FROM t_silver_r
  UNION ALL SELECT 'production_runs', MAX(end_ts) FROM t_runs
  UNION ALL SELECT 'maintenance_work_orders', MAX(created_ts) FROM t_wo
  UNION ALL SELECT 'quality_checks', MAX(check_ts) FROM t_qc
  UNION ALL SELECT 'alarms', MAX(alarm_ts) FROM t_al
)""") + """SELECT source, max_event_ts, (SELECT MAX(max_event_ts) FROM u) AS as_of_ts,
  CAST(date_sub('minute', max_event_ts, (SELECT MAX(max_event_ts) FROM u)) AS BIGINT) AS lag_minutes
FROM u"""


def _score(kpi: str, op: str, target: float, mart_key: str) -> str:
    return f"""SELECT '{kpi}' AS kpi, '{op}' AS comparison, CAST({target} AS DOUBLE) AS target,
  COUNT({kpi}) AS rows_evaluated,
  COUNT(*) FILTER (WHERE CAST({kpi} AS DOUBLE) {op} {target}) AS rows_meeting
FROM ({ORACLES[mart_key]}) m"""


ORACLES["kpi_scorecard"] = "SELECT *, " + rhu(
    "CAST(rows_meeting AS DOUBLE) / NULLIF(CAST(rows_evaluated AS DOUBLE), 0)", 4) + " AS share_meeting FROM (\n" + \
    "\nUNION ALL\n".join([
        _score("oee", ">", 0.85, "gold_oee_daily"),
        _score("scrap_rate", "<", 0.02, "gold_scrap_rate"),
        _score("mtbf_hours", ">", 72.0, "gold_reliability"),
        _score("mttr_minutes", "<", 45.0, "gold_reliability"),
        _score("first_pass_yield", ">", 0.98, "gold_first_pass_yield"),
        _score("changeover_minutes", "<", 30.0, "gold_changeover"),
    ]) + "\n) s"

ORACLES["line_scope"] = f"""SELECT a.manager_group, o.line_id, o.production_date, o.oee
FROM ({ORACLES['gold_oee_daily']}) o
JOIN (VALUES ('line1_managers', 1), ('line2_managers', 2), ('line3_managers', 3),
             ('plant_managers', 1), ('plant_managers', 2), ('plant_managers', 3)) a(manager_group, line_id)
  ON o.line_id = a.line_id"""

# ------------------------------------------------------------------ pinned questions
ORACLES["q_line_oee"] = f"""WITH o AS ({ORACLES['gold_oee_daily']}),
ref AS (SELECT MAX(production_date) + 1 AS today FROM o),
tgt AS (SELECT CAST(today - CAST(((((dayofweek(today) + 1 - 3) % 7) + 7) % 7 + 7) AS INTEGER) AS DATE) AS d FROM ref)
SELECT o.* FROM o JOIN tgt ON o.production_date = tgt.d"""

ORACLES["q_unplanned_stops"] = f"""SELECT * FROM ({ORACLES['gold_reliability']}) r WHERE unplanned_stop_count > 3"""

ORACLES["q_param_scrap_corr"] = with_ctes(T_QC, f"""sc AS ({ORACLES['gold_scrap_rate']})""", """d AS (
  SELECT line_id, CAST(check_ts_local AS DATE) AS production_date, parameter, AVG(value) AS param_mean
  FROM t_qc GROUP BY 1, 2, 3
)""", f"""c AS (
  SELECT d.line_id, d.parameter, COUNT(*) AS days, {rhu('corr(d.param_mean, sc.scrap_rate)', 6)} AS corr
  FROM d JOIN sc ON d.line_id = sc.line_id AND d.production_date = sc.production_date
  GROUP BY 1, 2
)""") + """SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY line_id ORDER BY abs(corr) DESC NULLS LAST, parameter) AS INTEGER) AS corr_rank
FROM c"""

ORACLES["param_scrap_corr_quarters"] = with_ctes(T_QC, f"""sc AS ({ORACLES['gold_scrap_rate']})""") + f"""
SELECT q.line_id, q.parameter, CAST(date_trunc('quarter', sc.production_date) AS DATE) AS quarter_start, COUNT(*) AS checks,
  CASE WHEN COUNT(*) > 1 AND stddev_pop(q.value) > 0 AND stddev_pop(sc.scrap_rate) > 0
       THEN {rhu('corr(q.value, sc.scrap_rate)', 6)} END AS corr
FROM t_qc q JOIN sc ON q.line_id = sc.line_id AND CAST(q.check_ts_local AS DATE) = sc.production_date
WHERE q.value IS NOT NULL AND sc.scrap_rate IS NOT NULL
GROUP BY 1, 2, 3"""

ORACLES["q_fill_weight_trend"] = with_ctes(T_RUNS, T_DONE, T_QC, T_B2R, """m AS (
  SELECT r.product_sku, q.parameter, CAST(q.check_ts_local AS DATE) AS check_date, q.value
  FROM t_b2r b
  JOIN t_qc q ON b.check_id = printf('QC-%010d-%08d-%02d-%012d-%03d-%03d', q.l_orderkey, q.l_suppkey, q.l_linenumber,
         CAST(round(q.l_extendedprice * 100) AS BIGINT), CAST(round(q.l_tax * 100) AS INTEGER),
         CAST(round(q.l_discount * 100) AS INTEGER))
  JOIN t_runs r ON r.run_id = b.matched_run_id
  WHERE b.match_count = 1
)""", """dd AS (
  SELECT product_sku, parameter, check_date, COUNT(*) AS checks,
         SUM(CAST(round(value * 100) AS BIGINT)) AS cents
  FROM m GROUP BY 1, 2, 3
)""") + f"""SELECT product_sku, parameter, check_date, checks,
  {rhu('CAST(cents AS DOUBLE) / CAST(checks * 100 AS DOUBLE)', 4)} AS mean_value,
  {rhu('CAST(SUM(cents) OVER w AS DOUBLE) / CAST(SUM(checks) OVER w * 100 AS DOUBLE)', 4)} AS moving_mean_value
FROM dd
WINDOW w AS (PARTITION BY product_sku, parameter ORDER BY date_diff('day', DATE '1970-01-01', check_date)
             RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)"""

ORACLES["q_top_technician"] = f"""SELECT * FROM (
  SELECT *, CAST(RANK() OVER (PARTITION BY resolved_week ORDER BY critical_work_orders_resolved DESC) AS INTEGER) AS rank
  FROM ({ORACLES['gold_critical_work_orders']}) c
) WHERE rank <= 1"""

# ------------------------------------------------------------------ registry
T_REG = """t_reg0 AS (
  SELECT s_suppkey AS s,
    CASE s_suppkey % 3 WHEN 0 THEN 'EQ-' || CAST(s_suppkey + 1000 AS VARCHAR)
         WHEN 1 THEN 'EQUIP_' || CAST(s_suppkey + 1000 AS VARCHAR) ELSE CAST(s_suppkey + 1000 AS VARCHAR) END AS equipment_id,
    'EQP-' || CAST(s_suppkey + 1000 AS VARCHAR) AS equipment_key,
    CASE s_suppkey % 10 WHEN 0 THEN 'Filling Machine' WHEN 1 THEN 'Capping Machine' WHEN 2 THEN 'Labeler'
         WHEN 3 THEN 'Pasteurizer' WHEN 4 THEN 'Conveyor' WHEN 5 THEN 'Case Packer' WHEN 6 THEN 'Palletizer'
         WHEN 7 THEN 'Rinser' WHEN 8 THEN 'Cip Unit' ELSE 'Depalletizer' END AS equipment_type,
    CAST(s_suppkey % 3 + 1 AS INTEGER) AS line_id,
    CASE s_suppkey % 6 WHEN 3 THEN 'STOPPED' WHEN 4 THEN 'MAINTENANCE' WHEN 5 THEN 'DECOMMISSIONED'
         ELSE 'RUNNING' END AS equipment_operational_status,
    CASE s_suppkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS criticality,
    DATE '2000-01-01' + CAST((s_suppkey * 37) % 7000 AS INTEGER) AS inst,
    s_suppkey % 4 AS date_fmt
  FROM supplier
),
t_reg AS (
  SELECT *, (date_fmt = 3 AND day(inst) <= 12) AS install_date_ambiguous,
         CASE WHEN date_fmt = 3 AND day(inst) <= 12 THEN NULL ELSE inst END AS install_date,
         inst + CAST((s * 11) % 900 + 30 AS INTEGER) AS last_maintenance_date
  FROM t_reg0
)"""

ORACLES["registry_clean"] = with_ctes(T_REG) + """SELECT equipment_id, equipment_key, equipment_type, line_id,
  equipment_operational_status, criticality, install_date, install_date_ambiguous, last_maintenance_date
FROM t_reg"""

ORACLES["scd2_registry"] = with_ctes(T_REG, """ex AS (
  SELECT t_reg.* EXCLUDE (equipment_operational_status), CAST(k AS INTEGER) AS export_no,
         TIMESTAMP '2024-01-01' + to_days(CAST(90 * k AS INTEGER)) AS exported_ts,
         CASE (s + CASE WHEN k >= 1 AND s % 4 = 0 THEN 1 ELSE 0 END + CASE WHEN k >= 2 AND s % 5 = 0 THEN 1 ELSE 0 END) % 6
           WHEN 3 THEN 'STOPPED' WHEN 4 THEN 'MAINTENANCE' WHEN 5 THEN 'DECOMMISSIONED' ELSE 'RUNNING' END AS equipment_operational_status
  FROM t_reg, range(3) r(k)
),
st AS (
  SELECT *, LAG(equipment_operational_status) OVER (PARTITION BY equipment_key ORDER BY export_no) AS before FROM ex
),
vs AS (SELECT * FROM st WHERE before IS NULL OR before <> equipment_operational_status)""") + """SELECT equipment_key, equipment_id,
  equipment_type, line_id, equipment_operational_status, criticality, install_date, last_maintenance_date, exported_ts AS valid_from,
  LEAD(exported_ts) OVER w AS valid_to, export_no AS version_seq, LEAD(exported_ts) OVER w IS NULL AS is_current
FROM vs WINDOW w AS (PARTITION BY equipment_key ORDER BY export_no)"""
ORACLES["stream_scd2_registry"] = ORACLES["scd2_registry"]

ORACLES["specs_variant"] = with_ctes(T_REG) + """SELECT equipment_key,
  CASE s % 3 WHEN 0 THEN 'JSON' WHEN 1 THEN 'TEXT' ELSE 'NULL' END AS specs_kind,
  CASE WHEN s % 3 = 0 THEN CAST((s * 13) % 900 + 100 AS INTEGER) END AS speed_bpm,
  CASE WHEN s % 3 = 0 THEN CAST(s % 40 + 5 AS INTEGER) END AS power_kw,
  CASE WHEN s % 3 = 0 THEN '{"power_kw":' || CAST(s % 40 + 5 AS VARCHAR) || ',"speed_bpm":'
                          || CAST((s * 13) % 900 + 100 AS VARCHAR) || '}' END AS specs_json,
  CASE WHEN s % 3 = 1 THEN 'see manual rev ' || CAST(s % 9 AS VARCHAR) END AS specs_raw
FROM t_reg"""

ORACLES["parse_multi_date"] = with_ctes(T_REG) + """SELECT
  CASE date_fmt WHEN 0 THEN 'yyyy-MM-dd' WHEN 1 THEN 'dd-MMM-yyyy' WHEN 2 THEN 'yyyy/MM/dd' ELSE 'nn/nn/yyyy' END AS date_format,
  COUNT(*) AS raw_rows, COUNT(install_date) AS parsed_rows,
  COUNT(*) FILTER (WHERE install_date_ambiguous) AS ambiguous_rows,
  MIN(install_date) AS min_date, MAX(install_date) AS max_date
FROM t_reg GROUP BY 1"""

ORACLES["suffix_key"] = with_ctes(T_REG) + "SELECT equipment_id, equipment_key FROM t_reg"

# ------------------------------------------------------------------ runs checks
_ACTUAL_L = f"""((CASE WHEN o_orderkey % 11 = 0 THEN {_VOLG} * CAST(1.2 AS DOUBLE) ELSE {_VOLG} END) * {_FACT} * CAST(1000 AS DOUBLE))"""

ORACLES["volume_normalize"] = with_ctes(T_RUNS) + """SELECT
  CASE unit_sel WHEN 0 THEN 'liters' WHEN 1 THEN 'L' WHEN 2 THEN 'gal' ELSE 'gallons' END AS volume_unit,
  COUNT(*) AS runs, COUNT(*) AS runs_with_volume,
  CASE WHEN unit_sel >= 2 THEN CAST(3.785 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END AS unit_factor
FROM t_runs GROUP BY 1, 4"""

ORACLES["sku_size"] = with_ctes(T_RUNS) + """SELECT product_sku, 'Drink ' || CAST(o_orderkey % 5 AS VARCHAR) || ' 355ml' AS product_name,
  COUNT(*) AS runs, CAST(355 AS INTEGER) AS unit_size_ml
FROM t_runs GROUP BY 1, 2"""

ORACLES["volume_validate"] = with_ctes(T_RUNS, f"""v AS (
  SELECT run_id, {_ACTUAL_L} AS actual_volume_l,
         CAST(total_units * 355 AS DOUBLE) / CAST(1000.0 AS DOUBLE) AS expected_volume_l
  FROM t_runs WHERE run_status = 'COMPLETED'
)""") + f"""SELECT run_id, actual_volume_l, expected_volume_l,
  {rhu('abs(actual_volume_l / NULLIF(expected_volume_l, 0) - CAST(1.0 AS DOUBLE))', 6)} AS deviation,
  CASE WHEN abs(actual_volume_l / NULLIF(expected_volume_l, 0) - CAST(1.0 AS DOUBLE)) > 0.05 THEN 'QUARANTINE' ELSE 'OK' END AS volume_status
FROM v"""

ORACLES["check_unit_math"] = """SELECT COUNT(*) AS completed_runs, COUNT(*) AS checked_runs, CAST(0 AS BIGINT) AS violations
FROM orders WHERE o_orderstatus = 'F'"""

ORACLES["ts_local"] = with_ctes(T_RUNS) + "SELECT run_id, start_ts, start_ts_local FROM t_runs"

# ------------------------------------------------------------------ conformance
ORACLES["equipment_conform"] = with_ctes(T_R) + """SELECT equipment_id, equipment_key, COUNT(*) AS rows FROM t_r GROUP BY 1, 2"""

ORACLES["line_conform"] = with_ctes(T_R) + """SELECT 'sensor_readings' AS source, raw_line, line_id, COUNT(*) AS rows FROM t_r GROUP BY 2, 3
UNION ALL
SELECT 'quality_checks', CASE l.l_partkey % 4 WHEN 0 THEN CAST(l.l_suppkey % 3 + 1 AS VARCHAR)
         WHEN 1 THEN 'L' || CAST(l.l_suppkey % 3 + 1 AS VARCHAR) WHEN 2 THEN 'Line ' || CAST(l.l_suppkey % 3 + 1 AS VARCHAR)
         ELSE 'Line-' || CAST(l.l_suppkey % 3 + 1 AS VARCHAR) END,
       CAST(l.l_suppkey % 3 + 1 AS INTEGER), COUNT(*)
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 2, 3
UNION ALL
SELECT 'alarms_events', 'L' || CAST(user_id % 3 + 1 AS VARCHAR), CAST(user_id % 3 + 1 AS INTEGER), COUNT(*)
FROM events WHERE event_type = 'error' GROUP BY 2, 3"""

ORACLES["join_coverage"] = with_ctes(T_R, """wa AS (
  SELECT 'A-' || CAST(CASE WHEN l_suppkey % 11 < 4 THEN 101 + l_suppkey % 11
                           WHEN l_suppkey % 11 < 8 THEN 197 + l_suppkey % 11
                           ELSE 293 + l_suppkey % 11 END AS VARCHAR) AS asset_number
  FROM lineitem
)""") + """SELECT
  (SELECT COUNT(*) FROM wa JOIN (SELECT DISTINCT equipment_id FROM t_r) r ON wa.asset_number = r.equipment_id) AS naive_matches,
  (SELECT COUNT(DISTINCT asset_number) FROM wa) AS distinct_assets,
  (SELECT COUNT(DISTINCT asset_number) FROM wa) AS assets_resolved,
  (SELECT COUNT(DISTINCT equipment_id) FROM t_r) AS distinct_reading_ids,
  (SELECT COUNT(DISTINCT equipment_id) FROM t_r WHERE equipment_key IS NOT NULL) AS reading_ids_resolved"""

ORACLES["orphan_check"] = with_ctes(T_R) + """SELECT 'sensor_readings' AS source, equipment_id AS source_id, COUNT(*) AS rows
FROM t_r WHERE equipment_key IS NULL GROUP BY 2
UNION ALL
SELECT 'alarms_events', 'EQ-999', COUNT(*) FROM events WHERE event_type = 'error' AND user_id % 12 = 11
HAVING COUNT(*) > 0"""

ORACLES["check_qc_consistency"] = with_ctes(T_QC) + """SELECT line_id, COUNT(*) AS checks,
  COUNT(*) FILTER (WHERE check_result = 'PASS' AND value BETWEEN 5 AND 45) AS pass_in_spec,
  COUNT(*) FILTER (WHERE check_result <> 'PASS' AND NOT (value BETWEEN 5 AND 45)) AS not_pass_out_of_spec,
  COUNT(*) FILTER (WHERE (check_result = 'PASS') <> (value BETWEEN 5 AND 45)) AS contradictions
FROM t_qc GROUP BY 1"""

ORACLES["check_invariants"] = """SELECT 'completed_orders_have_completed_date' AS rule, COUNT(*) AS rows_checked, CAST(0 AS BIGINT) AS violations
FROM lineitem WHERE l_linestatus = 'F'
UNION ALL
SELECT 'cleared_alarms_acknowledged', COUNT(*), CAST(0 AS BIGINT) FROM events WHERE event_type = 'error' AND event_id % 4 = 1"""

ORACLES["status_contract"] = with_ctes(T_R, T_QC) + """SELECT 'sensor_readings' AS table_name, COUNT(*) AS rows, CAST(0 AS BIGINT) AS ambiguous_columns FROM t_silver_r
UNION ALL SELECT 'production_runs', COUNT(*), 0 FROM orders
UNION ALL SELECT 'maintenance_work_orders', COUNT(*), 0 FROM lineitem
UNION ALL SELECT 'alarms', COUNT(*), 0 FROM events WHERE event_type = 'error'
UNION ALL SELECT 'quality_checks', COUNT(*), 0 FROM t_qc"""

# ------------------------------------------------------------------ profiling
ORACLES["table_counts"] = with_ctes(T_R, T_QC, """c AS (
  SELECT 'sensor_readings' AS table_name, COUNT(*) AS rows FROM t_r
  UNION ALL SELECT 'production_runs', COUNT(*) FROM orders
  UNION ALL SELECT 'maintenance_logs', COUNT(*) FROM lineitem
  UNION ALL SELECT 'quality_checks', COUNT(*) FROM t_qc
  UNION ALL SELECT 'alarms_events', COUNT(*) FROM events WHERE event_type = 'error'
  UNION ALL SELECT 'equipment_registry', COUNT(*) FROM supplier
)""") + f"""SELECT table_name, rows, {rhu('CAST(rows AS DOUBLE) / CAST((SELECT SUM(rows) FROM c) AS DOUBLE)', 6)} AS share FROM c"""

ORACLES["value_counts"] = with_ctes(T_R) + """SELECT 'production_runs.status' AS source_column,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'RUNNING' WHEN 'P' THEN 'SCHEDULED' ELSE 'ON_HOLD' END AS value,
  COUNT(*) AS rows FROM orders GROUP BY 2
UNION ALL SELECT 'production_runs.volume_unit',
  CASE o_orderkey % 4 WHEN 0 THEN 'liters' WHEN 1 THEN 'L' WHEN 2 THEN 'gal' ELSE 'gallons' END, COUNT(*) FROM orders GROUP BY 2
UNION ALL SELECT 'maintenance_logs.type',
  CASE l_linenumber % 4 WHEN 0 THEN 'Preventive' WHEN 1 THEN 'PM' WHEN 2 THEN 'Corrective' ELSE 'Breakdown' END, COUNT(*) FROM lineitem GROUP BY 2
UNION ALL SELECT 'maintenance_logs.priority',
  CASE l_returnflag WHEN 'R' THEN 'Critical' WHEN 'A' THEN 'High' WHEN 'N' THEN 'Low' ELSE 'Medium' END, COUNT(*) FROM lineitem GROUP BY 2
UNION ALL SELECT 'maintenance_logs.status',
  CASE WHEN l_linestatus = 'F' THEN 'COMPLETED'
       ELSE CASE l_linenumber % 3 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'IN_PROGRESS' ELSE 'CANCELLED' END END, COUNT(*) FROM lineitem GROUP BY 2
UNION ALL SELECT 'alarms_events.severity',
  CASE event_id % 8 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '4' WHEN 4 THEN 'CRITICAL'
       WHEN 5 THEN 'HIGH' WHEN 6 THEN 'MEDIUM' ELSE 'LOW' END, COUNT(*) FROM events WHERE event_type = 'error' GROUP BY 2
UNION ALL SELECT 'alarms_events.status',
  CASE event_id % 4 WHEN 0 THEN 'ACKNOWLEDGED' WHEN 1 THEN 'CLEARED' WHEN 2 THEN 'ACTIVE' ELSE 'SHELVED' END,
  COUNT(*) FROM events WHERE event_type = 'error' GROUP BY 2
UNION ALL SELECT 'sensor_readings.quality', quality, COUNT(*) FROM t_r GROUP BY 2"""

_IDS = """CASE WHEN {c} LIKE 'EQ-%' THEN 'EQ-nnn' WHEN {c} LIKE 'EQUIP_%' THEN 'EQUIP_nnn' ELSE 'nnn' END"""

ORACLES["format_profile"] = with_ctes(T_R, T_REG) + f"""SELECT 'sensor_readings.timestamp' AS source_column, ts_format AS format, COUNT(*) AS rows FROM t_r GROUP BY 2
UNION ALL SELECT 'sensor_readings.equipment_id', {_IDS.format(c='equipment_id')}, COUNT(*) FROM t_r GROUP BY 2
UNION ALL SELECT 'maintenance_logs.created_date', CASE WHEN l_partkey % 3 = 0 THEN 'US_SLASH' ELSE 'ISO_NAKED' END,
  COUNT(*) FROM lineitem GROUP BY 2
UNION ALL SELECT 'equipment_registry.install_date',
  CASE date_fmt WHEN 0 THEN 'yyyy-MM-dd' WHEN 1 THEN 'dd-MMM-yyyy' WHEN 2 THEN 'yyyy/MM/dd' ELSE 'nn/nn/yyyy' END,
  COUNT(*) FROM t_reg GROUP BY 2
UNION ALL SELECT 'equipment_registry.equipment_id', {_IDS.format(c='equipment_id')}, COUNT(*) FROM t_reg GROUP BY 2"""

ORACLES["id_scheme_examples"] = with_ctes(T_R) + f"""SELECT {_IDS.format(c='equipment_id')} AS id_scheme, equipment_id AS id,
  COUNT(*) AS "rows" FROM t_r GROUP BY 1, 2"""

ORACLES["distinct_domain"] = with_ctes(T_R, T_QC) + """SELECT 'sensor_readings.equipment_id' AS source_column, COUNT(DISTINCT equipment_id) AS distinct_values FROM t_r
UNION ALL SELECT 'sensor_readings.sensor_tag', COUNT(DISTINCT sensor_tag) FROM t_r
UNION ALL SELECT 'maintenance_logs.asset_number', COUNT(DISTINCT l_suppkey % 11) FROM lineitem
UNION ALL SELECT 'maintenance_logs.technician', COUNT(DISTINCT l_suppkey % 6) FROM lineitem
UNION ALL SELECT 'quality_checks.batch_id', COUNT(DISTINCT batch_id) FROM t_qc
UNION ALL SELECT 'quality_checks.parameter', COUNT(DISTINCT parameter) FROM t_qc"""

ORACLES["dup_keys"] = with_ctes(T_R) + """SELECT raw_timestamp AS "timestamp", equipment_id, sensor_tag, COUNT(*) AS copies
FROM t_r GROUP BY 1, 2, 3 HAVING COUNT(*) > 1"""

ORACLES["preview_limit"] = f"""SELECT * FROM ({ORACLES['quarantine_readings']}) q
ORDER BY "timestamp" NULLS FIRST, equipment_id NULLS FIRST, sensor_tag NULLS FIRST, quality NULLS FIRST,
         status NULLS FIRST, line_id NULLS FIRST, reading_ts NULLS FIRST, equipment_key NULLS FIRST,
         quarantine_reason NULLS FIRST
LIMIT 20"""

# ------------------------------------------------------------------ streaming / bronze
ORACLES["bronze_ingest"] = with_ctes(T_R, T_QC) + """SELECT 'sensor_readings' AS table_name, COUNT(*) AS rows, CAST(0 AS BIGINT) AS rescued_rows FROM t_r
UNION ALL SELECT 'production_runs', COUNT(*), 0 FROM orders
UNION ALL SELECT 'maintenance_logs', COUNT(*), 0 FROM lineitem
UNION ALL SELECT 'quality_checks', COUNT(*), 0 FROM t_qc
UNION ALL SELECT 'alarms_events', COUNT(*), 0 FROM events WHERE event_type = 'error'"""

ORACLES["bronze_json_ingest"] = with_ctes(T_REG, """rr AS (
  SELECT r.*, CASE s % 10 WHEN 0 THEN 'Filling Machine' WHEN 1 THEN 'Capping Machine' WHEN 2 THEN 'Labeler'
         WHEN 3 THEN 'Pasteurizer' WHEN 4 THEN 'Conveyor' WHEN 5 THEN 'Case Packer' WHEN 6 THEN 'Palletizer'
         WHEN 7 THEN 'Rinser' WHEN 8 THEN 'CIP Unit' ELSE 'Depalletizer' END AS t
  FROM t_reg r
)""") + """SELECT equipment_id, t || ' ' || CAST(s + 1000 AS VARCHAR) AS name,
  CASE s % 7 WHEN 0 THEN upper(t) WHEN 1 THEN lower(t) ELSE t END AS type,
  CASE WHEN s % 2 = 0 THEN 'Line ' || CAST(line_id AS VARCHAR) ELSE CAST(line_id AS VARCHAR) END AS line,
  equipment_operational_status AS status,
  CASE s % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'c' END AS criticality,
  CASE date_fmt WHEN 0 THEN strftime(inst, '%Y-%m-%d') WHEN 1 THEN upper(strftime(inst, '%d-%b-%Y'))
       WHEN 2 THEN strftime(inst, '%Y/%m/%d') ELSE strftime(inst, '%d/%m/%Y') END AS install_date,
  CASE WHEN s % 2 = 0 THEN strftime(last_maintenance_date, '%Y-%m-%d')
       ELSE strftime(last_maintenance_date, '%d-%b-%Y') END AS last_maintenance,
  CASE s % 3 WHEN 0 THEN '{"speed_bpm": ' || CAST((s * 13) % 900 + 100 AS VARCHAR) || ', "power_kw": '
                        || CAST(s % 40 + 5 AS VARCHAR) || '}'
             WHEN 1 THEN 'see manual rev ' || CAST(s % 9 AS VARCHAR) END AS specs
FROM rr"""

ORACLES["bronze_rescue"] = with_ctes(T_R) + """SELECT COUNT(*) AS rows,
  COUNT(*) FILTER (WHERE event_id % 89 = 0 OR event_id % 83 = 0) AS rescued_rows,
  COUNT(*) FILTER (WHERE event_id % 89 = 0) AS too_many_fields
FROM t_r"""

ORACLES["bronze_json_batch"] = ORACLES["bronze_json_ingest"]

ORACLES["bronze_rescue_json"] = """WITH r AS (
  SELECT s_suppkey AS s, CAST(s_suppkey % 900 AS VARCHAR) || CASE WHEN s_suppkey % 5 = 2 THEN '.5' ELSE '' END AS bpm,
         CASE WHEN s_suppkey % 9 = 0 THEN CAST(s_suppkey % 3 AS VARCHAR) END AS hall,
         CASE WHEN s_suppkey % 7 = 0 THEN 'rev ' || CAST(s_suppkey AS VARCHAR) END AS note
  FROM supplier
)
SELECT CASE WHEN s % 13 > 0 THEN 'EQ-' || CAST(s AS VARCHAR) END AS equipment_id,
       CASE WHEN s % 13 > 0 AND s % 5 NOT IN (1, 2) THEN CAST(bpm AS INTEGER) END AS rated_bpm,
       CASE WHEN s % 13 = 0 THEN
              CAST(to_json({'_record': concat_ws(', ', '{"equipment_id": "EQ-' || CAST(s AS VARCHAR) || '"',
                '"rated_bpm": ' || CASE WHEN s % 5 = 1 THEN '"n/a"' ELSE bpm END,
                '"vendor_note": "' || note || '"', '"geo": {"hall": ' || hall || '}')}) AS VARCHAR)
            WHEN s % 5 IN (1, 2) OR s % 7 = 0 OR s % 9 = 0 THEN
              '{' || concat_ws(',', '"geo":{"hall":' || hall || '}',
                CASE s % 5 WHEN 1 THEN '"rated_bpm":"n/a"' WHEN 2 THEN '"rated_bpm":' || bpm END,
                '"vendor_note":"' || note || '"') || '}' END AS rescued
FROM r"""

ORACLES["bronze_rescue_csv"] = with_ctes(T_R) + """SELECT
  NULLIF(concat_ws(';', CASE WHEN event_id % 89 = 0 THEN '_c7' WHEN event_id % 83 = 0 THEN '_fields' END,
                   CASE WHEN event_id % 71 = 0 THEN 'value' END), '') AS rescued_fields,
  COUNT(*) AS rows,
  COUNT(*) FILTER (WHERE event_id % 71 <> 0 AND (event_id % 53 = 0 OR event_id % 41 <> 0)) AS values_read,
  COUNT(*) AS tags_read
FROM t_r GROUP BY 1"""

# the drop a reading arrives in, and whether it is behind the mark of the drops before by over 6 h
T_DROPS = """t_drop AS (
  SELECT t_acc.*, least(2, (epoch_us(ts) // 1000000 - lo) * 3 // (hi - lo + 1) + CASE WHEN event_id % 61 = 0 THEN 1 ELSE 0 END) AS drop_no
  FROM t_acc, (SELECT MIN(epoch_us(ts) // 1000000) AS lo, MAX(epoch_us(ts) // 1000000) AS hi FROM events) r
),
t_mark AS (SELECT drop_no, MAX(reading_ts) AS mark FROM t_drop GROUP BY drop_no),
t_arrived AS (
  SELECT d.*, coalesce(reading_ts < (SELECT MAX(mark) FROM t_mark m WHERE m.drop_no < d.drop_no) - INTERVAL 6 HOUR, FALSE) AS late
  FROM t_drop d
)"""
ORACLES["stream_silver_readings"] = with_ctes(T_R, T_DROPS) + f"""SELECT reading_ts, {local_of_utc('reading_ts')} AS reading_ts_local,
  equipment_key, sensor_tag, value, opc_quality_code, reading_quality_status, opc_quality_code = 192 AS is_good_quality, line_id
FROM t_drop QUALIFY ROW_NUMBER() OVER (PARTITION BY reading_ts, equipment_key, sensor_tag
  ORDER BY opc_quality_code DESC, drop_no DESC, value DESC NULLS LAST, line_id DESC) = 1"""
ORACLES["stream_dedupe"] = with_ctes(T_R, T_DROPS) + """SELECT DISTINCT reading_ts, equipment_key, sensor_tag
FROM t_arrived WHERE NOT late"""
ORACLES["stream_balance"] = with_ctes(T_R, T_DROPS) + """SELECT input_rows, accepted_rows, quarantined_rows, late_rows,
  input_rows - accepted_rows - quarantined_rows - late_rows AS duplicate_rows, TRUE AS balanced
FROM (SELECT (SELECT COUNT(*) FROM t_r) AS input_rows,
  (SELECT COUNT(*) FROM (SELECT DISTINCT reading_ts, equipment_key, sensor_tag FROM t_arrived WHERE NOT late)) AS accepted_rows,
  (SELECT COUNT(*) FROM t_r WHERE reading_ts IS NULL OR equipment_key IS NULL) AS quarantined_rows,
  (SELECT COUNT(*) FROM t_arrived WHERE late) AS late_rows) c"""
# Spark compares with the watermark in milliseconds, and takes a row at the watermark for late
T_WATERMARK = """t_wm AS (
  SELECT d.*, coalesce(reading_ts <= (SELECT date_trunc('millisecond', MAX(mark)) FROM t_mark m WHERE m.drop_no < d.drop_no) - INTERVAL 6 HOUR, FALSE) AS behind
  FROM t_drop d
),
t_passed AS (SELECT DISTINCT reading_ts, equipment_key, sensor_tag FROM t_wm WHERE NOT behind)"""
ORACLES["stream_watermark_dedupe"] = with_ctes(T_R, T_DROPS, T_WATERMARK) + "SELECT * FROM t_passed"
ORACLES["stream_watermark_balance"] = with_ctes(T_R, T_DROPS, T_WATERMARK, """c AS (
  SELECT (SELECT COUNT(*) FROM t_r) AS input_rows,
    (SELECT COUNT(*) FROM t_r WHERE reading_ts IS NULL OR equipment_key IS NULL) AS quarantined_rows,
    (SELECT COUNT(*) FROM t_wm ANTI JOIN t_passed USING (reading_ts, equipment_key, sensor_tag)) AS late_rows,
    (SELECT COUNT(*) FROM t_passed) AS accepted_rows,
    (SELECT COUNT(*) FROM t_passed WHERE reading_ts > (SELECT date_trunc('millisecond', MAX(mark)) FROM t_mark) - INTERVAL 6 HOUR) AS state_keys
)""") + "SELECT *, input_rows - quarantined_rows - late_rows - accepted_rows AS duplicate_rows FROM c"
ORACLES["stream_unacked_alarms"] = with_ctes(T_AL, T_ACK) + """SELECT alarm_id, alarm_ts, equipment_key, severity_norm, alarm_state, line_id
FROM t_al a WHERE NOT EXISTS (
  SELECT 1 FROM t_ack k WHERE k.alarm_id = a.alarm_id AND k.op = 'UPSERT'
    AND k.change_ts >= a.alarm_ts AND k.change_ts <= a.alarm_ts + INTERVAL 30 MINUTE)"""
ORACLES["gold_refresh_late"] = ORACLES["gold_oee_daily"]

ORACLES["vibration_batch"] = """WITH m AS (
  SELECT 'VIB-' || CAST(user_id % 100 AS VARCHAR) AS sensor_id,
         date_trunc('millisecond', ts) + to_milliseconds(b.k * 250) AS event_ts,
         CASE WHEN b.k = 11 AND event_id % 5 = 0 THEN 60.0::DOUBLE ELSE CAST(event_id % 17 - 8 AS DOUBLE) END AS x,
         CAST(event_id % 13 - 6 AS DOUBLE) AS y, CAST(event_id % 11 - 5 AS DOUBLE) AS z
  FROM events, range(12) b(k)
),
w AS (
  SELECT sensor_id, x * x + y * y + z * z AS m2,
         make_timestamp((epoch_us(event_ts) // 10000000) * 10000000 - k * 10000000) AS window_start
  FROM m, range(6) r(k)
),
g AS (
  SELECT sensor_id, window_start, COUNT(*) AS n, MAX(m2) AS max_m2, SUM(m2) AS s1, SUM(m2 * m2) AS s2
  FROM w GROUP BY 1, 2
),
st AS (
  SELECT *, s1 / CAST(n AS DOUBLE) AS mean,
         sqrt(greatest((s2 - (s1 * s1) / CAST(n AS DOUBLE)) / NULLIF(CAST(n AS DOUBLE) - 1.0, 0), 0.0)) AS sd
  FROM g
)
SELECT sensor_id, window_start, window_start + INTERVAL 60 SECOND AS window_end, n, max_m2,
       """ + rhu("mean", 6) + """ AS mean_m2, """ + rhu("sd", 6) + """ AS sd_m2,
       COALESCE(max_m2 > mean + 3.0 * sd, FALSE) AS alert
FROM st"""

ORACLES["bronze_all_string"] = with_ctes(T_WO) + f"""SELECT work_order_id,
  'A-' || CAST(CASE WHEN l_suppkey % 11 < 4 THEN 101 + l_suppkey % 11 WHEN l_suppkey % 11 < 8 THEN 197 + l_suppkey % 11
                    ELSE 293 + l_suppkey % 11 END AS VARCHAR) AS asset_number,
  CASE l_linenumber % 4 WHEN 0 THEN 'Preventive' WHEN 1 THEN 'PM' WHEN 2 THEN 'Corrective' ELSE 'Breakdown' END
    || ' service, part ' || CAST(l_partkey AS VARCHAR) AS description,
  work_order_status AS status, priority,
  CASE l_linenumber % 4 WHEN 0 THEN 'Preventive' WHEN 1 THEN 'PM' WHEN 2 THEN 'Corrective' ELSE 'Breakdown' END AS type,
  CASE WHEN l_partkey % 3 = 0 THEN strftime(created_ts_local, '%m/%d/%Y %H:%M')
       ELSE strftime(created_ts_local, '%Y-%m-%d %H:%M:%S') END AS created_date,
  CASE WHEN completed_ts IS NOT NULL THEN strftime(completed_ts, '%Y-%m-%dT%H:%M:%SZ') END AS completed_date,
  CAST(downtime_minutes AS VARCHAR) AS downtime_minutes, technician, parts_used
FROM t_wo"""

# ------------------------------------------------------------------ seeds
ORACLES["seed_load"] = with_ctes(T_R, T_QC) + """SELECT 'equipment_xref' AS table_name, CAST(30 AS BIGINT) AS rows_loaded, 'LOADED' AS status,
  CAST(0 AS BIGINT) AS duplicate_keys,
  CAST((SELECT COUNT(*) FROM t_r) + (SELECT COUNT(*) FROM events WHERE event_type = 'error')
       + (SELECT COUNT(*) FROM lineitem) AS BIGINT) AS fact_rows_checked,
  CAST((SELECT COUNT(*) FROM t_r WHERE user_id % 12 <> 11)
       + (SELECT COUNT(*) FROM events WHERE event_type = 'error' AND user_id % 12 <> 11)
       + (SELECT COUNT(*) FROM lineitem) AS BIGINT) AS fact_rows_resolved
UNION ALL
SELECT 'line_xref', 12, 'LOADED', 0,
  (SELECT COUNT(*) FROM t_r) + (SELECT COUNT(*) FROM events WHERE event_type = 'error') + (SELECT COUNT(*) FROM t_qc)
    + (SELECT COUNT(*) FROM orders),
  (SELECT COUNT(*) FROM t_r) + (SELECT COUNT(*) FROM events WHERE event_type = 'error') + (SELECT COUNT(*) FROM t_qc)
    + (SELECT COUNT(*) FROM orders)
UNION ALL
SELECT 'alarm_severity_xref', 8, 'LOADED', 0, (SELECT COUNT(*) FROM events WHERE event_type = 'error'),
  (SELECT COUNT(*) FROM events WHERE event_type = 'error')
UNION ALL
SELECT 'wo_type_xref', 4, 'LOADED', 0, (SELECT COUNT(*) FROM lineitem), (SELECT COUNT(*) FROM lineitem)"""
ORACLES["stream_scd2"] = ORACLES["scd2_dim"]

ORACLES["seed_key_check"] = with_ctes(T_R, T_QC) + """SELECT 'equipment_xref' AS table_name, 'equipment_key; source_equipment_id; sap_asset_number' AS key_columns,
  CAST(30 AS BIGINT) AS seed_rows, CAST(0 AS BIGINT) AS duplicate_keys,
  CAST((SELECT COUNT(*) FROM t_r) + (SELECT COUNT(*) FROM lineitem) AS BIGINT) AS fact_rows_in,
  CAST((SELECT COUNT(*) FROM t_r) + (SELECT COUNT(*) FROM lineitem) AS BIGINT) AS fact_rows_out,
  FALSE AS multiplies_facts
UNION ALL SELECT 'line_xref', 'source_line_value', 12, 0,
  (SELECT COUNT(*) FROM t_r) + (SELECT COUNT(*) FROM t_qc), (SELECT COUNT(*) FROM t_r) + (SELECT COUNT(*) FROM t_qc), FALSE
UNION ALL SELECT 'alarm_severity_xref', 'source_severity', 8, 0,
  (SELECT COUNT(*) FROM events WHERE event_type = 'error'), (SELECT COUNT(*) FROM events WHERE event_type = 'error'), FALSE
UNION ALL SELECT 'wo_type_xref', 'source_type', 4, 0, (SELECT COUNT(*) FROM lineitem), (SELECT COUNT(*) FROM lineitem), FALSE"""

ORACLES["stream_silver_runs"] = ORACLES["silver_runs"]
ORACLES["stream_silver_work_orders"] = ORACLES["silver_work_orders"]
ORACLES["stream_silver_alarms"] = ORACLES["silver_alarms"]
ORACLES["stream_silver_quality"] = ORACLES["silver_quality"]
ORACLES["stream_expectation_metrics"] = _REPORT + """SELECT table_name, rule, policy, CAST(violations AS BIGINT) AS violations,
  CAST(total_rows AS BIGINT) AS total_rows FROM rep WHERE table_name = 'sensor_readings'"""

ORACLES["vibration_windows"] = ORACLES["vibration_batch"]
