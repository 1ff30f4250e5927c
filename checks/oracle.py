"""DuckDB twins of the registered queries.

Written separately from the Spark code: the as-of match is an ``ASOF JOIN``, order-dependent
operators are plain window functions, and aggregates run straight over the joined tables.
``PIECES`` are named subqueries; a query is prefixed with those it uses.
"""

from __future__ import annotations

import re

PIECES: dict[str, str] = {}

PIECES["f_trips"] = """
  SELECT trip_id, vehicle_id, driver_id, route_id,
    s - to_hours(trip_id % 96) AS scheduled_start_time,
    e - to_hours((trip_id * 11) % 120 - 24) AS scheduled_end_time,
    s AS actual_start_time, e AS actual_end_time
  FROM (SELECT *, s + to_minutes(1440 + (trip_id * 257) % 5820) AS e FROM (
    SELECT trip_id, cust // 10 AS vehicle_id, cust // 14 AS driver_id, (trip_id * 7) % 600 AS route_id,
      TIMESTAMP '2024-01-01' + to_minutes((trip_id * 7919) % 180 * 240 + (cust // 10) % 240) AS s
    FROM (SELECT o_orderkey // 20 AS trip_id, arg_min(o_custkey, o_orderkey) AS cust
          FROM orders GROUP BY 1)))"""

PIECES["f_vehicles"] = """
  SELECT vehicle_id, model, CAST(members * 150 AS DOUBLE) AS payload_capacity,
    CAST(vehicle_id % 16 + 70 AS DOUBLE) AS tank_capacity_l,
    CASE WHEN vehicle_id % 4 = 0 THEN 'Petrol' ELSE 'Diesel' END AS fuel_type,
    abs(balance) * 40 AS current_mileage
  FROM (SELECT c_custkey // 10 AS vehicle_id, arg_min(c_mktsegment, c_custkey) AS model,
          arg_min(c_acctbal, c_custkey) AS balance, count(*) AS members FROM customer GROUP BY 1)"""

PIECES["f_drivers"] = """
  SELECT s_suppkey AS driver_id, 'F' || (s_suppkey % 7) AS first_name, 'L' || (s_suppkey % 5) AS last_name,
    'C' || (s_suppkey % 3) AS license_class, '0' || (s_suppkey + 1000000000) AS phone_number FROM supplier"""

PIECES["f_cargo"] = """
  SELECT p_partkey AS cargo_id, kind AS cargo_type,
    CAST(CASE kind WHEN 'Controlled ambient' THEN 15 WHEN 'Chilled' THEN 8 WHEN 'Frozen' THEN -18
      WHEN 'Pharmaceutical' THEN 8 WHEN 'Deep frozen' THEN -40 ELSE 25 END AS DOUBLE) AS max_temp,
    CAST(CASE kind WHEN 'Controlled ambient' THEN 8 WHEN 'Chilled' THEN 0 WHEN 'Frozen' THEN -100
      WHEN 'Pharmaceutical' THEN 2 WHEN 'Deep frozen' THEN -1000 ELSE 0 END AS DOUBLE) AS min_temp,
    CAST(p_size * 3 AS DOUBLE) / CAST(10 AS DOUBLE) AS weight_kg, p_retailprice AS price_egp
  FROM (SELECT *, CASE p_partkey % 6 WHEN 0 THEN 'Controlled ambient' WHEN 1 THEN 'Chilled'
      WHEN 2 THEN 'Frozen' WHEN 3 THEN 'Pharmaceutical' WHEN 4 THEN 'Deep frozen' ELSE 'Other' END AS kind
    FROM part)"""

PIECES["f_depots"] = """
  SELECT CAST(n_nationkey AS BIGINT) AS depot_id, n_name || ', Dock ' || n_nationkey AS address,
    r_name AS governorate,
    CAST(n_nationkey * 4 AS DOUBLE) / CAST(10 AS DOUBLE) + CAST(22 AS DOUBLE) AS lat,
    CAST((n_nationkey * 7) % 25 AS DOUBLE) / CAST(2 AS DOUBLE) + CAST(25 AS DOUBLE) AS lon
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""

PIECES["f_route_pairs"] = """
  SELECT route_id, o AS origin_depot_id, k + CASE WHEN k >= o THEN 1 ELSE 0 END AS destination_depot_id
  FROM (SELECT DISTINCT route_id, route_id // 24 AS o, route_id % 24 AS k FROM f_trips)"""

PIECES["f_routes"] = """
  SELECT r.route_id, r.origin_depot_id, o.address AS origin_address, o.governorate AS origin_governorate,
    o.lat AS origin_lat, o.lon AS origin_lon, r.destination_depot_id, d.address AS destination_address,
    d.governorate AS destination_governorate, d.lat AS destination_lat, d.lon AS destination_lon
  FROM f_route_pairs r LEFT JOIN f_depots o ON o.depot_id = r.origin_depot_id
  LEFT JOIN f_depots d ON d.depot_id = r.destination_depot_id"""

PIECES["f_trip_cargo"] = """
  SELECT t + CASE WHEN t % 40 = 7 THEN 1 ELSE 0 END AS trip_id,
    CASE WHEN t % 4 = 1 THEN l_partkey ELSE l_partkey - l_partkey % 6 + t % 6 END AS cargo_id,
    CASE WHEN l_linestatus = 'O' THEN 'In Transit' WHEN l_returnflag = 'R' THEN 'Loaded'
      ELSE 'Delivered' END AS load_status
  FROM (SELECT *, l_orderkey // 20 AS t FROM lineitem)"""

PIECES["f_events"] = """
  SELECT *, user_id AS vehicle_id, 'S' || event_id AS sensor_id,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""

PIECES["f_quick"] = """
  SELECT vehicle_id, sensor_id, ts, CAST(k AS DOUBLE) / CAST(10 AS DOUBLE) + CAST(22 AS DOUBLE) AS lat,
    CAST(event_id % 100 AS DOUBLE) / CAST(10 AS DOUBLE) + CAST(25 AS DOUBLE) AS lon,
    CAST(date_diff('second', TIMESTAMP '2024-01-01', ts) * 10 // 9 AS DOUBLE) / CAST(100 AS DOUBLE) AS odometer_km,
    value * CAST(40 AS DOUBLE) + CAST(1000 AS DOUBLE) AS rpm, CAST(k AS DOUBLE) AS throttle_pct,
    value / CAST(100 AS DOUBLE) AS accel_ay_abs,
    CAST(1400 - k * 3 AS DOUBLE) / CAST(100 AS DOUBLE) AS battery_v
  FROM f_events WHERE event_type IN ('click', 'view', 'error')"""

PIECES["f_slow"] = """
  SELECT vehicle_id, sensor_id, ts, value AS fuel_amount_l,
    CAST(CASE WHEN k % 10 = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_door_open,
    value / CAST(10 AS DOUBLE) AS cargo_temp_c
  FROM f_events WHERE event_type IN ('purchase', 'signup')"""

# ---- raw tables ----

PIECES["r_vehicles"] = """
  SELECT CAST(vehicle_id AS VARCHAR) AS vehicle_id,
    '  ' || model || CASE WHEN cp = 1 THEN ' II ' ELSE ' ' END AS model,
    CAST(payload_capacity AS VARCHAR) AS payload_capacity, CAST(tank_capacity_l AS VARCHAR) AS tank_capacity_l,
    fuel_type, CASE WHEN vehicle_id % 7 = 0 THEN 'n/a' ELSE CAST(current_mileage AS VARCHAR) END AS current_mileage
  FROM f_vehicles, (VALUES (0), (1)) x(cp) WHERE cp = 0 OR vehicle_id % 5 = 0"""

PIECES["r_drivers"] = """
  SELECT CAST(driver_id AS VARCHAR) AS driver_id, ' ' || first_name AS first_name, last_name || '  ' AS last_name,
    CASE WHEN cp = 1 THEN NULL ELSE license_class END AS license_class, phone_number
  FROM f_drivers, (VALUES (0), (1)) x(cp) WHERE cp = 0 OR driver_id % 6 = 0"""

PIECES["r_cargo"] = """
  SELECT CAST(cargo_id AS VARCHAR) AS cargo_id, ' ' || cargo_type AS cargo_type,
    CAST(max_temp AS VARCHAR) AS max_temp, CAST(min_temp AS VARCHAR) AS min_temp,
    CASE WHEN cargo_id % 50 = 3 THEN 'heavy' ELSE CAST(weight_kg AS VARCHAR) END AS weight_kg,
    CAST(price_egp AS VARCHAR) AS price_egp
  FROM f_cargo, (VALUES (0), (1)) x(cp) WHERE cp = 0 OR cargo_id % 8 = 0"""

PIECES["r_trips"] = """
  SELECT CAST(trip_id AS VARCHAR) AS trip_id,
    CASE WHEN trip_id % 37 = 5 THEN 'x' ELSE CAST(vehicle_id AS VARCHAR) END AS vehicle_id,
    CAST(driver_id AS VARCHAR) AS driver_id, CAST(route_id AS VARCHAR) AS route_id,
    strftime(scheduled_start_time, '%Y-%m-%d %H:%M:%S') AS scheduled_start_time,
    strftime(scheduled_end_time, '%Y-%m-%d %H:%M:%S') AS scheduled_end_time,
    strftime(actual_start_time, '%Y-%m-%d %H:%M:%S') AS actual_start_time,
    CASE WHEN trip_id % 31 = 4 THEN 'soon' ELSE strftime(actual_end_time, '%Y-%m-%d %H:%M:%S') END AS actual_end_time
  FROM f_trips, (VALUES (0), (1)) x(cp) WHERE cp = 0 OR trip_id % 9 = 0"""

PIECES["r_trip_cargo"] = """
  SELECT CAST(trip_id AS VARCHAR) AS trip_id, CAST(cargo_id AS VARCHAR) AS cargo_id,
    ' ' || load_status || ' ' AS load_status FROM f_trip_cargo"""

# ---- clean layer ----

PIECES["s_vehicles"] = """
  SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY (model IS NULL)::INT
      + (payload_capacity IS NULL)::INT + (tank_capacity_l IS NULL)::INT + (fuel_type IS NULL)::INT
      + (current_mileage IS NULL)::INT, model NULLS FIRST,
      payload_capacity NULLS FIRST, tank_capacity_l NULLS FIRST, fuel_type NULLS FIRST,
      current_mileage NULLS FIRST) AS rn
    FROM (SELECT TRY_CAST(vehicle_id AS BIGINT) AS vehicle_id, trim(model) AS model,
      TRY_CAST(payload_capacity AS DOUBLE) AS payload_capacity,
      TRY_CAST(tank_capacity_l AS DOUBLE) AS tank_capacity_l, trim(fuel_type) AS fuel_type,
      TRY_CAST(current_mileage AS DOUBLE) AS current_mileage FROM r_vehicles)) WHERE rn = 1"""

PIECES["s_drivers"] = """
  SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY driver_id ORDER BY (first_name IS NULL)::INT
      + (last_name IS NULL)::INT + (license_class IS NULL)::INT + (phone_number IS NULL)::INT, first_name NULLS FIRST,
      last_name NULLS FIRST, license_class NULLS FIRST, phone_number NULLS FIRST) AS rn
    FROM (SELECT TRY_CAST(driver_id AS BIGINT) AS driver_id, trim(first_name) AS first_name,
      trim(last_name) AS last_name, trim(license_class) AS license_class,
      trim(phone_number) AS phone_number FROM r_drivers)) WHERE rn = 1"""

PIECES["s_cargo"] = """
  SELECT DISTINCT TRY_CAST(cargo_id AS BIGINT) AS cargo_id, trim(cargo_type) AS cargo_type,
    TRY_CAST(max_temp AS DOUBLE) AS max_temp, TRY_CAST(min_temp AS DOUBLE) AS min_temp,
    TRY_CAST(weight_kg AS DOUBLE) AS weight_kg, TRY_CAST(price_egp AS DOUBLE) AS price_egp FROM r_cargo"""

PIECES["s_trips_typed"] = """
  SELECT DISTINCT TRY_CAST(trip_id AS BIGINT) AS trip_id, TRY_CAST(vehicle_id AS BIGINT) AS vehicle_id,
    TRY_CAST(driver_id AS BIGINT) AS driver_id, TRY_CAST(route_id AS BIGINT) AS route_id,
    TRY_CAST(scheduled_start_time AS TIMESTAMP) AS scheduled_start_time,
    TRY_CAST(scheduled_end_time AS TIMESTAMP) AS scheduled_end_time,
    TRY_CAST(actual_start_time AS TIMESTAMP) AS actual_start_time,
    TRY_CAST(actual_end_time AS TIMESTAMP) AS actual_end_time FROM r_trips"""

PIECES["s_trips"] = """
  SELECT * FROM s_trips_typed WHERE vehicle_id IN (SELECT vehicle_id FROM s_vehicles)
    AND driver_id IN (SELECT driver_id FROM s_drivers) AND route_id IN (SELECT route_id FROM f_routes)"""

PIECES["s_trip_cargo"] = """
  SELECT CAST(trip_id AS BIGINT) AS trip_id, CAST(cargo_id AS BIGINT) AS cargo_id, trim(load_status) AS load_status
  FROM r_trip_cargo WHERE CAST(trip_id AS BIGINT) IN (SELECT trip_id FROM s_trips)
    AND CAST(cargo_id AS BIGINT) IN (SELECT cargo_id FROM s_cargo)"""

# ---- telemetry and gold, over typed tables and over the clean layer ----


def star(prefix: str, trips: str, trip_cargo: str, cargo: str) -> None:
    """Define the rollups and the fact over one set of trip tables."""
    p = prefix
    PIECES[f"{p}_cargo_agg"] = f"""
  SELECT trip_id, min(cargo_type) AS cargo_type,
    round(sum(CAST(weight_kg AS DECIMAL(18,6))), 2) AS total_cargo_weight_kg,
    round(sum(CAST(price_egp AS DECIMAL(18,6))), 2) AS total_cargo_value_egp
  FROM {trip_cargo} LEFT JOIN {cargo} USING (cargo_id) GROUP BY trip_id"""
    PIECES[f"{p}_bounds"] = f"""
  SELECT trip_id, min(min_temp) AS min_temp, max(max_temp) AS max_temp, min(cargo_type) AS cargo_type
  FROM {trip_cargo} LEFT JOIN {cargo} USING (cargo_id) GROUP BY trip_id"""
    PIECES[f"{p}_starts"] = f"""
  SELECT t.*, b.min_temp, b.max_temp, b.cargo_type FROM (
    SELECT *, row_number() OVER (PARTITION BY vehicle_id, actual_start_time ORDER BY trip_id DESC) AS rn
    FROM {trips} WHERE vehicle_id IS NOT NULL AND actual_start_time IS NOT NULL) t
  LEFT JOIN {p}_bounds b ON b.trip_id = t.trip_id WHERE rn = 1"""
    PIECES[f"{p}_quick"] = f"""
  SELECT q.*, t.trip_id FROM f_quick q ASOF JOIN {p}_starts t
    ON q.vehicle_id = t.vehicle_id AND q.ts >= t.actual_start_time WHERE q.ts <= t.actual_end_time"""
    PIECES[f"{p}_slow"] = f"""
  SELECT q.*, t.trip_id, t.min_temp, t.max_temp,
    coalesce(cargo_temp_c > max_temp OR cargo_temp_c < min_temp, false) AS breach,
    CAST(fuel_amount_l AS DECIMAL(18,6)) AS fuel,
    lag(CAST(fuel_amount_l AS DECIMAL(18,6))) OVER (PARTITION BY t.trip_id ORDER BY ts, sensor_id) AS prev_fuel
  FROM f_slow q ASOF JOIN {p}_starts t
    ON q.vehicle_id = t.vehicle_id AND q.ts >= t.actual_start_time WHERE q.ts <= t.actual_end_time"""
    PIECES[f"{p}_quick_rollup"] = f"""
  SELECT trip_id, count(*) AS quick_pings_count, count(*) FILTER (rpm > 4200) AS engine_fault_ticks,
    count(*) FILTER (throttle_pct > 85) AS speeding_ticks, count(*) FILTER (accel_ay_abs > 0.75) AS drift_ticks,
    count(*) FILTER (battery_v < 11.4) AS battery_fault_ticks,
    round(max(CAST(odometer_km AS DECIMAL(18,6))) - min(CAST(odometer_km AS DECIMAL(18,6))), 2) AS total_distance_km
  FROM {p}_quick GROUP BY trip_id"""
    PIECES[f"{p}_slow_rollup"] = f"""
  SELECT trip_id, count(*) AS slow_pings_count, CAST(sum(is_door_open) AS BIGINT) AS door_open_ticks,
    count(*) FILTER (breach) AS cargo_breach_ticks,
    round(sum(CASE WHEN prev_fuel > fuel THEN prev_fuel - fuel ELSE 0 END), 2) AS total_fuel_consumed_l
  FROM {p}_slow GROUP BY trip_id"""
    counters = ["quick_pings_count", "slow_pings_count", "engine_fault_ticks", "speeding_ticks", "drift_ticks",
                "battery_fault_ticks", "door_open_ticks", "cargo_breach_ticks"]
    measures = ["total_fuel_consumed_l", "total_distance_km"]
    filled = ", ".join(f"coalesce({m}, 0) AS {m}" for m in counters + measures)
    PIECES[f"{p}_telemetry"] = f"""
  SELECT trip_id, {filled} FROM {p}_quick_rollup FULL JOIN {p}_slow_rollup USING (trip_id)"""
    PIECES[f"{p}_joined"] = f"""
  SELECT t.trip_id, t.vehicle_id, t.driver_id, t.route_id, t.scheduled_start_time, t.scheduled_end_time,
    t.actual_start_time, t.actual_end_time, c.cargo_type,
    coalesce(c.total_cargo_weight_kg, 0) AS total_cargo_weight_kg,
    coalesce(c.total_cargo_value_egp, 0) AS total_cargo_value_egp,
    {", ".join(f"coalesce(m.{m}, 0) AS {m}" for m in counters + measures)}
  FROM {trips} t LEFT JOIN {p}_cargo_agg c ON c.trip_id = t.trip_id
  LEFT JOIN {p}_telemetry m ON m.trip_id = t.trip_id"""
    PIECES[f"{p}_fact"] = f"""
  SELECT *, round(total_fuel_consumed_l * 18.0, 2) AS fuel_cost_egp, fee AS base_cargo_type_fees,
    round(total_cargo_weight_kg * 2.5, 2) AS weight_surcharge_fees,
    round(total_fuel_consumed_l * 18.0 + fee + total_cargo_weight_kg * 2.5, 2) AS total_trip_cost_egp
  FROM (SELECT md5(CAST(trip_id AS VARCHAR)) AS trip_sk, trip_id AS trip_id_bk,
    md5(coalesce(CAST(vehicle_id AS VARCHAR), '_null_')) AS vehicle_key_sk,
    md5(coalesce(CAST(driver_id AS VARCHAR), '_null_')) AS driver_key_sk,
    md5(coalesce(CAST(route_id AS VARCHAR), '_null_')) AS route_key_sk,
    CAST(strftime(actual_start_time, '%Y%m%d') AS INTEGER) AS start_date_key_sk, cargo_type, total_distance_km,
    quick_pings_count, slow_pings_count, engine_fault_ticks, speeding_ticks, drift_ticks, battery_fault_ticks,
    door_open_ticks, cargo_breach_ticks,
    CAST(date_diff('microsecond', scheduled_end_time, actual_end_time) AS DOUBLE) / CAST(60000000 AS DOUBLE) AS delivery_delay_min,
    CAST(date_diff('microsecond', scheduled_start_time, actual_start_time) AS DOUBLE) / CAST(60000000 AS DOUBLE) AS loading_lag_min,
    total_fuel_consumed_l, total_cargo_weight_kg, total_cargo_value_egp,
    CAST(CASE cargo_type WHEN 'Deep frozen' THEN 1200 WHEN 'Frozen' THEN 800 WHEN 'Pharmaceutical' THEN 1000
      WHEN 'Chilled' THEN 500 WHEN 'Controlled ambient' THEN 300 ELSE 250 END AS DECIMAL(18,2)) AS fee
    FROM {p}_joined)"""


star("g", "f_trips", "f_trip_cargo", "f_cargo")
star("l", "s_trips", "s_trip_cargo", "s_cargo")

MONEY = ["total_distance_km", "total_fuel_consumed_l", "fuel_cost_egp", "total_cargo_weight_kg",
         "total_cargo_value_egp", "base_cargo_type_fees", "weight_surcharge_fees", "total_trip_cost_egp"]
FACT = """SELECT * EXCLUDE fee REPLACE (%s) FROM %%s_fact""" % ", ".join(
    f"CAST({m} AS DOUBLE) AS {m}" for m in MONEY)
TELEMETRY = """SELECT * REPLACE (CAST(total_fuel_consumed_l AS DOUBLE) AS total_fuel_consumed_l,
    CAST(total_distance_km AS DOUBLE) AS total_distance_km) FROM g_telemetry"""

PIECES["d_vehicles"] = "SELECT md5(CAST(vehicle_id AS VARCHAR)) AS vehicle_sk, * FROM f_vehicles"
PIECES["d_drivers"] = """
  SELECT md5(CAST(driver_id AS VARCHAR)) AS driver_sk, *, first_name || ' ' || last_name AS full_name FROM f_drivers"""
PIECES["d_routes"] = "SELECT md5(CAST(route_id AS VARCHAR)) AS route_sk, * FROM f_routes"
PIECES["x_drivers"] = "SELECT * FROM g_fact JOIN d_drivers ON driver_sk = driver_key_sk"
PIECES["x_vehicles"] = "SELECT * FROM g_fact JOIN d_vehicles ON vehicle_sk = vehicle_key_sk"
PIECES["x_routes"] = "SELECT * FROM g_fact JOIN d_routes ON route_sk = route_key_sk"

# ---- live rules ----

PIECES["v_trips"] = """
  SELECT t.*, b.min_temp, b.max_temp, b.cargo_type FROM (
    SELECT *, row_number() OVER (PARTITION BY vehicle_id, actual_start_time ORDER BY trip_id DESC) AS rn
    FROM f_trips) t LEFT JOIN g_bounds b ON b.trip_id = t.trip_id WHERE rn = 1"""


def with_trip(pings: str) -> str:
    """Pings with their active trip or nulls."""
    return f"""
  SELECT a.* EXCLUDE (tid, did, kind, lo, hi, s, e), CASE WHEN event_time <= e THEN tid END AS trip_id,
    CASE WHEN event_time <= e THEN did END AS driver_id, CASE WHEN event_time <= e THEN kind END AS cargo_type,
    CASE WHEN event_time <= e THEN lo END AS min_temp, CASE WHEN event_time <= e THEN hi END AS max_temp,
    CASE WHEN event_time <= e THEN s END AS start_ts, CASE WHEN event_time <= e THEN e END AS end_ts
  FROM (SELECT q.*, t.trip_id AS tid, t.driver_id AS did, t.cargo_type AS kind, t.min_temp AS lo, t.max_temp AS hi,
      t.actual_start_time AS s, t.actual_end_time AS e
    FROM (SELECT *, date_trunc('second', ts) AS event_time FROM {pings}) q
    ASOF LEFT JOIN v_trips t ON q.vehicle_id = t.vehicle_id AND q.event_time >= t.actual_start_time) a"""


PIECES["v_quick"] = with_trip("f_quick")
PIECES["v_slow_drops"] = """
  SELECT *, CASE WHEN prev_fuel > fuel THEN prev_fuel - fuel ELSE 0 END AS fuel_drop FROM (
    SELECT *, CAST(fuel_amount_l AS DECIMAL(18,6)) AS fuel, lag(CAST(fuel_amount_l AS DECIMAL(18,6)))
      OVER (PARTITION BY vehicle_id ORDER BY date_trunc('second', ts), sensor_id) AS prev_fuel FROM f_slow)"""
PIECES["v_slow"] = with_trip("v_slow_drops")
PIECES["v_quick_incidents"] = """
  SELECT vehicle_id, trip_id, driver_id, event_time, 'BLUE' AS incident_color, 'BATTERY_LOW' AS incident_type,
    'Battery ' || battery_v || 'V' AS detail, lat, lon, sensor_id FROM v_quick WHERE battery_v < 11.4
  UNION ALL
  SELECT vehicle_id, trip_id, driver_id, event_time, 'YELLOW',
    CASE WHEN throttle_pct > 85 THEN 'SPEEDING' ELSE 'DRIFT' END,
    CASE WHEN throttle_pct > 85 THEN 'Throttle ' || throttle_pct || '%' ELSE 'Lateral G ' || accel_ay_abs END,
    lat, lon, sensor_id FROM v_quick WHERE throttle_pct > 85 OR accel_ay_abs > 0.75"""
PIECES["v_slow_incidents"] = """
  SELECT vehicle_id, trip_id, driver_id, event_time,
    CASE rule WHEN 3 THEN 'ORANGE' ELSE 'RED' END AS incident_color,
    CASE rule WHEN 1 THEN 'FUEL_FRAUD' WHEN 2 THEN 'DOOR_OPEN' ELSE 'CARGO_BREACH' END AS incident_type,
    CASE rule WHEN 1 THEN 'Fuel siphoned ' || CAST(round(fuel_drop, 1) AS DECIMAL(18,1)) || 'L'
      WHEN 2 THEN 'Cargo door open mid-route'
      ELSE 'Temp ' || cargo_temp_c || 'C (limit ' || min_temp || '..' || max_temp || ')' END AS detail,
    CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon, sensor_id
  FROM (SELECT *, CASE WHEN fuel_drop >= 10 THEN 1
      WHEN is_door_open = 1 AND event_time > start_ts + INTERVAL 180 SECOND
        AND event_time < end_ts - INTERVAL 180 SECOND THEN 2
      WHEN cargo_temp_c > max_temp OR cargo_temp_c < min_temp THEN 3 END AS rule FROM v_slow)
  WHERE rule IS NOT NULL"""
PIECES["v_feed"] = """
  SELECT *, event_time AS detected_at, CASE incident_color WHEN 'RED' THEN 4 WHEN 'ORANGE' THEN 3
    WHEN 'YELLOW' THEN 2 WHEN 'BLUE' THEN 1 ELSE 0 END AS severity
  FROM (SELECT * FROM v_quick_incidents UNION ALL SELECT * FROM v_slow_incidents)"""
PIECES["v_recent"] = """
  SELECT * FROM v_feed WHERE detected_at > (SELECT max(detected_at) FROM v_feed) - INTERVAL 12 HOUR"""
PIECES["v_positions"] = """
  SELECT vehicle_id, lat, lon, event_time FROM (SELECT *, row_number() OVER (
    PARTITION BY vehicle_id ORDER BY event_time DESC, sensor_id DESC) AS rn FROM v_quick) WHERE rn = 1"""
PIECES["v_worst"] = """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY severity DESC, event_time DESC,
    incident_type DESC, sensor_id DESC) AS rn FROM v_recent) WHERE rn = 1"""


def status(colour: str, label: str) -> str:
    return f"""
  SELECT p.vehicle_id, lat, lon, coalesce(w.event_time, p.event_time) AS last_event_time,
    coalesce(w.incident_color, '{colour}') AS incident_color, coalesce(w.incident_type, '{label}') AS incident_label
  FROM v_positions p LEFT JOIN (SELECT vehicle_id, event_time, incident_color, incident_type FROM v_worst) w
    ON w.vehicle_id = p.vehicle_id"""


PIECES["v_status"] = status("WHITE", "OK")
PIECES["v_messages"] = """
  SELECT *, CAST(vehicle_id AS VARCHAR) AS kafka_key, CASE WHEN event_type IN ('purchase', 'signup')
    THEN 'vehicle.slow.sensors' ELSE 'vehicle.quick.sensors' END AS topic, ts AS kafka_ts,
    CAST(ts AS DATE) AS ingest_date FROM f_events"""

FEED = """SELECT vehicle_id, trip_id, driver_id, event_time, incident_color, incident_type, detail, lat, lon,
  sensor_id FROM v_feed"""
ENVELOPE = "SELECT kafka_key, sensor_id, topic, kafka_ts, ingest_date FROM v_messages"
TRIPS = """trip_id, vehicle_id, driver_id, route_id, scheduled_start_time, scheduled_end_time, actual_start_time"""
CORRECTED = f"""SELECT {TRIPS}, CASE WHEN CAST(actual_start_time AS DATE) = DATE '2024-01-15'
  THEN actual_end_time + INTERVAL 1 HOUR ELSE actual_end_time END AS actual_end_time"""
LATE = """SELECT trip_sk, trip_id_bk, start_date_key_sk, CASE WHEN start_date_key_sk >= 20240115
  THEN delivery_delay_min + CAST(5 AS DOUBLE) ELSE delivery_delay_min END AS delivery_delay_min,
  CAST(fuel_cost_egp AS DOUBLE) AS fuel_cost_egp"""
ROLLUP_SLOW = """SELECT * REPLACE (CAST(total_fuel_consumed_l AS DOUBLE) AS total_fuel_consumed_l) FROM g_slow_rollup"""
ROLLUP_QUICK = """SELECT * REPLACE (CAST(total_distance_km AS DOUBLE) AS total_distance_km) FROM g_quick_rollup"""
DIRTY = """(SELECT sensor_id, vehicle_id, is_door_open, cargo_temp_c, fuel_amount_l,
    CASE WHEN sensor_id LIKE '%5' THEN NULL ELSE date_trunc('second', ts) END AS event_time FROM f_slow)"""
STAGES = "(VALUES ('bronze'), ('silver'), ('telemetry'), ('staging'), ('dbt')) s(stage_name)"
SEED = f"""SELECT stage_name, (SELECT max(CAST(actual_start_time AS DATE)) FROM f_trips) AS last_processed_date,
  CAST(NULL AS BIGINT) AS rows_processed, 'seeded' AS status FROM {STAGES}"""


def half_up(ratio: str, digits: int) -> str:
    return f"CAST(round(CAST({ratio} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def ratio(total: str, count: str, digits: int) -> str:
    return half_up(f"CAST({total} AS DOUBLE) / CAST({count} AS DOUBLE)", digits)


def control(silver_day: str, silver_rows: str, silver_status: str) -> str:
    return f"""SELECT stage_name, CASE stage_name WHEN 'bronze' THEN DATE '2024-01-15' WHEN 'silver'
    THEN DATE '{silver_day}' ELSE DATE '2024-01-14' END AS last_processed_date,
  CASE stage_name WHEN 'bronze' THEN (SELECT count(*) FROM f_quick WHERE CAST(ts AS DATE) = DATE '2024-01-15')
    WHEN 'silver' THEN {silver_rows} END AS rows_processed,
  CASE stage_name WHEN 'bronze' THEN 'success' WHEN 'silver' THEN '{silver_status}' ELSE 'seeded' END AS status
  FROM {STAGES}"""


ADVANCED = control("2024-01-15", "(SELECT count(*) FROM f_trips WHERE CAST(actual_start_time AS DATE) = DATE '2024-01-15')",
                   "success")
KM = """CAST(2 * 6371 AS DOUBLE) * asin(sqrt(least(power(sin((b - a) / 2), 2)
  + cos(a) * cos(b) * power(sin(d / 2), 2), CAST(1 AS DOUBLE))))"""
GEO = """(SELECT trip_id, radians(origin_lat) AS a, radians(destination_lat) AS b,
  radians(destination_lon - origin_lon) AS d FROM f_trips JOIN f_routes USING (route_id))"""
PARTS = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, d AS full_date, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
  dayname(d) AS day_of_week, dayofweek(d) IN (5, 6) AS is_weekend"""
BRACKET = """CASE WHEN current_mileage < 100000 THEN '0-100k' WHEN current_mileage < 250000 THEN '100k-250k'
  ELSE '250k+' END"""


def violations() -> str:
    parts = []
    models = {"dim_vehicles": ("d_vehicles", ["vehicle_sk", "vehicle_id"]),
              "dim_drivers": ("d_drivers", ["driver_sk", "driver_id"]),
              "dim_routes": ("d_routes", ["route_sk", "route_id"]),
              "fct_trip_operations": ("g_fact", ["trip_sk", "trip_id_bk"])}
    for model, (table, columns) in models.items():
        for col in columns:
            parts.append(f"""SELECT 'unique_{model}_{col}' AS test, count(*) AS violations FROM (
                SELECT {col} FROM {table} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)""")
            parts.append(f"SELECT 'not_null_{model}_{col}', count(*) FROM {table} WHERE {col} IS NULL")
    for key, dim, dim_key in (("vehicle_key_sk", "d_vehicles", "vehicle_sk"), ("driver_key_sk", "d_drivers", "driver_sk"),
                              ("route_key_sk", "d_routes", "route_sk")):
        parts.append(f"""SELECT 'relationships_fct_trip_operations_{key}', count(*) FROM g_fact
            WHERE {key} NOT IN (SELECT {dim_key} FROM {dim})""")
    return " UNION ALL ".join(parts)


def landed_counts() -> str:
    keys = {"vehicles": ("r_vehicles", "vehicle_id"), "drivers": ("r_drivers", "driver_id"),
            "cargo": ("r_cargo", "cargo_id"), "depots": ("f_depots", "depot_id"),
            "trips": ("r_trips", "trip_id"), "trip_cargo": ("r_trip_cargo", "trip_id")}
    parts = [f"SELECT '{n}' AS table_name, count(*) AS row_count, count(DISTINCT {k}) AS distinct_keys FROM {t}"
             for n, (t, k) in keys.items()]
    parts.append("""SELECT 'routes', count(*) + count(*) FILTER (route_id % 9 = 0), count(DISTINCT route_id)
        FROM f_route_pairs""")
    return " UNION ALL ".join(parts)


QUERIES: dict[str, str] = {
    # scans and sources
    "scan_csv_strings": "SELECT * FROM r_trips",
    "land_static_tables": landed_counts(),
    "scan_parquet": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "scan_parquet_dir": "SELECT * FROM f_trips",
    "scan_daily_slice": f"{ENVELOPE} WHERE topic LIKE '%quick%' AND ingest_date = DATE '2024-01-15'",
    "scan_sharded_by_vehicle": "SELECT vehicle_id, sensor_id, fuel_amount_l FROM f_slow",
    "stream_source": """SELECT kafka_key AS key, sensor_id, topic, ts AS "timestamp" FROM v_messages
        WHERE topic LIKE '%quick%'""",
    "envelope_project": ENVELOPE,
    "named_sources": "SELECT model, count(*) AS trips FROM f_trips JOIN f_vehicles USING (vehicle_id) GROUP BY model",
    "dim_date": f"""SELECT {PARTS} FROM (SELECT CAST(unnest(generate_series(
        (SELECT min(scheduled_start_time) FROM f_trips)::DATE::TIMESTAMP,
        (SELECT max(actual_end_time) FROM f_trips)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS d)""",
    "json_payload": """SELECT CAST(vehicle_id AS VARCHAR) AS key, CAST(vehicle_id AS VARCHAR) AS json_vehicle_id,
        sensor_id AS json_sensor_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS json_timestamp, rpm AS json_rpm FROM f_quick""",
    # sinks
    "write_overwrite": "SELECT vehicle_id, model, (SELECT count(*) FROM f_vehicles) AS rows_reported FROM f_vehicles",
    "stream_land_bronze": f"{ENVELOPE} WHERE topic LIKE '%quick%'",
    "write_staging": "SELECT * FROM f_drivers",
    "copy_partition_forward": """SELECT kafka_key, sensor_id, topic, kafka_ts, ingest_date AS dt,
        count(*) OVER () AS rows_copied FROM v_messages
        WHERE topic LIKE '%slow%' AND ingest_date = DATE '2024-01-15'""",
    "replace_by_date": f"{CORRECTED}, CAST(actual_start_time AS DATE) AS dt FROM f_trips",
    "replace_by_key": f"{CORRECTED} FROM f_trips",
    "replace_by_start_date": f"{CORRECTED} FROM f_trips",
    "telemetry_table_write": TELEMETRY,
    "upsert_status": """WITH ranked AS (SELECT *, event_time < TIMESTAMP '2024-01-15' AS early, row_number() OVER (
          PARTITION BY vehicle_id, event_time < TIMESTAMP '2024-01-15' ORDER BY event_time DESC, sensor_id DESC) AS rn
        FROM v_quick), old AS (SELECT * FROM ranked WHERE rn = 1 AND early),
        new AS (SELECT * FROM ranked WHERE rn = 1 AND NOT early)
        SELECT coalesce(n.vehicle_id, o.vehicle_id) AS vehicle_id, coalesce(n.lat, o.lat) AS lat,
          coalesce(n.lon, o.lon) AS lon, coalesce(n.event_time, o.event_time) AS last_event_time,
          CASE WHEN o.vehicle_id IS NULL THEN 'WHITE' ELSE 'RED' END AS incident_color,
          CASE WHEN o.vehicle_id IS NULL THEN 'OK' ELSE 'DOOR_OPEN' END AS incident_label
        FROM old o FULL JOIN new n ON n.vehicle_id = o.vehicle_id""",
    "insert_if_absent": """SELECT vehicle_id, min(ts) AS first_seen, 'seen' AS status FROM f_quick GROUP BY 1
        UNION ALL SELECT vehicle_id, NULL, 'seeded' FROM f_vehicles
        WHERE vehicle_id NOT IN (SELECT vehicle_id FROM f_quick)""",
    "append_feed": FEED,
    "merge_fact": f"{LATE} FROM g_fact",
    "append_new_columns": f"{LATE}, CASE WHEN start_date_key_sk >= 20240115 THEN 'late' END AS audit_note FROM g_fact",
    "full_refresh_table": "SELECT * FROM d_routes",
    # clean layer
    "silver_vehicles": "SELECT * FROM s_vehicles",
    "silver_drivers": "SELECT * FROM s_drivers",
    "silver_cargo": "SELECT * FROM s_cargo",
    "silver_trips_typed": "SELECT * FROM s_trips_typed",
    "silver_trip_cargo_typed": "SELECT * FROM f_trip_cargo",
    "rename_roles": """SELECT trip_id, depot_id AS origin_depot_id, address AS origin_address,
        governorate AS origin_governorate, lat AS origin_lat, lon AS origin_lon
        FROM f_trips JOIN f_depots ON depot_id = route_id // 24""",
    "dedupe_by_key": "SELECT trip_id, cargo_id, min(load_status) AS load_status FROM f_trip_cargo GROUP BY 1, 2",
    "dedupe_full_row": "SELECT DISTINCT * FROM f_trip_cargo",
    "drop_null_keys": """SELECT * REPLACE (TRY_CAST(vehicle_id AS BIGINT) AS vehicle_id) FROM r_trips
        WHERE TRY_CAST(vehicle_id AS BIGINT) IS NOT NULL""",
    "silver_daily_clean": "SELECT * FROM f_slow",
    "fill_missing_measures": """SELECT trip_id, coalesce(quick_pings_count, 0) AS quick_pings_count,
        CAST(0 AS BIGINT) AS slow_pings_count, coalesce(engine_fault_ticks, 0) AS engine_fault_ticks,
        coalesce(speeding_ticks, 0) AS speeding_ticks, coalesce(drift_ticks, 0) AS drift_ticks,
        coalesce(battery_fault_ticks, 0) AS battery_fault_ticks, CAST(0 AS BIGINT) AS door_open_ticks,
        CAST(0 AS BIGINT) AS cargo_breach_ticks, CAST(0 AS DOUBLE) AS total_fuel_consumed_l,
        CAST(coalesce(total_distance_km, 0) AS DOUBLE) AS total_distance_km
        FROM f_trips LEFT JOIN g_quick_rollup USING (trip_id)""",
    "parse_json_pings": """SELECT CAST(vehicle_id AS VARCHAR) AS vehicle_id, sensor_id,
        CAST(is_door_open AS VARCHAR) AS is_door_open, fuel_amount_l FROM f_slow""",
    "tolerant_parse": f"""SELECT vehicle_id, sensor_id, event_time, fuel_amount_l, is_door_open, cargo_temp_c
        FROM {DIRTY} WHERE sensor_id NOT LIKE '%3'""",
    "tolerant_timestamp": f"SELECT sensor_id, event_time FROM {DIRTY}",
    "prune_columns": "SELECT trip_id, vehicle_id, actual_start_time, actual_end_time FROM f_trips",
    "dim_vehicles": "SELECT * FROM d_vehicles",
    "dim_drivers": "SELECT * FROM d_drivers",
    "dim_routes": "SELECT * FROM d_routes",
    # filters
    "filter_vehicle_range": "SELECT trip_id, vehicle_id FROM f_trips WHERE vehicle_id < 100",
    "threshold_flags": """SELECT sensor_id, CAST(rpm > 4200 AS INTEGER) AS engine_fault,
        CAST(throttle_pct > 85 AS INTEGER) AS speeding, CAST(accel_ay_abs > 0.75 AS INTEGER) AS drift,
        CAST(battery_v < 11.4 AS INTEGER) AS battery_fault FROM f_quick""",
    "in_window_filter": """SELECT trip_id, scheduled_start_time, actual_start_time, scheduled_end_time FROM f_trips
        WHERE actual_start_time BETWEEN scheduled_start_time AND scheduled_end_time""",
    "disjunctive_filter": """SELECT sensor_id, CAST(throttle_pct > 85 AS INTEGER) AS speeding,
        CAST(rpm > 4200 AS INTEGER) AS engine_fault FROM f_quick WHERE throttle_pct > 85 OR rpm > 4200""",
    "null_filter": "SELECT trip_id, actual_end_time FROM s_trips_typed WHERE actual_end_time IS NOT NULL",
    "date_slice_filter": """SELECT trip_id, actual_start_time FROM f_trips
        WHERE CAST(actual_start_time AS DATE) = DATE '2024-01-15'""",
    "having_filter": """SELECT vehicle_id, count(*) AS battery_fault_ticks FROM f_quick WHERE battery_v < 11.4
        GROUP BY vehicle_id HAVING count(*) > 1""",
    "in_list": "SELECT sensor_id, incident_type, incident_color FROM v_feed WHERE incident_color IN ('RED', 'ORANGE')",
    "recent_window_filter": "SELECT sensor_id, incident_type, detected_at FROM v_recent",
    "mid_route_guard": """SELECT sensor_id, trip_id, event_time FROM v_slow WHERE is_door_open = 1
        AND event_time > start_ts + INTERVAL 3 MINUTE AND event_time < end_ts - INTERVAL 3 MINUTE""",
    # joins
    "left_join_cargo": "SELECT * FROM f_trip_cargo LEFT JOIN f_cargo USING (cargo_id)",
    "silver_routes": "SELECT * FROM f_routes",
    "join_trip_inputs": "SELECT * REPLACE (%s) FROM g_joined" % ", ".join(
        f"CAST({m} AS DOUBLE) AS {m}" for m in ("total_cargo_weight_kg", "total_cargo_value_egp",
                                                "total_fuel_consumed_l", "total_distance_km")),
    "silver_trips": "SELECT * FROM s_trips",
    "silver_trip_cargo": "SELECT * FROM s_trip_cargo",
    "asof_trip_match": "SELECT sensor_id, vehicle_id, ts, trip_id FROM g_quick",
    "stream_static_asof": """SELECT sensor_id, vehicle_id, event_time, trip_id, driver_id, cargo_type, min_temp,
        max_temp, start_ts, end_ts FROM v_slow""",
    "outer_join_rollups": TELEMETRY,
    "left_join_bounds": """SELECT trip_id, vehicle_id, min_temp, max_temp
        FROM f_trips LEFT JOIN g_bounds USING (trip_id)""",
    "anti_join_reset": """SELECT vehicle_id, lat, lon, event_time AS last_event_time, 'WHITE' AS incident_color,
        'OK' AS incident_label FROM v_positions WHERE vehicle_id NOT IN (SELECT vehicle_id FROM v_recent)""",
    "update_from_join": status("RED", "DOOR_OPEN"),
    "star_join": """SELECT trip_id_bk, full_name, model, origin_governorate, destination_governorate,
        CAST(fuel_cost_egp AS DOUBLE) AS fuel_cost_egp FROM x_drivers JOIN d_routes ON route_sk = route_key_sk
        JOIN d_vehicles ON vehicle_sk = vehicle_key_sk""",
    "route_matrix": "SELECT *, route_id AS encoded_id FROM f_route_pairs",
    "fk_violations": """SELECT trip_id_bk, driver_key_sk FROM g_fact
        WHERE driver_key_sk NOT IN (SELECT driver_sk FROM d_drivers)""",
    # aggregates
    "trip_cargo_agg": """SELECT trip_id, cargo_type, CAST(total_cargo_weight_kg AS DOUBLE) AS total_cargo_weight_kg,
        CAST(total_cargo_value_egp AS DOUBLE) AS total_cargo_value_egp FROM g_cargo_agg""",
    "trip_thermal_bounds": "SELECT * FROM g_bounds",
    "quick_rollup": ROLLUP_QUICK,
    "slow_rollup": ROLLUP_SLOW,
    "breach_ticks": "SELECT trip_id, cargo_breach_ticks AS breach_ticks FROM g_slow_rollup",
    "fuel_consumed": "SELECT trip_id, CAST(total_fuel_consumed_l AS DOUBLE) AS total_fuel_consumed_l FROM g_slow_rollup",
    "trip_telemetry_agg": TELEMETRY,
    "global_sum": "SELECT CAST(sum(CAST(fuel_amount_l AS DECIMAL(18,6))) AS DOUBLE) AS fuel_total FROM f_slow",
    "count_distinct": "SELECT count(DISTINCT vehicle_key_sk) AS vehicles FROM g_fact",
    "two_level_agg": """SELECT band, count(*) AS vehicles FROM (SELECT vehicle_id,
        CASE WHEN count(*) > 30 THEN 'busy' ELSE 'quiet' END AS band FROM f_quick GROUP BY 1) GROUP BY band""",
    "group_by_expression": f"""SELECT {BRACKET} AS mileage_bracket, model || '/' || fuel_type AS kind,
        count(*) AS vehicles FROM f_vehicles GROUP BY 1, 2""",
    "filtered_counts": """SELECT count(*) AS pings, count(*) FILTER (throttle_pct > 85) AS speeding,
        count(*) FILTER (accel_ay_abs > 0.75 AND NOT throttle_pct > 85) AS drift_only FROM f_quick""",
    "avg_rounded": "SELECT vehicle_id, %s FROM f_slow GROUP BY vehicle_id" % ", ".join(
        f"{ratio('sum(is_door_open) * 100', 'count(*)', d)} AS door_pct_{d}dp" for d in (0, 1, 2)),
    "mixed_cargo_audit": """SELECT trip_id, count(DISTINCT cargo_type) AS cargo_types FROM f_trip_cargo
        JOIN f_cargo USING (cargo_id) GROUP BY trip_id HAVING count(DISTINCT cargo_type) > 1""",
    "status_distribution": f"""SELECT load_status, n, {ratio('n * 100', 'sum(n) OVER ()', 2)} AS share_pct
        FROM (SELECT load_status, count(*) AS n FROM f_trip_cargo GROUP BY 1)""",
    "share_of_total": f"""SELECT vehicle_id, n, {ratio('n * 100', 'sum(n) OVER ()', 2)} AS share_pct
        FROM (SELECT vehicle_id, count(*) AS n FROM f_quick GROUP BY 1)""",
    "value_counts": "SELECT cargo_type, count(*) AS n FROM f_cargo GROUP BY 1",
    "double_booking_audit": """SELECT CAST(sum(n - 1) AS BIGINT) AS double_booked FROM (
        SELECT count(*) AS n FROM f_trips GROUP BY vehicle_id, scheduled_start_time)""",
    "table_profile": """SELECT count(*) AS row_count, min(scheduled_start_time) AS first_start,
        max(scheduled_start_time) AS last_start FROM f_trips""",
    "latest_position": "SELECT * FROM v_positions",
    "unique_violations": "SELECT trip_id, count(*) AS n FROM r_trips GROUP BY 1 HAVING count(*) > 1",
    "not_null_violations": """SELECT 'trip_id' AS column_name, count(*) AS violations FROM r_trips WHERE trip_id IS NULL
        UNION ALL SELECT 'vehicle_id', count(*) FROM r_trips WHERE TRY_CAST(vehicle_id AS BIGINT) IS NULL""",
    # order
    "lag_fuel": """SELECT sensor_id, trip_id, CAST(fuel AS DOUBLE) AS fuel, CAST(prev_fuel AS DOUBLE) AS prev_fuel
        FROM g_slow""",
    "highest_severity": """SELECT vehicle_id, severity, event_time, incident_type, sensor_id, incident_color FROM (
        SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY severity DESC, event_time DESC,
        incident_type DESC, sensor_id DESC) AS rn FROM v_feed) WHERE rn = 1""",
    "resequence_ids": """SELECT row_number() OVER (ORDER BY scheduled_start_time, trip_id) - 1 AS new_trip_id,
        trip_id, scheduled_start_time FROM f_trips""",
    "topk": "SELECT sensor_id, vehicle_id, fuel_amount_l FROM f_slow ORDER BY fuel_amount_l DESC, sensor_id LIMIT 50",
    "sort_only": "SELECT vehicle_id, scheduled_start_time, trip_id FROM f_trips",
    "concat_parts": "SELECT vehicle_id, sensor_id, ts FROM f_events",
    # scalar functions
    "surrogate_key": """SELECT trip_id, md5(coalesce(CAST(v AS VARCHAR), '_null_')) AS vehicle_sk,
        md5(trip_id || '-' || coalesce(CAST(v AS VARCHAR), '_null_')) AS pair_sk
        FROM (SELECT trip_id, TRY_CAST(vehicle_id AS BIGINT) AS v FROM r_trips)""",
    "date_key": """SELECT trip_id, year(actual_start_time) * 10000 + month(actual_start_time) * 100
        + day(actual_start_time) AS date_sk FROM f_trips""",
    "calendar_parts": f"SELECT trip_id, {PARTS} FROM (SELECT trip_id, CAST(actual_start_time AS DATE) AS d FROM f_trips)",
    "minutes_between": """SELECT trip_id,
        (epoch(actual_end_time) - epoch(scheduled_end_time)) / 60 AS delivery_delay_min,
        (epoch(actual_start_time) - epoch(scheduled_start_time)) / 60 AS loading_lag_min FROM f_trips""",
    "base_fee": """SELECT cargo_id, CAST(CASE cargo_type WHEN 'Deep frozen' THEN 1200 WHEN 'Frozen' THEN 800
        WHEN 'Pharmaceutical' THEN 1000 WHEN 'Chilled' THEN 500 WHEN 'Controlled ambient' THEN 300 ELSE 250 END
        AS DOUBLE) AS base_fee FROM f_cargo""",
    "fuel_cost": """SELECT sensor_id, CAST(round(CAST(fuel_amount_l AS DECIMAL(18,2)) * 18.0, 2) AS DOUBLE)
        AS fuel_cost_egp FROM f_slow""",
    "weight_surcharge": """SELECT cargo_id, CAST(round(CAST(weight_kg AS DECIMAL(18,2)) * 2.5, 2) AS DOUBLE)
        AS weight_surcharge FROM f_cargo""",
    "total_trip_cost": "SELECT trip_id_bk AS trip_id, CAST(total_trip_cost_egp AS DOUBLE) AS total_trip_cost_egp FROM g_fact",
    "severity_code": "SELECT sensor_id, incident_type, severity FROM v_feed",
    "mileage_bracket": f"SELECT vehicle_id, {BRACKET} AS mileage_bracket FROM f_vehicles",
    "distance_bin": "SELECT sensor_id, floor(odometer_km / 50) * 50 AS distance_bin_km FROM f_quick",
    "corridor_label": """SELECT trip_id, origin_governorate || ' -> ' || destination_governorate AS corridor
        FROM f_trips JOIN f_routes USING (route_id)""",
    "haversine_km": f"SELECT trip_id, round({KM}, 4) AS distance_km FROM {GEO}",
    "travel_hours": f"""SELECT trip_id, CAST(round(CAST(greatest(CAST(1.5 AS DOUBLE), {KM} / 70 + 1)
        AS DECIMAL(18,8)), 2) AS DOUBLE) AS travel_hours FROM {GEO}""",
    "trim_text": "SELECT trip_id, cargo_id, trim(load_status) AS load_status FROM r_trip_cargo",
    "coalesce_zero": """SELECT trip_id, CAST(coalesce(total_fuel_consumed_l, 0) AS DOUBLE) AS total_fuel_consumed_l
        FROM f_trips LEFT JOIN g_slow_rollup USING (trip_id)""",
    "incident_detail": "SELECT sensor_id, incident_type, detail FROM v_feed",
    # streaming
    "stream_trigger": "SELECT ingest_date, count(*) AS messages FROM v_messages WHERE topic LIKE '%slow%' GROUP BY 1",
    "stream_checkpoint": "SELECT sensor_id, count(*) AS deliveries FROM f_quick GROUP BY 1",
    "stream_multi_query": "SELECT topic, ingest_date, count(*) AS messages FROM v_messages GROUP BY 1, 2",
    "quick_incidents": "SELECT * FROM v_quick_incidents",
    "slow_incidents": "SELECT * FROM v_slow_incidents",
    "fuel_drop_state": """SELECT vehicle_id, fuel_amount_l AS last_fuel_l, event_time AS last_event_time FROM (
        SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY event_time DESC, sensor_id DESC) AS rn
        FROM v_slow) WHERE rn = 1""",
    "vehicle_status": "SELECT * FROM v_status",
    "refresh_colours": "SELECT * FROM v_status",
    "incident_feed": FEED,
    "fuel_drop_batch": """SELECT sensor_id, vehicle_id, CAST(prev_fuel AS DOUBLE) AS prev_fuel,
        CAST(fuel_drop AS DOUBLE) AS fuel_drop FROM v_slow_drops""",
    # incremental control and quality
    "checkpoints_seed": SEED,
    "next_target_date": f"SELECT stage_name, last_processed_date + 1 AS target_date FROM ({SEED})",
    "advance_checkpoint": ADVANCED,
    "rewind_checkpoint": control("2024-01-12", "CAST(NULL AS BIGINT)", "rewound"),
    "checkpoint_report": ADVANCED,
    "backfill_pipeline": FACT % "l",
    "daily_pipeline": FACT % "l",
    "dq_gate": violations(),
    "row_loss_report": """SELECT count(*) AS rows_before, count(*) FILTER (ok) AS rows_after,
        count(*) FILTER (NOT ok) AS rows_dropped FROM (SELECT vehicle_id IS NOT NULL
          AND vehicle_id IN (SELECT vehicle_id FROM f_vehicles) AND driver_id IN (SELECT driver_id FROM f_drivers)
          AND route_id IN (SELECT route_id FROM f_routes) AS ok FROM s_trips_typed)""",
    # gold and business questions
    "fct_trip_operations": FACT % "g",
    "q1_1_dangerous_drivers": """SELECT driver_id, full_name, CAST(sum(speeding_ticks) AS BIGINT) AS speeding,
        CAST(sum(drift_ticks) AS BIGINT) AS drift, CAST(sum(speeding_ticks + drift_ticks) AS BIGINT) AS aggressive_ticks
        FROM x_drivers GROUP BY 1, 2 ORDER BY aggressive_ticks DESC, driver_id LIMIT 5""",
    "q1_1_by_name": """SELECT full_name, CAST(sum(speeding_ticks + drift_ticks) AS BIGINT) AS aggressive_ticks
        FROM x_drivers GROUP BY 1""",
    "q1_2_speeding_vs_engine": """SELECT trip_id_bk, speeding_ticks, engine_fault_ticks FROM g_fact
        WHERE speeding_ticks > 0 OR engine_fault_ticks > 0""",
    "q2_1_vehicles_at_risk": """SELECT count(DISTINCT vehicle_key_sk) AS vehicles_at_risk FROM g_fact
        WHERE battery_fault_ticks > 1""",
    "q2_1_risk_list": """SELECT vehicle_id, model, CAST(sum(battery_fault_ticks) AS BIGINT) AS battery_fault_ticks
        FROM x_vehicles GROUP BY 1, 2 HAVING sum(battery_fault_ticks) > 1""",
    "q2_1_risk_band": """SELECT risk_band, count(*) AS vehicles FROM (SELECT CASE WHEN sum(battery_fault_ticks) > 1
        THEN 'At risk' ELSE 'Healthy' END AS risk_band FROM g_fact GROUP BY vehicle_key_sk) GROUP BY 1""",
    "q2_2_mileage_wear": f"""SELECT model, {BRACKET} AS mileage_bracket,
        {ratio('sum(engine_fault_ticks)', 'count(*)', 1)} AS avg_engine_fault_ticks,
        CAST(sum(engine_fault_ticks) AS DOUBLE) / count(*) AS avg_engine_fault FROM x_vehicles GROUP BY 1, 2""",
    "q3_1_breach_by_type": """SELECT cargo_type, CAST(sum(cargo_breach_ticks) AS BIGINT) AS breach_ticks FROM g_fact
        WHERE cargo_type IS NOT NULL GROUP BY 1""",
    "q3_2_breach_by_distance": f"""SELECT CAST(floor(total_distance_km / 50) * 50 AS DOUBLE) AS distance_bin_km,
        {ratio('sum(cargo_breach_ticks)', 'count(*)', 2)} AS avg_breach_ticks, count(*) AS trips FROM g_fact
        WHERE total_distance_km > 0 GROUP BY 1""",
    "q4_1_corridors": f"""SELECT origin_governorate, destination_governorate, count(*) AS trip_volume,
        {ratio('sum(CAST(delivery_delay_min AS DECIMAL(24,6)))', 'count(*)', 1)} AS avg_delay_min
        FROM x_routes GROUP BY 1, 2 ORDER BY trip_volume DESC, 1, 2 LIMIT 15""",
    "q4_2_loading_lag": f"""SELECT origin_governorate,
        {ratio('sum(CAST(loading_lag_min AS DECIMAL(24,6)))', 'count(*)', 1)} AS avg_loading_lag_min,
        count(*) AS trips FROM x_routes GROUP BY 1""",
    "q5_1_fuel_cost": """SELECT origin_governorate, CAST(round(sum(fuel_cost_egp), 0) AS DOUBLE) AS fuel_cost_egp,
        CAST(round(sum(total_fuel_consumed_l), 0) AS DOUBLE) AS liters FROM x_routes GROUP BY 1""",
    "q5_1_total_fuel": "SELECT CAST(sum(fuel_cost_egp) AS DOUBLE) AS total_fuel_cost_egp FROM g_fact",
    "q5_2_net_profit": """SELECT origin_governorate, destination_governorate,
        CAST(round(sum(base_cargo_type_fees + weight_surcharge_fees), 0) AS DOUBLE) AS revenue_egp,
        CAST(round(sum(fuel_cost_egp), 0) AS DOUBLE) AS fuel_cost_egp,
        CAST(round(sum(base_cargo_type_fees + weight_surcharge_fees - fuel_cost_egp), 0) AS DOUBLE) AS net_profit_egp
        FROM x_routes GROUP BY 1, 2 ORDER BY net_profit_egp DESC, 1, 2 LIMIT 15""",
    "q5_2_by_corridor": """SELECT origin_governorate || ' -> ' || destination_governorate AS corridor,
        CAST(sum(base_cargo_type_fees + weight_surcharge_fees) AS DOUBLE) AS revenue_egp,
        CAST(sum(fuel_cost_egp) AS DOUBLE) AS fuel_cost_egp,
        CAST(sum(base_cargo_type_fees + weight_surcharge_fees - fuel_cost_egp) AS DOUBLE) AS net_profit_egp
        FROM x_routes GROUP BY 1""",
    "live_map": """SELECT vehicle_id, lat, lon, CASE incident_color WHEN 'RED' THEN 4 WHEN 'ORANGE' THEN 3
        WHEN 'YELLOW' THEN 2 WHEN 'BLUE' THEN 1 ELSE 0 END AS severity, incident_label, last_event_time FROM v_status""",
    "live_feed": """SELECT event_time, vehicle_id, incident_color, incident_type, detail FROM v_feed
        ORDER BY event_time DESC, sensor_id, incident_type LIMIT 50""",
    "fleet_ticker": """SELECT count(*) AS total_active, count(*) FILTER (incident_color = 'WHITE') AS nominal,
        count(*) FILTER (incident_color IN ('YELLOW', 'BLUE')) AS warnings,
        count(*) FILTER (incident_color IN ('RED', 'ORANGE')) AS critical FROM v_status""",
    "incidents_by_colour": "SELECT incident_color, count(*) AS incidents FROM v_feed GROUP BY 1",
}


def _named(sql: str) -> list[str]:
    """The pieces a query names directly."""
    words = set(re.findall(r"\w+", sql))
    return [name for name in PIECES if name in words]


def complete(sql: str, needs: dict[str, list[str]]) -> str:
    """Prefix a query with the pieces it uses, each after those it needs itself."""
    ordered: list[str] = []

    def place(name: str) -> None:
        if name not in ordered:
            for other in needs[name]:
                place(other)
            ordered.append(name)

    for name in _named(sql):
        place(name)
    if not ordered:
        return sql
    pieces = ",\n".join(f"{n} AS ({PIECES[n]})" for n in ordered)
    body = sql.lstrip()
    return f"WITH {pieces},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {pieces}\n{body}"


# the stored star answers as the fact does
QUERIES |= {stored: QUERIES[asked] for stored, asked in (
    ("stored_by_name", "q1_1_by_name"), ("stored_mileage_wear", "q2_2_mileage_wear"),
    ("stored_by_corridor", "q5_2_by_corridor"))}


def oracle_sql() -> dict[str, str]:
    needs = {name: _named(sql) for name, sql in PIECES.items()}
    return {name: complete(sql, needs) for name, sql in QUERIES.items()}
