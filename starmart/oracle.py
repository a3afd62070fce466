"""For each query the same question as plain SQL over the given tables (DuckDB dialect)."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def date_key(ts: str) -> str:
    return f"cast(strftime({ts}, '%Y%m%d') AS INTEGER)"


def time_key(ts: str) -> str:
    return f"cast(strftime({ts}, '%H%M%S') AS INTEGER)"


def rnd(value: str, digits: int) -> str:
    return f"cast(round(cast({value} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def avg(column: str) -> str:
    return f"cast(sum({column}) AS DOUBLE) / nullif(count({column}), 0)"


# Common table expressions, named after the roles of the domain -------------------------------------

CTE = {
    "ev": "SELECT *, cast(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "trip": """
        SELECT cast(event_id AS VARCHAR) AS trip_id, cast(user_id AS VARCHAR) AS user_id,
               cast(k // 4 AS VARCHAR) AS route_id,
               CASE WHEN event_type <> 'signup' THEN cast(user_id AS VARCHAR) END AS vehicle_id,
               cast(user_id AS VARCHAR) AS origin_stop_id,
               cast(cast(floor(value * 10) AS BIGINT) AS VARCHAR) AS destination_stop_id,
               ts AS start_ts, ts + to_minutes(k) AS end_ts, k * 100 AS distance_meters,
               event_type AS fare_product_id, cast(value AS DECIMAL(10,2)) AS fare_amount,
               CASE WHEN event_type <> 'click' THEN 'USD' END AS currency_code,
               CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'canceled'
                    ELSE 'in_progress' END AS trip_status,
               ts AS created_at
        FROM ev""",
    "pos": """
        SELECT concat(cast(user_id AS VARCHAR), '-', cast(cast(floor(epoch(ts)) AS BIGINT) AS VARCHAR)) AS raw_event_id,
               cast(user_id AS VARCHAR) AS vehicle_id, cast(k // 4 AS VARCHAR) AS route_id, ts AS event_ts,
               cast(55 + cast(k AS DECIMAL(9,2)) / 100 AS DECIMAL(9,6)) AS latitude,
               cast(37 + cast(k AS DECIMAL(9,2)) / 50 AS DECIMAL(9,6)) AS longitude,
               cast(value AS DECIMAL(6,2)) AS speed_kmph, cast(k * 3 AS DECIMAL(6,2)) AS heading_deg,
               cast(cast(floor(value * 10) AS BIGINT) AS VARCHAR) AS nearest_stop_id,
               k // 25 AS partition_id, event_id AS offset_in_partition
        FROM ev""",
    "pay": """
        SELECT cast(o_orderkey AS VARCHAR) AS payment_id, cast(o_custkey AS VARCHAR) AS user_id,
               o_orderpriority AS payment_method, cast(o_totalprice AS DECIMAL(10,2)) AS amount,
               o_orderstatus AS payment_status, o_orderdate AS created_at
        FROM orders""",
    "dim_user": """
        SELECT row_number() OVER (ORDER BY md5(n), n) AS user_sk, n AS user_id_nat
        FROM (SELECT cast(c_custkey AS VARCHAR) AS n FROM customer WHERE c_acctbal >= 0)""",
    "dim_vehicle": """
        SELECT row_number() OVER (ORDER BY md5(n), n) AS vehicle_sk, n AS vehicle_id_nat
        FROM (SELECT cast(s_suppkey AS VARCHAR) AS n FROM supplier WHERE s_acctbal >= 0)""",
    "dim_stop": """
        SELECT row_number() OVER (ORDER BY md5(n), n) AS stop_sk, n AS stop_id_nat
        FROM (SELECT cast(p_partkey AS VARCHAR) AS n FROM part)""",
    "dim_fare": """
        SELECT row_number() OVER (ORDER BY md5(n), n) AS fare_product_sk, n AS fare_product_id_nat
        FROM (SELECT DISTINCT event_type AS n FROM events WHERE event_type <> 'signup')""",
    "dim_route": """
        SELECT row_number() OVER (ORDER BY md5(n), n) AS route_sk, n AS route_id_nat, n_name AS route_code,
               concat(n_name, ' line') AS route_name, r_name AS route_type
        FROM (SELECT *, cast(n_nationkey AS VARCHAR) AS n FROM nation
              JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA')""",
    "resolved": f"""
        SELECT t.*, user_sk, route_sk, vehicle_sk, o.stop_sk AS origin_stop_sk, e.stop_sk AS destination_stop_sk,
               fare_product_sk,
               {date_key('start_ts')} AS start_date_key, {time_key('start_ts')} AS start_time_key,
               {date_key('end_ts')} AS end_date_key, {time_key('end_ts')} AS end_time_key,
               cast(date_diff('second', start_ts, end_ts) AS INTEGER) AS trip_duration_sec,
               coalesce(currency_code, 'EUR') AS currency
        FROM trip t
        LEFT JOIN dim_user ON user_id = user_id_nat
        LEFT JOIN dim_route ON route_id = route_id_nat
        LEFT JOIN dim_vehicle ON vehicle_id = vehicle_id_nat
        LEFT JOIN dim_stop o ON origin_stop_id = o.stop_id_nat
        LEFT JOIN dim_stop e ON destination_stop_id = e.stop_id_nat
        LEFT JOIN dim_fare ON fare_product_id = fare_product_id_nat""",
    # The mart and the star queries see only trips of known users and routes.
    "fact": f"""
        SELECT r.*, t.start_ts, date_trunc('hour', t.start_ts) AS start_hour,
               cast(date_diff('second', start_ts, end_ts) AS INTEGER) AS trip_duration_sec,
               distance_meters, fare_amount, trip_status
        FROM trip t JOIN dim_user ON user_id = user_id_nat JOIN dim_route r ON route_id = route_id_nat""",
    "mart": f"""
        SELECT route_id_nat, route_code, route_name, route_type, start_hour,
               count(*) AS trips_total,
               count(*) FILTER (trip_status = 'completed') AS trips_completed,
               count(*) FILTER (trip_status = 'canceled') AS trips_canceled,
               {avg('trip_duration_sec')} AS avg_trip_duration_sec,
               cast(sum(distance_meters) AS DOUBLE) AS total_distance_m,
               {avg('distance_meters')} AS avg_distance_m,
               cast(sum(fare_amount) AS DOUBLE) AS total_fare_amount,
               {avg('fare_amount')} AS avg_fare_amount,
               sum(fare_amount) AS exact_fare
        FROM fact GROUP BY ALL""",
    "star_7": f"""
        SELECT route_code, route_name, route_type, start_hour, count(*) AS trips_total,
               {rnd(avg('trip_duration_sec'), 2)} AS avg_trip_duration_sec,
               {rnd(avg('fare_amount'), 2)} AS avg_fare_amount
        FROM fact WHERE start_ts >= {AS_OF} - INTERVAL 7 DAY GROUP BY ALL""",
    "mart_7": f"""
        SELECT route_code, start_hour,
               trips_total + CASE WHEN route_type = 'AFRICA' THEN 1 ELSE 0 END AS trips_total,
               {rnd('avg_trip_duration_sec', 2)} AS avg_trip_duration_sec,
               {rnd('avg_fare_amount', 2)} AS avg_fare_amount
        FROM mart WHERE route_type <> 'EUROPE' AND start_hour >= {AS_OF} - INTERVAL 7 DAY""",
    "compared": """
        SELECT route_code, start_hour, l.trips_total AS trips_left, r.trips_total AS trips_right,
               l.avg_trip_duration_sec AS duration_left, r.avg_trip_duration_sec AS duration_right,
               l.avg_fare_amount AS fare_left, r.avg_fare_amount AS fare_right
        FROM star_7 l JOIN mart_7 r USING (route_code, start_hour)""",
    "stored": """
        SELECT row_number() OVER (ORDER BY md5(n), n) AS route_sk, n AS route_id_nat, c_name AS route_code,
               c_name AS route_name, cast(c_nationkey AS VARCHAR) AS route_type,
               CASE WHEN c_acctbal >= 500 THEN c_mktsegment END AS description,
               DATE '2024-01-01' AS valid_from, DATE '9999-12-31' AS valid_to
        FROM (SELECT *, cast(c_custkey AS VARCHAR) AS n FROM customer WHERE c_mktsegment <> 'MACHINERY')""",
    "history": """
        SELECT cast(c_custkey AS VARCHAR) AS route_id, c_name AS route_code,
               cast(c_nationkey AS VARCHAR) AS route_type,
               CASE WHEN c_acctbal < 1000 THEN 'new' ELSE c_mktsegment END AS description,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN DATE '2024-01-15'
                    WHEN 'BUILDING' THEN DATE '2023-12-15' ELSE DATE '2024-01-01' END AS valid_from,
               u.route_name, u.src_updated_at
        FROM customer, LATERAL (
            SELECT concat(c_name, '-old') AS route_name, TIMESTAMP '2024-01-10' AS src_updated_at
            UNION ALL
            SELECT CASE WHEN c_nationkey >= 13 THEN concat(c_name, '-v2') ELSE c_name END,
                   TIMESTAMP '2024-01-20') u""",
    "latest": """
        SELECT * FROM history
        QUALIFY row_number() OVER (PARTITION BY route_id ORDER BY src_updated_at DESC) = 1""",
    "changes": """
        SELECT l.*, s.valid_from AS current_from,
               CASE WHEN s.route_id_nat IS NULL THEN 'new' ELSE 'changed' END AS change_kind
        FROM latest l LEFT JOIN stored s ON route_id = route_id_nat
        WHERE s.route_id_nat IS NULL OR l.route_code IS DISTINCT FROM s.route_code
           OR l.route_name IS DISTINCT FROM s.route_name OR l.route_type IS DISTINCT FROM s.route_type
           OR l.description IS DISTINCT FROM s.description OR l.valid_from > s.valid_from""",
    "versions": """
        SELECT route_id AS route_id_nat, route_code, route_name, description, valid_from,
               DATE '9999-12-31' AS valid_to, true AS is_current, current_from
        FROM changes c
        WHERE NOT EXISTS (SELECT 1 FROM stored s
                          WHERE s.route_id_nat = c.route_id AND s.valid_from = c.valid_from)""",
    "snapshot": """
        SELECT s.route_sk, s.route_id_nat, s.route_code, s.route_name, s.description, s.valid_from,
               CASE WHEN v.valid_from IS NOT NULL THEN v.valid_from - 1 ELSE s.valid_to END AS valid_to,
               v.valid_from IS NULL AS is_current
        FROM stored s LEFT JOIN versions v ON s.route_id_nat = v.route_id_nat AND s.valid_to >= v.valid_from
        UNION ALL
        SELECT (SELECT max(route_sk) FROM stored) + row_number() OVER (ORDER BY md5(route_id_nat), route_id_nat),
               route_id_nat, route_code, route_name, description, valid_from, valid_to, is_current
        FROM versions""",
    # Starts of both batches that were not stored before; the keys of the first batch come below those of the second.
    "starts": """
        SELECT 1 AS batch, route_id, route_name, description, valid_from FROM latest
        UNION ALL
        SELECT 2, cast(c_custkey AS VARCHAR), concat(c_name, '-late'), c_mktsegment,
               DATE '2023-06-01' + cast(c_custkey % 400 AS INTEGER)
        FROM customer WHERE c_nationkey < 12""",
    "arrived": """
        SELECT NULL AS batch, route_sk, route_id_nat, route_name, description, valid_from FROM stored
        UNION ALL
        SELECT batch, (SELECT count(*) FROM stored) + row_number() OVER (
                   ORDER BY batch, md5(concat_ws('|', route_id, valid_from)), concat_ws('|', route_id, valid_from)),
               route_id, route_name, description, valid_from
        FROM (SELECT * FROM starts s WHERE NOT EXISTS (
                  SELECT 1 FROM stored o WHERE o.route_id_nat = s.route_id AND o.valid_from = s.valid_from)
              QUALIFY row_number() OVER (PARTITION BY route_id, valid_from ORDER BY batch) = 1)""",
    "nation_versions": """
        SELECT row_number() OVER (PARTITION BY n ORDER BY d) AS version, n, d AS valid_from,
               lead(d, 1, DATE '9999-12-31' + 1) OVER (PARTITION BY n ORDER BY d) - 1 AS valid_to, batch
        FROM (SELECT route_id_nat AS n, DATE '2024-01-05' AS d, 1 AS batch FROM dim_route
              UNION ALL SELECT route_id_nat, DATE '2024-01-16', 2 FROM dim_route WHERE cast(route_id_nat AS INTEGER) % 2 = 0
              UNION ALL SELECT route_id_nat, DATE '2023-12-01', 2 FROM dim_route WHERE route_type = 'AMERICA')""",
    "nation_keys": """
        SELECT n, valid_from, valid_to, route_sk FROM nation_versions JOIN dim_route ON n = route_id_nat WHERE batch = 1
        UNION ALL
        SELECT n, valid_from, valid_to, (SELECT max(route_sk) FROM dim_route) + row_number() OVER (
                   ORDER BY md5(concat_ws('|', n, valid_from)), concat_ws('|', n, valid_from))
        FROM nation_versions WHERE batch = 2""",
    "bridge": """
        SELECT DISTINCT cast(l_orderkey AS VARCHAR) AS route_id, cast(l_partkey AS VARCHAR) AS stop_id
        FROM lineitem""",
    "sequenced": """
        SELECT route_id, stop_id,
               cast(row_number() OVER (PARTITION BY route_id ORDER BY stop_id) AS INTEGER) AS stop_sequence
        FROM bridge""",
    "stop": """
        SELECT cast(p_partkey AS VARCHAR) AS stop_id, p_brand AS stop_code, p_name AS stop_name, p_type AS zone,
               CASE WHEN p_type <> 'PROMO' THEN cast(55 + cast(p_size AS DECIMAL(9,2)) / 100 AS DECIMAL(9,6)) END AS latitude,
               CASE WHEN p_type <> 'PROMO' THEN cast(36 + cast(p_retailprice AS DECIMAL(12,2)) / 1000 AS DECIMAL(9,6)) END AS longitude
        FROM part""",
}
NEEDS = {
    "trip": ["ev"], "pos": ["ev"],
    "resolved": ["trip", "dim_user", "dim_route", "dim_vehicle", "dim_stop", "dim_fare"],
    "fact": ["trip", "dim_user", "dim_route"], "mart": ["fact"], "star_7": ["fact"],
    "mart_7": ["mart"], "compared": ["star_7", "mart_7"], "latest": ["history"],
    "changes": ["latest", "stored"], "versions": ["changes", "stored"],
    "snapshot": ["stored", "versions"], "starts": ["latest"], "arrived": ["stored", "starts"],
    "nation_versions": ["dim_route"], "nation_keys": ["nation_versions"], "sequenced": ["bridge"],
}


def with_roles(*roles: str) -> str:
    """WITH clause of the roles and of the roles they need."""
    ordered: dict[str, None] = {}

    def add(role: str) -> None:
        for needed in NEEDS.get(role, []):
            add(needed)
        ordered[role] = None

    for role in roles:
        add(role)
    return "WITH " + ",\n".join(f"{r} AS ({CTE[r]})" for r in ordered) + "\n"


ORACLE: dict[str, str] = {}


def oracle(name: str, sql: str, *roles: str) -> None:
    ORACLE[name] = (with_roles(*roles) if roles else "") + sql


STAMPS = "cast(NULL AS TIMESTAMP) AS src_created_at, cast(NULL AS TIMESTAMP) AS src_updated_at"
NO_TEXT = "cast(NULL AS VARCHAR)"


def stage(name: str, columns: str, source: str, *roles: str, src_system: str = "oltp") -> None:
    oracle("stage_" + name, f"SELECT {columns}, '{src_system}' AS src_system, 'b1' AS etl_batch_id FROM {source}", *roles)


stage("user", f"""cast(c_custkey AS VARCHAR) AS user_id, {NO_TEXT} AS email, {NO_TEXT} AS phone, c_name AS full_name,
      cast(NULL AS TIMESTAMP) AS registration_ts, c_mktsegment AS status, {STAMPS}""", "customer")
stage("vehicle", f"""cast(s_suppkey AS VARCHAR) AS vehicle_id, s_name AS registration_number,
      {NO_TEXT} AS vehicle_type, s_nationkey AS capacity, {NO_TEXT} AS operator_name, {STAMPS}""",
      "supplier", src_system="oltp_or_stream")
stage("stop", f"stop_id, stop_code, stop_name, {NO_TEXT} AS city, latitude, longitude, zone, {STAMPS}", "stop", "stop")
stage("fare_product", f"""event_type AS fare_product_id, upper(event_type) AS product_name, {NO_TEXT} AS fare_type,
      {NO_TEXT} AS currency_code, cast(max_value AS DECIMAL(10,2)) AS base_price, {NO_TEXT} AS description, {STAMPS}""",
      "(SELECT event_type, max(value) AS max_value FROM events GROUP BY event_type)")
stage("route", f"""route_id, route_code, route_name, route_type, description, {NO_TEXT} AS route_pattern_hash,
      {NO_TEXT} AS default_fare_product_id, cast(valid_from AS TIMESTAMP) AS valid_from_ts,
      cast(NULL AS TIMESTAMP) AS valid_to_ts, true AS is_active,
      cast(NULL AS TIMESTAMP) AS src_created_at, src_updated_at""", "history", "history")
stage("trip", """trip_id, user_id, route_id, vehicle_id, origin_stop_id, destination_stop_id, start_ts, end_ts,
      distance_meters, fare_product_id, fare_amount, currency_code, trip_status, created_at,
      cast(NULL AS TIMESTAMP) AS updated_at""", "trip", "trip")
stage("payment", f"""payment_id, user_id, {NO_TEXT} AS fare_product_id, payment_method, amount,
      {NO_TEXT} AS currency_code, payment_status, {NO_TEXT} AS external_txn_id, created_at,
      cast(NULL AS TIMESTAMP) AS updated_at""", "pay", "pay")
stage("vehicle_position", """raw_event_id, vehicle_id, route_id, event_ts, latitude, longitude, speed_kmph,
      heading_deg, nearest_stop_id, partition_id, offset_in_partition""", "pos", "pos",
      src_system="kafka_vehicle_positions")
oracle("stage_batch_filter", "SELECT trip_id, 'b1' AS etl_batch_id FROM trip WHERE start_ts < TIMESTAMP '2024-01-16'", "trip")

oracle("scalar_date_keys", f"SELECT event_id AS trip_id, {date_key('ts')} AS start_date_key, {time_key('ts')} AS start_time_key FROM events")
oracle("scalar_duration", """SELECT l_orderkey, l_linenumber,
       cast(date_diff('second', o_orderdate, l_shipdate) AS INTEGER) AS duration_sec
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
oracle("scalar_key_to_timestamp", """SELECT event_id AS trip_id,
       CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS start_ts,
       CASE WHEN event_type <> 'error' THEN date_trunc('hour', ts) END AS start_hour FROM events""")
oracle("scalar_week_start", """SELECT event_id, cast(date_trunc('week', ts) AS DATE) AS week_monday,
       cast(ts AS DATE) - cast(dayofweek(ts) AS INTEGER) AS week_sunday FROM events""")
oracle("scalar_coerce", """SELECT p_partkey, try_cast(p_name AS DOUBLE) AS n1,
       try_cast(cast(p_size AS VARCHAR) AS DOUBLE) AS n2 FROM part""")

CALENDAR = f"""{date_key('d')} AS date_key, cast(d AS DATE) AS full_date, cast(year(d) AS SMALLINT) AS year,
       cast(quarter(d) AS SMALLINT) AS quarter, cast(month(d) AS SMALLINT) AS month, monthname(d) AS month_name,
       cast(week(d) AS SMALLINT) AS week_of_year, cast(day(d) AS SMALLINT) AS day_of_month,
       cast(isodow(d) AS SMALLINT) AS day_of_week, dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend"""
oracle("dim_date", f"""SELECT {CALENDAR} FROM (SELECT unnest(generate_series(
       (SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS d)""")
oracle("dim_date_insert", f"""SELECT {CALENDAR} FROM (
       SELECT cast(o_orderdate AS DATE) AS d FROM orders UNION SELECT cast(ts AS DATE) FROM events)
       WHERE d NOT BETWEEN DATE '2023-01-01' AND DATE '2027-12-31'""")
oracle("dim_time", f"""SELECT {time_key('s')} AS time_key, strftime(s, '%H:%M:%S') AS full_time,
       cast(hour(s) AS SMALLINT) AS hour, cast(minute(s) AS SMALLINT) AS minute,
       cast(second(s) AS SMALLINT) AS second, coalesce(trips, 0) AS trips
       FROM (SELECT unnest(generate_series(TIMESTAMP '2000-01-01 00:00:00', TIMESTAMP '2000-01-01 23:59:59',
                                           INTERVAL 1 SECOND)) AS s)
       LEFT JOIN (SELECT {time_key('ts')} AS tk, count(*) AS trips FROM events GROUP BY 1) ON tk = {time_key('s')}""")

oracle("latest_by_key", """SELECT user_id, event_id, ts, event_type FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
oracle("dim_user_insert", """SELECT cast(c_custkey AS VARCHAR) AS user_id_nat, c_name AS full_name,
       cast(NULL AS DATE) AS registration_dt, c_mktsegment AS status FROM customer WHERE c_acctbal < 0""")
oracle("dim_vehicle_insert", """SELECT cast(s_suppkey AS VARCHAR) AS vehicle_id_nat,
       s_name AS registration_number, s_nationkey AS capacity FROM supplier WHERE s_acctbal < 0""")
oracle("dim_stop_insert", """SELECT stop_id AS stop_id_nat, stop_code, stop_name, latitude, longitude, zone
       FROM stop WHERE stop_id NOT IN (SELECT destination_stop_id FROM trip)""", "stop", "trip")
oracle("dim_fare_insert", """SELECT event_type AS fare_product_id_nat, upper(event_type) AS product_name,
       'EUR' AS currency_code, cast(max(value) AS DECIMAL(10,2)) AS base_price
       FROM events WHERE event_type = 'signup' GROUP BY event_type""")
oracle("dim_user_keys", """SELECT user_sk, user_id_nat FROM dim_user
       UNION ALL
       SELECT (SELECT max(user_sk) FROM dim_user) + row_number() OVER (ORDER BY md5(n), n), n
       FROM (SELECT cast(c_custkey AS VARCHAR) AS n FROM customer WHERE c_acctbal < 0)""", "dim_user")

oracle("fact_trip", """SELECT trip_id, user_sk, route_sk, vehicle_sk, origin_stop_sk, destination_stop_sk,
       start_date_key, start_time_key, end_date_key, end_time_key, fare_product_sk, trip_duration_sec,
       distance_meters, fare_amount, currency AS currency_code, trip_status, created_at
       FROM resolved WHERE user_sk IS NOT NULL AND route_sk IS NOT NULL""", "resolved")
oracle("fact_trip_roles", "SELECT trip_id, origin_stop_sk, destination_stop_sk FROM resolved", "resolved")
oracle("fact_payment", f"""SELECT payment_id, user_sk, cast(NULL AS BIGINT) AS fare_product_sk,
       {date_key('created_at')} AS payment_date_key, {time_key('created_at')} AS payment_time_key,
       payment_method, amount, 'EUR' AS currency_code, payment_status, {NO_TEXT} AS external_txn_id, created_at
       FROM pay JOIN dim_user ON user_id = user_id_nat""", "pay", "dim_user")
oracle("fact_vehicle_position", f"""SELECT raw_event_id, vehicle_sk, route_sk, {date_key('event_ts')} AS date_key,
       {time_key('event_ts')} AS time_key, latitude, longitude, speed_kmph, heading_deg, stop_sk AS nearest_stop_sk
       FROM pos JOIN dim_vehicle ON vehicle_id = vehicle_id_nat LEFT JOIN dim_route ON route_id = route_id_nat
       LEFT JOIN dim_stop ON nearest_stop_id = stop_id_nat""", "pos", "dim_vehicle", "dim_route", "dim_stop")
oracle("fact_rejects", """SELECT trip_id, CASE WHEN user_sk IS NULL THEN 'user_sk' ELSE 'route_sk' END AS reject_reason
       FROM resolved WHERE user_sk IS NULL OR route_sk IS NULL""", "resolved")

oracle("fact_trip_redelivered", """SELECT trip_id, batch AS etl_batch_id,
       cast(fare_amount + CASE WHEN batch = 'b2' THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS fare_amount,
       batch = 'b1' AND trip_status = 'completed' AS superseded
       FROM resolved, (VALUES ('b1'), ('b2')) batches(batch)
       WHERE user_sk IS NOT NULL AND route_sk IS NOT NULL AND (batch = 'b1' OR trip_status = 'completed')""", "resolved")

oracle("scd2_latest", "SELECT route_id, route_name, description, valid_from FROM latest", "latest")
oracle("scd2_change_set", "SELECT route_id AS route_id_nat, change_kind FROM changes", "changes")
oracle("scd2_change_set_strict", """SELECT route_id AS route_id_nat,
       CASE WHEN s.route_id_nat IS NULL THEN 'new' ELSE 'changed' END AS change_kind
       FROM latest l LEFT JOIN stored s ON route_id = route_id_nat
       WHERE s.route_id_nat IS NULL OR l.route_code <> s.route_code OR l.route_name <> s.route_name
          OR l.route_type <> s.route_type OR l.description <> s.description OR l.valid_from > s.valid_from""",
       "latest", "stored")
VERSION = "route_id_nat, route_name, description, valid_from, valid_to, is_current"
oracle("scd2_new_versions", f"SELECT {VERSION} FROM versions", "versions")
oracle("scd2_new_versions_in_order",
       f"SELECT {VERSION} FROM versions WHERE current_from IS NULL OR valid_from >= current_from", "versions")
oracle("scd2_snapshot", f"SELECT route_sk, {VERSION} FROM snapshot", "snapshot")
oracle("dim_route_current", "SELECT route_id_nat, route_code, route_name, valid_from FROM snapshot WHERE is_current", "snapshot")
oracle("scd2_asof_lookup", """SELECT trip_id, route_sk FROM trip LEFT JOIN snapshot
       ON user_id = route_id_nat AND cast(start_ts AS DATE) BETWEEN valid_from AND valid_to""", "trip", "snapshot")

oracle("scd2_late_versions", """SELECT route_sk, route_id_nat, route_name, description, valid_from,
       lead(valid_from - 1, 1, DATE '9999-12-31') OVER (PARTITION BY route_id_nat ORDER BY valid_from) AS valid_to,
       lead(valid_from) OVER (PARTITION BY route_id_nat ORDER BY valid_from) IS NULL AS is_current
       FROM arrived""", "arrived")
oracle("fact_trip_asof", f"""SELECT trip_id, user_sk, k.route_sk, {date_key('start_ts')} AS start_date_key, trip_status,
       CASE WHEN user_sk IS NULL THEN 'user_sk' WHEN k.route_sk IS NULL THEN 'route_sk' END AS reject_reason
       FROM trip t LEFT JOIN dim_user ON user_id = user_id_nat
       LEFT JOIN nation_keys k ON t.route_id = k.n AND cast(start_ts AS DATE) BETWEEN k.valid_from AND k.valid_to""",
       "trip", "dim_user", "nation_keys")

oracle("mart_route_hour", f"""SELECT route_id_nat, route_code, route_name, route_type, start_hour, trips_total,
       trips_completed, trips_canceled, total_distance_m, total_fare_amount,
       {rnd('avg_trip_duration_sec', 4)} AS avg_trip_duration_sec, {rnd('avg_distance_m', 4)} AS avg_distance_m,
       {rnd('avg_fare_amount', 4)} AS avg_fare_amount FROM mart""", "mart")
oracle("mart_incremental", f"""SELECT route_id_nat, route_code, route_name, route_type, start_hour, count(*) AS trips_total,
       count(*) FILTER (trip_status = 'completed') AS trips_completed,
       count(*) FILTER (trip_status = 'canceled') AS trips_canceled,
       cast(sum(distance_meters) AS DOUBLE) AS total_distance_m, cast(sum(fare_amount) AS DOUBLE) AS total_fare_amount,
       {rnd(avg('trip_duration_sec'), 4)} AS avg_trip_duration_sec, {rnd(avg('distance_meters'), 4)} AS avg_distance_m,
       {rnd(avg('fare_amount'), 4)} AS avg_fare_amount
       FROM fact WHERE start_ts >= TIMESTAMP '2024-01-16' OR trip_status <> 'canceled' GROUP BY ALL""", "fact")
oracle("mart_replace_by_key", """SELECT route_id_nat, start_hour,
       trips_total + CASE WHEN route_type = 'AMERICA' THEN 1 ELSE 0 END AS trips_total FROM mart""", "mart")
oracle("mart_latest", f"""SELECT route_code, start_hour, trips_total,
       {rnd('avg_trip_duration_sec', 4)} AS avg_trip_duration_sec, total_fare_amount
       FROM mart ORDER BY start_hour DESC, route_code LIMIT 10""", "mart")


def route_hour(days: int, limit: int, digits: tuple[int, int, int]) -> str:
    a, b, c = digits
    return f"""SELECT route_code, route_name, route_type, start_hour, trips_total, trips_completed, trips_canceled,
       {rnd('avg_trip_duration_sec', a)} AS avg_trip_duration_sec, {rnd('avg_distance_m', b)} AS avg_distance_m,
       {rnd('avg_fare_amount', c)} AS avg_fare_amount
       FROM mart WHERE start_hour >= {AS_OF} - INTERVAL {days} DAY
       ORDER BY start_hour DESC, route_code LIMIT {limit}"""


# The window begins on a full hour, so the star gives the same rows as the mart.
oracle("route_hour_7d", route_hour(7, 200, (1, 1, 2)), "mart")
oracle("dwh_route_hour", route_hour(7, 200, (1, 1, 2)), "mart")
oracle("route_hour_param", route_hour(3, 50, (2, 2, 2)), "mart")
oracle("dwh_route_hour_param", route_hour(3, 50, (2, 2, 2)), "mart")


def peak(source: str, trips: str, at: str) -> str:
    share = "trips / nullif(sum(trips) OVER (PARTITION BY route_type), 0)"
    return f"""SELECT route_type, hour, trips, {rnd(share, 3)} AS share_in_type FROM (
       SELECT route_type, cast(hour({at}) AS INTEGER) AS hour, cast({trips} AS BIGINT) AS trips
       FROM {source} WHERE {at} >= {AS_OF} - INTERVAL 7 DAY GROUP BY ALL)"""


oracle("peak_hour_share", peak("mart", "sum(trips_total)", "start_hour"), "mart")
oracle("dwh_peak_hour_share", peak("fact", "count(*)", "start_ts"), "fact")


def trend(source: str, at: str, week: str, fare: str, canceled: str, total: str) -> str:
    return f"""SELECT route_code, week_start, fare_sum, canceled, total,
       {rnd('canceled / nullif(total, 0)', 3)} AS cancel_rate FROM (
       SELECT route_code, {week} AS week_start, cast(sum({fare}) AS DOUBLE) AS fare_sum,
              cast({canceled} AS BIGINT) AS canceled, cast({total} AS BIGINT) AS total
       FROM {source} WHERE {at} >= {AS_OF} - INTERVAL 56 DAY GROUP BY ALL)"""


oracle("weekly_trend", trend("mart", "start_hour", "cast(start_hour AS DATE) - cast(dayofweek(start_hour) AS INTEGER)",
                             "exact_fare", "sum(trips_canceled)", "sum(trips_total)"), "mart")
oracle("dwh_weekly_trend", trend("fact", "start_ts", "cast(date_trunc('week', start_ts) AS DATE)", "fare_amount",
                                 "count(*) FILTER (trip_status = 'canceled')", "count(*)"), "fact")

oracle("reconcile_route_hour", f"""SELECT route_code, start_hour, trips_left - trips_right AS trips_diff,
       {rnd('fare_left - fare_right', 2)} AS fare_diff, {rnd('duration_left - duration_right', 2)} AS duration_diff
       FROM compared""", "compared")
oracle("reconcile_full", """SELECT route_code, start_hour,
       CASE WHEN r.trips_total IS NULL THEN 'left_only' WHEN l.trips_total IS NULL THEN 'right_only'
            ELSE 'matched' END AS status, l.trips_total - r.trips_total AS trips_diff
       FROM star_7 l FULL JOIN mart_7 r USING (route_code, start_hour)""", "compared")
oracle("reconcile_buckets", """SELECT route_code, start_hour,
       CASE WHEN twice THEN 'duplicate' WHEN r.trips_total IS NULL THEN 'left_only' ELSE 'different' END AS status,
       cast(1 AS BIGINT) AS n_left, cast(CASE WHEN r.trips_total IS NULL THEN 0 WHEN twice THEN 2 ELSE 1 END AS BIGINT) AS n_right,
       l.trips_total AS trips_total_left, CASE WHEN NOT twice THEN r.trips_total END AS trips_total_right
       FROM (SELECT *, route_type = 'MIDDLE EAST' AS twice FROM star_7) l LEFT JOIN mart_7 r USING (route_code, start_hour)
       WHERE twice OR r.trips_total IS NULL OR l.trips_total <> r.trips_total""", "compared")
oracle("hourly_compare", """SELECT start_hour, cast(sum(trips_left) AS BIGINT) AS trips_left,
       cast(sum(trips_right) AS BIGINT) AS trips_right
       FROM compared GROUP BY start_hour ORDER BY start_hour DESC LIMIT 48""", "compared")


def exact_mean(column: str) -> str:
    return f"{rnd(avg(f'cast({column} AS DECIMAL(24,8))'), 4)} AS {column}"


oracle("route_diff", f"""SELECT route_code, cast(sum(trips_left) AS BIGINT) AS trips_left,
       cast(sum(trips_right) AS BIGINT) AS trips_right,
       cast(sum(trips_left) - sum(trips_right) AS BIGINT) AS trips_diff,
       {exact_mean('fare_left')}, {exact_mean('fare_right')}, {exact_mean('duration_left')}, {exact_mean('duration_right')}
       FROM compared GROUP BY route_code""", "compared")

oracle("dq_not_null", """SELECT 'user_sk' AS column_name, count(*) FILTER (user_sk IS NULL) AS violations FROM resolved
       UNION ALL SELECT 'route_sk', count(*) FILTER (route_sk IS NULL) FROM resolved
       UNION ALL SELECT 'vehicle_sk', count(*) FILTER (vehicle_sk IS NULL) FROM resolved
       UNION ALL SELECT 'start_ts', count(*) FILTER (start_ts IS NULL) FROM resolved""", "resolved")
oracle("dq_unique", """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
oracle("dq_foreign_key", """SELECT 'trip_destination_stop' AS check_name, count(*) AS violations
       FROM trip WHERE destination_stop_id NOT IN (SELECT stop_id_nat FROM dim_stop)
       UNION ALL
       SELECT 'payment_date', count(*) FROM orders
       WHERE cast(o_orderdate AS DATE) NOT BETWEEN DATE '2023-01-01' AND DATE '2027-12-31'""", "trip", "dim_stop")
oracle("dq_length", "SELECT p_partkey, cast(length(p_name) AS INTEGER) AS len FROM part WHERE length(p_name) > 10")
oracle("dq_precision", """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
       WHERE round(l_extendedprice, 2) > 99999.99""")
oracle("dq_gate_counts", """SELECT (SELECT count(*) FROM fact) AS fact_rows,
       (SELECT count(*) FROM snapshot WHERE is_current) AS current_routes,
       (SELECT count(*) FROM fact WHERE route_sk IS NULL) AS null_route_keys,
       (SELECT count(*) FROM mart) AS mart_rows,
       (SELECT count(*) FROM fact) > 0 AND (SELECT count(*) FROM mart) > 0 AS passed""", "mart", "snapshot")

oracle("route_stop_sequence", "SELECT route_id, stop_id, stop_sequence FROM sequenced", "sequenced")
oracle("route_pattern_hash", r"""SELECT route_id, concat(substr(h, 1, 12), '5', substr(h, 14, 3),
       substr('89ab', (('0x' || substr(h, 17, 1))::INTEGER & 3) + 1, 1), substr(h, 18, 15)) AS pattern_hash
       FROM (SELECT route_id, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8')
                    || encode(string_agg(stop_id, ',' ORDER BY stop_id))) AS h
             FROM bridge GROUP BY route_id)""", "bridge")
oracle("route_geometry", f"""SELECT route_id, {rnd(avg('latitude'), 6)} AS center_lat,
       {rnd(avg('longitude'), 6)} AS center_lon, min(stop_id) AS first_stop, max(stop_id) AS last_stop
       FROM bridge LEFT JOIN stop USING (stop_id) GROUP BY route_id""", "bridge", "stop")
oracle("position_dedup", """SELECT raw_event_id, offset_in_partition AS event_id, vehicle_id, route_id, event_ts, latitude,
       longitude, speed_kmph, heading_deg, nearest_stop_id, partition_id
       FROM pos QUALIFY row_number() OVER (PARTITION BY raw_event_id ORDER BY offset_in_partition) = 1""", "pos")


def draw(purpose: str) -> str:
    return f"cast('0x' || substr(md5('{purpose}:' || trip_id), 1, 4) AS INTEGER)"


oracle("payments_from_trips", f"""SELECT concat('PAY-', trip_id) AS payment_id, user_id, fare_product_id,
       ['card', 'apple_pay', 'google_pay', 'cash'][{draw('method')} % 4 + 1] AS payment_method,
       fare_amount AS amount, 'success' AS payment_status, md5('txn:' || trip_id) AS external_txn_id,
       start_ts - to_minutes({draw('early')} % 6) AS created_at,
       start_ts - to_minutes({draw('early')} % 6) + to_minutes({draw('delay')} % 6) AS updated_at
       FROM trip WHERE trip_status = 'completed' AND {draw('paid')} < 62259""", "trip")
