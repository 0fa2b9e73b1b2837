"""For each query the same result in plain SQL over the given tables, written independently.

Sums are of whole numbers and are rounded once, so that both engines compute the same values.
"""

from __future__ import annotations

from tripmill.plans.queries import (
    AS_OF,
    CHANGE_CUT,
    LINE_KEY,
    LINE_ORDER,
    PII_SALT,
    REDELIVERED_FROM,
    RETENTION_DAYS,
    SUMMARY_DAYS,
    VIEW_FROM,
)


def nearest(x: str) -> str:
    return f"CAST(CASE WHEN ({x}) < 0 THEN -floor(0.5 - ({x})) ELSE floor(({x}) + 0.5) END AS BIGINT)"


def mean(total: str, n: str, digits: int = 0) -> str:
    value = f"CAST({nearest(f'CAST({total} AS DOUBLE) / CAST(nullif({n}, 0) AS DOUBLE)')} AS DOUBLE)"
    return f"{value} / {float(10**digits)}::DOUBLE" if digits else value


def total(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


def cents(x: str) -> str:
    return f"CAST({x} AS DOUBLE) / 100::DOUBLE"


def short_key(text: str) -> str:
    return f"substr(sha256({text}), 1, 32)"


RIDES = """
per_order AS (
    SELECT l_orderkey, min(l_suppkey) AS driver, sum(l_quantity) AS quantity
    FROM lineitem GROUP BY l_orderkey
),
rides AS (
    SELECT
        o_orderkey AS k,
        CAST(o_orderkey AS VARCHAR) AS ride_id,
        CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS rider_id,
        CAST(driver AS VARCHAR) AS driver_id,
        CASE WHEN o_orderkey % 89 = 0 THEN 600000
             ELSE CAST(coalesce(quantity, 0) * 100 AS BIGINT) END AS distance_meters,
        CAST(floor(o_totalprice / 4) AS BIGINT) * CASE WHEN o_orderkey % 83 = 0 THEN -1 ELSE 1 END
            AS fare_cents,
        CASE WHEN o_orderkey % 103 = 0 THEN 6.0::DOUBLE
             ELSE 1.0::DOUBLE + 0.25::DOUBLE * (o_orderkey % 5) END AS surge_multiplier,
        CASE WHEN o_orderkey % 113 = 0 THEN 95.0::DOUBLE
             ELSE 37.7::DOUBLE + CAST(o_custkey % 1000 AS DOUBLE) / 10000 END AS pickup_lat,
        -122.5::DOUBLE + CAST(o_custkey % 700 AS DOUBLE) / 10000 AS pickup_lon,
        CASE WHEN o_orderkey % 109 = 0 THEN pickup_lat
             ELSE 37.7::DOUBLE + CAST(o_orderkey * 7 % 1000 AS DOUBLE) / 10000 END AS dropoff_lat,
        CASE WHEN o_orderkey % 109 = 0 THEN pickup_lon
             ELSE -122.5::DOUBLE + CAST(o_orderkey * 3 % 700 AS DOUBLE) / 10000 END AS dropoff_lon,
        o_orderstatus AS order_status,
        o_orderdate + to_minutes(o_orderkey * 37 % 1440) AS requested_at,
        CASE o_orderkey % 3 WHEN 0 THEN 'no_drivers' WHEN 1 THEN 'changed_mind' END AS reason
    FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey
)"""

BRONZE = RIDES + """,
planned AS (
    SELECT *, 'ride_requested' AS event_type, 0 AS minutes FROM rides
    UNION ALL SELECT *, 'ride_accepted', 3 FROM rides WHERE driver_id IS NOT NULL
    UNION ALL SELECT *, 'ride_started', 8 FROM rides
        WHERE driver_id IS NOT NULL AND order_status IN ('F', 'O') AND k % 101 <> 0
    UNION ALL SELECT rides.*, 'gps_update', m FROM rides, (VALUES (10), (12)) v(m)
        WHERE driver_id IS NOT NULL AND order_status IN ('F', 'O') AND k % 101 <> 0
    UNION ALL SELECT *, 'ride_completed', 18 + k % 50 FROM rides
        WHERE driver_id IS NOT NULL AND order_status = 'F'
    UNION ALL SELECT *, 'ride_cancelled', 5 FROM rides WHERE order_status = 'P'
),
delivered AS (
    SELECT *, 0 AS delay FROM planned
    UNION ALL SELECT *, k % 10 FROM planned WHERE k % 10 IN (0, 1)
),
timed AS (
    SELECT *, requested_at + to_minutes(CAST(minutes + delay AS BIGINT)) AS event_timestamp
    FROM delivered
),
stamped AS (
    SELECT *, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS "timestamp" FROM timed
),
bronze AS (
    SELECT
        substr(sha256(CASE WHEN k % 107 = 0 THEN 'x' ELSE '' END
               || ride_id || ':' || event_type || ':' || "timestamp"), 1, 32) AS event_id,
        ride_id,
        event_type,
        "timestamp",
        event_timestamp,
        CASE WHEN event_type NOT IN ('gps_update', 'ride_cancelled') THEN rider_id END AS rider_id,
        CASE WHEN event_type IN ('ride_accepted', 'ride_started', 'ride_completed')
             THEN driver_id END AS driver_id,
        CASE event_type WHEN 'ride_requested' THEN pickup_lat
             WHEN 'gps_update' THEN (pickup_lat + dropoff_lat) / 2 END AS latitude,
        CASE event_type WHEN 'ride_requested' THEN pickup_lon
             WHEN 'gps_update' THEN (pickup_lon + dropoff_lon) / 2 END AS longitude,
        CASE WHEN event_type = 'ride_completed' THEN fare_cents ELSE 0 END AS fare_cents,
        CASE WHEN event_type = 'ride_completed' THEN distance_meters ELSE 0 END AS distance_meters,
        CASE WHEN event_type = 'ride_completed' THEN surge_multiplier ELSE 1 END
            AS surge_multiplier,
        CASE WHEN event_type = 'ride_cancelled' THEN reason END AS cancel_reason,
        k, pickup_lat, pickup_lon, dropoff_lat, dropoff_lon
    FROM stamped
)"""


def silver_cte(key: str) -> str:
    km100 = nearest("CAST(distance_meters AS DOUBLE) / 10")
    return BRONZE + f""",
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY event_timestamp, event_id) AS rn
    FROM bronze
),
silver AS (
    SELECT * EXCLUDE (rn, distance_meters), CAST(distance_meters AS DOUBLE) AS distance_meters,
        {km100} AS km100, {cents(km100)} AS distance_km, {cents("fare_cents")} AS fare_usd
    FROM ranked WHERE rn = 1
),
done AS (SELECT * FROM silver WHERE event_type = 'ride_completed')"""


SILVER = silver_cte("ride_id, event_type")
SILVER_BY_TS = silver_cte("ride_id, event_type, event_timestamp")

SILVER_LIST = (
    "event_id, ride_id, event_type, event_timestamp, rider_id, driver_id, latitude, longitude, "
    "fare_cents, distance_meters, distance_km, fare_usd"
)
MEAN_FARE_USD = mean("sum(fare_cents)", "count(fare_cents)", 2)
MEAN_KM = mean("sum(km100)", "count(km100)", 2)
MEAN_SURGE = mean(f"sum({nearest('surge_multiplier * 100')})", "count(surge_multiplier)", 2)

HOURLY = f"""
    SELECT date_trunc('hour', event_timestamp) AS metric_hour,
        count(*) AS rides_completed_count,
        {mean("sum(fare_cents)", "count(fare_cents)")} AS avg_fare_cents,
        {MEAN_KM} AS avg_distance_km,
        {cents("sum(fare_cents)")} AS total_revenue_usd,
        min(event_timestamp) AS window_start,
        max(event_timestamp) AS window_end
    FROM done WHERE fare_cents IS NOT NULL GROUP BY 1"""

DRIVERS = f"""
    SELECT driver_id,
        count(DISTINCT ride_id) AS rides_completed,
        {cents("sum(fare_cents)")} AS total_earnings_usd,
        {MEAN_FARE_USD} AS avg_fare_usd,
        {cents("sum(km100)")} AS total_distance_km,
        {MEAN_KM} AS avg_distance_km,
        min(event_timestamp) AS first_ride_at,
        max(event_timestamp) AS last_ride_at
    FROM done WHERE driver_id IS NOT NULL GROUP BY driver_id"""

PASSENGERS = f"""
    SELECT rider_id AS passenger_id,
        count(DISTINCT ride_id) AS rides_taken,
        {cents("sum(fare_cents)")} AS total_spent_usd,
        {MEAN_FARE_USD} AS avg_fare_usd,
        {MEAN_KM} AS avg_distance_km,
        count(DISTINCT CAST(event_timestamp AS DATE)) AS active_days,
        count(DISTINCT ride_id) > 1 AS is_repeat_rider,
        {cents(nearest("CAST(count(DISTINCT ride_id) AS DOUBLE)"
                       " / count(DISTINCT CAST(event_timestamp AS DATE)) * 100"))}
            AS rides_per_active_day,
        min(event_timestamp) AS first_ride_at,
        max(event_timestamp) AS last_ride_at
    FROM done WHERE rider_id IS NOT NULL GROUP BY rider_id"""

SUMMARY = f"""
    SELECT CAST(event_timestamp AS DATE) AS ride_date, driver_id, rider_id AS passenger_id,
        count(DISTINCT ride_id) AS rides_completed,
        {mean("sum(fare_cents)", "count(fare_cents)")} AS avg_fare_cents,
        {MEAN_FARE_USD} AS avg_fare_usd,
        {cents("sum(km100)")} AS total_distance_km,
        {MEAN_KM} AS avg_distance_km,
        {total("fare_cents")} AS total_revenue_cents
    FROM done GROUP BY ALL"""


def daily(who: str) -> str:
    return f"""WITH {SILVER}
    SELECT {who}, CAST(event_timestamp AS DATE) AS metric_date,
        count(*) AS total_rides,
        {total("distance_meters")} AS total_distance_meters,
        {total("fare_cents")} AS total_fare_cents,
        {MEAN_SURGE} AS avg_surge_multiplier
    FROM done WHERE {who} IS NOT NULL GROUP BY ALL
    ORDER BY total_fare_cents DESC, metric_date, {who}"""


ONCE = "WITH " + SILVER
LINES = f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY {", ".join(LINE_KEY)} ORDER BY {", ".join(LINE_ORDER)}) AS rn
        FROM lineitem) WHERE rn = 1"""

TRIPS = SILVER + """,
trips AS (
    SELECT done.* EXCLUDE (pickup_lat, pickup_lon, dropoff_lat, dropoff_lon),
        rides.pickup_lat, rides.pickup_lon, rides.dropoff_lat, rides.dropoff_lon
    FROM done JOIN rides USING (ride_id)
),
lines AS (
    SELECT *,
        sin((radians(dropoff_lat) - radians(pickup_lat)) / 2) ** 2
        + cos(radians(pickup_lat)) * cos(radians(dropoff_lat))
        * sin((radians(dropoff_lon) - radians(pickup_lon)) / 2) ** 2 AS a,
        2 * 6371.0::DOUBLE * atan2(sqrt(a), sqrt(1 - a)) AS line_km,
        """ + nearest("line_km * 100") + """ AS line100
    FROM trips
)"""

PRICED = TRIPS + """,
service AS (
    SELECT *, CASE WHEN surge_multiplier BETWEEN 1 AND 5
        THEN 250 + CAST(ceil(distance_km * 150::DOUBLE * surge_multiplier) AS BIGINT) END AS fare
    FROM trips
),
floored AS (
    SELECT *, greatest(250 + CAST(ceil(distance_km * 150::DOUBLE * surge_multiplier) AS BIGINT), 500)
        AS fare
    FROM trips
)"""

OUTCOMES = SILVER + """,
outcomes AS (
    SELECT ride_id, max(rider_id) AS rider_id, max(driver_id) AS driver_id,
        max(event_timestamp) FILTER (event_type = 'ride_requested') AS requested_at,
        max(event_timestamp) FILTER (event_type = 'ride_started') AS started_at,
        max(event_timestamp) FILTER (event_type = 'ride_completed') AS completed_at,
        max(event_timestamp) FILTER (event_type = 'ride_cancelled') AS cancelled_at,
        max(distance_meters) FILTER (event_type = 'ride_completed') AS distance_meters,
        max(km100) FILTER (event_type = 'ride_completed') AS km100,
        max(fare_cents) FILTER (event_type = 'ride_completed') AS fare_cents,
        min(event_timestamp) FILTER (driver_id IS NOT NULL) AS driver_from,
        max(event_timestamp) FILTER (driver_id IS NOT NULL) AS driver_to,
        date_diff('second', started_at, completed_at) AS seconds
    FROM silver GROUP BY ride_id
)"""

CHANGES = f"""
log AS (
    SELECT CAST(o_custkey AS VARCHAR) AS driver_id, o_orderdate AS changed_at, o_orderkey AS entry,
        o_orderpriority AS vehicle_type, o_orderstatus <> 'P' AS active_flag
    FROM orders
),
days AS (
    SELECT driver_id, CAST(changed_at AS DATE) AS effective_date, vehicle_type, active_flag
    FROM log QUALIFY row_number() OVER (
        PARTITION BY driver_id, CAST(changed_at AS DATE) ORDER BY changed_at DESC, entry DESC) = 1
),
marked AS (
    SELECT *, lag(vehicle_type) OVER w AS old_type, lag(active_flag) OVER w AS old_flag
    FROM days WINDOW w AS (PARTITION BY driver_id ORDER BY effective_date)
),
kept AS (
    SELECT driver_id, vehicle_type, active_flag, effective_date
    FROM marked WHERE old_type IS DISTINCT FROM vehicle_type OR old_flag IS DISTINCT FROM active_flag
),
drivers AS (
    SELECT {short_key("driver_id || '|' || CAST(effective_date AS VARCHAR)")} AS driver_key,
        driver_id, vehicle_type, active_flag, effective_date,
        lead(effective_date) OVER (PARTITION BY driver_id ORDER BY effective_date) AS end_date,
        end_date IS NULL AS is_current
    FROM kept
),
riders AS (
    SELECT {short_key("driver_id")} AS rider_key, driver_id AS rider_id, vehicle_type, active_flag,
        CAST(min(changed_at) OVER (PARTITION BY driver_id) AS DATE) AS account_created_date,
        changed_at AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
    FROM log QUALIFY row_number() OVER (
        PARTITION BY driver_id ORDER BY changed_at DESC, entry DESC) = 1
)"""


def cell(lat: str, lon: str, n: int) -> str:
    return (
        f"(CAST(floor(({lat} + 90) * {n}) AS BIGINT) * {360 * n + 1}"
        f" + CAST(floor(({lon} + 180) * {n}) AS BIGINT))"
    )


def surge(n: int, bucket: str) -> str:
    return f"""{ONCE}
    SELECT {cell("latitude", "longitude", n)} AS cell,
        time_bucket(INTERVAL '{bucket}', event_timestamp, TIMESTAMP '1970-01-01') AS window_start,
        count(*) AS demand,
        CAST(CASE WHEN count(*) < 5 THEN 1 WHEN count(*) < 10 THEN 1.25 WHEN count(*) < 15 THEN 1.5
             WHEN count(*) < 20 THEN 2 ELSE 3 END AS DOUBLE) AS surge_multiplier
    FROM silver WHERE event_type = 'ride_requested' GROUP BY ALL"""


def violations(cte: str) -> str:
    return f"""WITH {cte},
    ranked_events AS (
        SELECT *, row_number() OVER w AS step FROM (
            SELECT *, list_position(['ride_requested', 'ride_accepted', 'ride_started',
                'gps_update', 'ride_completed', 'ride_cancelled'], event_type) AS rank FROM silver)
        WINDOW w AS (PARTITION BY ride_id ORDER BY event_timestamp, rank, event_id)
    ),
    steps AS (
        SELECT *, lag(event_type) OVER (PARTITION BY ride_id ORDER BY step) AS previous
        FROM ranked_events
        WHERE step = 1 OR event_type NOT IN ('ride_requested', 'gps_update')
    ),
    bad AS (
        SELECT * FROM steps WHERE CASE WHEN step = 1 THEN event_type <> 'ride_requested'
            WHEN previous = 'ride_requested' THEN event_type NOT IN ('ride_accepted', 'ride_cancelled')
            WHEN previous = 'ride_accepted' THEN event_type NOT IN ('ride_started', 'ride_cancelled')
            WHEN previous = 'ride_started' THEN event_type NOT IN ('ride_completed', 'ride_cancelled')
            ELSE true END
        QUALIFY row_number() OVER (PARTITION BY ride_id ORDER BY step) = 1
    )
    SELECT ride_id, event_id, event_timestamp,
        CASE previous WHEN 'ride_started' THEN 'in_progress' ELSE substr(previous, 6) END AS from_status,
        CASE event_type WHEN 'ride_started' THEN 'in_progress' WHEN 'gps_update' THEN event_type
             ELSE substr(event_type, 6) END AS to_status
    FROM bad"""


# In silver a ride has each event once, and its events are planned in lifecycle order.
REPLAYED = OUTCOMES + """,
requests AS (SELECT * FROM silver WHERE event_type = 'ride_requested'),
reasons AS (SELECT ride_id, cancel_reason FROM silver WHERE event_type = 'ride_cancelled'),
accepts AS (SELECT ride_id, event_timestamp, driver_id FROM silver WHERE event_type = 'ride_accepted'),
replayed AS (
    SELECT o.ride_id,
        CASE WHEN cancelled_at IS NOT NULL THEN 'cancelled'
             WHEN completed_at IS NOT NULL THEN 'completed'
             WHEN started_at IS NOT NULL THEN 'in_progress'
             WHEN a.event_timestamp IS NOT NULL THEN 'accepted' ELSE 'requested' END AS status,
        q.rider_id AS passenger_id, a.driver_id,
        q.pickup_lat, q.pickup_lon, q.dropoff_lat, q.dropoff_lon,
        o.km100 / 100::DOUBLE AS distance_km, o.fare_cents,
        requested_at AS created_at, started_at, completed_at,
        CASE WHEN cancelled_at IS NOT NULL THEN coalesce(c.cancel_reason, 'unknown') END
            AS cancel_reason,
        CASE WHEN completed_at IS NOT NULL AND started_at IS NULL THEN 'invalid_history'
             WHEN trim(q.rider_id) = '' THEN 'blank_passenger'
             WHEN q.pickup_lat > 90 OR q.dropoff_lat > 90 THEN 'location_out_of_range'
             WHEN o.fare_cents < 0 THEN 'negative_fare' END AS error
    FROM outcomes o JOIN requests q USING (ride_id)
    LEFT JOIN accepts a USING (ride_id) LEFT JOIN reasons c USING (ride_id)
)"""

# The same with its two large parts computed once.

CURRENT = f"WITH {REPLAYED} SELECT * EXCLUDE (error) FROM replayed WHERE error IS NULL"
STATES = "ride_id, status, driver_id, distance_km, fare_cents, completed_at"

MESSAGES = """
messages AS (
    SELECT *,
        CASE event_type WHEN 'purchase' THEN 'ride_completed' WHEN 'signup' THEN 'ride_requested'
            WHEN 'click' THEN 'gps_update' WHEN 'view' THEN 'gps_update' ELSE event_type END AS kind,
        CASE WHEN date_part('microsecond', ts) % 1000000 = 0
             THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END
            || '+00:00' AS iso,
        """ + nearest("value * 100") + """ AS fare,
        1.0::DOUBLE + CAST(CAST(json_extract(props, '$.k') AS INTEGER) % 17 AS DOUBLE) / 4 AS surge,
        CAST(event_id % 300 AS DOUBLE) / 10 AS km
    FROM events
),
valid AS (SELECT * FROM messages WHERE event_type IN ('purchase', 'signup'))"""

WINDOWS = f"""WITH {MESSAGES},
    metres AS (SELECT *, CAST(trunc(km * 1000) AS BIGINT) AS m FROM valid WHERE event_type = 'purchase'),
    kms AS (SELECT *, {nearest("m / 10::DOUBLE")} * 10 AS m2 FROM metres)
    SELECT time_bucket(INTERVAL '5 minutes', ts, TIMESTAMP '1970-01-01') AS window_start,
        time_bucket(INTERVAL '5 minutes', ts, TIMESTAMP '1970-01-01') + INTERVAL '5 minutes'
            AS window_end,
        count(*) AS rides_completed_count,
        CAST(sum(fare) AS DOUBLE) / CAST(count(fare) AS DOUBLE) AS avg_fare_cents,
        CAST(sum(m2) AS DOUBLE) / CAST(count(m2) AS DOUBLE) / 1000::DOUBLE AS avg_distance_km,
        max(surge) AS max_surge_multiplier
    FROM kms GROUP BY ALL"""

ARRIVALS = """
arrivals AS (SELECT *, ts + to_minutes(user_id % 20) AS arrived_at FROM events)"""


def check_row(check: str, table: str, column: str, source: str, broken: str) -> str:
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", '{column}' AS \"column\","
        f" count(*) FILTER ({broken}) AS violations, count(*) AS total FROM {source}"
    )


def unique_row(table: str, keys: tuple[str, ...], source: str, nulls_too: bool = False) -> str:
    where = "" if nulls_too else " WHERE " + " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        f"SELECT 'unique' AS \"check\", '{table}' AS \"table\", '{'+'.join(keys)}' AS \"column\","
        f" count(*) FILTER (n > 1) AS violations, count(*) AS total FROM ("
        f"SELECT count(*) AS n FROM {source}{where} GROUP BY {', '.join(keys)})"
    )


def dq_summary() -> str:
    def missing(table: str, source: str, *columns: str) -> list[str]:
        return [check_row("not_null", table, c, source, f"{c} IS NULL") for c in columns]

    completed = "event_type = 'ride_completed' AND "
    kinds = (
        "'ride_requested', 'ride_accepted', 'ride_started', 'ride_completed', 'ride_cancelled', "
        "'gps_update'"
    )
    rows = [
        *missing("ride_events", "bronze", "event_id", "ride_id", "event_type"),
        check_row("surge_bounds", "ride_events", "surge_multiplier", "bronze",
                  completed + "(surge_multiplier < 1 OR surge_multiplier > 5)"),
        unique_row("ride_events", ("event_id",), "bronze"),
        *missing("stg_rides", "silver", "event_id", "ride_id", "event_type", "event_timestamp"),
        check_row("accepted_values", "stg_rides", "event_type", "silver", f"event_type NOT IN ({kinds})"),
        check_row("distance_bounds", "stg_rides", "distance_km", "silver",
                  completed + "(distance_km < 0 OR distance_km > 500)"),
        check_row("fare_not_negative", "stg_rides", "fare_cents", "silver", completed + "fare_cents < 0"),
        check_row("fare_bounds", "stg_rides", "fare_cents", "silver",
                  completed + "(fare_cents < 0 OR fare_cents > 100000)"),
        unique_row("stg_rides", ("event_id",), "silver"),
        *missing("stg_metrics", "hourly", "metric_hour", "rides_completed_count"),
        *missing("rides_summary", "summary", "ride_date", "rides_completed"),
        unique_row("rides_summary", ("ride_date", "driver_id", "passenger_id"), "summary", True),
        *missing("driver_metrics", "per_driver", "driver_id", "rides_completed"),
        unique_row("driver_metrics", ("driver_id",), "per_driver"),
        *missing("passenger_metrics", "per_passenger", "passenger_id", "rides_taken"),
        unique_row("passenger_metrics", ("passenger_id",), "per_passenger"),
    ]
    return (
        f"WITH {SILVER}, hourly AS ({HOURLY}), summary AS ({SUMMARY}), per_driver AS ({DRIVERS}),"
        f" per_passenger AS ({PASSENGERS})\n" + "\nUNION ALL ".join(rows)
    )


PLACES = ("pickup_lat", "pickup_lon", "dropoff_lat", "dropoff_lon")

LANDED = f"""WITH {MESSAGES}
    SELECT CAST(event_id AS VARCHAR) AS event_id, 'r' || event_id AS ride_id, kind AS event_type,
        CAST(user_id AS VARCHAR) AS driver_id, fare AS fare_cents,
        CAST(trunc(km * 1000) AS BIGINT) AS distance_meters, surge AS surge_multiplier,
        CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
        CAST(day(ts) AS INTEGER) AS day
    FROM valid"""

PAYLOAD_FIELDS = {
    "passenger_id": ("text", "rider_id IS NOT NULL"),
    "driver_id": ("text", "driver_id IS NOT NULL"),
    "latitude": ("number", "event_type = 'gps_update'"),
    "longitude": ("number", "event_type = 'gps_update'"),
    **{name: ("number", "event_type = 'ride_requested'") for name in PLACES},
    "fare_cents": ("number", "event_type = 'ride_completed'"),
    "distance_km": ("number", "event_type = 'ride_completed'"),
    "surge_multiplier": ("number", "event_type = 'ride_completed'"),
    "reason": ("text", "cancel_reason IS NOT NULL"),
}


def payload_drift() -> str:
    parts = " UNION ALL ".join(
        f"""SELECT event_type, substr("timestamp", 1, 7) AS m, '{field}' AS field, '{kind}' AS kind FROM bronze WHERE {there}"""
        for field, (kind, there) in PAYLOAD_FIELDS.items()
    )
    return f"""WITH {BRONZE}, fields AS ({parts}),
    seen AS (
        SELECT event_type, field, kind, count(*) AS rows, min(m) AS first_seen, max(m) AS last_seen FROM fields GROUP BY ALL)
    SELECT *, first_seen > min(first_seen) OVER (PARTITION BY event_type) AS is_new,
        last_seen < max(last_seen) OVER (PARTITION BY event_type) AS is_gone
    FROM seen"""


ORACLES: dict[str, str] = {
    "silver_rides": f"{ONCE} SELECT {SILVER_LIST} FROM silver",
    "silver_rides_by_ts": f"WITH {SILVER_BY_TS} SELECT {SILVER_LIST} FROM silver",
    "dedup_first_rownum": LINES,
    "dedup_first_minby": LINES,
    "partition_columns": f"""{ONCE}
        SELECT CAST(year(event_timestamp) AS INTEGER) AS year,
            CAST(month(event_timestamp) AS INTEGER) AS month,
            CAST(day(event_timestamp) AS INTEGER) AS day,
            CAST(hour(event_timestamp) AS INTEGER) AS hour, count(*) AS events
        FROM silver GROUP BY ALL""",
    "hourly_metrics": ONCE + HOURLY,
    "driver_metrics": ONCE + DRIVERS,
    "driver_metrics_nodistinct": ONCE + DRIVERS,
    "passenger_metrics": ONCE + PASSENGERS,
    "passenger_metrics_nodistinct": ONCE + PASSENGERS,
    "passenger_metrics_join": ONCE + PASSENGERS,
    "rides_summary": ONCE + SUMMARY,
    "recent_summary_topk": f"""{ONCE}, summary AS ({SUMMARY})
        SELECT * FROM summary WHERE ride_date >= DATE '{AS_OF}' - {SUMMARY_DAYS}
        ORDER BY ride_date DESC, driver_id NULLS LAST, passenger_id NULLS LAST LIMIT 50""",
    "events_by_type": """
        SELECT event_type, count(*) AS events,
            CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_cents
        FROM events GROUP BY event_type ORDER BY event_type""",
    "global_revenue": f"""{ONCE}
        SELECT count(DISTINCT ride_id) AS rides, {total("fare_cents")} AS total_cents FROM done""",
    "revenue_by_currency": f"""{ONCE},
        paid AS (
            SELECT driver_id, fare_cents, CASE WHEN CAST(ride_id AS BIGINT) % 2 = 0
                AND CAST(driver_id AS BIGINT) % 3 = 0 THEN 'EUR' ELSE 'USD' END AS currency
            FROM done WHERE driver_id IS NOT NULL)
        SELECT driver_id, count(DISTINCT currency) AS currencies,
            CASE WHEN count(DISTINCT currency) = 1 THEN max(currency) END AS currency,
            CASE WHEN count(DISTINCT currency) = 1 THEN {total("fare_cents")} END AS total_cents,
            count(DISTINCT currency) > 1 AS mixed
        FROM paid GROUP BY driver_id""",
    "batch_metrics_zero_fill": """
        SELECT count(*) AS rides_completed_count,
            sum(CASE WHEN event_type <> 'view' THEN round(value * 100) ELSE 0 END) / count(*)
                AS avg_fare_cents,
            sum(CASE WHEN event_type <> 'click' THEN CAST(event_id % 300 AS DOUBLE) / 4 ELSE 0 END)
                / count(*) AS avg_distance_km,
            max(CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE + CAST(user_id % 9 AS DOUBLE) / 4
                ELSE 1 END) AS max_surge_multiplier
        FROM events""",
    "driver_daily": daily("driver_id"),
    "passenger_daily": daily("rider_id"),
    "pipeline_summary": f"""{ONCE}
        SELECT count(*) AS total_rides, {total("fare_cents")} AS total_revenue_cents,
            {cents("sum(fare_cents)")} AS total_revenue_dollars,
            {total("distance_meters")} AS total_distance_meters,
            sum(distance_meters) / 1000::DOUBLE AS total_distance_km,
            {MEAN_SURGE} AS avg_surge, count(DISTINCT driver_id) AS unique_drivers
        FROM done""",
    "trips_daily": f"""{ONCE}
        SELECT CAST(event_timestamp AS DATE) AS trip_date, count(*) AS trips,
            {total("fare_cents")} AS total_fare_cents, {MEAN_KM} AS avg_distance_km
        FROM done GROUP BY ALL""",
    "gold_by_increments": f"""WITH {SILVER_BY_TS}
        SELECT CAST(date_trunc('month', event_timestamp) AS DATE) AS period,
            count(*) FILTER (event_type = 'ride_completed') AS rides,
            CAST(sum(fare_cents) FILTER (event_type = 'ride_completed') AS BIGINT) AS fare_cents,
            CAST(sum(distance_meters) FILTER (event_type = 'ride_completed') AS BIGINT) AS distance_meters,
            count(DISTINCT driver_id) FILTER (event_type = 'ride_completed') AS drivers,
            count(DISTINCT rider_id) FILTER (event_type = 'ride_completed') AS riders
        FROM silver GROUP BY 1""",
    "fact_trip": f"""WITH {OUTCOMES}
        SELECT {short_key("ride_id")} AS trip_key, ride_id AS trip_id, done.rider_id, done.driver_id,
            started_at, completed_at, CAST(seconds AS INTEGER) AS duration_seconds,
            outcomes.distance_meters, outcomes.fare_cents, CAST(started_at AS DATE) AS trip_date
        FROM outcomes JOIN done USING (ride_id)""",
    "fact_driver_daily": f"""WITH {OUTCOMES}
        SELECT {short_key("driver_id")} AS driver_key, driver_id,
            CAST(coalesce(completed_at, cancelled_at) AS DATE) AS activity_date,
            count(completed_at) AS trips_completed,
            count(*) FILTER (completed_at IS NULL) AS trips_cancelled,
            coalesce({total("fare_cents")}, 0) AS total_earnings_cents,
            coalesce(sum(distance_meters), 0) AS total_distance_meters,
            {mean("sum(seconds) * 100", "count(seconds)", 2)} AS avg_trip_duration_seconds,
            {cents(nearest("CAST(date_diff('second', min(driver_from), max(driver_to)) AS DOUBLE) / 36"))}
                AS online_hours
        FROM outcomes
        WHERE driver_id IS NOT NULL AND coalesce(completed_at, cancelled_at) IS NOT NULL
        GROUP BY driver_id, CAST(coalesce(completed_at, cancelled_at) AS DATE)""",
    "platform_daily": f"""WITH {OUTCOMES}
        SELECT CAST(requested_at AS DATE) AS date, count(*) AS total_rides,
            count(completed_at) AS completed_rides,
            coalesce({cents("sum(km100)")}, 0) AS total_distance_km,
            {mean("sum(fare_cents)", "count(fare_cents)")} AS avg_fare_cents,
            {mean("sum(seconds) * 100", "count(seconds) * 60", 2)} AS avg_duration_minutes,
            count(DISTINCT rider_id) AS active_riders,
            count(DISTINCT driver_id) AS active_drivers,
            {mean("sum(CASE WHEN seconds <= 1800 THEN 10000 ELSE 0 END)", "count(seconds)", 2)}
                AS on_time_pct
        FROM outcomes GROUP BY CAST(requested_at AS DATE)""",
    "dim_driver_scd2": f"WITH {CHANGES} SELECT * FROM drivers",
    "scd2_merge": f"WITH {CHANGES} SELECT driver_key AS version_key, * EXCLUDE (driver_key) FROM drivers",
    "scd2_lookup": f"""{ONCE}, {CHANGES}
        SELECT d.ride_id, d.rider_id AS driver_id, CAST(d.event_timestamp AS DATE) AS ride_date,
            v.driver_key, v.vehicle_type
        FROM done d LEFT JOIN drivers v ON d.rider_id = v.driver_id
            AND CAST(d.event_timestamp AS DATE) >= v.effective_date
            AND CAST(d.event_timestamp AS DATE) < coalesce(v.end_date, DATE '9999-01-01')""",
    "dim_rider": f"WITH {CHANGES} SELECT * FROM riders",
    "dim_date": f"""{ONCE},
        days AS (
            SELECT CAST(unnest(generate_series(min(CAST(event_timestamp AS DATE)),
                max(CAST(event_timestamp AS DATE)), INTERVAL 1 DAY)) AS DATE) AS date FROM silver)
        SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_id, date,
            CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
            CAST(day(date) AS INTEGER) AS day, CAST(isodow(date) - 1 AS INTEGER) AS weekday,
            isodow(date) >= 6 AS is_weekend
        FROM days""",
    "dim_time": f"""{ONCE}
        SELECT DISTINCT CAST(strftime(event_timestamp, '%H%M') AS INTEGER) AS time_id,
            CAST(hour(event_timestamp) AS INTEGER) AS hour,
            CAST(minute(event_timestamp) AS INTEGER) AS minute FROM silver""",
    "dim_location": f"""WITH {RIDES},
        ends AS (
            SELECT pickup_lat AS lat, pickup_lon AS lon, 'p' AS side FROM rides
            UNION ALL SELECT dropoff_lat, dropoff_lon, 'd' FROM rides)
        SELECT {cell("lat", "lon", 100)} AS location_id,
            min((floor((lat + 90) * 100) + 0.5::DOUBLE) / 100 - 90) AS centre_lat,
            min((floor((lon + 180) * 100) + 0.5::DOUBLE) / 100 - 180) AS centre_lon,
            count(*) FILTER (side = 'p') AS pickups, count(*) FILTER (side = 'd') AS dropoffs
        FROM ends WHERE lat IS NOT NULL AND lon IS NOT NULL GROUP BY 1""",
    "fact_rides_star": f"""WITH {OUTCOMES}, {CHANGES}
        SELECT o.ride_id, coalesce(r.rider_key, '-1') AS rider_key,
            coalesce(v.driver_key, '-1') AS driver_key,
            CAST(strftime(started_at, '%Y%m%d') AS INTEGER) AS date_id,
            CAST(strftime(started_at, '%H%M') AS INTEGER) AS start_time_id,
            {cell("b.pickup_lat", "b.pickup_lon", 100)} AS pickup_location_id,
            {cell("b.dropoff_lat", "b.dropoff_lon", 100)} AS dropoff_location_id,
            o.distance_meters, CAST(seconds AS INTEGER) AS duration_seconds, o.fare_cents,
            completed_at IS NOT NULL AS completed, seconds > 1800 AS late
        FROM outcomes o JOIN rides b USING (ride_id)
        LEFT JOIN riders r ON o.rider_id = r.rider_id
        LEFT JOIN drivers v ON o.driver_id = v.driver_id
            AND CAST(started_at AS DATE) >= v.effective_date
            AND CAST(started_at AS DATE) < coalesce(v.end_date, DATE '9999-01-01')""",
    "pii_hash": f"SELECT c_custkey, sha256('{PII_SALT}' || c_name) AS c_name FROM customer",
    "flatten_payload": f"""WITH {BRONZE}
        SELECT event_id, ride_id, event_type, "timestamp", nullif(rider_id, '') AS rider_id, driver_id,
            latitude, longitude, fare_cents,
            CAST(trunc(CAST(distance_meters AS DOUBLE) / 1000 * 1000) AS BIGINT) AS distance_meters,
            surge_multiplier
        FROM bronze""",
    "rebuild_payload": f"""WITH {BRONZE}
        SELECT event_id, ride_id, event_type, "timestamp",
            '{{' || CASE WHEN rider_id IS NULL THEN '' ELSE '"rider_id":"' || rider_id || '",' END
            || CASE WHEN driver_id IS NULL THEN '' ELSE '"driver_id":"' || driver_id || '",' END
            || '"fare_cents":' || fare_cents || ',"distance_meters":' || distance_meters || '}}' AS data
        FROM bronze""",
    "publish_messages": f"""WITH {BRONZE}
        SELECT ride_id AS key,
            '{{"event_id":"' || event_id || '","ride_id":"' || ride_id || '","event_type":"' || event_type
            || '","timestamp":"' || "timestamp" || '"'
            || CASE WHEN rider_id IS NULL THEN '' ELSE ',"rider_id":"' || rider_id || '"' END
            || CASE WHEN driver_id IS NULL THEN '' ELSE ',"driver_id":"' || driver_id || '"' END
            || ',"fare_cents":' || fare_cents || '}}' AS value
        FROM bronze""",
    "event_id_check": f"""{ONCE}
        SELECT ride_id, event_type, event_timestamp, event_id,
            substr(sha256(ride_id || ':' || event_type || ':' || "timestamp"), 1, 32) AS expected_id
        FROM silver WHERE k % 107 = 0""",
    "payload_validate_split": f"""WITH {MESSAGES}
        SELECT event_id AS "offset", CAST(event_id AS VARCHAR) AS event_id,
            'r' || event_id AS ride_id, kind AS event_type, iso AS "timestamp"
        FROM valid""",
    "quarantine": f"""WITH {MESSAGES}
        SELECT event_id AS "offset",
            CASE WHEN event_type <> 'view' THEN CAST(event_id AS VARCHAR) END AS event_id,
            CASE WHEN event_type = 'error' THEN 'r' || event_id END AS ride_id,
            CASE WHEN event_type = 'view' THEN substr('{{"event_id":"' || event_id || '","ride_id":"r'
                || event_id || '","event_type":"gps_update"', 1, 40) END AS raw_text,
            CASE event_type WHEN 'view' THEN 'malformed' WHEN 'click' THEN 'missing_ride_id'
                ELSE 'unknown_event_type' END AS _error,
            epoch_us(ts) / 1000000::DOUBLE AS _dlq_timestamp
        FROM messages WHERE event_type NOT IN ('purchase', 'signup')""",
    "ride_validate": f"""WITH {RIDES},
        reasons AS (
            SELECT ride_id, concat_ws(';', CASE WHEN trim(rider_id) = '' THEN 'blank_rider' END,
                CASE WHEN abs(pickup_lat) > 90 THEN 'pickup_latitude' END,
                CASE WHEN abs(pickup_lon) > 180 THEN 'pickup_longitude' END,
                CASE WHEN abs(dropoff_lat) > 90 THEN 'dropoff_latitude' END,
                CASE WHEN abs(dropoff_lon) > 180 THEN 'dropoff_longitude' END,
                CASE WHEN distance_meters < 0 THEN 'negative_distance' END,
                CASE WHEN fare_cents < 0 THEN 'negative_fare' END,
                CASE WHEN pickup_lat = dropoff_lat AND pickup_lon = dropoff_lon THEN 'same_ends' END
                ) AS reasons FROM rides)
        SELECT * FROM reasons WHERE reasons <> ''""",
    "unseen_events": f"""WITH {BRONZE}
        SELECT DISTINCT event_id, ride_id, event_type, "timestamp" FROM bronze
        WHERE event_type <> 'ride_requested'""",
    "unseen_by_bitmaps": f"""WITH {BRONZE}
        SELECT DISTINCT event_id, ride_id, event_type, "timestamp" FROM bronze
        WHERE event_timestamp >= TIMESTAMP '{CHANGE_CUT}' AND event_timestamp >= TIMESTAMP '{REDELIVERED_FROM}'""",
    "payload_drift": payload_drift(),
    "trip_distance_by_driver": f"""WITH {TRIPS}
        SELECT driver_id, count(*) AS trips, {cents("sum(line100)")} AS straight_km,
            {cents("max(line100)")} AS longest_km FROM lines GROUP BY driver_id""",
    "fare_audit_service": f"""WITH {PRICED}
        SELECT driver_id, CAST(event_timestamp AS DATE) AS ride_date, count(*) AS trips,
            {total("fare_cents")} AS charged_cents, {total("fare")} AS expected_cents,
            {total("fare_cents - fare")} AS difference_cents,
            count(*) FILTER (fare_cents = fare) AS n_match,
            count(*) FILTER (fare_cents > fare) AS n_over,
            count(*) FILTER (fare_cents < fare) AS n_under,
            count(*) FILTER (fare IS NULL) AS n_invalid_surge
        FROM service GROUP BY ALL""",
    "fare_audit_minimum": f"""WITH {PRICED}
        SELECT ride_id, fare_cents, fare AS expected_cents, fare_cents - fare AS difference_cents,
            CASE WHEN fare_cents < fare THEN 'under' WHEN fare_cents > fare THEN 'over'
                ELSE 'match' END AS verdict
        FROM floored""",
    "fare_estimate_error": f"""WITH {TRIPS}
        SELECT ride_id, fare_cents, 250 + CAST(ceil(line_km * 150) AS BIGINT) AS estimated_cents,
            fare_cents - (250 + CAST(ceil(line_km * 150) AS BIGINT)) AS error_cents
        FROM lines""",
    "distance_audit": f"""WITH {TRIPS}
        SELECT ride_id, {cents("line100")} AS straight_km, distance_km AS recorded_km,
            abs(km100 - line100) * 100 > line100 * 5 AS off_tolerance
        FROM lines""",
    "surge_by_cell": surge(2, "1 day"),
    "demand_cells": surge(100, "5 minutes"),
    "lifecycle_violations": violations(SILVER),
    "lifecycle_violations_by_ts": violations(SILVER_BY_TS),
    "rides_current": CURRENT,
    "stream_rides_current": CURRENT,
    "stream_restart": CURRENT,
    "rides_in_error": f"WITH {REPLAYED} SELECT ride_id, error FROM replayed WHERE error IS NOT NULL",
    "rides_by_status": f"""WITH {REPLAYED},
        lines AS (
            SELECT *, sin((radians(dropoff_lat) - radians(pickup_lat)) / 2) ** 2
                + cos(radians(pickup_lat)) * cos(radians(dropoff_lat))
                * sin((radians(dropoff_lon) - radians(pickup_lon)) / 2) ** 2 AS a
            FROM replayed WHERE error IS NULL AND status = 'in_progress')
        SELECT ride_id, status, true AS is_active, false AS is_terminal,
            {cents(nearest("12742::DOUBLE * atan2(sqrt(a), sqrt(1 - a)) * 100"))}
                AS estimated_distance_km
        FROM lines""",
    # Rides that are over, or only under way, before the date keep that state; no event undoes it.
    "ride_state_upsert": f"WITH {REPLAYED} SELECT {STATES} FROM replayed WHERE error IS NULL",
    "ride_delete": f"""WITH {REPLAYED} SELECT {STATES} FROM replayed
        WHERE error IS NULL AND status <> 'cancelled'""",
    "ride_by_id": f"""WITH {REPLAYED} SELECT {STATES} FROM replayed WHERE error IS NULL
        ORDER BY ride_id DESC LIMIT 1""",
    "event_history": f"""WITH {BRONZE},
        wrong AS (
            SELECT ride_id FROM rides
            WHERE trim(rider_id) = '' OR pickup_lat > 90 OR dropoff_lat > 90
               OR (driver_id IS NOT NULL AND order_status = 'F' AND (k % 101 = 0 OR fare_cents < 0))
        )
        SELECT event_id, ride_id, event_type, "timestamp",
            '{{' || CASE WHEN rider_id IS NULL THEN '' ELSE '"rider_id":"' || rider_id || '",' END
            || CASE WHEN driver_id IS NULL THEN '' ELSE '"driver_id":"' || driver_id || '",' END
            || '"fare_cents":' || fare_cents || '}}' AS data
        FROM bronze WHERE ride_id IN (SELECT ride_id FROM wrong)""",
    "stage_changes": f"""{ONCE},
        a AS (SELECT CAST(date_trunc('month', event_timestamp) AS DATE) AS event_month, count(*) AS n FROM bronze GROUP BY 1),
        b AS (SELECT CAST(date_trunc('month', event_timestamp) AS DATE) AS event_month, count(*) AS n FROM silver GROUP BY 1)
        SELECT event_month, a.n AS rows_before, coalesce(b.n, 0) AS rows_after, a.n = coalesce(b.n, 0) AS same
        FROM a LEFT JOIN b USING (event_month)""",
    "driver_event_checks": f"""WITH {BRONZE},
        counted AS (
            SELECT count(*) AS total, count(*) FILTER (WHERE event_id IS NULL) AS e,
                count(*) FILTER (WHERE driver_id IS NULL) AS d FROM bronze
        )
        SELECT 'not_null' AS "check", 'driver_events' AS "table", 'event_id' AS "column", e AS violations, total FROM counted
        UNION ALL SELECT 'not_null', 'driver_events', 'driver_id', d, total FROM counted""",
    "date_range_violations": f"""{ONCE}
        SELECT CAST(event_timestamp AS DATE) AS event_date, count(*) AS events FROM silver
        WHERE CAST(event_timestamp AS DATE) < DATE '1996-01-01' OR CAST(event_timestamp AS DATE) > DATE '{AS_OF}' GROUP BY 1""",
    "dq_summary": dq_summary(),
    "dq_violations": f"""{ONCE},
        broken AS (
            SELECT ride_id, event_type, fare_cents, distance_km, concat_ws(';',
                CASE WHEN distance_km < 0 OR distance_km > 500 THEN 'distance_bounds' END,
                CASE WHEN fare_cents < 0 THEN 'fare_not_negative' END,
                CASE WHEN fare_cents < 0 OR fare_cents > 100000 THEN 'fare_bounds' END) AS checks
            FROM done)
        SELECT * FROM broken WHERE checks <> ''""",
    "dq_unique": f"""WITH {BRONZE}
        SELECT event_id, count(*) AS cnt FROM bronze GROUP BY event_id HAVING count(*) > 1""",
    "dq_unique_composite": """
        SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem
        GROUP BY ALL HAVING count(*) > 1""",
    "dq_relationships": """
        SELECT 'orders' AS side, o_orderkey AS key, count(*) AS rows FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY o_orderkey
        UNION ALL
        SELECT 'lineitem', l_orderkey, count(*) FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey""",
    "reconcile": f"""{ONCE},
        a AS (SELECT CAST(event_timestamp AS DATE) AS event_date, count(*) AS n FROM bronze GROUP BY 1),
        b AS (SELECT CAST(event_timestamp AS DATE) AS event_date, count(*) AS n FROM silver GROUP BY 1)
        SELECT event_date, a.n AS source_rows, coalesce(b.n, 0) AS target_rows,
            a.n - coalesce(b.n, 0) <= CAST(a.n AS DOUBLE) * 0.001::DOUBLE AS within
        FROM a LEFT JOIN b USING (event_date)""",
    "reconcile_totals": f"""{ONCE}
        SELECT {total("fare_cents")} AS parts_total, {total("fare_cents")} AS whole_total,
            true AS equal FROM done""",
    "id_difference": f"""{ONCE}
        SELECT DISTINCT event_id, 'left' AS side FROM bronze
        WHERE event_id NOT IN (SELECT event_id FROM silver)""",
    "recency": """
        SELECT max(ts) AS latest_at,
            CAST(date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-02-01') AS BIGINT)
                AS age_seconds,
            date_diff('second', date_trunc('second', max(ts)), TIMESTAMP '2024-02-01') > 86400 AS stale
        FROM events""",
    "stage_lag": f"""WITH {ARRIVALS}
        SELECT count(*) AS rows, sum(user_id % 20 * 60) / CAST(count(*) AS DOUBLE) AS avg_lag_seconds,
            max(user_id % 20 * 60) AS max_lag_seconds FROM arrivals""",
    "retention": f"""{ONCE}
        SELECT event_id, ride_id, event_type, CAST(event_timestamp AS DATE) AS event_date FROM silver
        WHERE CAST(event_timestamp AS DATE) >= DATE '{AS_OF}' - {RETENTION_DAYS}""",
    "event_append": f"""WITH {BRONZE}
        SELECT CAST(date_trunc('month', event_timestamp) AS DATE) AS event_month, event_type, count(*) AS events,
            count(DISTINCT event_id) AS ids
        FROM bronze GROUP BY ALL""",
    "file_lineage": f"""WITH {BRONZE}
        SELECT CAST(year(event_timestamp) AS VARCHAR) AS batch, count(*) AS events, count(*) AS in_place, CAST(1 AS BIGINT) AS loads
        FROM bronze GROUP BY 1""",
    "load_stamps": f"""{ONCE}, layers AS (
            SELECT 'stg_rides' AS layer, count(*) AS rows FROM silver
            UNION ALL SELECT 'stg_metrics', count(*) FROM ({HOURLY})
            UNION ALL SELECT 'rides_summary', count(*) FROM ({SUMMARY})
            UNION ALL SELECT 'driver_metrics', count(*) FROM ({DRIVERS})
            UNION ALL SELECT 'passenger_metrics', count(*) FROM ({PASSENGERS}))
        SELECT layer, rows, CAST(0 AS BIGINT) AS unstamped FROM layers""",
    "silver_view": f"""{ONCE}
        SELECT CAST(year(event_timestamp) AS INTEGER) AS event_year, event_type, count(*) AS events, count(DISTINCT ride_id) AS rides
        FROM silver WHERE year(event_timestamp) >= {VIEW_FROM} GROUP BY ALL""",
    "gold_extract": ONCE + DRIVERS,
    "parquet_roundtrip": f"""{ONCE}
        SELECT event_type, count(*) AS events, {total("fare_cents")} AS total_cents
        FROM silver WHERE fare_cents >= 0 GROUP BY event_type""",
    "ndjson_roundtrip": f"""WITH {BRONZE}
        SELECT event_id, ride_id, event_type, "timestamp", rider_id, driver_id, latitude, longitude,
            fare_cents, distance_meters, surge_multiplier FROM bronze""",
    "window_5min_metrics": WINDOWS,
    "window_5min_stream": WINDOWS,
    "stream_dedup": "SELECT * FROM events",
    "stream_progress": """
        SELECT 'dedup' AS query, CAST(1 AS BIGINT) AS batches, count(*) AS input_rows, CAST(0 AS BIGINT) AS dropped_late,
            date_trunc('milliseconds', max(CAST(ts AS TIMESTAMP))) - INTERVAL 10 MINUTE AS watermark
        FROM events""",
    "late_events": f"""WITH {ARRIVALS}
        SELECT event_id, ts, arrived_at, CAST(user_id % 20 * 60 AS DOUBLE) AS lateness_seconds
        FROM arrivals WHERE user_id % 20 > 10""",
    "landing": LANDED,
    "landing_compacted": LANDED,
    "landing_rejects": f"""WITH {MESSAGES}
        SELECT CASE WHEN event_type <> 'view' THEN CAST(event_id AS VARCHAR) END AS event_id,
            CASE WHEN event_type = 'error' THEN 'r' || event_id END AS ride_id,
            CASE WHEN event_type = 'view' THEN substr('{{"event_id":"' || event_id || '","ride_id":"r'
                || event_id || '","event_type":"gps_update"', 1, 40) END AS raw_text,
            CASE event_type WHEN 'view' THEN 'malformed' WHEN 'click' THEN 'missing_ride_id'
                ELSE 'unknown_event_type' END AS _error
        FROM messages WHERE event_type NOT IN ('purchase', 'signup')""",
    "layer_rebuild": f"""{ONCE}
        SELECT CAST(event_timestamp AS DATE) AS event_date, event_type, count(*) AS events
        FROM silver WHERE event_timestamp < TIMESTAMP '{CHANGE_CUT}' GROUP BY ALL""",
    "build_rejects": f"""WITH {BRONZE},
        marked AS (
            SELECT CASE WHEN k % 7 <> 0 THEN event_id END AS event_id, ride_id,
                CASE WHEN k % 13 = 0 THEN 'ride_teleported' ELSE event_type END AS event_type,
                k % 11 = 0 AS late
            FROM (SELECT *, CAST(ride_id AS BIGINT) AS k FROM bronze))
        SELECT event_id, ride_id, event_type,
            CASE WHEN event_id IS NULL AND event_type = 'ride_teleported' THEN 'missing_event_id;unknown_event_type'
                 WHEN event_id IS NULL THEN 'missing_event_id'
                 WHEN event_type = 'ride_teleported' THEN 'unknown_event_type' ELSE 'bad_timestamp' END AS _error
        FROM marked WHERE event_id IS NULL OR event_type = 'ride_teleported' OR late""",
    "layer_retention": f"""{ONCE}
        SELECT CAST(date_trunc('month', event_timestamp) AS DATE) AS event_month, count(*) AS events FROM silver
        WHERE date_trunc('month', event_timestamp) >= DATE '{AS_OF}' - {RETENTION_DAYS} GROUP BY 1""",
    "registered_partitions": f"""{ONCE}
        SELECT CAST(date_trunc('month', event_timestamp) AS DATE) AS event_month, count(*) AS events
        FROM silver GROUP BY 1""",
}
