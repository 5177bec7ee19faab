"""The SQL each query is compared with. A query without an entry is random or fitted."""

from __future__ import annotations

KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

TRIPS = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, pu AS tpep_pickup_datetime,
 pu + ((l_partkey*31 + l_suppkey*17 + l_linenumber*101) % 5400 - 60) * INTERVAL '1' SECOND
   AS tpep_dropoff_datetime,
 CAST(CASE WHEN l_orderkey % 97 = 0 THEN 264 ELSE c_nationkey END AS INT) AS PULocationID,
 CAST(CASE WHEN l_partkey % 89 = 0 THEN 265 ELSE s_nationkey END AS INT) AS DOLocationID,
 CASE WHEN l_orderkey % 20 = 0 THEN NULL ELSE l_linenumber END AS passenger_count,
 CAST(l_suppkey % 2 + 1 AS INT) AS VendorID, CAST(l_partkey % 5 AS INT) AS payment_type,
 CASE WHEN l_partkey % 53 = 0 THEN 0E0 ELSE l_quantity * 0.4E0 END AS trip_distance,
 3E0 + l_quantity AS fare_amount, l_discount * 50E0 AS tip_amount,
 l_tax * 10E0 AS extra, 0.5E0 AS mta_tax,
 CASE WHEN l_suppkey % 10 = 0 THEN 6E0 ELSE 0E0 END AS tolls_amount,
 1E0 AS improvement_surcharge, 2.5E0 AS congestion_surcharge,
 CASE WHEN l_orderkey % 20 = 0 THEN NULL WHEN l_suppkey % 10 = 0 THEN 1.75E0 ELSE 0E0 END
   AS airport_fee,
 3E0 + l_quantity + l_discount*50E0 + l_tax*10E0 + 4E0
   + CASE WHEN l_suppkey % 10 = 0 THEN 7.75E0 ELSE 0E0 END AS total_amount
FROM (SELECT *, o_orderdate
        + ((l_orderkey*7919 + l_partkey*104729 + l_linenumber*1009) % 86400) * INTERVAL '1' SECOND
        AS pu
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey) b"""

ZONES = """
SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone
FROM nation JOIN region ON n_regionkey = r_regionkey"""

NEWS = """
SELECT event_id,
 CASE WHEN event_id % 7 = 0 THEN 'bot_user_0' WHEN event_id % 8 = 1 THEN 'bot_user_1'
   ELSE concat('user_', user_id) END AS user_id,
 CASE WHEN event_id % 6 = 0 THEN 'article_hot' ELSE concat('article_', event_id % 83) END
   AS article_id,
 TIMESTAMP '2024-01-01 00:00:00'
   + CAST(floor(event_id * 36E0 / 100E0) AS BIGINT) * INTERVAL '1' SECOND AS timestamp,
 CASE event_type WHEN 'purchase' THEN 'finance' WHEN 'view' THEN 'sports'
   WHEN 'click' THEN 'politics' WHEN 'signup' THEN 'culture' ELSE 'science' END AS category,
 concat('country_', user_id % 11) AS location,
 CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
 concat('s_', user_id, '_', CAST(floor(event_id / 500E0) AS BIGINT)) AS session_id
FROM events"""

# The fees of a trip.
FEES = "extra + mta_tax + tolls_amount + improvement_surcharge + congestion_surcharge + airport_fee"
SECONDS = "CAST(epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime) AS BIGINT)"
DAY = "CAST(dayofweek(tpep_pickup_datetime) + 1 AS INT)"

PREPARED = f"""
SELECT * EXCLUDE (extra, mta_tax, tolls_amount, improvement_surcharge, congestion_surcharge,
                  airport_fee),
 CAST(hour(tpep_pickup_datetime) AS INT) AS hour, {DAY} AS day_of_week, {FEES} AS extras
FROM trips WHERE tpep_dropoff_datetime > tpep_pickup_datetime"""

FINAL = """
SELECT p.*, a.Borough AS PU_Borough, a.Zone AS PU_Zone, b.Borough AS DO_Borough, b.Zone AS DO_Zone
FROM prepared p LEFT JOIN zones a ON p.PULocationID = a.LocationID
LEFT JOIN zones b ON p.DOLocationID = b.LocationID"""

TIMED = f"""
SELECT *, trip_distance / trip_duration_hours AS avg_speed_mph
FROM (SELECT *, {SECONDS} / 3600E0 AS trip_duration_hours FROM final) t
WHERE trip_duration_hours > 0.05E0 AND trip_distance > 0"""

TIMED_RAW = TIMED.replace("FROM final", "FROM trips")

VIEWS = {
    "trips": TRIPS,
    "zones": ZONES,
    "news": NEWS,
    "prepared": PREPARED,
    "final": FINAL,
    "timed": TIMED,
    "timed_raw": TIMED_RAW,
}
NEEDS = {
    "prepared": ["trips"],
    "final": ["trips", "prepared", "zones"],
    "timed": ["trips", "prepared", "zones", "final"],
    "timed_raw": ["trips"],
}


def over(view: str, sql: str) -> str:
    """``sql`` with ``view`` and the views below it defined in front."""
    names = [*NEEDS.get(view, []), view]
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name]})" for name in names) + "\n" + sql


def day_case(first: str) -> str:
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    if first == "Sunday":
        names = names[-1:] + names[:-1]
    whens = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names, 1))
    return f"CASE day_of_week {whens} ELSE 'Unknown' END"


def day_hour(first: str) -> str:
    return over(
        "prepared",
        f"""SELECT day_name, hour, count(*) AS "count"
        FROM (SELECT {day_case(first)} AS day_name, hour FROM prepared) t GROUP BY 1, 2
        ORDER BY "count" DESC, day_name NULLS LAST, hour NULLS LAST LIMIT 20""",
    )


def windowed(minutes: int, key: str, measure: str, tail: str = "", name: str | None = None) -> str:
    width = f"INTERVAL '{minutes}' MINUTE"
    shown = f"{key} AS {name}" if name else key
    return over(
        "news",
        f"""SELECT time_bucket({width}, timestamp) AS window_start,
         time_bucket({width}, timestamp) + {width} AS window_end, {shown}, {measure}
        FROM news {tail if tail.startswith("WHERE") else ""} GROUP BY 1, 2, 3
        {"" if tail.startswith("WHERE") else tail}""",
    )


COUNT = 'count(*) AS "count"'
FINANCE = windowed(15, "location", COUNT, "WHERE category = 'finance'")
TOP10 = f"""SELECT window_start, window_end, location, "count" FROM (
 SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY "count" DESC, location) AS place
 FROM ({FINANCE}) f) r WHERE place <= 10"""
DEVICES = windowed(1, "device_type", COUNT)
SESSIONS = windowed(5, "location", "count(DISTINCT session_id) AS active_sessions")
SPIKES = windowed(
    10, "article_id", COUNT, "HAVING count(*) > 250", "articles_with_spike_in_views"
)
BOTS = windowed(1, "user_id", COUNT, "HAVING count(*) > 20", "suspicius_users")


def crossings(minutes: int, key: str, above: int, name: str) -> str:
    """The event by which a group of a window has more than ``above``."""
    width = f"INTERVAL '{minutes}' MINUTE"
    return over(
        "news",
        f"""SELECT window_start, window_start + {width} AS window_end, {key} AS {name},
         timestamp AS crossed_at
        FROM (SELECT *, time_bucket({width}, timestamp) AS window_start FROM news) n
        QUALIFY row_number() OVER (PARTITION BY window_start, {key} ORDER BY timestamp) = {above + 1}""",
    )


SPIKE_ALERTS = crossings(10, "article_id", 250, "articles_with_spike_in_views")
BOT_ALERTS = crossings(1, "user_id", 20, "suspicius_users")
BOT_ARTICLES = windowed(
    1,
    "user_id",
    "count(DISTINCT article_id) AS articles",
    "HAVING count(DISTINCT article_id) > 20",
    "suspicius_users",
)
CLOSED_DEVICES = f"""SELECT * FROM ({DEVICES}) w WHERE window_end <=
 (SELECT max(timestamp) - INTERVAL '10' MINUTE FROM ({NEWS}) n)"""

# Codes, feature lists and column names.
CODES = ["PULocationID", "DOLocationID", "VendorID", "payment_type"]
CLEAN = ["trip_distance", "passenger_count", "hour", "day_of_week", *CODES]
LEAKY = [
    "trip_distance",
    "hour",
    "day_of_week",
    "extras",
    "fare_amount",
    "tip_amount",
    "passenger_count",
    "payment_type",
]
NUMBERS = [
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "VendorID",
    "payment_type",
    "trip_distance",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "hour",
    "day_of_week",
    "extras",
]
TEXTS = ["PU_Borough", "PU_Zone", "DO_Borough", "DO_Zone"]
TIMES = ["tpep_pickup_datetime", "tpep_dropoff_datetime"]


def not_null(columns: list[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in columns)


def union(selects: list[str]) -> str:
    return "\nUNION ALL ".join(selects)


ONEHOT = ", ".join(
    f"CAST(CASE WHEN {c} < m_{c} THEN {c} END AS BIGINT) AS {c}_at,"
    f" CAST(m_{c} AS INT) AS {c}_size"
    for c in CODES
)
ONEHOT_MAX = ", ".join(f"max({c}) AS m_{c}" for c in CODES)

DESCRIBE = union(
    [
        f"""SELECT '{c}' AS column_name, count({c}) AS row_count, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min_value,
        CAST(max({c}) AS DOUBLE) AS max_value, CAST(NULL AS VARCHAR) AS min_text,
        CAST(NULL AS VARCHAR) AS max_text FROM final"""
        for c in NUMBERS
    ]
    + [
        f"""SELECT '{c}', count({c}), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
        CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), min({c}), max({c}) FROM final"""
        for c in TEXTS
    ]
)

ERRORS = """SELECT *, total_amount - prediction AS error FROM (
 SELECT *, 6E0 + fare_amount + trip_distance * 0.25E0 AS prediction FROM prepared) p"""

LABELLED = f"""SELECT *, {SECONDS} AS triptime,
 (l_orderkey*31 + l_partkey*17 + l_linenumber) % 10 < 8 AS trains,
 CAST(floor((l_orderkey*31 + l_partkey*17 + l_linenumber) / 10) AS BIGINT) % 3 AS fold
FROM prepared"""


def group_means(label: str) -> str:
    """What a tree on payment_type alone predicts for the test rows."""
    return over(
        "prepared",
        f"""SELECT {KEY}, round(m.v, 6) AS prediction FROM ({LABELLED}) t
        JOIN (SELECT payment_type, avg({label}) AS v FROM ({LABELLED}) u WHERE trains
              GROUP BY payment_type) m USING (payment_type)
        WHERE NOT trains AND {label} IS NOT NULL""",
    )


LINE = over(
    "prepared",
    f"""SELECT {KEY}, round(m.a + m.b * trip_distance, 6) AS prediction FROM ({LABELLED}) t,
    (SELECT regr_intercept(total_amount, trip_distance) AS a,
            regr_slope(total_amount, trip_distance) AS b FROM ({LABELLED}) u WHERE trains) m
    WHERE NOT trains""",
)
FOLD_SCORES = over(
    "prepared",
    f"""SELECT "maxDepth", round(avg(rmse), 6) AS avg_rmse FROM (
     SELECT f.fold, sqrt(avg((t.tip_amount - m.v) * (t.tip_amount - m.v))) AS rmse
     FROM (SELECT unnest([0, 1, 2]) AS fold) f
     JOIN ({LABELLED}) t ON t.fold = f.fold AND t.trains
     JOIN (SELECT g.fold, payment_type, avg(tip_amount) AS v
           FROM (SELECT unnest([0, 1, 2]) AS fold) g
           JOIN ({LABELLED}) u ON u.fold <> g.fold AND u.trains GROUP BY 1, 2) m
       ON m.fold = f.fold AND m.payment_type = t.payment_type
     GROUP BY f.fold) s, (SELECT unnest([4E0, 5E0]) AS "maxDepth") d GROUP BY 1""",
)
TOP_MEANS = over(
    "prepared",
    f"""SELECT row_number() OVER (ORDER BY total_amount DESC, {KEY}) - 1 AS "index", total_amount,
    round(m.v, 6) AS prediction, {KEY} FROM ({LABELLED}) t
    JOIN (SELECT payment_type, avg(total_amount) AS v FROM ({LABELLED}) u WHERE trains
          GROUP BY payment_type) m USING (payment_type)
    WHERE NOT trains AND total_amount IS NOT NULL ORDER BY total_amount DESC, {KEY} LIMIT 100""",
)
SLIDING_SPIKES = over(
    "news",
    """SELECT window_start, window_start + INTERVAL '10' MINUTE AS window_end,
     article_id AS articles_with_spike_in_views, count(*) AS "count"
    FROM (SELECT article_id, unnest([time_bucket(INTERVAL '5' MINUTE, timestamp),
       time_bucket(INTERVAL '5' MINUTE, timestamp) - INTERVAL '5' MINUTE]) AS window_start FROM news) n
    GROUP BY 1, 3 HAVING count(*) > 250""",
)
SLIDING_SESSIONS = over(
    "news",
    """SELECT window_start, window_start + INTERVAL '15' MINUTE AS window_end, location,
     count(DISTINCT session_id) AS active_sessions, true AS within
    FROM (SELECT location, session_id, time_bucket(INTERVAL '5' MINUTE, timestamp)
           - unnest([0, 5, 10]) * INTERVAL '1' MINUTE AS window_start FROM news) n
    GROUP BY 1, 3""",
)
ISLANDS = over(
    "news",
    """SELECT min(timestamp) AS window_start, max(timestamp) + INTERVAL '30' SECOND AS window_end,
     user_id, count(*) AS "count" FROM (
      SELECT user_id, timestamp,
       sum(CASE WHEN timestamp <= before + INTERVAL '30' SECOND THEN 0 ELSE 1 END)
         OVER (PARTITION BY user_id ORDER BY timestamp ROWS UNBOUNDED PRECEDING) AS island
      FROM (SELECT user_id, timestamp, lag(timestamp) OVER (PARTITION BY user_id ORDER BY timestamp)
             AS before FROM news) l) i
    GROUP BY user_id, island""",
)
AS_OF = over(
    "prepared",
    f"""SELECT p.*, v.Zone, v.valid_from FROM (
     SELECT {KEY}, tpep_pickup_datetime, PULocationID FROM prepared) p
    ASOF LEFT JOIN (
     SELECT LocationID, concat(Zone, ' ', v) AS Zone,
      TIMESTAMP '1992-01-01 00:00:00' + (LocationID * 37 + v * 500) * INTERVAL '1' DAY AS valid_from
     FROM ({ZONES}) z, (SELECT unnest(range(5)) AS v) n) v
    ON p.PULocationID = v.LocationID AND p.tpep_pickup_datetime >= v.valid_from""",
)
TERMS = ", ".join(
    ["{'n': '1', 'v': 1E0}"]
    + [f"{{'n': '{c}', 'v': CAST({c} AS DOUBLE)}}" for c in CLEAN[:4]]
    + [f"{{'n': concat('{c}=', {c}), 'v': 1E0}}" for c in CODES]
    + ["{'n': 'label', 'v': total_amount}"]
)
MOMENTS = over(
    "prepared",
    f"""SELECT fold, t[i].n AS a, t[j].n AS b, round(sum(t[i].v * t[j].v), 4) + 0E0 AS total
    FROM (SELECT CAST(fold AS INT) AS fold, [{TERMS}] AS t FROM ({LABELLED}) l
          WHERE trains AND {not_null([*CLEAN, "total_amount"])}) r,
     (SELECT i, unnest(range(i, 11)) AS j FROM (SELECT unnest(range(1, 11)) AS i)) p
    GROUP BY ALL""",
)
CLOSED = f"(SELECT max(timestamp) - INTERVAL '10' MINUTE FROM ({NEWS}) n)"

ORACLE = {
    "ml_exact_linear": LINE,
    "ml_moments": MOMENTS,
    "panes_finance_by_country": FINANCE,
    "panes_device_usage": DEVICES,
    "panes_article_spikes": SPIKES,
    "panes_bot_users": BOTS,
    "panes_sliding_spikes": SLIDING_SPIKES,
    "sliding_sessions_error": SLIDING_SESSIONS,
    "user_sessions": ISLANDS,
    "stream_user_sessions_append": f"SELECT * FROM ({ISLANDS}) w WHERE window_end <= {CLOSED}",
    "join_zone_as_of": AS_OF,
    "sample_per_payment": over(
        "prepared",
        f"""SELECT {KEY}, payment_type, total_amount FROM (
         SELECT *, row_number() OVER (PARTITION BY payment_type
           ORDER BY md5(concat_ws('|', {KEY})), {KEY}) AS place FROM prepared) p
        WHERE place <= 50""",
    ),
    "ml_exact_tree": group_means("total_amount"),
    "ml_exact_tree_tip": group_means("tip_amount"),
    "ml_exact_forest_distance": group_means("trip_distance"),
    "ml_exact_forest_duration": group_means("triptime"),
    "ml_exact_boosted": group_means("total_amount"),
    "ml_exact_cv": FOLD_SCORES,
    "ml_exact_top100": TOP_MEANS,
    "ml_model_roundtrip": over(
        "prepared",
        f"""SELECT {KEY}, true AS same FROM ({LABELLED}) t
        WHERE NOT trains AND {not_null(LEAKY)}""",
    ),
    "scan_csv_inferred": f"""SELECT CAST(LocationID AS INT) AS LocationID, Borough, Zone
        FROM ({ZONES}) z""",
    "sample_of_keys": over(
        "prepared",
        f"""SELECT {KEY}, total_amount FROM prepared
        WHERE CAST(floor((l_orderkey*31 + l_partkey*17 + l_linenumber) / 7) AS BIGINT) % 100 = 0""",
    ),
    "stream_active_sessions_append": f"""SELECT * FROM ({SESSIONS}) w
        WHERE window_end <= {CLOSED}""",
    "active_sessions_error": f"SELECT *, true AS within FROM ({SESSIONS}) s",
    "revenue_by_hour_zone": over(
        "final",
        """SELECT hour, PU_Zone, round(sum(total_amount), 2) AS total_revenue FROM final
        GROUP BY 1, 2 ORDER BY total_revenue DESC, hour NULLS LAST, PU_Zone NULLS LAST LIMIT 20""",
    ),
    "prepare_trips": over("final", "SELECT * FROM final"),
    "zone_pair_counts": over(
        "final",
        """SELECT PU_Zone, DO_Zone, count(*) AS "count" FROM final GROUP BY 1, 2
        ORDER BY "count" DESC, PU_Zone NULLS LAST, DO_Zone NULLS LAST LIMIT 20""",
    ),
    "fastest_trips": over(
        "timed",
        """SELECT PU_Zone, DO_Zone, avg_speed_mph FROM timed WHERE avg_speed_mph < 120
        ORDER BY avg_speed_mph DESC, PU_Zone NULLS LAST, DO_Zone NULLS LAST LIMIT 20""",
    ),
    "avg_speed_by_pair": over(
        "timed",
        """SELECT PU_Zone, DO_Zone, round(avg(avg_speed_mph), 6) AS average_speed FROM timed
        WHERE avg_speed_mph < 120 GROUP BY 1, 2
        ORDER BY average_speed DESC, PU_Zone NULLS LAST, DO_Zone NULLS LAST LIMIT 20""",
    ),
    "avg_tip_by_hour": over(
        "prepared",
        """SELECT hour, round(avg(tip_amount), 6) AS average_tip FROM prepared GROUP BY 1
        ORDER BY average_tip DESC, hour NULLS LAST LIMIT 20""",
    ),
    "trips_by_day_hour": day_hour("Sunday"),
    "trips_by_day_hour_legacy": day_hour("Monday"),
    "scan_parquet": f"SELECT {KEY}, l_quantity, l_shipdate FROM lineitem",
    "scan_csv": ZONES,
    "load_table": """SELECT s_suppkey, s_name, s_acctbal, n_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "sink_parquet_roundtrip": over("final", "SELECT * FROM final"),
    "stream_source_json": over("news", "SELECT * EXCLUDE (event_id) FROM news"),
    "trips_valid": over(
        "trips",
        f"""SELECT {KEY}, tpep_pickup_datetime, tpep_dropoff_datetime FROM trips
        WHERE tpep_dropoff_datetime > tpep_pickup_datetime""",
    ),
    "speed_valid_trips": over(
        "timed_raw", f"SELECT {KEY}, trip_distance, trip_duration_hours FROM timed_raw"
    ),
    "finance_events": over("news", "SELECT * FROM news WHERE category = 'finance'"),
    "select_features": over(
        "prepared", f"SELECT {KEY}, {', '.join(CLEAN)}, total_amount FROM prepared"
    ),
    "drop_fee_columns": over(
        "trips",
        """SELECT * EXCLUDE (extra, mta_tax, tolls_amount, improvement_surcharge,
        congestion_surcharge, airport_fee) FROM trips""",
    ),
    "zones_as_pickup": over(
        "zones",
        """SELECT LocationID AS PULocationID, Borough AS PU_Borough, Zone AS PU_Zone
        FROM zones""",
    ),
    "trip_time_parts": over(
        "trips",
        f"""SELECT {KEY}, CAST(hour(tpep_pickup_datetime) AS INT) AS hour, {DAY} AS day_of_week
        FROM trips""",
    ),
    "trip_extras": over("trips", f"SELECT {KEY}, {FEES} AS extras FROM trips"),
    "trip_duration": over(
        "trips",
        f"""SELECT {KEY}, {SECONDS} AS triptime, {SECONDS} / 3600E0 AS trip_duration_hours
        FROM trips""",
    ),
    "trip_speed": over("timed_raw", f"SELECT {KEY}, avg_speed_mph FROM timed_raw"),
    "day_names": over(
        "trips",
        f"""SELECT {KEY}, day_of_week, {day_case("Sunday")} AS day_name,
        {day_case("Monday")} AS legacy_day_name
        FROM (SELECT *, {DAY} AS day_of_week FROM trips) t""",
    ),
    "parse_events_json": """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k
        FROM events""",
    "drop_null_rows": over(
        "prepared",
        f"""SELECT {KEY}, {', '.join(CLEAN)}, total_amount FROM prepared
        WHERE {not_null([*CLEAN, "total_amount"])}""",
    ),
    "numeric_columns": over("prepared", f"SELECT {KEY}, {', '.join(NUMBERS)} FROM prepared"),
    "train_test_split": over(
        "prepared",
        f"""SELECT {KEY}, CASE WHEN (l_orderkey*31 + l_partkey*17 + l_linenumber) % 10 < 8
        THEN 'train' ELSE 'test' END AS split FROM prepared""",
    ),
    "join_pickup_zone": over(
        "final", f"SELECT {KEY}, PULocationID, PU_Borough, PU_Zone FROM final"
    ),
    "join_both_zones": over(
        "final",
        f"""SELECT {KEY}, PULocationID, DOLocationID, PU_Borough, PU_Zone, DO_Borough, DO_Zone
        FROM final""",
    ),
    "null_counts": over(
        "final",
        union(
            [
                f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM final"""
                for c in [*TIMES, *NUMBERS, *TEXTS]
            ]
        ),
    ),
    "describe_columns": over("final", DESCRIBE),
    "correlation_matrix": over(
        "prepared",
        union(
            [
                f"""SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) + 0E0 AS r
                FROM prepared WHERE {not_null(NUMBERS)}"""
                for a in NUMBERS
                for b in NUMBERS
            ]
        ),
    ),
    "finance_by_country": FINANCE,
    "top10_countries": TOP10,
    "device_usage": DEVICES,
    "active_sessions": SESSIONS,
    "article_spikes": SPIKES,
    "bot_users": BOTS,
    "bot_users_distinct_articles": BOT_ARTICLES,
    "stream_finance_by_country": FINANCE,
    "stream_top10_countries": TOP10,
    "stream_device_usage": DEVICES,
    "stream_active_sessions_exact": SESSIONS,
    "stream_article_spikes": SPIKES,
    "stream_bot_users": BOTS,
    "spike_alerts": SPIKE_ALERTS,
    "bot_alerts": BOT_ALERTS,
    "stream_spike_alerts": SPIKE_ALERTS,
    "stream_bot_alerts": BOT_ALERTS,
    "stream_device_usage_append": CLOSED_DEVICES,
    "onehot_codes": over(
        "prepared",
        f"""SELECT {KEY}, {', '.join(CODES)}, {ONEHOT}
        FROM prepared, (SELECT {ONEHOT_MAX} FROM prepared) m""",
    ),
    "assemble_features": over(
        "prepared",
        f"""SELECT {KEY}, {', '.join(f'CAST({c} AS DOUBLE) AS f_{c}' for c in LEAKY)}
        FROM prepared WHERE {not_null(LEAKY)}""",
    ),
    "normalize_features": over(
        "prepared",
        f"""SELECT {KEY}, {', '.join(f'round(({c} - a_{c}) / s_{c}, 6) + 0E0 AS z_{c}'
                                    for c in LEAKY)}
        FROM prepared, (SELECT {', '.join(f'avg({c}) AS a_{c}, stddev_samp({c}) AS s_{c}'
                                          for c in LEAKY)}
                        FROM prepared WHERE {not_null(LEAKY)}) m
        WHERE {not_null(LEAKY)}""",
    ),
    "regression_metrics": over(
        "prepared",
        f"""SELECT count(error) AS "rows", round(sqrt(avg(error * error)), 6) AS rmse,
        round(avg(abs(error)), 6) AS mae,
        round(1 - avg(error * error) / var_pop(total_amount), 6) AS r2 FROM ({ERRORS}) e""",
    ),
    "rule_top100": over(
        "prepared",
        f"""SELECT row_number() OVER (ORDER BY total_amount DESC, {KEY}) - 1 AS "index",
        total_amount, prediction, {KEY} FROM ({ERRORS}) e
        ORDER BY total_amount DESC, {KEY} LIMIT 100""",
    ),
}
