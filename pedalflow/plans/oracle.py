"""The same results in SQL, for a check of the queries by another engine (DuckDB)."""

from ..constants import TRAILING, TRAIN_BELOW
from ..schemas import UTIL_MEASURES, WEATHER_MEASURES
from .queries import CUTOFF, CUTOFFS, LEAD_DELAY, METRO

# The derived feeds, over the given tables. Events carry the region of their user as city, or one city for all.
_EVENTS_BY_REGION = """fx_events AS (
  SELECT e.event_id, date_trunc('second', e.ts) AS event_time, e.user_id, e.event_type, e.value,
    CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k, r_name AS city
  FROM events e LEFT JOIN customer ON e.user_id = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

_EVENTS_ONE_CITY = f"""fx_events AS (
  SELECT e.event_id, date_trunc('second', e.ts) AS event_time, e.user_id, e.event_type, e.value,
    CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k, '{METRO}' AS city
  FROM events e)"""

_FEEDS = """fx_status_raw AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS station_id,
    CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(floor(value) AS INTEGER) % 21 END AS num_bikes_available,
    CASE WHEN k % 19 = 0 THEN NULL ELSE k % 21 END AS num_docks_available,
    CASE WHEN k % 7 = 0 THEN NULL ELSE k % 2 = 0 END AS is_renting, city, event_time
  FROM fx_events WHERE event_type <> 'view'),
fx_status AS (
  SELECT event_id, station_id, COALESCE(num_bikes_available, 0) AS num_bikes_available,
    COALESCE(num_docks_available, 0) AS num_docks_available, COALESCE(is_renting, TRUE) AS is_renting, city, event_time
  FROM fx_status_raw WHERE station_id <> ''),
fx_weather AS (
  SELECT event_id, value AS temperature, CAST(k AS DOUBLE) / 10 AS wind_speed, k AS cloudiness,
    CASE WHEN k % 5 = 0 THEN value / 100 ELSE CAST(0 AS DOUBLE) END AS precipitation, city, event_time
  FROM fx_events WHERE event_type = 'view')"""

_STATIONS = """fx_info_raw AS (
  SELECT CAST(c_custkey AS VARCHAR) AS station_id, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END AS name,
    CAST(20 AS DOUBLE) + c_nationkey AS lat, CAST(50 AS DOUBLE) + c_nationkey AS lon,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(floor(c_acctbal / 100) AS INTEGER) END AS capacity, 1 AS msg_offset
  FROM customer
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), c_name, CAST(20 AS DOUBLE) + c_nationkey, CAST(50 AS DOUBLE) + c_nationkey,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(floor(c_acctbal / 100) AS INTEGER) + 5 END, 2
  FROM customer WHERE c_custkey % 3 = 0),
valid_stations AS (
  SELECT station_id, COALESCE(name, 'Unknown') AS name, lat, lon, capacity, msg_offset
  FROM fx_info_raw WHERE station_id <> '' AND capacity IS NOT NULL),
stations AS (
  SELECT station_id, name, lat, lon, capacity FROM valid_stations
  QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY msg_offset DESC) = 1)"""

_EPOCH = "CAST(epoch(event_time) AS BIGINT)"

_UTILIZATION = "num_bikes_available / NULLIF(CAST(num_bikes_available + num_docks_available AS DOUBLE), 0)"

_STATUS_RECORD = f"""SELECT event_id, station_id, num_bikes_available, num_docks_available, is_renting AS is_installed,
  is_renting, is_renting AS is_returning, {_EPOCH} AS last_reported, city, {_EPOCH} AS event_timestamp"""

_WEATHER_RECORD = f"""SELECT {_EPOCH} AS timestamp, temperature, wind_speed, cloudiness, precipitation, city,
  {_EPOCH} AS event_timestamp"""

_BUCKETS = {
    30: "time_bucket(INTERVAL '30 minutes', event_time)",
    1: "date_trunc('minute', event_time)",
}


def _round(*names):
    return ", ".join(f"round({name}, 6) AS {name}" for name in names)


def _feeds(one_city=False):
    return f"WITH {_EVENTS_ONE_CITY if one_city else _EVENTS_BY_REGION},\n{_FEEDS}"


def _windows(minutes):
    start = _BUCKETS[minutes]
    end = f"{start} + INTERVAL '{minutes} minutes'"
    return f"""util AS (
  SELECT {start} AS window_start, {end} AS window_end, city, avg(u) AS avg_util, max(u) AS max_util,
    min(u) AS min_util, stddev_samp(u) AS std_util
  FROM (SELECT event_time, city, {_UTILIZATION} AS u FROM fx_status) GROUP BY ALL),
air AS (
  SELECT {start} AS window_start, {end} AS window_end, city, avg(temperature) AS avg_temp, avg(wind_speed) AS avg_wind,
    avg(cloudiness) AS avg_clouds, avg(precipitation) AS avg_rain
  FROM fx_weather GROUP BY ALL),
usage AS (
  SELECT util.*, avg_temp, avg_wind, avg_clouds, avg_rain FROM util JOIN air USING (window_start, window_end, city))"""


def _usage(minutes=30, one_city=False):
    return f"{_feeds(one_city)},\n{_windows(minutes)}"


_USAGE_OUT = f"window_start, window_end, city, {_round(*UTIL_MEASURES, *WEATHER_MEASURES)}"

_LEADS = {
    "avg_temp": "temp_t1h",
    "avg_wind": "wind_t1h",
    "avg_rain": "rain_t1h",
    "avg_clouds": "clouds_t1h",
    "window_start": "time_t1h",
    "avg_util": "util_t1h",
}
_LED_DOUBLES = [name for name in _LEADS.values() if name != "time_t1h"]


def _lead_rows():
    leads = ", ".join(f"lead({source}, 2) OVER w AS {name}" for source, name in _LEADS.items())
    return f"led AS (SELECT *, {leads} FROM usage WINDOW w AS (PARTITION BY city ORDER BY window_start))"


def _lead_exact():
    leads = ", ".join(f"b.{source} AS {name}" for source, name in _LEADS.items())
    return f"""led AS (SELECT a.*, {leads} FROM usage a
  LEFT JOIN usage b ON a.city = b.city AND b.window_start = a.window_start + INTERVAL '1 hour')"""


_LED_OUT = f"{_USAGE_OUT}, time_t1h, {_round(*_LED_DOUBLES)}"


def _calendar(at):
    weekday = f"CAST(dayofweek({at}) + 1 AS INTEGER)"
    return f"""CAST(hour({at}) AS INTEGER) AS hour_t1h, {weekday} AS dow_t1h,
  CASE WHEN {weekday} IN (1, 7) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS is_weekend_t1h"""


_PART = f"""CASE WHEN substr(md5(concat_ws('|', city, CAST(CAST(epoch(window_start) AS BIGINT) AS VARCHAR))), 1, 4)
  < '{TRAIN_BELOW}' THEN 'train' ELSE 'test' END"""

_COMPLETE = " AND ".join(f"{name} IS NOT NULL" for name in _LEADS.values())


def _features(lead, one_city=True):
    return f"""{_usage(one_city=one_city)},
{lead},
features AS (SELECT *, {_calendar("time_t1h")} FROM led WHERE {_COMPLETE})"""


_FEATURES_OUT = f"{_LED_OUT}, hour_t1h, dow_t1h, is_weekend_t1h"

_LAST_STATUS = "(SELECT max(event_time) FROM fx_status)"
# Readings without a city are never published.
_LAST_WEATHER = "(SELECT max(event_time) FROM fx_weather WHERE city IS NOT NULL)"


def _closed(last, delay):
    return f"window_end <= {last} - INTERVAL '{delay}'"


def _weather_flatten(lost):
    present = f"NOT ({lost})"
    fields = ["temperature", "wind_speed", "cloudiness", "precipitation"]
    values = ", ".join(f"CASE WHEN {present} THEN {f} END AS {f}" for f in fields)
    return f"{_feeds()}\nSELECT event_id, {_EPOCH} AS timestamp, {values} FROM fx_weather"


def _record_text():
    names = ["event_id", "station_id", "num_bikes_available", "num_docks_available", "is_installed", "is_renting"]
    names += ["is_returning", "last_reported", "city", "event_timestamp"]
    fields = ", ".join(f"'{n}': {n}" for n in names)
    return f"""{_feeds()}
SELECT station_id AS key, CAST(to_json({{{fields}}}) AS VARCHAR) AS value
FROM ({_STATUS_RECORD} FROM fx_status_raw) WHERE station_id <> ''"""


def _histogram(before, values):
    return f"""{before},
v AS ({values}),
r AS (SELECT min(v) - m AS low, max(v) + m AS high
  FROM v, (SELECT CASE WHEN min(v) = max(v) THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS m FROM v) GROUP BY m),
b AS (SELECT CAST(least(floor((v - low) * 20 / (high - low)), 19) AS INTEGER) AS bin, count(*) AS n
  FROM v, r GROUP BY 1),
bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(20))
SELECT bin, round(low + bin * (high - low) / 20, 6) AS bin_start,
  round(low + (bin + 1) * (high - low) / 20, 6) AS bin_end, COALESCE(n, 0) AS n
FROM bins LEFT JOIN b USING (bin), r"""


_STATUS_COLUMNS = "event_id, station_id, num_bikes_available, num_docks_available, is_renting, city, event_time"

_ENRICHED = f"""{_feeds()},
{_STATIONS}
SELECT s.*, name, lat, lon, capacity FROM fx_status s LEFT JOIN stations USING (station_id)"""

def _trailing():
    """Whole sums over RANGE frames, and joins for the lags; the numbers are not rounded."""
    columns, joins = [], []
    for name, span in TRAILING.items():
        n, s, q = (f"{f} OVER w_{name}" for f in ("count(x)", "sum(x)", "sum(CAST(x AS HUGEINT) * x)"))
        columns += [
            f"{n} AS n_{name}",
            f"CASE WHEN {n} > 0 THEN CAST({s} AS DOUBLE) / ({n}) / 1000000 END AS mean_{name}",
            f"""CASE WHEN {n} > 1 THEN
    sqrt(CAST(({n}) * ({q}) - ({s}) * ({s}) AS DOUBLE) / CAST(({n}) * ({n} - 1) AS DOUBLE)) / 1000000 END AS std_{name}""",
            f"CAST(l_{name}.x AS DOUBLE) / 1000000 AS lag_{name}",
        ]
        joins.append(f"""LEFT JOIN values_at l_{name}
  ON l_{name}.city IS NOT DISTINCT FROM u.city AND l_{name}.window_start = u.window_start - INTERVAL '{span}'""")
    windows = ", ".join(
        f"w_{name} AS (PARTITION BY u.city ORDER BY u.window_start RANGE BETWEEN INTERVAL '{span}' PRECEDING AND CURRENT ROW)"
        for name, span in TRAILING.items()
    )
    u = ", ".join(c.replace("(x)", "(u.x)").replace("AS HUGEINT) * x", "AS HUGEINT) * u.x").replace("CAST(x AS", "CAST(u.x AS") for c in columns)
    return f""",
values_at AS (SELECT window_start, city, CAST(round(round(avg_util, 6) * 1000000) AS BIGINT) AS x FROM usage)
SELECT u.window_start, u.city, {u}
FROM values_at u {" ".join(joins)} WINDOW {windows}"""


_CUTOFF_ROWS = ", ".join(f"({k}, TIMESTAMP '{c}', TIMESTAMP '{e}')" for k, (c, e) in enumerate(zip(CUTOFFS, [*CUTOFFS[1:], "9999-01-01"])))

_FOLDS = f"""{_features(_lead_exact())},
cuts(fold, low, high) AS (VALUES {_CUTOFF_ROWS}),
folded AS (SELECT features.*, CAST(fold AS INTEGER) AS fold,
    CASE WHEN features.time_t1h < low THEN 'train' WHEN window_start >= low AND window_start < high THEN 'test' END AS part
  FROM features JOIN cuts ON features.time_t1h < low OR (window_start >= low AND window_start < high))"""

ORACLE = {
    "usage_compacted": f"{_usage()}\nSELECT {_USAGE_OUT} FROM usage",
    "usage_rollup": f"""{_usage()}
SELECT {_USAGE_OUT}, '30 minutes' AS grain FROM usage
UNION ALL SELECT * FROM ({_usage(1)} SELECT {_USAGE_OUT}, '1 minute' AS grain FROM usage)""",
    "status_enriched_asof": f"""{_feeds()},
{_STATIONS},
history AS (SELECT station_id, name, lat, lon, capacity, TIMESTAMP '2024-01-01' + to_days(CAST(
    CASE WHEN msg_offset = 1 THEN CAST(station_id AS BIGINT) % 5 ELSE 10 + CAST(station_id AS BIGINT) % 13 END AS INTEGER)) AS valid_from
  FROM valid_stations)
SELECT s.*, name, lat, lon, capacity FROM fx_status s
ASOF LEFT JOIN history h ON s.station_id = h.station_id AND s.event_time >= h.valid_from""",
    "trailing_features": f"{_usage(one_city=True)}{_trailing()}",
    "trailing_features_by_city": f"{_usage()}{_trailing()}",
    "stream_dedup_usage": f"""{_feeds()},
{_windows(30).replace("FROM fx_status)", "FROM (SELECT DISTINCT event_time, city, station_id, num_bikes_available, num_docks_available FROM fx_status))").replace("FROM fx_weather GROUP", "FROM (SELECT DISTINCT event_time, city, temperature, wind_speed, cloudiness, precipitation FROM fx_weather) GROUP")}
SELECT {_USAGE_OUT} FROM usage WHERE {_closed(f"least({_LAST_STATUS}, {_LAST_WEATHER})", "30 minutes")}""",
    "stream_usage_rollup": f"""{_usage()}
SELECT {_USAGE_OUT} FROM usage WHERE {_closed(f"least({_LAST_STATUS}, {_LAST_WEATHER})", "30 minutes")}""",
    "stream_lead_exact": f"""{_usage()},
closed AS (SELECT * FROM usage WHERE {_closed(f"least({_LAST_STATUS}, {_LAST_WEATHER})", "30 minutes")}),
{_lead_exact().replace("FROM usage a", "FROM closed a").replace("JOIN usage b", "JOIN closed b")}
SELECT {_LED_OUT} FROM led
WHERE time_t1h IS NOT NULL OR window_start + INTERVAL '1 hour' < (SELECT max(window_start) FROM closed) - INTERVAL '{LEAD_DELAY}'""",
    "stream_open_windows": f"""{_usage()}
SELECT window_start, window_end, city FROM util WHERE NOT ({_closed(_LAST_STATUS, "30 minutes")})""",
    "stream_intake_counts": f"""{_feeds()},
ends AS (SELECT min({_EPOCH}) AS first, max({_EPOCH}) AS last FROM fx_status),
sent AS (SELECT event_id, event_time, FALSE AS again FROM fx_status
  UNION ALL SELECT event_id, event_time, TRUE FROM fx_status, ends WHERE ({_EPOCH} - first) * 4 // (last - first + 1) = 0),
good AS (SELECT max(event_time) AS greatest FROM fx_status WHERE event_id % 50 <> 7)
SELECT CASE WHEN event_id % 50 = 7 THEN 'corrupt'
  WHEN again AND {_BUCKETS[30]} + INTERVAL '30 minutes' <= greatest - INTERVAL '30 minutes' THEN 'late' ELSE 'loaded' END AS outcome,
  count(*) AS n
FROM sent, good GROUP BY 1""",
    "fold_sizes": f"{_FOLDS}\nSELECT fold, part, count(*) AS n FROM folded GROUP BY fold, part",
    "rolling_persistence": f"""{_FOLDS},
judged AS (SELECT fold, util_t1h AS y, util_t1h - avg_util AS e FROM folded WHERE part = 'test')
SELECT fold, count(*) AS n, round(sqrt(avg(e * e)), 6) AS rmse,
  round(1 - sum(e * e) / NULLIF(var_pop(y) * count(y), 0), 6) AS r2, round(avg(abs(e)), 6) AS mae
FROM judged GROUP BY fold""",
    "message_encode": _record_text(),
    "decode_status": f"""{_feeds()}
SELECT * EXCLUDE (event_id) FROM ({_STATUS_RECORD} FROM fx_status_raw) WHERE station_id <> ''""",
    "decode_info": f"WITH {_STATIONS}\nSELECT station_id, name, lat, lon, capacity FROM fx_info_raw",
    "decode_weather": f"{_feeds()}\n{_WEATHER_RECORD} FROM fx_weather WHERE city <> ''",
    "stations_explode": f"WITH {_STATIONS}\nSELECT station_id, name, lat, lon, capacity FROM fx_info_raw",
    "static_snapshot": f"WITH {_STATIONS}\nSELECT * FROM stations",
    "station_info_valid": f"WITH {_STATIONS}\nSELECT * FROM valid_stations",
    "station_status_clean": f"{_feeds()}\nSELECT {_STATUS_COLUMNS} FROM fx_status",
    "weather_flatten": _weather_flatten("FALSE"),
    "weather_missing": _weather_flatten("event_id % 10 = 3"),
    "stamped_status": f"""{_feeds(one_city=True)}
SELECT event_id, station_id, num_bikes_available, num_docks_available, is_renting, 'Dubai' AS city,
  {_EPOCH} AS event_timestamp
FROM fx_status""",
    "event_time": f"""{_feeds(one_city=True)}
SELECT event_id, {_EPOCH} AS event_timestamp, make_timestamp({_EPOCH} * 1000000) AS event_time FROM fx_status""",
    "utilization": f"""{_feeds()}
SELECT event_id, station_id, city, round({_UTILIZATION}, 6) AS utilization FROM fx_status""",
    "audit_counts": f"""{_feeds(one_city=True)},
{_STATIONS}
SELECT 'station_info' AS feed, CASE WHEN station_id IS NULL OR station_id = '' THEN 'no_station_id'
  WHEN capacity IS NULL THEN 'no_capacity' ELSE 'loaded' END AS outcome, count(*) AS n FROM fx_info_raw GROUP BY 1, 2
UNION ALL
SELECT 'station_status', CASE WHEN station_id IS NULL OR station_id = '' THEN 'no_station_id' ELSE 'loaded' END,
  count(*) FROM fx_status_raw GROUP BY 1, 2""",
    "status_enriched": _ENRICHED,
    "utilization_by_window_30m": f"""{_usage()}
SELECT window_start, window_end, city, {_round(*UTIL_MEASURES)} FROM util""",
    "utilization_by_window_1m": f"""{_usage(1)}
SELECT window_start, window_end, city, {_round(*UTIL_MEASURES)} FROM util""",
    "weather_by_window_30m": f"""{_usage()}
SELECT window_start, window_end, city, {_round(*WEATHER_MEASURES)} FROM air""",
    "weather_by_window_1m": f"""{_usage(1)}
SELECT window_start, window_end, city, {_round(*WEATHER_MEASURES)} FROM air""",
    "usage_summary_30m": f"{_usage()}\nSELECT {_USAGE_OUT} FROM usage",
    "usage_summary_1m": f"{_usage(1)}\nSELECT {_USAGE_OUT} FROM usage",
    "usage_from_json_30m": f"{_usage()}\nSELECT {_USAGE_OUT} FROM usage",
    "usage_ordered": f"{_usage()}\nSELECT {_USAGE_OUT} FROM usage ORDER BY window_start, city",
    "summary_csv_roundtrip": f"{_usage()}\nSELECT {_USAGE_OUT} FROM usage",
    "lead_rows": f"{_usage(one_city=True)},\n{_lead_rows()}\nSELECT {_LED_OUT} FROM led",
    "lead_rows_by_city": f"{_usage()},\n{_lead_rows()}\nSELECT {_LED_OUT} FROM led",
    "lead_exact": f"{_usage(one_city=True)},\n{_lead_exact()}\nSELECT {_LED_OUT} FROM led",
    "lead_exact_by_city": f"{_usage()},\n{_lead_exact()}\nSELECT {_LED_OUT} FROM led",
    "calendar_features": f"{_feeds(one_city=True)}\nSELECT event_id, {_calendar('event_time')} FROM fx_status",
    "feature_rows": f"{_features(_lead_exact())}\nSELECT {_FEATURES_OUT} FROM features",
    "feature_rows_by_rows": f"{_features(_lead_rows())}\nSELECT {_FEATURES_OUT} FROM features",
    "latest_row": f"""{_features(_lead_exact())}
SELECT {_FEATURES_OUT} FROM features ORDER BY features.time_t1h DESC, city LIMIT 1""",
    "latest_row_per_city": f"""{_features(_lead_exact(), one_city=False)}
SELECT {_FEATURES_OUT} FROM features
QUALIFY row_number() OVER (PARTITION BY city ORDER BY features.time_t1h DESC) = 1""",
    "util_histogram": _histogram(
        _usage(one_city=True), "SELECT round(avg_util, 6) AS v FROM usage WHERE avg_util IS NOT NULL"
    ),
    "test_label_histogram_by_time": _histogram(
        _features(_lead_exact()),
        f"SELECT round(util_t1h, 6) AS v FROM features WHERE window_start >= TIMESTAMP '{CUTOFF}'",
    ),
    "stream_usage_summary": f"""{_usage()}
SELECT {_USAGE_OUT} FROM usage WHERE {_closed(f"least({_LAST_STATUS}, {_LAST_WEATHER})", "30 minutes")}""",
    "stream_usage_from_files": f"""{_usage()}
SELECT {_USAGE_OUT} FROM usage WHERE {_closed(f"least({_LAST_STATUS}, {_LAST_WEATHER})", "30 minutes")}""",
    "stream_usage_late_files": f"""{_usage()}
SELECT {_USAGE_OUT} FROM usage WHERE {_closed(f"least({_LAST_STATUS}, {_LAST_WEATHER})", "30 minutes")}""",
    "stream_usage_summary_1m": f"""{_usage(1)}
SELECT {_USAGE_OUT} FROM usage WHERE {_closed(f"least({_LAST_STATUS}, {_LAST_WEATHER})", "30 seconds")}""",
    "stream_utilization": f"""{_usage()}
SELECT window_start, window_end, city, {_round(*UTIL_MEASURES)} FROM util
WHERE {_closed(_LAST_STATUS, "30 minutes")}""",
    "stream_weather_windows": f"""{_usage()}
SELECT window_start, window_end, city, {_round(*WEATHER_MEASURES)} FROM air
WHERE city IS NOT NULL AND {_closed(_LAST_WEATHER, "30 minutes")}""",
    "stream_status_enriched": _ENRICHED,
    "stream_weather_rows": f"""{_feeds()}
SELECT timestamp, round(temperature, 6) AS temperature, round(wind_speed, 6) AS wind_speed, cloudiness,
  round(precipitation, 6) AS precipitation, city, event_timestamp,
  make_timestamp(event_timestamp * 1000000) AS event_time
FROM ({_WEATHER_RECORD} FROM fx_weather WHERE city <> '')""",
    "split_counts": f"{_features(_lead_exact())}\nSELECT {_PART} AS part, count(*) AS n FROM features GROUP BY 1",
    "test_label_histogram": _histogram(
        _features(_lead_exact()), f"SELECT round(util_t1h, 6) AS v FROM features WHERE {_PART} = 'test'"
    ),
    "persistence_metrics": f"""{_features(_lead_exact())},
judged AS (SELECT util_t1h AS y, util_t1h - avg_util AS e FROM features WHERE {_PART} = 'test')
SELECT count(*) AS n, round(sqrt(avg(e * e)), 6) AS rmse,
  round(1 - sum(e * e) / NULLIF(var_pop(y) * count(y), 0), 6) AS r2, round(avg(abs(e)), 6) AS mae
FROM judged""",
    "persistence_series": f"""{_features(_lead_exact())}
SELECT features.time_t1h, city, round(util_t1h, 6) AS util_t1h, round(avg_util, 6) AS prediction
FROM features WHERE {_PART} = 'test' ORDER BY features.time_t1h, city""",
    "split_counts_by_time": f"""{_features(_lead_exact())}
SELECT CASE WHEN window_start < TIMESTAMP '{CUTOFF}' THEN 'train' ELSE 'test' END AS part, count(*) AS n
FROM features GROUP BY 1""",
}
