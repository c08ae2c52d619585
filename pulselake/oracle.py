"""The named queries in SQL, for comparison by another engine on the same tables."""

from __future__ import annotations

from pulselake.functions.calendar import CATEGORY_NAMES
from pulselake.sources import testdata

_KINDS = " ".join(f"WHEN '{k}' THEN {i}" for k, i, _ in testdata.ACTIVITIES)
_NAMES = " ".join(f"WHEN '{k}' THEN '{n}'" for k, _, n in testdata.ACTIVITIES)


def _pick(values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[CAST(c_custkey % {len(values)} AS INTEGER) + 1]"


# Common table expressions: silver readings, users and activities.
HR = f"""hr AS (
  SELECT event_id, user_id,
         CAST(floor(value) AS BIGINT) % 166 + 40 AS heart_rate,
         date_trunc('second', ts) AS event_timestamp,
         CAST(date_trunc('second', ts) AS DATE) AS event_date,
         CAST(CASE event_type {_KINDS} END AS BIGINT) AS activity_id,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) - 45 AS DOUBLE) AS latitude,
         CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) * 2 - 90 AS DOUBLE) AS longitude
  FROM events)"""

USERS = f"""users AS (
  SELECT c_custkey AS user_id,
         split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
         (c_custkey % 65 + 1940) * 10000 + (c_custkey % 12 + 1) * 100 + (c_custkey % 28 + 1) AS dob,
         make_date(c_custkey % 65 + 1940, c_custkey % 12 + 1, c_custkey % 28 + 1) AS date_of_birth,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(c_custkey % 50 + 150 AS BIGINT) AS height, CAST(c_custkey % 60 + 45 AS BIGINT) AS weight,
         {_pick(testdata.BLOOD_TYPES)} AS blood_type, {_pick(testdata.RACES)} AS race,
         n_name AS origin_country, c_name || ', ' || n_name AS address, n_name AS address_country,
         'N' || c_nationkey AS country_code,
         CAST('{testdata.USER_UPDATE[:10]}' AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

ACTIVITIES = f"""activities AS (
  SELECT DISTINCT CAST(CASE event_type {_KINDS} END AS BIGINT) AS activity_id,
         CASE event_type {_NAMES} END AS activity_name,
         CAST('{testdata.ACTIVITY_UPDATE[:10]}' AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date
  FROM events)"""

DIRTY = HR + """, dirty AS (
  SELECT event_id, CASE WHEN heart_rate <= 190 THEN user_id END AS user_id, heart_rate, event_timestamp,
         CASE WHEN heart_rate >= 60 THEN activity_id END AS activity_id,
         CASE WHEN heart_rate >= 60 THEN latitude * 2 END AS latitude,
         CASE WHEN heart_rate >= 60 THEN longitude * 2 END AS longitude
  FROM hr)"""

_SILVER = ("SELECT user_id, heart_rate, event_timestamp, activity_id, latitude, longitude, event_id FROM hr")

_CATEGORY = """CASE WHEN hour(event_timestamp) <= 5 THEN 'Early Morning'
  WHEN hour(event_timestamp) <= 11 THEN 'Morning' WHEN hour(event_timestamp) <= 17 THEN 'Afternoon'
  WHEN hour(event_timestamp) <= 21 THEN 'Evening' ELSE 'Night' END"""

_LAG = "lag(heart_rate) OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id)"
_DAY = "PARTITION BY user_id, activity_id, event_date"

FACT = HR + f""", fact AS (
  SELECT user_id AS user_key, heart_rate, event_date, strftime(event_timestamp, '%H:%M:%S') AS event_time,
         {_LAG} AS previous_heart_rate,
         max(heart_rate) OVER ({_DAY}) AS max_heart_rate, min(heart_rate) OVER ({_DAY}) AS min_heart_rate,
         avg(heart_rate) OVER ({_DAY}) AS avg_heart_rate, activity_id, latitude, longitude,
         event_id, event_timestamp
  FROM hr)"""
_FACT = f"""WITH {FACT} SELECT user_key, heart_rate, event_date, event_time, previous_heart_rate,
  max_heart_rate, min_heart_rate, avg_heart_rate, activity_id, latitude, longitude FROM fact"""

_DAYS = """days AS (
  SELECT CAST(d AS DATE) AS date FROM (
    SELECT unnest(generate_series(
      date_trunc('year', min(o_orderdate)),
      CAST(make_date(CAST(year(max(o_orderdate)) AS BIGINT), 12, 31) AS TIMESTAMP),
      INTERVAL 1 DAY)) AS d FROM orders))"""

_MINUTES = """minutes AS (
  SELECT CAST(m // 60 AS INTEGER) AS hour, CAST(m % 60 AS INTEGER) AS minute,
         lpad(CAST(m // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') || ':00' AS time_of_day
  FROM (SELECT unnest(range(1440)) AS m))"""


def _report(table: str, source: str, rules: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{name}' AS rule, count(*) FILTER (WHERE {bad}) AS violations,"
        f" count(*) AS total FROM {source}" for name, bad in rules)


ORACLE: dict[str, str] = {}

# Sources and sinks
ORACLE["write_roundtrip"] = f"WITH {HR} {_SILVER}"
ORACLE["publish_dims"] = f"""WITH {USERS}, {ACTIVITIES}, {_DAYS}, {_MINUTES}
SELECT 'dim_users' AS dimension, CAST(user_id AS VARCHAR) AS member FROM users
UNION ALL SELECT 'dim_activities', CAST(activity_id AS VARCHAR) FROM activities
UNION ALL SELECT 'dim_date', CAST(date AS VARCHAR) FROM days
UNION ALL SELECT 'dim_time', time_of_day FROM minutes"""
ORACLE["csv_ingest"] = f"""WITH {USERS} SELECT user_id AS userid, first_name AS fname, last_name AS lname, dob,
  gender AS sex, height, weight, blood_type, race, country_code AS origin_country_code,
  origin_country AS origin_country_name, address, country_code AS address_country_code,
  address_country AS address_country_name, '{testdata.USER_UPDATE}' AS last_update FROM users"""
ORACLE["scan_table"] = ORACLE["csv_ingest"]
ORACLE["jsonl_ingest"] = f"WITH {HR} {_SILVER}"
ORACLE["jsonl_corrupt_split"] = f"""WITH {HR} SELECT
  CASE WHEN heart_rate > 180 THEN 'corrupt' ELSE 'good' END AS status,
  CASE WHEN heart_rate <= 180 THEN event_id END AS event_id,
  CASE WHEN heart_rate <= 180 THEN heart_rate END AS heart_rate FROM hr"""
_META = """'{"activity_id":' || activity_id || ',"location":{"latitude":' || latitude || ',"longitude":' || longitude
  || '}}' AS meta"""
ORACLE["incremental_append"] = f"""WITH {HR} SELECT event_id, user_id, heart_rate,
  CAST(epoch(event_timestamp) AS BIGINT) AS timestamp, {_META} FROM hr"""
ORACLE["encode_events"] = f"""WITH {HR} SELECT CAST(user_id AS VARCHAR) AS key,
  '{{"event_id":' || event_id || ',"user_id":' || user_id || ',"heart_rate":' || heart_rate
  || ',"timestamp":' || CAST(epoch(event_timestamp) AS BIGINT) || ',"meta":{{"activity_id":' || activity_id
  || ',"location":{{"latitude":' || latitude || ',"longitude":' || longitude || '}}}}}}' AS value FROM hr"""
ORACLE["decode_events"] = f"WITH {HR} {_SILVER}"
ORACLE["lake_sink_hourly"] = ORACLE["stream_lake_sink"] = f"""WITH {HR} SELECT event_id, user_id, heart_rate,
  CAST(epoch(event_timestamp) AS BIGINT) AS timestamp, {_META},
  strftime(event_timestamp, '%Y') AS year, strftime(event_timestamp, '%m') AS month,
  strftime(event_timestamp, '%d') AS day, strftime(event_timestamp, '%H') AS hour FROM hr"""

# Cleaning
ORACLE["silver_users"] = f"""WITH {USERS} SELECT user_id, first_name, last_name, date_of_birth, gender, height,
  weight, blood_type, race, origin_country, address, address_country, start_date, end_date FROM users"""
ORACLE["silver_activities"] = f"WITH {ACTIVITIES} SELECT * FROM activities"
ORACLE["silver_heart_rate"] = f"WITH {HR} {_SILVER}"
ORACLE["filter_not_null"] = f"""WITH {DIRTY} SELECT event_id, user_id, activity_id FROM dirty
WHERE user_id IS NOT NULL AND activity_id IS NOT NULL"""
ORACLE["filter_conjunction"] = f"""WITH {HR} SELECT event_id, user_id, activity_id, heart_rate FROM hr
WHERE activity_id = 20683 AND heart_rate = 100 AND event_date >= DATE '2024-01-10'"""
ORACLE["json_flatten"] = f"WITH {DIRTY} SELECT event_id, activity_id, latitude, longitude FROM dirty"
ORACLE["parse_yyyymmdd"] = f"""WITH {USERS} SELECT user_id AS userid,
  CASE WHEN height >= 190 THEN dob + 1300 ELSE dob END AS dob,
  CASE WHEN height < 190 THEN date_of_birth END AS date_of_birth, height >= 190 AS rejected FROM users"""
ORACLE["epoch_to_timestamp"] = f"""WITH {HR} SELECT event_id, CAST(epoch(event_timestamp) AS BIGINT) AS timestamp,
  event_timestamp, strftime(event_timestamp, '%H:%M:%S') AS event_time FROM hr"""
ORACLE["dedup_events"] = f"WITH {HR} {_SILVER}"
ORACLE["dedup_conflicts"] = f"WITH {HR} {_SILVER}"
ORACLE["epoch_out_of_range"] = f"""WITH {HR} SELECT event_id,
  CAST(epoch(event_timestamp) AS BIGINT) * CASE WHEN heart_rate > 150 THEN 1000 WHEN heart_rate > 100 THEN 1000000000 ELSE 1 END
    AS timestamp,
  CASE WHEN heart_rate <= 100 THEN event_timestamp END AS event_timestamp FROM hr"""
ORACLE["dedup_latest"] = """SELECT o_custkey AS user_id, o_orderdate AS last_update, o_orderkey AS version,
  o_orderpriority AS address FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""

# Keys and history
ORACLE["surrogate_key"] = f"""WITH {USERS} SELECT user_id, start_date,
  md5(user_id || '|' || CAST(start_date AS VARCHAR)) AS user_sk FROM users"""
_SCD2 = """WITH daily AS (
  SELECT o_custkey AS user_id, CAST(o_orderdate AS DATE) AS start_date,
         o_orderpriority AS address, o_orderstatus AS blood_type FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)
                             ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
marked AS (
  SELECT *, lag(address) OVER w AS was_address, lag(blood_type) OVER w AS was_type,
         row_number() OVER w AS n
  FROM daily WINDOW w AS (PARTITION BY user_id ORDER BY start_date)),
versions AS (
  SELECT * FROM marked
  WHERE n = 1 OR address IS DISTINCT FROM was_address OR blood_type IS DISTINCT FROM was_type)
SELECT user_id, address, blood_type, start_date,
       lead(start_date) OVER (PARTITION BY user_id ORDER BY start_date) AS end_date"""
ORACLE["scd2_history"] = _SCD2 + """, md5(user_id || '|' || CAST(start_date AS VARCHAR)) AS user_sk FROM versions"""
ORACLE["scd2_merge"] = _SCD2 + " FROM versions"

_VERSIONS = """daily AS (
  SELECT o_custkey AS user_id, CAST(DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) AS DATE) AS start_date,
         max(o_orderpriority) AS address FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL),
changed AS (
  SELECT * FROM daily QUALIFY address IS DISTINCT FROM lag(address) OVER (PARTITION BY user_id ORDER BY start_date)),
versions AS (
  SELECT *, lead(start_date) OVER w AS end_date, row_number() OVER w AS nth
  FROM changed WINDOW w AS (PARTITION BY user_id ORDER BY start_date))"""
ORACLE["dim_users_history"] = f"""WITH {USERS}, {_VERSIONS}
SELECT v.user_id, first_name, v.address, v.start_date, v.end_date,
  md5(v.user_id || '|' || CAST(v.start_date AS VARCHAR)) AS user_sk FROM versions v JOIN users USING (user_id)"""

# Joins
_STRANGERS = """hr AS (SELECT * REPLACE (
  CASE WHEN heart_rate % 2 = 1 THEN -user_id ELSE user_id END AS user_id,
  CASE WHEN heart_rate % 2 = 1 THEN -activity_id ELSE activity_id END AS activity_id) FROM read)"""
ORACLE["join_users"] = ORACLE["join_users_hot_split"] = f"""WITH read AS (WITH {HR} SELECT * FROM hr), {_STRANGERS}, {USERS}
SELECT event_id, hr.user_id AS user_key, heart_rate, gender, address_country
FROM hr LEFT JOIN users u ON hr.user_id = u.user_id"""
ORACLE["join_activities"] = f"""WITH read AS (WITH {HR} SELECT * FROM hr), {_STRANGERS}, {ACTIVITIES}
SELECT event_id, user_id AS user_key, heart_rate, activity_name
FROM hr LEFT JOIN activities a ON hr.activity_id = a.activity_id"""
ORACLE["join_date"] = f"""WITH {HR} SELECT event_id, user_id AS user_key, heart_rate, event_date,
  dayname(event_date) AS day_name, isodow(event_date) >= 6 AS is_weekend FROM hr"""
ORACLE["join_time"] = f"""WITH {HR} SELECT event_id, user_id AS user_key, heart_rate,
  strftime(event_timestamp, '%H:%M:%S') AS event_time, CAST(hour(event_timestamp) AS INTEGER) AS hour,
  {_CATEGORY} AS time_category FROM hr"""
ORACLE["star_join"] = f"""WITH {HR}, {USERS}, {ACTIVITIES} SELECT event_id, hr.user_id AS user_key, heart_rate,
  event_date, strftime(event_timestamp, '%H:%M:%S') AS event_time, dayname(event_date) AS day_name,
  isodow(event_date) >= 6 AS is_weekend, {_CATEGORY} AS time_category, activity_name, gender, race, address_country
FROM hr LEFT JOIN users USING (user_id) LEFT JOIN activities USING (activity_id)"""

# Aggregates, sort, questions
_DAILY = """SELECT user_id, activity_id, event_date, max(heart_rate) AS max_heart_rate,
  min(heart_rate) AS min_heart_rate, avg(heart_rate) AS avg_heart_rate FROM hr GROUP BY ALL"""
ORACLE["daily_hr_stats"] = f"WITH {HR} {_DAILY}"
ORACLE["first_event_date"] = f"WITH {HR} SELECT user_id, min(event_date) AS first_date FROM hr GROUP BY user_id"
ORACLE["first_event_per_user"] = f"""WITH {HR} SELECT user_id, event_timestamp, event_id, heart_rate, activity_id
FROM hr QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id) = 1"""
ORACLE["user_timeline"] = f"""WITH {HR} SELECT user_id, event_timestamp, event_id, heart_rate FROM hr
ORDER BY user_id, event_timestamp, event_id"""
ORACLE["hr_by_activity_demographic"] = f"""WITH {HR}, {USERS}, {ACTIVITIES}
SELECT activity_name, gender, address_country AS region,
  CAST(grouping_id(activity_name, gender, address_country) AS INTEGER) AS level,
  CAST(count(heart_rate) AS BIGINT) AS readings, min(heart_rate) AS min_heart_rate,
  max(heart_rate) AS max_heart_rate, round(avg(heart_rate), 6) AS avg_heart_rate
FROM hr LEFT JOIN users USING (user_id) LEFT JOIN activities USING (activity_id)
GROUP BY ROLLUP (activity_name, gender, address_country)"""
ORACLE["hr_seasonal"] = f"""WITH {HR}, periods AS (
  SELECT user_id, CAST(date_trunc('week', event_timestamp) AS DATE) AS period_start,
         count(heart_rate) AS readings, avg(heart_rate) AS a
  FROM hr GROUP BY ALL)
SELECT user_id, period_start,
  CASE WHEN month(period_start) IN (12, 1, 2) THEN 'Winter' WHEN month(period_start) IN (3, 4, 5) THEN 'Spring'
       WHEN month(period_start) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
  readings, round(a, 6) AS avg_heart_rate,
  round(a - lag(a) OVER (PARTITION BY user_id ORDER BY period_start), 6) AS change
FROM periods"""
ORACLE["activity_likelihood"] = f"""WITH {HR}, {USERS}, {ACTIVITIES}, counts AS (
  SELECT address_country AS region, {_CATEGORY} AS time_category, activity_name, count(*) AS readings
  FROM hr LEFT JOIN users USING (user_id) LEFT JOIN activities USING (activity_id) GROUP BY ALL)
SELECT region, time_category, activity_name, readings,
  round(readings / sum(readings) OVER (PARTITION BY region, time_category), 6) AS likelihood FROM counts"""
ORACLE["prior_period_compare"] = f"""WITH {HR}, daily AS ({_DAILY})
SELECT d.user_id, d.activity_id, d.event_date, d.avg_heart_rate, p.avg_heart_rate AS prior_avg_heart_rate,
  round(d.avg_heart_rate - p.avg_heart_rate, 6) AS change
FROM daily d LEFT JOIN daily p ON d.user_id = p.user_id AND d.activity_id = p.activity_id
  AND p.event_date = d.event_date - 1"""

# Windows and the fact
ORACLE["win_lag"] = ORACLE["win_lag_hot_split"] = f"""WITH {HR} SELECT event_id, user_id AS user_key, heart_rate,
  {_LAG} AS previous_heart_rate FROM hr"""
for _f in ("max", "min", "avg"):
    ORACLE[f"win_{_f}"] = f"""WITH {HR} SELECT event_id, user_id AS user_key, heart_rate, event_date, activity_id,
  {_f}(heart_rate) OVER ({_DAY}) AS {_f}_heart_rate FROM hr"""
ORACLE["fct_heart_rate"] = ORACLE["fct_heart_rate_hot_split"] = _FACT
ORACLE["fct_heart_rate_by_day"] = ORACLE["medallion_refresh"] = _FACT
ORACLE["incremental_refresh"] = f"""WITH known AS (WITH {USERS} SELECT user_id AS user_key, gender FROM users),
whole AS ({_FACT}) SELECT whole.*, gender FROM whole LEFT JOIN known USING (user_key)"""

ORACLE["fact_by_version"] = f"""WITH {FACT}, {_VERSIONS}, {ACTIVITIES}
SELECT user_key, event_date, event_time, heart_rate, previous_heart_rate, address, v.start_date AS valid_from, activity_name
FROM fact LEFT JOIN activities USING (activity_id) LEFT JOIN versions v ON v.user_id = user_key
  AND (event_date >= v.start_date OR nth = 1) AND (event_date < v.end_date OR v.end_date IS NULL)"""
ORACLE["increment_a_year_late"] = f"""WITH given AS (WITH {HR} SELECT * FROM hr), hr AS (
  SELECT * REPLACE (event_timestamp - CASE WHEN heart_rate > 203 THEN INTERVAL 366 DAY ELSE INTERVAL 0 DAY END AS event_timestamp,
                    CAST(event_timestamp - CASE WHEN heart_rate > 203 THEN INTERVAL 366 DAY ELSE INTERVAL 0 DAY END AS DATE) AS event_date)
  FROM given), {FACT[len(HR) + 2:]} SELECT user_key, heart_rate, event_date, event_time, previous_heart_rate,
  max_heart_rate, min_heart_rate, avg_heart_rate, activity_id, latitude, longitude FROM fact"""

# Dimensions
ORACLE["calendar_month_ends"] = f"""WITH {HR}, per_day AS (SELECT event_date AS date_day, count(*) AS n FROM hr GROUP BY 1),
ends AS (SELECT least(DATE '2024-01-01', date_trunc('year', min(event_date))) AS lo,
                greatest(DATE '2026-12-31', make_date(CAST(year(max(event_date)) AS BIGINT), 12, 31)) AS hi FROM hr),
days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_day FROM ends)
SELECT date_day, last_day(date_day) AS month_end_date, make_date(year(date_day), 12, 31) AS year_end_date,
  CAST(coalesce(n, 0) AS BIGINT) AS readings FROM days LEFT JOIN per_day USING (date_day)"""
ORACLE["dim_date"] = f"""WITH {_DAYS}, per_day AS (
  SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS orders FROM orders GROUP BY 1)
SELECT date AS date_day, date, date - 1 AS prior_date_day, date + 1 AS next_date_day,
  date - 365 AS prior_year_date_day, date - 364 AS prior_year_over_year_date_day,
  CAST(date_trunc('year', date) AS DATE) AS year_start_date,
  make_date(year(date), 12, 31) AS year_end_date, CAST(day(date) AS INTEGER) AS day,
  CAST(isodow(date) AS INTEGER) AS day_of_week, dayname(date) AS day_name,
  isodow(date) >= 6 AS is_weekend, CAST(coalesce(orders, 0) AS BIGINT) AS orders
FROM days LEFT JOIN per_day USING (date)"""
ORACLE["dim_time"] = f"""WITH {HR}, {_MINUTES}, per_minute AS (
  SELECT strftime(event_timestamp, '%H:%M:00') AS time_of_day, count(*) AS readings FROM hr GROUP BY 1)
SELECT time_of_day, hour, minute, CAST(0 AS INTEGER) AS second,
  CASE WHEN hour <= 5 THEN 'Early Morning' WHEN hour <= 11 THEN 'Morning' WHEN hour <= 17 THEN 'Afternoon'
       WHEN hour <= 21 THEN 'Evening' ELSE 'Night' END AS time_category,
  CAST(coalesce(readings, 0) AS BIGINT) AS readings
FROM minutes LEFT JOIN per_minute USING (time_of_day)"""
ORACLE["time_category"] = f"WITH {HR} SELECT {_CATEGORY} AS time_category, count(*) AS readings FROM hr GROUP BY 1"
ORACLE["weekday_flags"] = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
  CAST(isodow(o_orderdate) AS INTEGER) AS day_of_week, dayname(o_orderdate) AS day_name,
  isodow(o_orderdate) >= 6 AS is_weekend FROM orders"""

# Quality
ORACLE["dq_not_null"] = f"WITH {DIRTY} " + _report("readings", "dirty", [
    (f"not_null({c})", f"{c} IS NULL") for c in ("user_id", "heart_rate", "activity_id", "event_timestamp")])
ORACLE["dq_castable"] = f"WITH {USERS} " + _report("users", "users", [
    ("castable(last_update,date)", "height >= 190"), ("castable(dob,bigint)", "dob IS NULL"),
    ("castable(fname,timestamp)", "try_cast(first_name AS TIMESTAMP) IS NULL")])
ORACLE["dq_all_null"] = f"WITH {USERS} " + _report("users", "users", [
    ("all_null(end_date)", "end_date IS NOT NULL"), ("all_null(closed)", "height >= 190")])
ORACLE["dq_range"] = f"WITH {DIRTY} " + _report("readings", "dirty", [
    ("range(latitude)", "latitude < -90 OR latitude > 90"),
    ("range(longitude)", "longitude < -180 OR longitude > 180")])
ORACLE["dq_accepted_values"] = f"WITH {USERS} " + _report("users", "users", [
    ("accepted(race)", "race NOT IN ('W', 'B', 'A', 'H', 'O')"),
    ("accepted(blood_type)", "blood_type NOT IN ('A+', 'B+', 'AB+', 'O+')"),
    ("accepted(gender)", "gender NOT IN ('M', 'F')")])
_EXPECTED = ", ".join(f"('{c}')" for c in [*CATEGORY_NAMES, "No Such Category"])
ORACLE["dq_coverage"] = f"""WITH {HR}, seen AS (
  SELECT {_CATEGORY} AS value, count(*) AS n FROM hr GROUP BY 1)
SELECT value, CAST(coalesce(n, 0) AS BIGINT) AS rows FROM (VALUES {_EXPECTED}) e(value) LEFT JOIN seen USING (value)"""
_TAMPERED = FACT + """, tampered AS (
  SELECT * REPLACE (CASE WHEN heart_rate > 200 THEN max_heart_rate + 1 ELSE max_heart_rate END AS max_heart_rate)
  FROM fact)"""
ORACLE["reconcile_window_vs_group"] = f"""WITH {_TAMPERED}
SELECT user_key, activity_id, event_date, count(*) AS readings, max(heart_rate) <= 200 AS matches
FROM tampered GROUP BY user_key, activity_id, event_date"""
ORACLE["reconcile_detail_rows"] = f"""WITH {_TAMPERED}
SELECT user_key, heart_rate, event_date, event_time, previous_heart_rate, max_heart_rate, min_heart_rate,
  avg_heart_rate, activity_id, latitude, longitude, max_heart_rate - 1 AS expected_max,
  min_heart_rate AS expected_min, avg_heart_rate AS expected_avg
FROM tampered WHERE heart_rate > 200"""
ORACLE["dq_lag_continuity"] = f"""WITH {FACT}
SELECT event_id, user_key, CAST(0 AS BIGINT) AS previous_heart_rate, previous_heart_rate AS expected
FROM fact WHERE heart_rate > 200"""
ORACLE["dq_chain_continuity"] = f"WITH {FACT} SELECT DISTINCT user_key, event_date FROM fact WHERE heart_rate > 200"
ORACLE["rejected_readings"] = f"""WITH {DIRTY} SELECT event_id, concat_ws(',',
    CASE WHEN user_id IS NULL THEN 'not_null(user_id)' END,
    CASE WHEN latitude < -90 OR latitude > 90 THEN 'range(latitude)' END,
    CASE WHEN longitude < -180 OR longitude > 180 THEN 'range(longitude)' END) AS failed_rules
FROM dirty WHERE user_id IS NULL OR NOT coalesce(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, true)"""
ORACLE["dq_first_row_null"] = f"""WITH {HR}, ranked AS (
  SELECT user_id AS user_key, heart_rate, date_trunc('second', event_timestamp) AS second,
    row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id) AS nth FROM hr),
tampered AS (SELECT *, CASE WHEN nth = 1 THEN heart_rate <= 120 ELSE heart_rate > 200 END AS missing FROM ranked)
SELECT user_key, CAST(abs(count(*) FILTER (missing) - 1)
  + CASE WHEN min(second) IS NOT DISTINCT FROM min(second) FILTER (missing) THEN 0 ELSE 1 END AS BIGINT) AS violations
FROM tampered GROUP BY user_key"""
ORACLE["hr_band_check"] = f"""WITH {HR}, {ACTIVITIES}, named AS (
  SELECT event_id, user_id AS user_key, heart_rate, activity_name,
         CASE WHEN activity_name IN ('Stand', 'Sit', 'Sleep') THEN 'rest'
              WHEN activity_name IN ('Run', 'HIIT', 'Swimming', 'Kickboxing', 'Multisport') THEN 'vigorous'
              ELSE 'other' END AS band
  FROM hr LEFT JOIN activities USING (activity_id))
SELECT *, CASE band WHEN 'rest' THEN heart_rate BETWEEN 40 AND 80 WHEN 'vigorous' THEN heart_rate BETWEEN 130 AND 205
               ELSE heart_rate BETWEEN 70 AND 150 END AS plausible FROM named"""
ORACLE["dq_quarantine"] = f"""WITH {DIRTY}, named AS (
  SELECT event_id, concat_ws(',',
    CASE WHEN user_id IS NULL THEN 'not_null(user_id)' END,
    CASE WHEN activity_id IS NULL THEN 'not_null(activity_id)' END,
    CASE WHEN latitude < -90 OR latitude > 90 THEN 'range(latitude)' END,
    CASE WHEN longitude < -180 OR longitude > 180 THEN 'range(longitude)' END) AS failed_rules FROM dirty)
SELECT event_id, failed_rules <> '' AS quarantined, failed_rules FROM named"""

# Streaming
ORACLE["decode_topic_messages"] = f"""WITH {HR} SELECT event_id, user_id, heart_rate, 'heartrate' AS _topic,
  CAST(user_id % 6 AS INTEGER) AS _partition, event_id AS _offset, event_timestamp + INTERVAL 2 SECOND AS _message_time FROM hr"""
ORACLE["stream_flatten"] = ORACLE["stream_dedup"] = ORACLE["stream_compacted"] = f"WITH {HR} {_SILVER}"
ORACLE["stream_daily_stats"] = f"WITH {HR} {_DAILY}"
ORACLE["stream_malformed_kept"] = f"""WITH {HR} SELECT CASE WHEN heart_rate > 180 THEN 'malformed' ELSE 'good' END AS status,
  CASE WHEN heart_rate <= 180 THEN event_id END AS event_id, CASE WHEN heart_rate <= 180 THEN heart_rate END AS heart_rate,
  CASE WHEN heart_rate > 180 THEN '{{"user_id": 7, broken ' || heart_rate ELSE '' END AS record FROM hr"""
ORACLE["stream_previous_hr"] = ORACLE["stream_late_reconciled"] = f"""WITH {HR} SELECT user_id, event_timestamp, event_id, heart_rate,
  {_LAG} AS previous_heart_rate FROM hr"""
ORACLE["replay_equals_stream"] = """SELECT CAST(count(*) AS BIGINT) AS left_rows, CAST(count(*) AS BIGINT) AS right_rows,
  CAST(0 AS BIGINT) AS differing FROM events"""

del _f
