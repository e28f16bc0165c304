"""Independent DuckDB formulations of the cleaned tables.

Written from the operator semantics (not generated from the Spark plans),
they are the value oracle for the registered queries: the driver tables are
views, the raw shapes come from ``fixtures.DUCKDB_ADAPTERS``.
"""

from __future__ import annotations

from tarmac.sources.fixtures import DUCKDB_ADAPTERS

FLIGHTS_CLEAN = """
flights_clean AS (
  WITH s AS (
    SELECT aircraft, try_strptime("date", '%d %b %Y')::DATE AS "date", "from", "to", flight,
           flight_time, scheduled_time_departure, actual_time_departure, scheduled_time_arrival,
           string_split(status, ' ')[1] AS status,
           substring(status, length(status) - 4, 5) AS actual_time_arrival
    FROM flights_raw),
  t AS (
    SELECT aircraft, "date",
           lower(substr(string_split("from", ' (')[2], 1, 3)) AS "from",
           lower(substr(string_split("to", ' (')[2], 1, 3)) AS "to",
           flight,
           try_cast(string_split(flight_time, ':')[1] AS DOUBLE)
             + try_cast(string_split(flight_time, ':')[2] AS DOUBLE) / 60 AS flight_time,
           try_strptime(concat_ws(' ', strftime("date", '%Y-%m-%d'), scheduled_time_departure), '%Y-%m-%d %H:%M') AS scheduled_time_departure,
           try_strptime(concat_ws(' ', strftime("date", '%Y-%m-%d'), actual_time_departure), '%Y-%m-%d %H:%M') AS actual_time_departure,
           try_strptime(concat_ws(' ', strftime("date", '%Y-%m-%d'), scheduled_time_arrival), '%Y-%m-%d %H:%M') AS scheduled_time_arrival,
           status,
           try_strptime(concat_ws(' ', strftime("date", '%Y-%m-%d'), actual_time_arrival), '%Y-%m-%d %H:%M') AS actual_time_arrival,
           lower(string_split("from", ' (')[1]) AS from_city,
           lower(string_split("to", ' (')[1]) AS to_city
    FROM s WHERE regexp_matches(status, 'Landed')),
  r AS (
    SELECT DISTINCT *, CASE WHEN scheduled_time_arrival IS NULL THEN NULL
             ELSE CAST("date" AS TIMESTAMP)
                  + to_hours(CAST((hour(scheduled_time_arrival)
                     + CASE WHEN minute(scheduled_time_arrival) >= 30 THEN 1 ELSE 0 END) % 24 AS BIGINT))
           END AS rounded_hour
    FROM t),
  d AS (
    SELECT *, "to" AS airport,
           date_diff('second', scheduled_time_arrival, actual_time_arrival) / 60 AS delay_raw
    FROM r),
  l AS (
    SELECT *, CASE WHEN delay_raw > 15 THEN 'Delayed' ELSE 'On Time' END AS label FROM d)
  SELECT aircraft, "date", "from", "to", flight, flight_time, scheduled_time_departure,
         actual_time_departure, scheduled_time_arrival, label AS status, actual_time_arrival,
         from_city, to_city, rounded_hour, airport,
         CASE WHEN delay_raw > 720 AND label <> 'Delayed' THEN delay_raw - 1440
              WHEN delay_raw <= -720 AND label <> 'Delayed' THEN delay_raw + 1440
              ELSE delay_raw END AS delay_time
  FROM l
  WHERE "from" IS NOT NULL AND "to" IS NOT NULL AND scheduled_time_departure IS NOT NULL
    AND actual_time_departure IS NOT NULL AND scheduled_time_arrival IS NOT NULL)
"""

WEATHER_OBS = """
weather_obs AS (
  WITH n AS (SELECT * FROM weather_raw
             WHERE "time" IS NOT NULL AND temperature IS NOT NULL AND dew_point IS NOT NULL
               AND humidity IS NOT NULL AND wind_direction IS NOT NULL AND wind_speed IS NOT NULL
               AND wind_gust IS NOT NULL AND pressure IS NOT NULL AND precip IS NOT NULL
               AND condition IS NOT NULL AND airport IS NOT NULL AND "date" IS NOT NULL),
  u AS (
    SELECT DISTINCT
      try_cast(regexp_replace(temperature, '[^0-9-]', '', 'g') AS INTEGER) AS temperature,
      try_cast(regexp_replace(dew_point, '[^0-9-]', '', 'g') AS INTEGER) AS dew_point,
      try_cast(regexp_replace(humidity, '[^0-9]', '', 'g') AS INTEGER) AS humidity,
      wind_direction,
      try_cast(regexp_replace(wind_speed, '[^0-9]', '', 'g') AS INTEGER) AS wind_speed,
      try_cast(regexp_replace(wind_gust, '[^0-9]', '', 'g') AS INTEGER) AS wind_gust,
      try_cast(regexp_replace(pressure, '[^0-9.]', '', 'g') AS FLOAT) AS pressure,
      try_cast(regexp_replace(precip, '[^0-9.]', '', 'g') AS FLOAT) AS precip,
      condition, airport,
      try_strptime(concat_ws(' ', string_split("date", ' ')[1], "time"), '%Y-%m-%d %-I:%M %p') AS date_time
    FROM n)
  SELECT *, CASE WHEN date_time IS NULL THEN NULL
              ELSE date_trunc('day', date_time)
                   + to_hours(CAST((hour(date_time) + CASE WHEN minute(date_time) >= 30 THEN 1 ELSE 0 END) % 24 AS BIGINT))
            END AS rounded_hour
  FROM u)
"""

WEATHER_ONE = """
weather_one AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY airport, rounded_hour ORDER BY
        temperature NULLS FIRST, dew_point NULLS FIRST, humidity NULLS FIRST,
        wind_direction NULLS FIRST, wind_speed NULLS FIRST, wind_gust NULLS FIRST,
        pressure NULLS FIRST, precip NULLS FIRST, condition NULLS FIRST, date_time NULLS FIRST) AS rn
    FROM weather_obs) WHERE rn = 1)
"""

WEATHER_CLEAN = """
weather_clean AS (
  SELECT airport, rounded_hour,
         CAST(trunc(avg(temperature)) AS INTEGER) AS temperature,
         CAST(trunc(avg(dew_point)) AS INTEGER) AS dew_point,
         CAST(trunc(avg(humidity)) AS INTEGER) AS humidity,
         CAST(trunc(avg(wind_speed)) AS INTEGER) AS wind_speed,
         CAST(trunc(avg(wind_gust)) AS INTEGER) AS wind_gust,
         CAST(avg(pressure) AS FLOAT) AS pressure,
         CAST(avg(precip) AS FLOAT) AS precip
  FROM weather_one GROUP BY airport, rounded_hour)
"""

AIRCRAFTS_CLEAN = """
aircrafts_clean AS (
  WITH a AS (
    SELECT msn, "type", lower(aircraft) AS aircraft, airline,
           CASE WHEN try_cast(regexp_extract(first_flight, '\\((\\d+) years\\)', 1) AS DOUBLE) = 2024 THEN 1.0
                ELSE try_cast(regexp_extract(first_flight, '\\((\\d+) years\\)', 1) AS DOUBLE) END AS age
    FROM aircrafts_raw)
  SELECT msn, "type", aircraft, airline, coalesce(age, (SELECT avg(age) FROM a)) AS age
  FROM a WHERE aircraft IS NOT NULL AND airline IS NOT NULL)
"""

AIRPORTS_CLEAN = """
airports_clean AS (
  WITH n AS (
    SELECT DISTINCT
      try_cast(regexp_replace(nullif(my_flightradar24_rating, 'N/A'), '[^0-9]', '', 'g') AS INTEGER) AS my_flightradar24_rating,
      try_cast(nullif(arrival_delay_index, 'N/A') AS FLOAT) AS arrival_delay_index,
      try_cast(nullif(departure_delay_index, 'N/A') AS FLOAT) AS departure_delay_index,
      nullif(airport, 'N/A') AS airport
    FROM airports_raw)
  SELECT my_flightradar24_rating,
         coalesce(arrival_delay_index, CAST(2.5 AS FLOAT)) AS arrival_delay_index,
         coalesce(departure_delay_index, CAST(2.5 AS FLOAT)) AS departure_delay_index,
         airport
  FROM n WHERE my_flightradar24_rating IS NOT NULL)
"""

REVIEWS_CLEAN = """
reviews_clean AS (
  SELECT DISTINCT comment, airport FROM (
    SELECT regexp_replace(lower("comment"), '[^a-zA-Z0-9 ]', '', 'g') AS comment, airport
    FROM reviews_raw)
  WHERE trim(comment) <> '')
"""

JOINED = """
joined AS (
  SELECT f.aircraft, f.airport, f.rounded_hour, f."date", f."from", f."to", f.flight, f.flight_time,
         f.scheduled_time_departure, f.actual_time_departure, f.scheduled_time_arrival, f.status,
         f.actual_time_arrival, f.from_city, f.to_city, f.delay_time,
         w.temperature, w.dew_point, w.humidity, w.wind_speed, w.wind_gust, w.pressure, w.precip,
         p.my_flightradar24_rating, p.arrival_delay_index, p.departure_delay_index,
         c.msn, c."type", c.airline, c.age
  FROM flights_clean f
  JOIN weather_clean w ON f.rounded_hour = w.rounded_hour AND f.airport = w.airport
  JOIN airports_clean p ON f.airport = p.airport
  JOIN aircrafts_clean c ON f.aircraft = c.aircraft)
"""

FLIGHTS_MSG = """
flights_msg AS (
  SELECT concat('"', concat_ws(',', flight, temp1, temp2, "date", "from", "to", aircraft, flight_time,
         scheduled_time_departure, actual_time_departure, scheduled_time_arrival, temp3, status, temp4),
         '\\n"') AS value
  FROM flights_raw)
"""

FLIGHTS_LIVE = """
flights_live AS (
  WITH c AS (SELECT string_split(value, ',') AS v FROM flights_msg),
  s AS (SELECT v[1] AS flight, try_strptime(v[4], '%d %b %Y')::DATE AS "date", v[5] AS "from", v[6] AS "to",
               v[7] AS aircraft, v[8] AS flight_time, v[9] AS std, v[10] AS atd, v[11] AS sta, v[13] AS status FROM c),
  t AS (
    SELECT DISTINCT flight, "date",
      lower(substr(string_split("from", ' (')[2], 1, 3)) AS "from", lower(substr(string_split("to", ' (')[2], 1, 3)) AS "to",
      aircraft, flight_time,
      try_strptime(concat_ws(' ', strftime("date", '%Y-%m-%d'), std), '%Y-%m-%d %H:%M') AS scheduled_time_departure,
      try_strptime(concat_ws(' ', strftime("date", '%Y-%m-%d'), atd), '%Y-%m-%d %H:%M') AS actual_time_departure,
      try_strptime(concat_ws(' ', strftime("date", '%Y-%m-%d'), sta), '%Y-%m-%d %H:%M') AS scheduled_time_arrival,
      status, lower(string_split("from", ' (')[1]) AS from_city, lower(string_split("to", ' (')[1]) AS to_city
    FROM s)
  SELECT * REPLACE (regexp_replace(flight, '\\\\?"', '', 'g') AS flight),
         CASE WHEN scheduled_time_arrival IS NULL THEN NULL
              ELSE CAST("date" AS TIMESTAMP) + to_hours(CAST((hour(scheduled_time_arrival)
                   + CASE WHEN minute(scheduled_time_arrival) >= 30 THEN 1 ELSE 0 END) % 24 AS BIGINT)) END AS rounded_hour
  FROM t)
"""

WEATHER_LIVE = """
weather_live AS (
  WITH p AS (
    SELECT try_strptime(json_extract_string(value, '$.date'), '%Y-%m-%d %H:%M:%S') AS "timestamp",
      try_cast(regexp_replace(json_extract_string(value, '$.details.feels_like'), '[^0-9]', '', 'g') AS INTEGER) AS temperature,
      json_extract_string(value, '$.details.wind_direction') AS wind_direction,
      try_cast(regexp_replace(json_extract_string(value, '$.details.wind_speed'), '[^0-9]', '', 'g') AS INTEGER) AS wind_speed,
      try_cast(regexp_replace(json_extract_string(value, '$.details.humidity'), '[^0-9]', '', 'g') AS INTEGER) AS humidity,
      try_cast(regexp_replace(json_extract_string(value, '$.details.cloud_cover'), '[^0-9]', '', 'g') AS INTEGER) AS cloud_cover,
      try_cast(regexp_replace(json_extract_string(value, '$.details.rain_amount'), '[^0-9.]', '', 'g') AS FLOAT) AS precip,
      '{location}' AS location
    FROM weather_msg)
  SELECT *, CAST("timestamp" AS DATE) AS "date" FROM p
  WHERE "timestamp" IS NOT NULL AND temperature IS NOT NULL AND wind_direction IS NOT NULL AND wind_speed IS NOT NULL
    AND humidity IS NOT NULL AND cloud_cover IS NOT NULL AND precip IS NOT NULL)
"""

# Airport whose hourly forecast the live weather messages carry in the
# registered queries (the live stream holds one airport's forecast).
LIVE_LOCATION = "a05"

LIVE_JOINED = """
live_joined AS (
  SELECT f.*, a.my_flightradar24_rating, a.arrival_delay_index, a.departure_delay_index, a.airport,
         w."timestamp", w.temperature, w.wind_direction, w.wind_speed, w.humidity, w.cloud_cover, w.precip, w.location
  FROM flights_live f
  JOIN airports_clean a ON f."to" = a.airport
  JOIN weather_live w ON f.rounded_hour = w."timestamp" AND f."to" = w.location)
"""

_DEPENDS = {
    "flights_msg": (["flights_raw"], FLIGHTS_MSG),
    "flights_live": (["flights_msg"], FLIGHTS_LIVE),
    "weather_live": (["weather_msg"], WEATHER_LIVE.replace("{location}", LIVE_LOCATION)),
    "live_joined": (["flights_live", "airports_clean", "weather_live"], LIVE_JOINED),
    "flights_clean": (["flights_raw"], FLIGHTS_CLEAN),
    "weather_obs": (["weather_raw"], WEATHER_OBS),
    "weather_one": (["weather_obs"], WEATHER_ONE),
    "weather_clean": (["weather_one"], WEATHER_CLEAN),
    "aircrafts_clean": (["aircrafts_raw"], AIRCRAFTS_CLEAN),
    "airports_clean": (["airports_raw"], AIRPORTS_CLEAN),
    "reviews_clean": (["reviews_raw"], REVIEWS_CLEAN),
    "joined": (["flights_clean", "weather_clean", "airports_clean", "aircrafts_clean"], JOINED),
}


def with_tables(*names: str, extra: list[str] | None = None) -> str:
    """``WITH`` clause defining the named (raw or cleaned) tables and their
    dependencies, in dependency order, followed by ``extra`` CTE texts."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        if n in _DEPENDS:
            for d in _DEPENDS[n][0]:
                visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        if n in DUCKDB_ADAPTERS:
            parts.append(f"{n} AS ({DUCKDB_ADAPTERS[n].strip()})")
        else:
            parts.append(_DEPENDS[n][1].strip())
    parts += [p.strip() for p in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n"
