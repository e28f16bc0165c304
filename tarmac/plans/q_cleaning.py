"""Registered queries: cleaning chains and the joined table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.functions import columns as C
from tarmac.operators import dimensions, flights, joins, weather
from tarmac.plans import tables as T
from tarmac.plans.oracle import with_tables
from tarmac.plans.registry import query

JOINED_COLUMNS = [
    "aircraft", "airport", "rounded_hour", "date", "from", "to", "flight", "flight_time",
    "scheduled_time_departure", "actual_time_departure", "scheduled_time_arrival", "status",
    "actual_time_arrival", "from_city", "to_city", "delay_time", "temperature", "dew_point",
    "humidity", "wind_speed", "wind_gust", "pressure", "precip", "my_flightradar24_rating",
    "arrival_delay_index", "departure_delay_index", "msn", "type", "airline", "age",
]


@query("d7_clean_flights", with_tables("flights_clean") + "SELECT * FROM flights_clean")
def d7_clean_flights(spark, sf_dir):
    return T.portable(T.flights_clean(spark, sf_dir))


@query("d10_clean_weather", with_tables("weather_clean") + "SELECT * FROM weather_clean")
def d10_clean_weather(spark, sf_dir):
    return T.portable(T.weather_clean(spark, sf_dir))


@query("d8_clean_aircrafts", with_tables("aircrafts_clean") + "SELECT * FROM aircrafts_clean")
def d8_clean_aircrafts(spark, sf_dir):
    return T.aircrafts_clean(spark, sf_dir)


@query("d9_clean_airports", with_tables("airports_clean") + "SELECT * FROM airports_clean")
def d9_clean_airports(spark, sf_dir):
    return T.airports_clean(spark, sf_dir)


@query("d11_clean_reviews", with_tables("reviews_clean") + "SELECT * FROM reviews_clean")
def d11_clean_reviews(spark, sf_dir):
    return T.reviews_clean(spark, sf_dir)


@query("d14_join_flights", with_tables("joined") + "SELECT * FROM joined")
def d14_join_flights(spark, sf_dir):
    return T.portable(T.joined(spark, sf_dir))


# ---------------------------------------------------------------- variants
@query("d1_d2_d3_route_status_clocks", with_tables("flights_raw") + """
SELECT lower(string_split("from", ' (')[1]) AS from_city, lower(substr(string_split("from", ' (')[2], 1, 3)) AS "from",
       lower(string_split("to", ' (')[1]) AS to_city, lower(substr(string_split("to", ' (')[2], 1, 3)) AS "to",
       string_split(status, ' ')[1] AS status, substring(status, length(status) - 4, 5) AS actual_time_arrival,
       try_strptime(concat_ws(' ', strftime(try_strptime("date", '%d %b %Y')::DATE, '%Y-%m-%d'), scheduled_time_arrival),
                    '%Y-%m-%d %H:%M') AS scheduled_time_arrival
FROM flights_raw""")
def d1_d2_d3_route_status_clocks(spark, sf_dir):
    r = T.raw(spark, sf_dir, "flights_raw").withColumn("date", C.parse_date("date"))
    r = flights.with_clock_times(flights.parse_status(flights.parse_route(r)), ["scheduled_time_arrival"])
    return T.portable(r.select("from_city", "from", "to_city", "to", "status", "actual_time_arrival",
                               "scheduled_time_arrival"))


@query("d4_round_to_hour_roll", with_tables("flights_clean") + """
SELECT scheduled_time_arrival, date_trunc('hour', scheduled_time_arrival + INTERVAL 30 MINUTE) AS rounded_hour
FROM flights_clean""")
def d4_round_to_hour_roll(spark, sf_dir):
    f = T.flights_clean(spark, sf_dir).select("scheduled_time_arrival")
    return T.portable(flights.with_rounded_hour(f, midnight="roll"))


@query("d5_d6_relabel_after_wrap", with_tables("flights_clean") + """
SELECT flight, delay_time, CASE WHEN delay_time > 15 THEN 'Delayed' ELSE 'On Time' END AS status FROM flights_clean""")
def d5_d6_relabel_after_wrap(spark, sf_dir):
    f = T.flights_clean(spark, sf_dir, relabel=True)
    return f.select("flight", "delay_time", "status")


@query("d7_job_variant", with_tables("flights_raw", extra=["""
p AS (SELECT aircraft, try_strptime("date", '%d %b %Y')::DATE AS d, "from", "to", flight, flight_time,
             scheduled_time_departure, actual_time_departure, scheduled_time_arrival,
             string_split(status, ' ')[1] AS st, substring(status, length(status) - 4, 5) AS ata
      FROM flights_raw)""", """
t AS (SELECT DISTINCT aircraft, d, lower(substr(string_split("from", ' (')[2], 1, 3)) AS fr,
        lower(substr(string_split("to", ' (')[2], 1, 3)) AS tt, flight,
        lower(string_split("from", ' (')[1]) AS from_city, lower(string_split("to", ' (')[1]) AS to_city,
        try_strptime(concat_ws(' ', strftime(d, '%Y-%m-%d'), flight_time), '%Y-%m-%d %-H:%M') AS flight_time,
        try_strptime(concat_ws(' ', strftime(d, '%Y-%m-%d'), scheduled_time_departure), '%Y-%m-%d %H:%M') AS std,
        try_strptime(concat_ws(' ', strftime(d, '%Y-%m-%d'), actual_time_departure), '%Y-%m-%d %H:%M') AS atd,
        try_strptime(concat_ws(' ', strftime(d, '%Y-%m-%d'), scheduled_time_arrival), '%Y-%m-%d %H:%M') AS sta,
        try_strptime(concat_ws(' ', strftime(d, '%Y-%m-%d'), ata), '%Y-%m-%d %H:%M') AS ata, st
      FROM p WHERE regexp_matches(st, 'Landed'))"""]) + """
SELECT count(*) AS n_rows, count(flight_time) AS with_flight_time, count(date_diff('second', sta, ata)) AS with_delay,
       count(*) FILTER (WHERE date_diff('second', sta, ata) / 60 > 15) AS delayed FROM t""")
def d7_job_variant(spark, sf_dir):
    """Packaged-job chain (flight_time as a timestamp, no wrap, no null
    drop), profiled as counts."""
    f = T.flights_clean(spark, sf_dir, variant="job")
    return f.agg(F.count(F.lit(1)).alias("n_rows"), F.count("flight_time").alias("with_flight_time"),
                 F.count("delay_time").alias("with_delay"),
                 F.count_if(F.col("status") == "Delayed").alias("delayed"))


FLIGHTS_JOB_SQL = """
flights_job AS (
  WITH s AS (SELECT aircraft, try_strptime("date", '%d %b %Y')::DATE AS "date", "from", "to", flight, flight_time,
                    scheduled_time_departure AS std, actual_time_departure AS atd, scheduled_time_arrival AS sta,
                    string_split(status, ' ')[1] AS st, substring(status, length(status) - 4, 5) AS ata FROM flights_raw),
  t AS (SELECT aircraft, "date", lower(substr(string_split("from", ' (')[2], 1, 3)) AS "from",
          lower(substr(string_split("to", ' (')[2], 1, 3)) AS "to", flight,
          try_strptime(concat_ws(' ', strftime("date", '%Y-%m-%d'), flight_time), '%Y-%m-%d %-H:%M') AS flight_time,
          try_strptime(concat_ws(' ', strftime("date", '%Y-%m-%d'), std), '%Y-%m-%d %H:%M') AS scheduled_time_departure,
          try_strptime(concat_ws(' ', strftime("date", '%Y-%m-%d'), atd), '%Y-%m-%d %H:%M') AS actual_time_departure,
          try_strptime(concat_ws(' ', strftime("date", '%Y-%m-%d'), sta), '%Y-%m-%d %H:%M') AS scheduled_time_arrival,
          st, try_strptime(concat_ws(' ', strftime("date", '%Y-%m-%d'), ata), '%Y-%m-%d %H:%M') AS actual_time_arrival,
          lower(string_split("from", ' (')[1]) AS from_city, lower(string_split("to", ' (')[1]) AS to_city
        FROM s WHERE regexp_matches(st, 'Landed')),
  r AS (SELECT DISTINCT *, CASE WHEN scheduled_time_arrival IS NULL THEN NULL
          ELSE CAST("date" AS TIMESTAMP) + to_hours(CAST((hour(scheduled_time_arrival)
               + CASE WHEN minute(scheduled_time_arrival) >= 30 THEN 1 ELSE 0 END) % 24 AS BIGINT)) END AS rounded_hour
        FROM t)
  SELECT aircraft, "date", "from", "to", flight, flight_time, scheduled_time_departure, actual_time_departure,
         scheduled_time_arrival, actual_time_arrival, from_city, to_city, rounded_hour, "to" AS airport,
         date_diff('second', scheduled_time_arrival, actual_time_arrival) / 60 AS delay_time,
         CASE WHEN date_diff('second', scheduled_time_arrival, actual_time_arrival) / 60 > 15 THEN 'Delayed' ELSE 'On Time' END AS status
  FROM r)"""

AIRCRAFTS_JOB_SQL = """
aircrafts_job AS (
  SELECT msn, "type", lower(aircraft) AS aircraft, airline,
         try_cast(regexp_extract(first_flight, '\\((\\d+) years\\)', 1) AS INTEGER) AS age FROM aircrafts_raw)"""

AIRPORTS_JOB_SQL = """
airports_job AS (
  SELECT DISTINCT
    try_cast(regexp_replace(nullif(my_flightradar24_rating, 'N/A'), '[^0-9]', '', 'g') AS INTEGER) AS my_flightradar24_rating,
    try_cast(nullif(arrival_delay_index, 'N/A') AS FLOAT) AS arrival_delay_index,
    try_cast(nullif(departure_delay_index, 'N/A') AS FLOAT) AS departure_delay_index,
    nullif(airport, 'N/A') AS airport,
    date_diff('minute', try_strptime(concat('1970-01-01 ', nullif("local", 'N/A')), '%Y-%m-%d %I:%M %p'),
              try_strptime(concat('1970-01-01 ', regexp_extract(nullif(utc, 'N/A'), '(\\d{2}:\\d{2})', 0)), '%Y-%m-%d %H:%M')) AS time_diff
  FROM airports_raw)"""


@query("d14_job_variant_distinct", with_tables("flights_raw", "weather_one", "aircrafts_raw", "airports_raw",
                                               extra=[FLIGHTS_JOB_SQL, AIRCRAFTS_JOB_SQL, AIRPORTS_JOB_SQL]) + """
SELECT DISTINCT f.*, w.temperature, w.dew_point, w.humidity, w.wind_direction, w.wind_speed, w.wind_gust,
       w.pressure, w.precip, w.condition, w.date_time, p.my_flightradar24_rating, p.arrival_delay_index,
       p.departure_delay_index, c.msn, c."type", c.airline, c.age
FROM flights_job f
JOIN weather_one w ON f.rounded_hour = w.rounded_hour AND f.airport = w.airport
JOIN airports_job p ON f.airport = p.airport
JOIN aircrafts_job c ON f.aircraft = c.aircraft""")
def d14_job_variant_distinct(spark, sf_dir):
    """The packaged job's joined table: job variants of all four chains
    (weather keeps its hourly survivor rows), inner joins, final dedup."""
    out = joins.join_flights(T.flights_clean(spark, sf_dir, variant="job"),
                             T.weather_clean(spark, sf_dir, variant="job"),
                             T.airports_clean(spark, sf_dir, variant="job"),
                             T.aircrafts_clean(spark, sf_dir, variant="job"), distinct=True)
    return T.portable(out)
