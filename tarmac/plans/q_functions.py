"""Registered queries: scalar functions (F1-F27), projections / filters /
null handling (P1-P19) and the URL key (S7), each applied to the raw or
cleaned tables where the pipeline uses it."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.functions import columns as C
from tarmac.operators import dimensions, flights, nulls
from tarmac.plans import tables as T
from tarmac.plans.oracle import with_tables
from tarmac.plans.registry import query
from tarmac.schemas import FLIGHTS_STREAM_COLUMNS
from tarmac.sources import fixtures


def _sql(tables: list[str], body: str) -> str:
    return with_tables(*tables) + body


# ------------------------------------------------------------------ F-items
@query("f1_lower", _sql(["flights_raw"], 'SELECT "from", lower("from") AS from_lower, lower(aircraft) AS aircraft_lower FROM flights_raw'))
def f1_lower(spark, sf_dir):
    r = T.raw(spark, sf_dir, "flights_raw")
    return r.select("from", F.lower("from").alias("from_lower"), F.lower("aircraft").alias("aircraft_lower"))


@query("f2_split_element", _sql(["flights_raw"], """
SELECT status, string_split(status, ' ')[1] AS status_token, string_split("to", ' (')[2] AS to_code_part,
       string_split("to", ' (')[1] AS to_city_part FROM flights_raw"""))
def f2_split_element(spark, sf_dir):
    r = T.raw(spark, sf_dir, "flights_raw")
    return r.select("status", C.token("status", " ", 0).alias("status_token"),
                    C.token("to", r" \(", 1).alias("to_code_part"), C.token("to", r" \(", 0).alias("to_city_part"))


@query("f3_substring", _sql(["flights_raw"], """
SELECT substr(string_split("to", ' (')[2], 1, 3) AS to_code, substring(status, length(status) - 4, 5) AS status_tail
FROM flights_raw"""))
def f3_substring(spark, sf_dir):
    r = T.raw(spark, sf_dir, "flights_raw")
    return r.select(F.substring(C.token("to", r" \(", 1), 1, 3).alias("to_code"),
                    F.expr("substring(status, length(status) - 4, 5)").alias("status_tail"))


@query("f4_concat", _sql(["weather_raw"], """
SELECT concat_ws(' ', string_split("date", ' ')[1], "time") AS day_and_clock,
       concat('1970-01-01 ', "time") AS epoch_clock, concat_ws(':', airport, NULL, condition) AS skips_nulls
FROM weather_raw"""))
def f4_concat(spark, sf_dir):
    r = T.raw(spark, sf_dir, "weather_raw")
    return r.select(F.concat_ws(" ", C.token("date", " ", 0), F.col("time")).alias("day_and_clock"),
                    F.concat(F.lit("1970-01-01 "), F.col("time")).alias("epoch_clock"),
                    F.concat_ws(":", F.col("airport"), F.lit(None).cast("string"), F.col("condition")).alias("skips_nulls"))


@query("f5_lpad", _sql(["flights_clean"], """
SELECT lpad(CAST(hour(scheduled_time_arrival) AS VARCHAR), 2, '0') AS hour_text FROM flights_clean"""))
def f5_lpad(spark, sf_dir):
    f = T.flights_clean(spark, sf_dir)
    return f.select(F.lpad(F.hour("scheduled_time_arrival").cast("string"), 2, "0").alias("hour_text"))


@query("f6_keep_digits", _sql(["weather_raw"], """
SELECT try_cast(regexp_replace(temperature, '[^0-9-]', '', 'g') AS INTEGER) AS temperature,
       try_cast(regexp_replace(wind_speed, '[^0-9]', '', 'g') AS INTEGER) AS wind_speed,
       try_cast(regexp_replace(pressure, '[^0-9.]', '', 'g') AS FLOAT) AS pressure FROM weather_raw"""))
def f6_keep_digits(spark, sf_dir):
    r = T.raw(spark, sf_dir, "weather_raw")
    return r.select(C.keep_digits("temperature", "-").alias("temperature"),
                    C.keep_digits("wind_speed").alias("wind_speed"),
                    C.keep_digits("pressure", ".", "float").alias("pressure"))


@query("f7_keep_alnum", _sql(["reviews_raw"], """
SELECT airport, regexp_replace("comment", '[^a-zA-Z0-9 ]', '', 'g') AS comment_alnum FROM reviews_raw"""))
def f7_keep_alnum(spark, sf_dir):
    r = T.raw(spark, sf_dir, "reviews_raw")
    return r.select("airport", C.keep_alnum("comment").alias("comment_alnum"))


@query("f8_strip_quotes", _sql(["flights_msg"], """
SELECT regexp_replace(string_split(value, ',')[1], '\\\\?"', '', 'g') AS flight,
       regexp_replace(string_split(value, ',')[14], '\\\\?"', '', 'g') AS last_cell FROM flights_msg"""))
def f8_strip_quotes(spark, sf_dir):
    m = fixtures.flights_msg(spark, sf_dir)
    cells = F.split("value", ",")
    return m.select(C.strip_quotes(F.get(cells, 0)).alias("flight"), C.strip_quotes(F.get(cells, 13)).alias("last_cell"))


@query("f9_regexp_extract", _sql(["aircrafts_raw", "airports_raw"], """
SELECT regexp_extract(first_flight, '\\((\\d+) years\\)', 1) AS extracted FROM aircrafts_raw
UNION ALL SELECT regexp_extract(utc, '(\\d{2}:\\d{2})', 0) FROM airports_raw"""))
def f9_regexp_extract(spark, sf_dir):
    a = T.raw(spark, sf_dir, "aircrafts_raw").select(
        F.regexp_extract("first_flight", dimensions.AGE_PATTERN, 1).alias("extracted"))
    p = T.raw(spark, sf_dir, "airports_raw").select(F.regexp_extract("utc", r"(\d{2}:\d{2})", 0).alias("extracted"))
    return a.unionAll(p)


@query("f10_trim_strip", _sql(["flights_raw"], """
SELECT trim(concat('(', flight, ')'), '()') AS flight, trim(concat('  ', status, ' ')) AS status FROM flights_raw"""))
def f10_trim_strip(spark, sf_dir):
    r = T.raw(spark, sf_dir, "flights_raw")
    return r.select(C.strip_chars(F.concat(F.lit("("), F.col("flight"), F.lit(")"))).alias("flight"),
                    F.trim(F.concat(F.lit("  "), F.col("status"), F.lit(" "))).alias("status"))


@query("f11_to_date", _sql(["flights_raw"], """
SELECT "date" AS text, try_strptime("date", '%d %b %Y')::DATE AS parsed FROM flights_raw"""))
def f11_to_date(spark, sf_dir):
    r = T.raw(spark, sf_dir, "flights_raw")
    return r.select(F.col("date").alias("text"), C.parse_date("date").alias("parsed"))


@query("f12_to_timestamp", _sql(["weather_raw", "airports_raw"], """
SELECT try_strptime(concat_ws(' ', string_split("date", ' ')[1], "time"), '%Y-%m-%d %-I:%M %p') AS ts FROM weather_raw
UNION ALL SELECT try_strptime("date", '%Y-%m-%d %H:%M:%S') FROM weather_raw
UNION ALL SELECT try_strptime(concat('1970-01-01 ', regexp_extract(utc, '(\\d{2}:\\d{2})', 0)), '%Y-%m-%d %H:%M') FROM airports_raw
UNION ALL SELECT try_strptime(concat('1970-01-01 ', "local"), '%Y-%m-%d %I:%M %p') FROM airports_raw"""))
def f12_to_timestamp(spark, sf_dir):
    w = T.raw(spark, sf_dir, "weather_raw")
    a = T.raw(spark, sf_dir, "airports_raw")
    parts = [
        w.select(C.parse_timestamp(F.concat_ws(" ", C.token("date", " ", 0), F.col("time")), "yyyy-MM-dd h:mm a").alias("ts")),
        w.select(C.parse_timestamp("date", "yyyy-MM-dd HH:mm:ss").alias("ts")),
        a.select(C.parse_timestamp(F.regexp_extract("utc", r"(\d{2}:\d{2})", 0), "H:mm").alias("ts")),
        a.select(C.parse_timestamp(F.concat(F.lit("1970-01-01 "), F.col("local")), "yyyy-MM-dd h:mm a").alias("ts")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return T.portable(out)


@query("f13_date_format", _sql(["flights_raw"], """
SELECT strftime(try_strptime("date", '%d %b %Y')::DATE, '%Y-%m-%d') AS iso FROM flights_raw"""))
def f13_date_format(spark, sf_dir):
    r = T.raw(spark, sf_dir, "flights_raw")
    return r.select(F.date_format(C.parse_date("date"), "yyyy-MM-dd").alias("iso"))


@query("f14_hour_minute", _sql(["weather_obs"], """
SELECT CAST(hour(date_time) AS INTEGER) AS h, CAST(minute(date_time) AS INTEGER) AS m FROM weather_obs"""))
def f14_hour_minute(spark, sf_dir):
    from tarmac.operators import weather
    o = weather.hourly_observations(T.raw(spark, sf_dir, "weather_raw"))
    return o.select(F.hour("date_time").alias("h"), F.minute("date_time").alias("m"))


@query("f15_casts", _sql(["airports_raw"], """
SELECT try_cast(regexp_replace(my_flightradar24_rating, '[^0-9]', '', 'g') AS INTEGER) AS as_int,
       try_cast(arrival_delay_index AS FLOAT) AS as_float, try_cast(departure_delay_index AS DOUBLE) AS as_double,
       try_cast(regexp_replace(my_flightradar24_rating, '[^0-9]', '', 'g') AS BIGINT) AS as_long FROM airports_raw"""))
def f15_casts(spark, sf_dir):
    a = T.raw(spark, sf_dir, "airports_raw")
    digits = F.regexp_replace("my_flightradar24_rating", "[^0-9]", "")
    return a.select(digits.try_cast("int").alias("as_int"),
                    F.col("arrival_delay_index").try_cast("float").alias("as_float"),
                    F.col("departure_delay_index").try_cast("double").alias("as_double"),
                    digits.try_cast("long").alias("as_long"))


@query("f16_duration_hours", _sql(["flights_raw"], """
SELECT flight_time, try_cast(string_split(flight_time, ':')[1] AS DOUBLE)
       + try_cast(string_split(flight_time, ':')[2] AS DOUBLE) / 60 AS hours FROM flights_raw"""))
def f16_duration_hours(spark, sf_dir):
    r = T.raw(spark, sf_dir, "flights_raw")
    return r.select("flight_time", C.hours_of_duration("flight_time").alias("hours"))


@query("f17_f18_time_between", _sql(["flights_clean"], """
SELECT date_diff('second', scheduled_time_departure, actual_time_departure) / 60 AS departure_delay,
       date_diff('second', scheduled_time_departure, scheduled_time_arrival) / 3600 AS scheduled_hours
FROM flights_clean"""))
def f17_f18_time_between(spark, sf_dir):
    f = T.flights_clean(spark, sf_dir)
    return f.select(C.minutes_between("actual_time_departure", "scheduled_time_departure").alias("departure_delay"),
                    C.hours_between("scheduled_time_arrival", "scheduled_time_departure").alias("scheduled_hours"))


@query("f19_d9_airports_time_diff", _sql(["airports_raw"], """
SELECT DISTINCT
  try_cast(regexp_replace(nullif(my_flightradar24_rating, 'N/A'), '[^0-9]', '', 'g') AS INTEGER) AS my_flightradar24_rating,
  try_cast(nullif(arrival_delay_index, 'N/A') AS FLOAT) AS arrival_delay_index,
  try_cast(nullif(departure_delay_index, 'N/A') AS FLOAT) AS departure_delay_index,
  nullif(airport, 'N/A') AS airport,
  date_diff('minute', try_strptime(concat('1970-01-01 ', nullif("local", 'N/A')), '%Y-%m-%d %I:%M %p'),
            try_strptime(concat('1970-01-01 ', regexp_extract(nullif(utc, 'N/A'), '(\\d{2}:\\d{2})', 0)), '%Y-%m-%d %H:%M')) AS time_diff
FROM airports_raw"""))
def f19_d9_airports_time_diff(spark, sf_dir):
    return T.airports_clean(spark, sf_dir, variant="job")


@query("f20_when_label", _sql(["flights_clean"], """
SELECT delay_time, CASE WHEN delay_time > 15 THEN 'Delayed' ELSE 'On Time' END AS label FROM flights_clean"""))
def f20_when_label(spark, sf_dir):
    f = T.flights_clean(spark, sf_dir)
    return f.select("delay_time", F.when(F.col("delay_time") > 15, "Delayed").otherwise("On Time").alias("label"))


@query("f21_calendar_parts", _sql(["flights_clean"], """
SELECT CAST(year(scheduled_time_arrival) AS INTEGER) AS "year", CAST(month(scheduled_time_arrival) AS INTEGER) AS "month",
       CAST(day(scheduled_time_arrival) AS INTEGER) AS "day", CAST(hour(scheduled_time_arrival) AS INTEGER) AS "hour",
       CAST(isodow(scheduled_time_arrival) - 1 AS INTEGER) AS dayofweek, CAST(quarter(scheduled_time_arrival) AS INTEGER) AS quarter,
       CAST(month(scheduled_time_arrival) = 1 AND day(scheduled_time_arrival) = 1 AS INTEGER) AS is_year_start,
       CAST(month(scheduled_time_arrival) = 12 AND day(scheduled_time_arrival) = 31 AS INTEGER) AS is_year_end
FROM flights_clean"""))
def f21_calendar_parts(spark, sf_dir):
    f = T.flights_clean(spark, sf_dir)
    return f.select(*[c.alias(k) for k, c in C.calendar_parts("scheduled_time_arrival").items()])


@query("f24_f25_from_json", _sql(["weather_msg"], """
SELECT json_extract_string(value, '$.date') AS "date", json_extract_string(value, '$.hour') AS "hour",
       json_extract_string(value, '$.details.feels_like') AS feels_like,
       json_extract_string(value, '$.details.rain_amount') AS rain_amount FROM weather_msg"""))
def f24_f25_from_json(spark, sf_dir):
    from tarmac.schemas import WEATHER_DETAILS, WEATHER_MESSAGE
    m = T.raw(spark, sf_dir, "weather_msg")
    p = m.select(F.from_json("value", WEATHER_MESSAGE).alias("p")).select("p.*")
    p = p.withColumn("details", F.from_json("details", WEATHER_DETAILS))
    return p.select("date", "hour", F.col("details.feels_like").alias("feels_like"),
                    F.col("details.rain_amount").alias("rain_amount"))


@query("f26_field_name", "SELECT p_type, replace(lower(p_type), ' ', '_') AS field FROM part")
def f26_field_name(spark, sf_dir):
    p = fixtures.table(spark, sf_dir, "part")
    return p.select("p_type", C.field_name("p_type").alias("field"))


@query("f27_last_two_reversed", """
SELECT p_name, array_to_string(list_reverse(string_split(p_name, ' ')[-2:]), ' ') AS tail FROM part""")
def f27_last_two_reversed(spark, sf_dir):
    p = fixtures.table(spark, sf_dir, "part")
    return p.select("p_name", C.last_two_reversed("p_name").alias("tail"))


@query("s7_airport_of_url", "SELECT page_id, trim(string_split(url, '/')[-1]) AS key FROM pages")
def s7_airport_of_url(spark, sf_dir):
    p = fixtures.table(spark, sf_dir, "pages")
    return p.select("page_id", C.url_key("url").alias("key"))


# ------------------------------------------------------------------ P-items
@query("p1_drop_columns", _sql(["flights_raw"], "SELECT * EXCLUDE (temp1, temp2, temp3, temp4) FROM flights_raw"))
def p1_drop_columns(spark, sf_dir):
    return nulls.drop_columns(T.raw(spark, sf_dir, "flights_raw"), "temp1", "temp2", "temp3", "temp4", "time_diff")


@query("p2_select_schema", _sql(["joined"], """
SELECT flight, "from", "to", from_city, to_city, flight_time, temperature, humidity, wind_speed,
       my_flightradar24_rating, arrival_delay_index, departure_delay_index FROM joined"""))
def p2_select_schema(spark, sf_dir):
    return nulls.select_columns(T.joined(spark, sf_dir), [
        "flight", "from", "to", "from_city", "to_city", "flight_time", "temperature", "humidity",
        "wind_speed", "my_flightradar24_rating", "arrival_delay_index", "departure_delay_index"])


@query("p3_rename_columns", _sql(["airports_clean"], """
SELECT airport AS code, my_flightradar24_rating AS rating, arrival_delay_index, departure_delay_index FROM airports_clean"""))
def p3_rename_columns(spark, sf_dir):
    return nulls.rename_columns(T.airports_clean(spark, sf_dir),
                                {"airport": "code", "my_flightradar24_rating": "rating"})


@query("p4_split_line", _sql(["flights_msg"], "SELECT " + ", ".join(
    f'string_split(value, \',\')[{i + 1}] AS "{n}"' for i, n in enumerate(FLIGHTS_STREAM_COLUMNS)) + " FROM flights_msg"))
def p4_split_line(spark, sf_dir):
    return flights.split_stream_line(fixtures.flights_msg(spark, sf_dir), FLIGHTS_STREAM_COLUMNS)


@query("p5_regex_filter", _sql(["flights_raw"], """
SELECT * FROM flights_raw WHERE regexp_matches(string_split(status, ' ')[1], 'Landed')"""))
def p5_regex_filter(spark, sf_dir):
    r = T.raw(spark, sf_dir, "flights_raw")
    return nulls.regex_filter(r, "status", "^[^ ]*Landed")


@query("p6_non_blank", _sql(["reviews_raw"], "SELECT * FROM reviews_raw WHERE trim(\"comment\") <> ''"))
def p6_non_blank(spark, sf_dir):
    return nulls.non_blank(T.raw(spark, sf_dir, "reviews_raw"), "comment")


@query("p6_non_blank_some", _sql(["reviews_raw"], """
SELECT "comment" FROM (SELECT CASE length("comment") % 3 WHEN 0 THEN '' WHEN 1 THEN '   ' ELSE "comment" END AS "comment" FROM reviews_raw)
WHERE trim("comment") <> ''"""))
def p6_non_blank_some(spark, sf_dir):
    """Comments of two in three lengths are emptied or blanked first, so the filter has rows to drop."""
    third = F.length("comment") % 3
    some = F.when(third == 0, "").when(third == 1, "   ").otherwise(F.col("comment"))
    return nulls.non_blank(T.raw(spark, sf_dir, "reviews_raw").select(some.alias("comment")), "comment")


@query("p8_drop_any_null", _sql(["weather_raw"], "SELECT * FROM weather_raw WHERE condition IS NOT NULL"))
def p8_drop_any_null(spark, sf_dir):
    return nulls.require(T.raw(spark, sf_dir, "weather_raw"))


@query("p9_drop_subset_null", _sql(["aircrafts_raw"], "SELECT * FROM aircrafts_raw WHERE aircraft IS NOT NULL AND airline IS NOT NULL"))
def p9_drop_subset_null(spark, sf_dir):
    return nulls.require(T.raw(spark, sf_dir, "aircrafts_raw"), ["aircraft", "airline"])


@query("p10_sentinel_to_null", _sql(["airports_raw"], """
SELECT nullif(my_flightradar24_rating, 'N/A') AS my_flightradar24_rating, nullif(temp, 'N/A') AS temp,
       nullif(arrival_delay_index, 'N/A') AS arrival_delay_index, nullif(departure_delay_index, 'N/A') AS departure_delay_index,
       nullif(utc, 'N/A') AS utc, nullif("local", 'N/A') AS "local", nullif(airport, 'N/A') AS airport FROM airports_raw"""))
def p10_sentinel_to_null(spark, sf_dir):
    return nulls.sentinel_to_null(T.raw(spark, sf_dir, "airports_raw"), "N/A")


@query("p11_constant_fill", _sql(["airports_raw"], """
SELECT airport, coalesce(try_cast(arrival_delay_index AS FLOAT), CAST(2.5 AS FLOAT)) AS arrival_delay_index,
       coalesce(try_cast(departure_delay_index AS FLOAT), CAST(2.5 AS FLOAT)) AS departure_delay_index FROM airports_raw"""))
def p11_constant_fill(spark, sf_dir):
    a = T.raw(spark, sf_dir, "airports_raw").select(
        "airport", F.col("arrival_delay_index").try_cast("float").alias("arrival_delay_index"),
        F.col("departure_delay_index").try_cast("float").alias("departure_delay_index"))
    return nulls.fill_constant(a, 2.5, ["arrival_delay_index", "departure_delay_index"])


@query("p12_p13_mean_fill_age", with_tables("aircrafts_raw", extra=["""
a AS (SELECT aircraft, CASE WHEN try_cast(regexp_extract(first_flight, '\\((\\d+) years\\)', 1) AS DOUBLE) = 2024 THEN 1.0
      ELSE try_cast(regexp_extract(first_flight, '\\((\\d+) years\\)', 1) AS DOUBLE) END AS age FROM aircrafts_raw)"""])
      + "SELECT aircraft, round(coalesce(age, (SELECT avg(age) FROM a)), 9) AS age FROM a")
def p12_p13_mean_fill_age(spark, sf_dir):
    a = T.raw(spark, sf_dir, "aircrafts_raw")
    a = a.select("aircraft", nulls.repair_sentinel(
        F.regexp_extract("first_flight", dimensions.AGE_PATTERN, 1).try_cast("double"), 2024, 1.0).alias("age"))
    return nulls.fill_with_mean(a, "age").withColumn("age", F.round("age", 9))


@query("p14_blank_fallback", _sql(["flights_raw"], """
SELECT coalesce(nullif(trim(actual_time_departure), ''), scheduled_time_departure) AS departure_clock,
       coalesce(nullif(trim("date"), ''), 'unknown') AS day_text FROM flights_raw"""))
def p14_blank_fallback(spark, sf_dir):
    r = T.raw(spark, sf_dir, "flights_raw")
    r = nulls.with_fallback(r, "actual_time_departure", "scheduled_time_departure")
    r = nulls.with_fallback(nulls.with_constant(r, "unknown", "unknown"), "date", "unknown")
    return r.select(F.col("actual_time_departure").alias("departure_clock"), F.col("date").alias("day_text"))


@query("p16_status_routing", _sql(["flights_raw"], """
SELECT flight, status FROM flights_raw WHERE status <> 'Scheduled'"""))
def p16_status_routing(spark, sf_dir):
    r = T.raw(spark, sf_dir, "flights_raw")
    rows = r.select("flight", "status", F.array("flight", "status", F.lit("x"), F.lit("y")).alias("cells"))
    return nulls.route_by_status(rows, "history").select("flight", "status")


_ROUTED = """
SELECT flight, status FROM (SELECT flight, CASE WHEN right(flight, 1) IN ('0', '1', '2') THEN 'Scheduled'
    WHEN right(flight, 1) IN ('3', '4') THEN 'Estimated 10:15' ELSE status END AS status FROM flights_raw)
WHERE """


def _routed(spark, sf_dir, mode):
    """Flights by their number's last digit as not yet departed, so both modes keep some rows and drop some."""
    last = F.right("flight", F.lit(1))
    status = F.when(last.isin("0", "1", "2"), "Scheduled").when(last.isin("3", "4"), "Estimated 10:15").otherwise(F.col("status"))
    r = T.raw(spark, sf_dir, "flights_raw").select("flight", status.alias("status"))
    rows = r.select("*", F.array("flight", "status", F.lit("x"), F.lit("y")).alias("cells"))
    return nulls.route_by_status(rows, mode).select("flight", "status")


@query("p16_history_routing", _sql(["flights_raw"], _ROUTED + "status <> 'Scheduled'"))
def p16_history_routing(spark, sf_dir):
    return _routed(spark, sf_dir, "history")


@query("p16_live_routing", _sql(["flights_raw"], _ROUTED + "split_part(status, ' ', 1) IN ('Scheduled', 'Estimated')"))
def p16_live_routing(spark, sf_dir):
    return _routed(spark, sf_dir, "live")


@query("p17_class_filter", _sql(["flights_clean"], """
SELECT flight, delay_time FROM flights_clean WHERE status = 'Delayed'"""))
def p17_class_filter(spark, sf_dir):
    return nulls.only_class(T.flights_clean(spark, sf_dir), "status", "Delayed").select("flight", "delay_time")


@query("p18_city_pair", _sql(["flights_clean"], """
SELECT flight, from_city, to_city FROM flights_clean WHERE from_city = 'city3' AND to_city = 'city17'"""))
def p18_city_pair(spark, sf_dir):
    f = nulls.city_pair(T.flights_clean(spark, sf_dir), "City3", "City17")
    return f.select("flight", "from_city", "to_city")


@query("p19_nulls_to_empty", _sql(["airports_raw"], """
SELECT coalesce(temp, '') AS temp, coalesce(airport, '') AS airport FROM airports_raw"""))
def p19_nulls_to_empty(spark, sf_dir):
    return nulls.nulls_to_empty(T.raw(spark, sf_dir, "airports_raw").select("temp", "airport"))
