"""Registered queries: aggregations and profiles (A1-A11), W1-W4."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.operators import flights as FL
from tarmac.operators import joins, profile, weather
from tarmac.plans import tables as T
from tarmac.plans.oracle import with_tables
from tarmac.plans.registry import query

# Numeric columns of the feature table profiled by describe / box plots.
PROFILE_COLUMNS = ["flight_time", "temperature", "humidity", "wind_speed",
                   "my_flightradar24_rating", "arrival_delay_index", "departure_delay_index"]


def _round(df, digits=6, keep=()):
    """Round double outputs (sum order changes the last bits between engines)."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
        if f.dataType.typeName() in ("double", "float") and f.name not in keep else F.col(f"`{f.name}`")
        for f in df.schema.fields])


@query("a1_delay_rate_per_airport", with_tables("joined") + """
SELECT airport, count(*) AS flights, count(*) FILTER (WHERE status = 'Delayed') AS delayed,
       round(count(*) FILTER (WHERE status = 'Delayed') / count(*), 6) AS delay_rate,
       round(avg(delay_time), 6) AS mean_delay
FROM joined GROUP BY airport""")
def a1_delay_rate_per_airport(spark, sf_dir):
    j = T.joined(spark, sf_dir, measures=False)
    out = j.groupBy("airport").agg(
        F.count(F.lit(1)).alias("flights"),
        F.count_if(F.col("status") == "Delayed").alias("delayed"),
        F.avg("delay_time").alias("mean_delay"))
    out = out.withColumn("delay_rate", F.col("delayed") / F.col("flights"))
    return _round(out).orderBy(F.desc("flights"), "airport")


@query("a1_flights_per_destination", with_tables("flights_clean") + """
SELECT "to", count(*) AS count FROM flights_clean GROUP BY "to" """)
def a1_flights_per_destination(spark, sf_dir):
    return profile.count_by(T.flights_clean(spark, sf_dir), "to")


@query("a2_weather_hourly_means_all", with_tables("weather_obs") + """
SELECT airport, rounded_hour,
       CAST(trunc(avg(temperature)) AS INTEGER) AS temperature, CAST(trunc(avg(dew_point)) AS INTEGER) AS dew_point,
       CAST(trunc(avg(humidity)) AS INTEGER) AS humidity, CAST(trunc(avg(wind_speed)) AS INTEGER) AS wind_speed,
       CAST(trunc(avg(wind_gust)) AS INTEGER) AS wind_gust,
       round(CAST(avg(pressure) AS FLOAT), 3) AS pressure, round(CAST(avg(precip) AS FLOAT), 3) AS precip
FROM weather_obs GROUP BY airport, rounded_hour""")
def a2_weather_hourly_means_all(spark, sf_dir):
    out = T.weather_clean(spark, sf_dir, aggregate="all")
    out = out.withColumns({c: F.round(F.col(c), 3) for c in ["pressure", "precip"]})
    return T.portable(out)


@query("a3_a4_aircraft_age_stats", with_tables("aircrafts_clean") + """
SELECT count(*) AS n_rows, round(avg(age), 6) AS mean_age, min(age) AS min_age, max(age) AS max_age
FROM aircrafts_clean""")
def a3_a4_aircraft_age_stats(spark, sf_dir):
    return _round(profile.global_stats(T.aircrafts_clean(spark, sf_dir), "age"), keep=("min_age", "max_age"))


@query("a5_joined_row_count", with_tables("joined") + "SELECT count(*) AS n_rows FROM joined")
def a5_joined_row_count(spark, sf_dir):
    return T.joined(spark, sf_dir, measures=False).agg(F.count(F.lit(1)).alias("n_rows"))


@query("a6_status_balance", with_tables("joined") + """
SELECT status, count(*) AS count, round(count(*) / (SELECT count(*) FROM joined), 6) AS share
FROM joined GROUP BY status""")
def a6_status_balance(spark, sf_dir):
    return _round(profile.value_counts(T.joined(spark, sf_dir, measures=False), "status"))


def _null_profile_sql() -> str:
    from tarmac.plans.q_cleaning import JOINED_COLUMNS

    parts = [f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS nulls, "
             f"count(*) FILTER (WHERE \"{c}\" IS NULL) > 0 AS has_null FROM joined" for c in JOINED_COLUMNS]
    return with_tables("joined") + "\nUNION ALL\n".join(parts)


@query("a7_null_profile", _null_profile_sql())
def a7_null_profile(spark, sf_dir):
    return profile.null_profile(T.joined(spark, sf_dir))


@query("a8_raw_flight_duplicates", with_tables("flights_raw") + """
SELECT CAST((SELECT count(*) FROM flights_raw) - (SELECT count(*) FROM (SELECT DISTINCT * FROM flights_raw)) AS BIGINT) AS duplicates""")
def a8_raw_flight_duplicates(spark, sf_dir):
    return profile.duplicate_count(T.raw(spark, sf_dir, "flights_raw"))


def _stack_sql(table: str, cols: list[str], select: str) -> str:
    return "\nUNION ALL\n".join(
        select.format(c=c, t=table) for c in cols)


@query("a9_describe_joined", with_tables("joined") + _stack_sql("joined", PROFILE_COLUMNS, """
SELECT '{c}' AS "column", count("{c}") AS count, round(avg("{c}"), 6) AS mean, round(stddev_samp("{c}"), 6) AS std,
       round(min("{c}"), 6) AS min, round(quantile_cont("{c}", 0.25), 6) AS p25, round(quantile_cont("{c}", 0.5), 6) AS p50,
       round(quantile_cont("{c}", 0.75), 6) AS p75, round(max("{c}"), 6) AS max FROM {t}"""))
def a9_describe_joined(spark, sf_dir):
    return _round(profile.describe(T.joined(spark, sf_dir), PROFILE_COLUMNS))


@query("a10_box_summary", with_tables("joined", extra=["""
q AS (""" + _stack_sql("joined", PROFILE_COLUMNS, """
SELECT '{c}' AS "column", quantile_cont("{c}", 0.25) AS q1, quantile_cont("{c}", 0.75) AS q3 FROM {t}""") + """)""",
"""s AS (""" + _stack_sql("joined", PROFILE_COLUMNS, """
SELECT '{c}' AS "column", CAST("{c}" AS DOUBLE) AS value FROM {t} WHERE "{c}" IS NOT NULL""") + ")"]) + """
SELECT q."column", round(q1, 6) AS q1, round(q3, 6) AS q3,
       round(min(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
       round(max(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
       count(*) FILTER (WHERE NOT (value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS outliers
FROM s JOIN q ON s."column" = q."column" GROUP BY q."column", q1, q3""")
def a10_box_summary(spark, sf_dir):
    return _round(profile.box_summary(T.joined(spark, sf_dir), PROFILE_COLUMNS))


def arrival_delays(spark, sf_dir):
    """Delayed rows of the joined table with their arrival delay (minutes)."""
    j = T.joined(spark, sf_dir, measures=False).filter(F.col("status") == "Delayed")
    return j.withColumn("arrival_delay", (F.unix_timestamp("actual_time_arrival")
                                          - F.unix_timestamp("scheduled_time_arrival")) / 60)


@query("a11_arrival_delay_kde", with_tables("joined", extra=["""
x AS (SELECT date_diff('second', scheduled_time_arrival, actual_time_arrival) / 60 AS x
      FROM joined WHERE status = 'Delayed')""", """
st AS (SELECT count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS bw, min(x) AS lo, max(x) AS hi FROM x)""", """
vc AS (SELECT x, count(*) AS cnt FROM x GROUP BY x)""", """
g AS (SELECT i, lo - 3 * bw + i * ((hi - lo + 6 * bw) / 199) AS g FROM st, range(200) r(i))"""]) + """
SELECT CAST(g.i AS INTEGER) AS point, round(g.g, 6) AS value,
       round(sum(cnt * exp(-0.5 * ((g.g - x) / bw) * ((g.g - x) / bw))) / (n * bw * sqrt(2 * pi())), 10) AS density
FROM g, vc, st GROUP BY g.i, g.g, n, bw""")
def a11_arrival_delay_kde(spark, sf_dir):
    k = profile.kde_grid(arrival_delays(spark, sf_dir), "arrival_delay")
    return k.select("point", F.round("value", 6).alias("value"), F.round("density", 10).alias("density"))


@query("a11_arrival_delay_kde_binned", with_tables("joined", extra=["""
x AS (SELECT date_diff('second', scheduled_time_arrival, actual_time_arrival) / 60 AS x
      FROM joined WHERE status = 'Delayed')""", """
st AS (SELECT count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS bw, min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / 512 AS d FROM x)""", """
b AS (SELECT least(floor((x - lo) / d), 511) AS j, (x - lo) / d AS place FROM x, st)""", """
vc AS (SELECT lo + j * d AS x, sum(w) AS cnt FROM (SELECT j, 1 - (place - j) AS w FROM b UNION ALL SELECT j + 1, place - j FROM b), st GROUP BY lo + j * d)""", """
g AS (SELECT i, lo - 3 * bw + i * ((hi - lo + 6 * bw) / 199) AS g FROM st, range(200) r(i))"""]) + """
SELECT CAST(g.i AS INTEGER) AS point, round(g.g, 6) AS value,
       round(sum(cnt * exp(-0.5 * ((g.g - x) / bw) * ((g.g - x) / bw))) / (n * bw * sqrt(2 * pi())), 10) AS density
FROM g, vc, st GROUP BY g.i, g.g, n, bw""")
def a11_arrival_delay_kde_binned(spark, sf_dir):
    """The density from 512 linear bins, as for columns of very many values."""
    k = profile.kde_grid(arrival_delays(spark, sf_dir), "arrival_delay", bins=512)
    return k.select("point", F.round("value", 6).alias("value"), F.round("density", 10).alias("density"))


@query("w1_distinct_raw_flights", with_tables("flights_raw") + "SELECT DISTINCT * FROM flights_raw")
def w1_distinct_raw_flights(spark, sf_dir):
    return profile.distinct_rows(T.raw(spark, sf_dir, "flights_raw"))


@query("w2_weather_one_per_hour", with_tables("weather_one") + "SELECT * FROM weather_one")
def w2_weather_one_per_hour(spark, sf_dir):
    return T.portable(T.weather_clean(spark, sf_dir, variant="job"))


@query("w3_flights_by_delay", with_tables("flights_clean") + """
SELECT flight, aircraft, scheduled_time_arrival, delay_time FROM flights_clean ORDER BY delay_time""")
def w3_flights_by_delay(spark, sf_dir):
    f = T.flights_clean(spark, sf_dir).select("flight", "aircraft", "scheduled_time_arrival", "delay_time")
    return T.portable(profile.top(f, [F.asc("delay_time")]))


@query("w4_top20_delays", with_tables("flights_clean") + """
SELECT flight, aircraft, scheduled_time_arrival, delay_time FROM flights_clean
ORDER BY delay_time DESC NULLS LAST, flight, aircraft, scheduled_time_arrival LIMIT 20""")
def w4_top20_delays(spark, sf_dir):
    f = T.flights_clean(spark, sf_dir).select("flight", "aircraft", "scheduled_time_arrival", "delay_time")
    order = [F.desc_nulls_last("delay_time"), F.asc("flight"), F.asc("aircraft"), F.asc("scheduled_time_arrival")]
    return T.portable(profile.top(f, order, 20))
