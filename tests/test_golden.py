"""Hand-written rows for the semantic traps of the cleaning chains."""

import datetime as dt

from pyspark.sql import functions as F

from tarmac.operators import dimensions, flights, weather
from tarmac.schemas import AIRCRAFTS, AIRPORTS, FLIGHTS_HISTORY, WEATHER_HISTORY


def _flight(spark, rows):
    full = [("a1", "", "", d, "Doha (DOH)", "Paris (CDG)", "QR1", "6:30", std, atd, sta, "", st, "") for d, std, atd, sta, st in rows]
    return spark.createDataFrame(full, FLIGHTS_HISTORY)


def test_midnight_rounding_same_day_and_roll(spark):
    raw = _flight(spark, [("05 Mar 2024", "17:00", "17:05", "23:45", "Landed 23:50")])
    same = flights.clean_flights(raw).collect()[0]
    assert same.rounded_hour == dt.datetime(2024, 3, 5, 0, 0)  # a day early, as in the reference
    roll = flights.clean_flights(raw, midnight="roll").collect()[0]
    assert roll.rounded_hour == dt.datetime(2024, 3, 6, 0, 0)


def test_delay_wrap_over_midnight_stays_on_time(spark):
    raw = _flight(spark, [("05 Mar 2024", "17:00", "17:05", "23:50", "Landed 00:10")])
    r = flights.clean_flights(raw).collect()[0]
    assert r.delay_time == 20.0 and r.status == "On Time"
    relabeled = flights.clean_flights(raw, relabel=True).collect()[0]
    assert relabeled.status == "Delayed"


def test_landed_without_time_and_filters(spark):
    raw = _flight(spark, [
        ("05 Mar 2024", "10:00", "10:05", "12:00", "Landed"),
        ("05 Mar 2024", "10:00", "10:05", "12:00", "Canceled"),
        ("05 Mar 2024", "10:00", "—", "12:00", "Landed 12:30"),
        ("", "10:00", "10:05", "12:00", "Landed 12:30"),
    ])
    out = flights.clean_flights(raw).collect()
    assert len(out) == 1  # Canceled filtered; dash time and blank date dropped by the null filter
    assert out[0].actual_time_arrival is None and out[0].status == "On Time"
    assert out[0].flight_time == 6.5 and out[0]["from"] == "doh" and out[0].to_city == "paris"


def test_airports_na_fill_and_required_rating(spark):
    raw = spark.createDataFrame([
        ("87%", None, "N/A", "1.5", "UTC 05:30", "03:30 PM", "doh"),
        ("N/A", None, "2.0", "2.0", "UTC 05:30", "03:30 PM", "cdg"),
        ("87%", None, "N/A", "1.5", "UTC 05:30", "03:30 PM", "doh"),
    ], AIRPORTS)
    out = dimensions.clean_airports(raw).collect()
    assert len(out) == 1
    assert out[0].my_flightradar24_rating == 87 and out[0].arrival_delay_index == 2.5
    job = dimensions.clean_airports(raw, variant="job").orderBy("airport").collect()
    assert job[1].time_diff == 5 * 60 + 30 - (15 * 60 + 30)


def test_aircraft_age_sentinel_and_mean_fill(spark):
    raw = spark.createDataFrame([
        ("1", "B777", "A7-X", "QR", "Mar 2010 (14 years)", ""),
        ("2", "B777", "A7-Y", "QR", "Jan 2024 (2024 years)", ""),
        ("3", "B777", "A7-Z", "QR", "N/A", ""),
        ("4", "B777", "A7-W", None, "Mar 2010 (3 years)", ""),
    ], AIRCRAFTS)
    out = {r.aircraft: r.age for r in dimensions.clean_aircrafts(raw).collect()}
    assert out == {"a7-x": 14.0, "a7-y": 1.0, "a7-z": (14 + 1 + 3) / 3}


def test_weather_signs_and_hourly_survivor(spark):
    raw = spark.createDataFrame([
        ("11:20 PM", "-3 °F", "-9 °F", "80 %", "N", "Calm", "5 mph", "29.92 in", "0.0 in", "Fog", "doh", "2024-01-05 00:00:00"),
        ("11:50 PM", "4 °F", "1 °F", "70 %", "N", "7 mph", "5 mph", "29.90 in", "0.1 in", "Fog", "doh", "2024-01-05 00:00:00"),
    ], WEATHER_HISTORY)
    out = weather.clean_weather(raw).orderBy("rounded_hour").collect()
    assert [r.rounded_hour for r in out] == [dt.datetime(2024, 1, 5, 0, 0), dt.datetime(2024, 1, 5, 23, 0)]
    assert out[1].temperature == -3 and out[1].wind_speed is None
    msgs = spark.createDataFrame([('{"date": "2024-01-05 10:00:00", "hour": "10", "details": {"feels_like": "-5°", '
                                   '"wind_direction": "N", "wind_speed": "3 mph", "humidity": "50%", "cloud_cover": "10%", '
                                   '"rain_amount": "0.1 in"}}',)], "value string")
    assert weather.clean_weather_stream(msgs).collect()[0].temperature == 5
    assert weather.clean_weather_stream(msgs, signed=True).collect()[0].temperature == -5
