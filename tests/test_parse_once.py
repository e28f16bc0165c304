"""Texts are parsed once: filters that come later (null drops, join keys) read the parsed columns, and tables that
are read several times are written first."""

import re

from pyspark.sql import functions as F

from tarmac.functions import columns as C
from tarmac.operators import weather
from tarmac.plans import catalog
from tarmac.plans import features as FT
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _parsing_filters(df) -> list[str]:
    return [line for line in _plan(df).splitlines() if re.match(r"[\s:+-]*Filter", line) and "gettimestamp" in line]


def test_no_filter_parses_texts_again(spark):
    assert not _parsing_filters(FT.training_features(spark, SF_SMALL))
    assert not _parsing_filters(FT.live_joined(spark, SF_SMALL))


def test_parsed_columns_replace_and_follow(spark):
    df = spark.createDataFrame([("x 1", None), (None, 2)], "a string, `b c` int")
    out = C.parsed(df, {"a": F.upper("a"), "n": F.length("a")})
    assert out.columns == ["a", "b c", "n"]
    assert {tuple(r) for r in out.collect()} == {("X 1", None, 3), (None, 2, None)}


def test_units_of_odd_texts(spark):
    rows = [("-3 °F",), ("1a2--b3",), ("--",), ("",), (None,), ("12",)]
    df = spark.createDataFrame(rows, "t string").select("t", C.digits_text("t", "-").alias("d"))
    assert [r.d for r in df.collect()] == ["-3", "12--3", "--", None, None, "12"]


def test_live_weather_drops_incomplete_messages(spark):
    whole = '{"date": "2024-01-05 10:00:00", "hour": "10", "details": {"feels_like": "-4°", "wind_direction": "N", "wind_speed": "7 mph", "humidity": "50%", "cloud_cover": "9%", "rain_amount": "0.5 in"}}'
    msgs = spark.createDataFrame([(whole,), (whole.replace("50%", "%"),), (whole.replace("2024-01-05", "x"),), ("no json",), (None,)], "value string")
    out = weather.clean_weather_stream(msgs)
    assert out.columns == ["timestamp", "temperature", "wind_direction", "wind_speed", "humidity", "cloud_cover", "precip", "location", "date"]
    assert [(r.temperature, r.wind_speed, r.humidity, r.cloud_cover, r.precip) for r in out.collect()] == [(4, 7, 50, 9, 0.5)]


def test_features_are_written_before_codes_and_splits(spark):
    enc, _ = FT.encoded_training(spark, SF_SMALL)
    assert "parquet" not in _plan(enc)
    assert "parquet" not in _plan(catalog.queries()["m4_stratified_split"](spark, SF_SMALL))


def test_reviews_are_cleaned_once(spark):
    from tarmac.operators import dimensions

    raw = spark.createDataFrame([("Good, VERY good!", "a1"), ("goodvery good", "a1"), ("?!", "a2"), (None, "a2"), ("Good  very good", "a1"), ("good very good", "a1")], "comment string, airport string")
    out = dimensions.clean_reviews(raw)
    assert not [line for line in _plan(out).splitlines() if re.match(r"[\s:+-]*Filter", line) and "regexp_replace" in line]
    assert sorted(map(tuple, out.collect())) == [("good  very good", "a1"), ("good very good", "a1"), ("goodvery good", "a1")]
