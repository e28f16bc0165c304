"""Cleaned tables of one data directory, built lazily from the raw shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tarmac.operators import dimensions, flights, joins, weather
from tarmac.session import checkpoint_dir, ensure_utc
from tarmac.sources import fixtures


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_utc(spark)
    return fixtures.raw(spark, sf_dir, name)


def flights_clean(spark, sf_dir, **kw) -> DataFrame:
    return flights.clean_flights(raw(spark, sf_dir, "flights_raw"), **kw)


def weather_clean(spark, sf_dir, **kw) -> DataFrame:
    return weather.clean_weather(raw(spark, sf_dir, "weather_raw"), **kw)


def aircrafts_clean(spark, sf_dir, **kw) -> DataFrame:
    return dimensions.clean_aircrafts(raw(spark, sf_dir, "aircrafts_raw"), **kw)


def airports_clean(spark, sf_dir, **kw) -> DataFrame:
    return dimensions.clean_airports(raw(spark, sf_dir, "airports_raw"), **kw)


def reviews_clean(spark, sf_dir) -> DataFrame:
    return dimensions.clean_reviews(raw(spark, sf_dir, "reviews_raw"))


def joined(spark, sf_dir, measures: bool = True) -> DataFrame:
    """The joined flight table; without ``measures`` the same rows, but only
    the keys of the weather."""
    hours = weather_clean(spark, sf_dir) if measures else weather.observed_hours(raw(spark, sf_dir, "weather_raw"))
    return joins.join_flights(flights_clean(spark, sf_dir), hours,
                              airports_clean(spark, sf_dir), aircrafts_clean(spark, sf_dir))


def portable(df: DataFrame) -> DataFrame:
    """Zone-free output: session timestamps -> TIMESTAMP_NTZ (wall clock).

    Registered queries end with this so that their values do not depend on
    the reader's time zone."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(c.cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else c)
    return df.select(*cols)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a table that later plans read several times (label
    codes, the split training table): a reliable checkpoint in the cluster's
    shared ``spark.checkpoint.dir``. Later plans start from the checkpoint,
    so they stay small and a lost executor never re-runs the upstream
    cleaning and joins."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
