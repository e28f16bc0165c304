"""Weather cleaning (D10 history, D13 live stream) and the hourly key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions import columns as C
from tarmac.schemas import WEATHER_DETAILS, WEATHER_MESSAGE

MEASURES_INT = ["temperature", "dew_point", "humidity", "wind_speed", "wind_gust"]
MEASURES_FLOAT = ["pressure", "precip"]


#: Column, characters kept besides digits, type.
UNITS = [("temperature", "-", "int"), ("dew_point", "-", "int"), ("humidity", "", "int"), ("wind_speed", "", "int"),
         ("wind_gust", "", "int"), ("pressure", ".", "float"), ("precip", ".", "float")]


def parse_units(df: DataFrame) -> DataFrame:
    """Numbers with units -> numbers (temperature / dew point keep their sign).

    The seven regexes and the seven casts run in two generated methods, kept
    apart by a one-row explode: in one method they outgrow what the JVM
    compiles, and a row then costs five times as much."""
    text = F.struct(*[C.digits_text(c, extra).alias(c) for c, extra, _ in UNITS])
    out = df.withColumn("_text", F.explode(F.array(text)))
    return out.withColumns({c: F.col("_text")[c].try_cast(to) for c, _, to in UNITS}).drop("_text")


def with_observation_time(df: DataFrame) -> DataFrame:
    """'yyyy-MM-dd ...' day + 'h:mm AM' clock -> date_time; raw texts dropped."""
    text = F.concat_ws(" ", C.token("date", " ", 0), F.col("time"))
    return C.parsed(df, {"date_time": C.parse_timestamp(text, "yyyy-MM-dd h:mm a")}).drop("date", "time")


def hourly_observations(df: DataFrame, midnight: str = "same_day", distinct: bool = True) -> DataFrame:
    """D10 up to the hourly key (the packaged-job variant stops after W2).
    ``distinct=False`` leaves equal rows, for a caller that keeps one of them."""
    df = df.dropna(how="any")
    df = parse_units(df)
    df = with_observation_time(df)
    if distinct:
        df = df.dropDuplicates()
    return df.withColumn("rounded_hour", C.round_to_hour("date_time", midnight))


def observed_hours(raw: DataFrame, midnight: str = "same_day") -> DataFrame:
    """The keys of ``clean_weather``, without its measures: a join that uses
    none of them meets the same one row per airport and hour, and no unit is
    parsed and no survivor chosen."""
    df = with_observation_time(raw.dropna(how="any"))
    return df.select("airport", C.round_to_hour("date_time", midnight).alias("rounded_hour")).distinct()


ORDER_COLUMNS = MEASURES_INT[:3] + ["wind_direction"] + MEASURES_INT[3:] + MEASURES_FLOAT + [
    "condition", "date_time"]


def one_per_hour(df: DataFrame, keys: tuple[str, ...] = ("airport", "rounded_hour")) -> DataFrame:
    """One row per key. The survivor is the smallest row in column order
    (nulls first), which makes the reference's arbitrary pick deterministic.

    ``row_number() = 1``: Spark limits each key to its first row inside every
    map task before the shuffle, so a key holding a third of all rows costs
    one row per map task. (``min(struct)`` with text in it would be a sort
    aggregate on both sides of the shuffle.)
    """
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in ORDER_COLUMNS if c in rest] + [c for c in rest if c not in ORDER_COLUMNS]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order]))
    return df.withColumn("_first", first).filter(F.col("_first") == 1).select(*keys, *rest)


def hourly_means(df: DataFrame) -> DataFrame:
    """A2: means per (airport, hour); integer measures truncate toward zero."""
    aggs = [F.avg(c).cast("int").alias(c) for c in MEASURES_INT]
    aggs += [F.avg(c).cast("float").alias(c) for c in MEASURES_FLOAT]
    return df.groupBy("airport", "rounded_hour").agg(*aggs)


def clean_weather(raw: DataFrame, variant: str = "notebook", aggregate: str = "survivor",
                  midnight: str = "same_day") -> DataFrame:
    """D10. ``variant='job'`` returns the deduplicated hourly observations;
    ``'notebook'`` adds the per-hour means. ``aggregate='survivor'`` (reference)
    averages the single W2 survivor; ``'all'`` averages every observation of
    the hour."""
    if aggregate == "all" and variant == "notebook":
        return hourly_means(hourly_observations(raw, midnight))
    one = one_per_hour(hourly_observations(raw, midnight, distinct=False))  # of equal rows one survives anyway
    if variant == "job":
        return one
    # One row per key already: the mean is that row's value, cast as the
    # reference does. Computed as a projection - no second aggregation.
    return one.select(
        "airport", "rounded_hour",
        *[F.col(c).cast("double").cast("int").alias(c) for c in MEASURES_INT],
        *[F.col(c).cast("double").cast("float").alias(c) for c in MEASURES_FLOAT])


# D13
def clean_weather_stream(messages: DataFrame, location: str = "doh", signed: bool = False) -> DataFrame:
    """Live weather: two-level JSON -> typed hourly forecast rows.

    The reference strips the minus sign of the felt temperature; ``signed=True``
    keeps it. Rows missing any required value are dropped (P7)."""
    msg = messages.select(F.from_json(F.col("value").cast("string"), WEATHER_MESSAGE).alias("m")).select("m.*")
    msg = msg.withColumn("details", F.from_json("details", WEATHER_DETAILS))
    df = C.parsed(msg, {
        "timestamp": C.parse_timestamp("date", "yyyy-MM-dd HH:mm:ss"),
        "temperature": C.keep_digits("details.feels_like", "-" if signed else ""),
        "wind_direction": F.col("details.wind_direction"),
        "wind_speed": C.keep_digits("details.wind_speed"),
        "humidity": C.keep_digits("details.humidity"),
        "cloud_cover": C.keep_digits("details.cloud_cover"),
        "precip": C.keep_digits("details.rain_amount", ".", "float"),
    }).drop(*msg.columns).withColumn("location", F.lit(location))
    df = df.dropna(subset=["timestamp", "temperature", "wind_direction", "wind_speed",
                           "humidity", "cloud_cover", "precip"])
    return df.withColumn("date", F.to_date("timestamp"))
