"""Aircraft (D8), airport (D9) and review (D11) cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import columns as C
from tarmac.operators import nulls

AGE_PATTERN = r"\((\d+) years\)"  # fixed value: '(N years)' in the first-flight text


# D8
def clean_aircrafts(raw: DataFrame, variant: str = "notebook") -> DataFrame:
    """Age from 'Mar 2010 (14 years)'; the 2024 sentinel (first flight this
    year, scraped as '2024 years') becomes 1.0; key lower-cased.

    ``'notebook'``: double age, null age -> mean age (P12), rows without
    aircraft or airline dropped. ``'job'``: integer age, no fill, no drop.
    """
    df = raw.drop("photo")
    age_text = F.regexp_extract("first_flight", AGE_PATTERN, 1)
    if variant == "job":
        return df.withColumn("age", age_text.try_cast("int")).drop("first_flight") \
                 .withColumn("aircraft", F.lower("aircraft"))
    df = df.withColumn("age", age_text.try_cast("double")).drop("first_flight")
    df = df.withColumn("age", F.when(F.col("age") == 2024, 1.0).otherwise(F.col("age")))
    df = df.withColumn("aircraft", F.lower("aircraft"))
    df = nulls.fill_with_mean(df, "age")
    return df.dropna(subset=["aircraft", "airline"])


# D9
def clean_airports(raw: DataFrame, variant: str = "notebook") -> DataFrame:
    """'N/A' -> null, '87%' -> 87, delay indices to float; 'notebook' fills
    missing indices with 2.5 and requires a rating, 'job' keeps the UTC-local
    offset as whole minutes (``time_diff``)."""
    df = raw.drop("temp")
    df = nulls.sentinel_to_null(df, "N/A")
    df = df.withColumns({
        "my_flightradar24_rating": C.keep_digits("my_flightradar24_rating"),
        "arrival_delay_index": F.col("arrival_delay_index").try_cast("float"),
        "departure_delay_index": F.col("departure_delay_index").try_cast("float"),
    })
    if variant == "job":
        utc = C.parse_timestamp(F.regexp_extract("utc", r"(\d{2}:\d{2})", 0), "H:mm")
        local = C.parse_timestamp(F.concat(F.lit("1970-01-01 "), F.col("local")), "yyyy-MM-dd h:mm a")
        df = df.withColumn("time_diff", C.interval_minutes(utc, local)).drop("utc", "local")
        return df.dropDuplicates()
    df = df.drop("utc", "local").dropDuplicates()
    df = df.fillna(2.5, subset=["arrival_delay_index", "departure_delay_index"])
    return df.dropna(subset=["my_flightradar24_rating"])


# D11
def clean_reviews(raw: DataFrame) -> DataFrame:
    """Lower-case, keep ASCII letters / digits / blanks, drop blank comments,
    drop duplicate (comment, airport) rows. Whole texts are kept."""
    df = C.parsed(raw, {"comment": C.keep_alnum(F.lower("comment"))})
    df = df.filter(F.trim("comment") != "")
    return df.dropDuplicates()
