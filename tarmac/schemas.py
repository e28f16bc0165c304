"""Raw (all-text) schemas of the scraped tables and the model feature lists.

Column names and their order are fixed values: raw CSV files carry no
usable header, so columns are bound by position.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType


def text_schema(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# --- fixed values: raw column orders -------------------------------------
FLIGHTS_HISTORY_COLUMNS = [
    "aircraft", "temp1", "temp2", "date", "from", "to", "flight", "flight_time",
    "scheduled_time_departure", "actual_time_departure", "scheduled_time_arrival",
    "temp3", "status", "temp4",
]
FLIGHTS_STREAM_COLUMNS = [
    "flight", "temp1", "temp2", "date", "from", "to", "aircraft", "flight_time",
    "scheduled_time_departure", "actual_time_departure", "scheduled_time_arrival",
    "temp3", "status", "temp4",
]
AIRCRAFTS_COLUMNS = ["msn", "type", "aircraft", "airline", "first_flight", "photo"]
AIRPORTS_COLUMNS = [
    "my_flightradar24_rating", "temp", "arrival_delay_index", "departure_delay_index",
    "utc", "local", "airport",
]
WEATHER_HISTORY_COLUMNS = [
    "time", "temperature", "dew_point", "humidity", "wind_direction", "wind_speed",
    "wind_gust", "pressure", "precip", "condition", "airport", "date",
]
REVIEWS_COLUMNS = ["comment", "airport"]
WEATHER_STREAM_DETAIL_FIELDS = [
    "feels_like", "wind_direction", "wind_speed", "humidity", "cloud_cover", "rain_amount",
]

# --- fixed values: model inputs -------------------------------------------
ENCODED_COLUMNS = ["flight", "from", "to", "from_city", "to_city"]
FEATURE_COLUMNS = [
    "flight", "from", "to", "from_city", "to_city", "flight_time", "departure_delay",
    "temperature", "humidity", "wind_speed", "my_flightradar24_rating",
    "arrival_delay_index", "departure_delay_index", "year", "month", "day", "hour",
    "dayofweek", "quarter",
]
# Output fields of the search result (prediction projection).
RESULT_FIELDS = [
    "from", "to", "from_city", "to_city", "aircraft", "flight_time",
    "scheduled_time_departure", "actual_time_departure", "scheduled_time_arrival", "status",
]
# --------------------------------------------------------------------------

FLIGHTS_HISTORY = text_schema(FLIGHTS_HISTORY_COLUMNS)
FLIGHTS_STREAM = text_schema(FLIGHTS_STREAM_COLUMNS)
AIRCRAFTS = text_schema(AIRCRAFTS_COLUMNS)
AIRPORTS = text_schema(AIRPORTS_COLUMNS)
WEATHER_HISTORY = text_schema(WEATHER_HISTORY_COLUMNS)
REVIEWS = text_schema(REVIEWS_COLUMNS)
WEATHER_MESSAGE = text_schema(["date", "hour", "details"])
WEATHER_DETAILS = text_schema(WEATHER_STREAM_DETAIL_FIELDS)
