"""Registered queries: scans and sinks checked by read-back (S1-S6, K1-K8,
T1, T5). Each writes into a fresh folder under the cluster's shared
checkpoint directory and returns the frame read back from it."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tarmac.operators import dimensions, flights
from tarmac.plans import tables as T
from tarmac.plans.oracle import with_tables
from tarmac.plans.registry import query
from tarmac.schemas import AIRPORTS, FLIGHTS_HISTORY, REVIEWS, WEATHER_HISTORY_COLUMNS
from tarmac.session import checkpoint_dir
from tarmac.sinks import writers
from tarmac.sources import fixtures, readers
from tarmac.streaming import jobs


def scratch(spark, name: str) -> str:
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tarmac-io/{name}-{uuid.uuid4().hex[:12]}"


@query("s1_k2_typed_csv_roundtrip", with_tables("airports_clean") + "SELECT * FROM airports_clean")
def s1_k2_typed_csv_roundtrip(spark, sf_dir):
    path = scratch(spark, "airports_csv")
    writers.write_csv(T.raw(spark, sf_dir, "airports_raw"), path, header=True)
    return dimensions.clean_airports(readers.read_csv_typed(spark, path, AIRPORTS, header=True))


@query("s2_header_csv", with_tables("flights_raw") + "SELECT " + ", ".join(
    f'nullif("{c}", \'\') AS "{c}"' for c in FLIGHTS_HISTORY.fieldNames()) + " FROM flights_raw")
def s2_header_csv(spark, sf_dir):
    """Header CSV written and read back: every column text, blank cells null."""
    path = scratch(spark, "flights_csv")
    writers.write_csv(T.raw(spark, sf_dir, "flights_raw"), path, header=True)
    return readers.read_csv_header(spark, path)


@query("s3_conform_by_position", with_tables("flights_raw") + "SELECT * FROM flights_raw")
def s3_conform_by_position(spark, sf_dir):
    r = T.raw(spark, sf_dir, "flights_raw")
    renamed = r.toDF(*[f"c{i}" for i in range(len(r.columns))])
    return readers.conform(renamed, FLIGHTS_HISTORY)


@query("s4_k1_k4_parquet_roundtrip", with_tables("flights_clean") + "SELECT * FROM flights_clean")
def s4_k1_k4_parquet_roundtrip(spark, sf_dir):
    path = scratch(spark, "flights_parquet")
    writers.write_parquet(T.flights_clean(spark, sf_dir), path, compression="snappy")
    return T.portable(readers.read_parquet(spark, path))


@query("k3_eventdate_partition", with_tables("joined") + "SELECT *, '20240507' AS eventdate FROM joined")
def k3_eventdate_partition(spark, sf_dir):
    base = scratch(spark, "joined_eventdate")
    writers.write_eventdate(T.joined(spark, sf_dir), base, "20240507")
    back = spark.read.option("basePath", base).parquet(f"{base}/eventdate=20240507")
    return T.portable(back.withColumn("eventdate", F.col("eventdate").cast("string")))


@query("s6_scan_date_range", with_tables("flights_live") + """
SELECT * FROM flights_live WHERE "date" BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""")
def s6_scan_date_range(spark, sf_dir):
    path = scratch(spark, "live_by_date")
    live = flights.clean_flights_stream(fixtures.flights_msg(spark, sf_dir))
    live.write.partitionBy("date").parquet(path)
    return T.portable(readers.scan_date_range(spark, path, "2024-01-10", "2024-01-12", fmt="parquet"))


@query("k8_compact_partitions", with_tables("weather_live") + "SELECT * FROM weather_live")
def k8_compact_partitions(spark, sf_dir):
    from tarmac.operators import weather
    from tarmac.plans.oracle import LIVE_LOCATION
    small, dst = scratch(spark, "weather_small"), scratch(spark, "weather_compact")
    w = weather.clean_weather_stream(T.raw(spark, sf_dir, "weather_msg"), location=LIVE_LOCATION)
    w.write.partitionBy("date").parquet(small)
    writers.compact_partitions(spark, small, dst, fmt="parquet")
    back = spark.read.parquet(dst)
    return T.portable(back.select(*w.columns))


@query("k6_k7_message_roundtrip", with_tables("flights_raw") + """
SELECT concat_ws(',', aircraft, temp1, temp2, "date", "from", "to", flight, flight_time, scheduled_time_departure,
       actual_time_departure, scheduled_time_arrival, temp3, status, temp4) AS value FROM flights_raw""")
def k6_k7_message_roundtrip(spark, sf_dir):
    r = T.raw(spark, sf_dir, "flights_raw")
    msgs = writers.to_messages(r, [c for c in r.columns if c != "aircraft"], F.col("aircraft"))
    return writers.decode_message(msgs, "flights")


@query("s1_k2_reviews_csv", with_tables("reviews_raw") + """SELECT "comment", airport FROM reviews_raw""")
def s1_k2_reviews_csv(spark, sf_dir):
    """Comments with quotes, commas and line breaks through CSV, unchanged."""
    path = scratch(spark, "reviews_csv")
    writers.write_csv(T.raw(spark, sf_dir, "reviews_raw"), path, header=True, quoted_lines=True)
    return readers.read_csv_typed(spark, path, REVIEWS, header=True, quoted_lines=True)


@query("k6_decode_reviews", with_tables("reviews_raw") + """
SELECT concat_ws(',', replace(coalesce("comment", ''), ',', ' '), replace(airport, ',', ' ')) AS value FROM reviews_raw""")
def k6_decode_reviews(spark, sf_dir):
    msgs = writers.to_messages(T.raw(spark, sf_dir, "reviews_raw"), ["comment", "airport"], kind="reviews")
    return writers.decode_message(msgs, "reviews")


_WEATHER_CELLS = WEATHER_HISTORY_COLUMNS


@query("k6_land_weather", with_tables("weather_raw") + "SELECT concat_ws(',', " + ", ".join(
    f"coalesce(\"{c}\", '')" for c in _WEATHER_CELLS) + ") AS value FROM weather_raw")
def k6_land_weather(spark, sf_dir):
    """Weather messages landed as text lines by the stream sink, read back."""
    src, out, ck = scratch(spark, "weather_msgs"), scratch(spark, "weather_landed"), scratch(spark, "weather_land_ck")
    writers.to_messages(T.raw(spark, sf_dir, "weather_raw"), _WEATHER_CELLS, kind="array").write.text(src)
    writers.land_raw(readers.read_stream(spark, "text", path=src), "weather", out, ck).awaitTermination()
    return spark.read.text(out)


@query("t1_t5_flights_stream_job", with_tables("flights_live") + "SELECT * FROM flights_live")
def t1_t5_flights_stream_job(spark, sf_dir):
    """The live-flight stream job over message files (availableNow), read
    back from its date-partitioned CSV output with the cleaned types."""
    src, out, ck = scratch(spark, "msgs"), scratch(spark, "live_out"), scratch(spark, "live_ck")
    fixtures.flights_msg(spark, sf_dir).write.text(src)
    jobs.flights_stream_job(spark, out, ck, path=src).awaitTermination()
    schema = ("flight string, `from` string, `to` string, aircraft string, flight_time string, "
              "scheduled_time_departure timestamp, actual_time_departure timestamp, "
              "scheduled_time_arrival timestamp, status string, from_city string, to_city string, "
              "rounded_hour timestamp, date date")
    back = spark.read.schema(schema).option("header", True).csv(out)
    return T.portable(back)


@query("w7_union_by_position", with_tables("flights_raw") + "SELECT * FROM flights_raw")
def w7_union_by_position(spark, sf_dir):
    """Two slices whose columns carry other names, conformed to the raw
    schema by position and unioned."""
    r = T.raw(spark, sf_dir, "flights_raw")
    a = r.filter(F.col("status").startswith("Landed")).toDF(*[f"a{i}" for i in range(len(r.columns))])
    b = r.filter(~F.col("status").startswith("Landed")).toDF(*[f"b{i}" for i in range(len(r.columns))])
    return readers.conform(a, FLIGHTS_HISTORY).unionAll(readers.conform(b, FLIGHTS_HISTORY))


@query("t2_weather_stream_job", with_tables("weather_live") + "SELECT * FROM weather_live")
def t2_weather_stream_job(spark, sf_dir):
    """The live-weather stream job over message files, read back typed."""
    from tarmac.plans.oracle import LIVE_LOCATION
    src, out, ck = scratch(spark, "wmsgs"), scratch(spark, "weather_out"), scratch(spark, "weather_ck")
    T.raw(spark, sf_dir, "weather_msg").write.text(src)
    jobs.weather_stream_job(spark, out, ck, path=src, location=LIVE_LOCATION).awaitTermination()
    schema = ("timestamp timestamp, temperature int, wind_direction string, wind_speed int, humidity int, "
              "cloud_cover int, precip float, location string, date date")
    return T.portable(spark.read.schema(schema).option("header", True).csv(out))
