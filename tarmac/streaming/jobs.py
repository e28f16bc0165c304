"""Structured Streaming jobs (T1-T5): live flights and live weather.

Both run the batch cleaning functions unchanged on the unbounded frame and
append date-partitioned CSV with a checkpoint (offsets + dedup state), so a
restarted query continues where it stopped without re-emitting rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import columns as C
from tarmac.operators import flights, weather
from tarmac.sinks.writers import stream_to_csv
from tarmac.sources.readers import read_stream


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def dedup_flights(df: DataFrame, mode: str = "state", watermark: str = "2 days", ttl: str = "30 days") -> DataFrame:
    """T3. ``state``: exact full-row dedup over the whole stream (state grows
    with the distinct rows, as in the reference); ``ttl``: exact for ``ttl``
    after a row has first come in, then its key leaves the state, so state is
    bounded by what comes in during twice that time, and no row is ever late,
    as the clock is that of the batch; ``watermark``: duplicates are dropped
    within ``watermark`` of the scheduled departure."""
    if mode == "state":
        return df.dropDuplicates()
    if mode == "ttl":
        came = df.withColumn("_came", F.current_timestamp()).withWatermark("_came", ttl)
        return came.dropDuplicatesWithinWatermark(df.columns).drop("_came")
    if mode == "watermark":
        return df.withWatermark("scheduled_time_departure", watermark).dropDuplicatesWithinWatermark()
    raise ValueError("mode must be 'state', 'ttl' or 'watermark'")


def live_flights(messages: DataFrame, dedup: str = "state", watermark: str = "2 days", ttl: str = "30 days") -> DataFrame:
    """D12 on a stream with the chosen dedup mode."""
    df = flights.clean_flights_stream(messages, dedup=False)
    return dedup_flights(df, dedup, watermark, ttl).withColumn("flight", C.strip_quotes("flight"))


# T1
def flights_stream_job(spark: SparkSession, output: str, checkpoint: str, source: str = "text",
                       path: str | None = None, options: dict | None = None, dedup: str = "ttl",
                       trigger: dict | None = None, ttl: str = "30 days", state_store: str | None = ROCKSDB):
    """State lies in ``state_store``: by default on the executors' disks, with
    changes in the checkpoint, so it may outgrow their memory. The store of
    an existing checkpoint cannot be changed."""
    if state_store:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", state_store)
    msgs = read_stream(spark, source, path, options)
    return stream_to_csv(live_flights(msgs, dedup, ttl=ttl), output, checkpoint, "date", trigger, "live_flights")


# T2
def weather_stream_job(spark: SparkSession, output: str, checkpoint: str, source: str = "text",
                       path: str | None = None, options: dict | None = None, location: str = "doh",
                       signed: bool = False, trigger: dict | None = None):
    msgs = read_stream(spark, source, path, options)
    df = weather.clean_weather_stream(msgs, location=location, signed=signed)
    return stream_to_csv(df, output, checkpoint, "date", trigger, "live_weather")
