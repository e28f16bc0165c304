"""Stream = batch, checkpoint resume and date partitions."""

import glob
import os

from pyspark.sql import functions as F

from tarmac.operators import flights, weather
from tarmac.sinks import writers
from tarmac.sources import fixtures, readers
from tarmac.streaming import jobs
from tests.conftest import SF_SMALL


def _write_lines(df, path):
    df.select("value").write.mode("overwrite").text(path)


def test_flights_stream_equals_batch_and_resumes(spark, scratch):
    msgs = fixtures.flights_msg(spark, SF_SMALL)
    src, out, ck = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    _write_lines(msgs.filter(F.hash("value") % 2 == 0), f"{src}/part1")
    q = jobs.flights_stream_job(spark, out, ck, path=f"{src}/*")
    q.awaitTermination()
    # second batch of files; restart from the checkpoint
    _write_lines(msgs.filter(F.hash("value") % 2 != 0), f"{src}/part2")
    q = jobs.flights_stream_job(spark, out, ck, path=f"{src}/*")
    q.awaitTermination()
    got = spark.read.option("header", True).csv(out)
    batch = flights.clean_flights_stream(msgs)
    assert got.count() == batch.count()
    assert sorted(glob.glob(f"{out}/date=*"))  # partitioned by date
    # nothing re-emitted: a third run adds no rows
    q = jobs.flights_stream_job(spark, out, ck, path=f"{src}/*")
    q.awaitTermination()
    assert spark.read.option("header", True).csv(out).count() == batch.count()


def test_weather_stream_equals_batch(spark, scratch):
    msgs = fixtures.raw(spark, SF_SMALL, "weather_msg")
    _write_lines(msgs, f"{scratch}/in")
    q = jobs.weather_stream_job(spark, f"{scratch}/out", f"{scratch}/ck", path=f"{scratch}/in")
    q.awaitTermination()
    got = spark.read.option("header", True).csv(f"{scratch}/out")
    assert got.count() == weather.clean_weather_stream(msgs).count()
    # Date-pruned scan of the stream output
    one = readers.scan_date_range(spark, f"{scratch}/out", "2024-01-03", "2024-01-04")
    assert one.select("date").distinct().count() == 2


def test_watermark_dedup_mode(spark, scratch):
    msgs = fixtures.flights_msg(spark, SF_SMALL)
    _write_lines(msgs, f"{scratch}/in")
    q = jobs.flights_stream_job(spark, f"{scratch}/out", f"{scratch}/ck", path=f"{scratch}/in", dedup="watermark")
    q.awaitTermination()
    assert spark.read.option("header", True).csv(f"{scratch}/out").count() == flights.clean_flights_stream(msgs).count()


def test_messages_round_trip_and_compaction(spark, scratch):
    raw = fixtures.raw(spark, SF_SMALL, "flights_raw")
    cells = [c for c in raw.columns if c != "aircraft"]
    msgs = writers.to_messages(raw, cells, F.col("aircraft"))
    lines = writers.decode_message(msgs, "flights")
    back = lines.select(F.split("value", ",").alias("v")).select(F.get("v", 0).alias("aircraft"))
    assert back.exceptAll(raw.select("aircraft")).count() == 0
    arr = writers.to_messages(raw, cells, kind="array")
    assert writers.decode_message(arr, "weather").count() == raw.count()
    # K8: small files per date -> one file per date
    w = weather.clean_weather_stream(fixtures.raw(spark, SF_SMALL, "weather_msg"))
    w.repartition(6).write.partitionBy("date").option("header", True).csv(f"{scratch}/small")
    writers.compact_partitions(spark, f"{scratch}/small", f"{scratch}/compact")
    for d in glob.glob(f"{scratch}/compact/date=*"):
        assert len([f for f in os.listdir(d) if f.endswith(".csv")]) == 1
    assert spark.read.option("header", True).csv(f"{scratch}/compact").count() == w.count()


def test_details_and_forecast_messages(spark):
    from tarmac.operators import pages
    item = lambda label, *values: f'<li><span class="label">{label}</span>' + "".join(f'<span class="value">{v}</span>' for v in values) + "</li>"
    block = lambda hour, *items: f'<details><span class="hour">{hour}</span><ul>{"".join(items)}</ul></details>'
    html = (block("10 pm", item("Wind", "N 7 mph"), item("Humidity", "55%"), item("UV Index", "2", "3 of 11"), item("Cloud Cover", "20%"))
            + block("11 pm", item("Wind", "<span>WSW</span> <span>12</span> mph"), item("Humidity", "54%"), item("Humidity", "53%"), item("UV Index", "2"))
            + block("12 am", item("", "x"), item("Empty", "")))
    rows = pages.extract_details(spark.createDataFrame([(1, html)], "page_id long, html string")).orderBy("block").collect()
    import json
    assert [(r.hour, r.details) for r in rows] == [
        ("10 pm", {"wind_direction": "N", "wind_speed": "7 mph", "humidity": "55%", "uv_index": "3 of 11", "cloud_cover": "20%"}),
        ("11 pm", {"wind_direction": "WSW", "wind_speed": "12 mph", "humidity": "53%"}), ("12 am", {})]
    labels = spark.createDataFrame([(1, i, h) for i, h in enumerate(["10 pm", "11 pm", "12 am", "1 am"])],
                                   "g int, i int, hour string")
    rolled = pages.day_rollover(labels, "g", "i").withColumn("details", F.create_map(F.lit("humidity"), F.lit("5%")))
    msgs = [json.loads(r.value) for r in pages.forecast_messages(rolled, "2024-05-06", 2024).orderBy("value").collect()]
    assert [m["date"] for m in msgs] == ["2024-05-07 22:00:00", "2024-05-07 23:00:00",
                                         "2024-05-08 00:00:00", "2024-05-08 01:00:00"]
    assert msgs[0]["details"] == {"humidity": "5%"}
    leap = spark.createDataFrame([(0, "1 am")], "day_offset int, hour string").withColumn("details", F.create_map())
    assert "date" not in json.loads(pages.forecast_messages(leap, "2024-02-29", 2023).first().value)


def test_comment_block_ends_at_its_own_close_tag(spark):
    from tarmac.operators import pages
    html = ('<div class="x">no</div><div class="content">a, <div>b <div class="content">c</div></div> d</div> out '
            '<div class="content"></div><div class="content">never closed')
    got = pages.extract_comments(spark.createDataFrame([("http://h/DOH", html), ("u", None)], "url string, html string")).collect()
    assert [(r.comment, r.airport) for r in got] == [("a  b c d", "DOH"), ("", "DOH")]


def test_dedup_state_is_bounded_and_exact_for_its_time(spark, scratch):
    """Many restarted batches: a row of the batch before never passes again, and state keeps only what came lately."""
    import time

    src, out, ck = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", jobs.ROCKSDB)
    sizes, sent = [], 0
    for batch in range(12):
        new = spark.range(40 * batch, 40 * batch + 40).selectExpr("concat('row ', id) AS value")
        again = spark.range(max(0, 40 * batch - 10), 40 * batch + 10).selectExpr("concat('row ', id) AS value")  # of the last batch, and twice in this one
        new.union(again).coalesce(1).write.text(f"{src}/{batch}")
        sent += 40
        df = jobs.dedup_flights(spark.readStream.text(f"{src}/*"), "ttl", ttl="6 seconds")
        q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination()
        sizes.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
        time.sleep(1.2)
    got = [r.value for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) == sent
    assert sizes[0] == 40 and max(sizes) < sent  # evicted after twice the time at most


def test_dedup_mode_must_be_known(spark):
    import pytest

    with pytest.raises(ValueError):
        jobs.dedup_flights(spark.range(1), "none")
