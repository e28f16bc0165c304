"""Compaction beside a running stream, the tasks that parse its messages, and the density from bins."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.operators import profile
from tarmac.sinks import compaction, writers
from tarmac.sources import fixtures

SCHEMA = StructType([StructField(c, StringType()) for c in ("id", "text", "date")])


def batch(spark, src, out, ck, k, n=60):
    """One more batch of the stream, of three dates, restarted from its checkpoint."""
    spark.range(k * n, k * n + n).selectExpr("id", "concat('t, ', id) AS text", "concat('2024-01-0', id % 3 + 1) AS date").repartition(4).write.json(f"{src}/{k}")
    df = spark.readStream.schema("id long, text string, date string").json(f"{src}/*")
    writers.stream_to_csv(df, out, ck).awaitTermination()


def ids(df):
    return sorted(int(r.id) for r in df.collect())


def test_each_row_once_before_during_and_after(spark, scratch, monkeypatch):
    src, out, ck, to = (f"{scratch}/{x}" for x in ("in", "out", "ck", "compact"))
    read = lambda: ids(compaction.read_compacted(spark, out, to, SCHEMA))
    assert read() == []
    for k in range(12):  # past the sink's own compaction of its log
        batch(spark, src, out, ck, k)
        if k in (1, 2, 10):
            before = compaction.read_compacted(spark, out, to, SCHEMA)
            assert compaction.compact_stream(spark, out, to, SCHEMA) > 0
            assert ids(before) == list(range(60 * k + 60))  # a reader that began before the run
        assert read() == list(range(60 * k + 60))
    assert compaction.compact_stream(spark, out, to, SCHEMA) > 0 and compaction.compact_stream(spark, out, to, SCHEMA) == 0
    state = compaction.manifest(spark, to)
    for name, folder in state["partitions"].items():
        assert len([f for f in os.listdir(f"{to}/data/{folder}/{name}") if f.endswith(".csv")]) == 1
    row = compaction.read_compacted(spark, out, to, SCHEMA).filter("id = '7'").first()
    assert (row.text, row.date) == ("t, 7", "2024-01-02")
    # a run that fails before it publishes changes nothing, and the next takes the same files
    batch(spark, src, out, ck, 12)
    with monkeypatch.context() as m:
        m.setattr(compaction, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            compaction.compact_stream(spark, out, to, SCHEMA)
    assert read() == list(range(13 * 60)) and compaction.compact_stream(spark, out, to, SCHEMA) > 0 and read() == list(range(13 * 60))


def test_only_changed_partitions_are_rewritten_and_runs_do_not_overtake(spark, scratch):
    src, out, ck, to = (f"{scratch}/{x}" for x in ("in", "out", "ck", "compact"))
    batch(spark, src, out, ck, 0)
    compaction.compact_stream(spark, out, to, SCHEMA)
    first = compaction.manifest(spark, to)
    spark.createDataFrame([(999, "x", "2024-01-02")], "id long, text string, date string").write.json(f"{src}/one")
    writers.stream_to_csv(spark.readStream.schema("id long, text string, date string").json(f"{src}/*"), out, ck).awaitTermination()
    compaction.compact_stream(spark, out, to, SCHEMA)
    second = compaction.manifest(spark, to)
    assert [p for p in second["partitions"] if second["partitions"][p] != first["partitions"][p]] == ["date=2024-01-02"]
    with pytest.raises(RuntimeError):
        compaction._publish(spark, to, second)


def test_binned_density_is_within_its_bound(spark):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 5, 4000), rng.exponential(30, 4000)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    exact = {r.point: r.density for r in profile.kde_grid(df, "x").collect()}
    bw = x.std(ddof=1) * len(x) ** -0.2
    for bins in (64, 512):
        got = {r.point: r.density for r in profile.kde_grid(df, "x", bins=bins).collect()}
        bound = (np.ptp(x) / bins) ** 2 / (8 * math.sqrt(2 * math.pi) * bw**3) + 2e-14 / bw
        assert max(abs(got.get(i, 0.0) - d) for i, d in exact.items()) <= bound


def test_messages_of_one_row_group_are_parsed_by_several_tasks(spark, scratch):
    n = 200_000  # one file, one row group; rows that come twice, null times and ids
    spark.range(0, n, 1, 1).selectExpr(
        "if(id % 1000 = 7, null, id div 2) AS event_id", "if(id % 500 = 3, null, timestamp_seconds(1704067200 + id div 2 * 26)) AS ts",
        "xxhash64(id div 2) AS user_id", "'view' AS event_type", "1.5D AS value", "'' AS props").write.parquet(f"{scratch}/events.parquet")
    msgs = fixtures.raw(spark, scratch, "weather_msg")
    per = msgs.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.substring("value", 11, 10)).alias("dates")).collect()
    dates = msgs.select(F.substring("value", 11, 10)).distinct().count()
    assert sum(r["rows"] for r in per) == n and max(r["rows"] for r in per) <= 0.6 * n
    assert sum(r.dates for r in per) <= dates + len(per)  # a write by date leaves few files
    plain = spark.sql(fixtures.SPARK_ADAPTERS["weather_msg"][1], events=fixtures.table(spark, scratch, "events"))
    counts = lambda df: df.groupBy("value").count()
    assert counts(msgs).exceptAll(counts(plain)).isEmpty() and counts(plain).exceptAll(counts(msgs)).isEmpty()
