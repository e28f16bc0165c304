"""Sink details and the pluggable (Arrow-batched) comment classifier."""

import pandas as pd
from pyspark.sql import functions as F

from tarmac.operators import scoring
from tarmac.sinks import writers


def test_eventdate_overwrite_replaces_only_its_partition(spark, scratch):
    base = f"{scratch}/out"
    df = spark.range(5).withColumn("v", F.lit("a"))
    writers.write_eventdate(df, base, "20240506")
    writers.write_eventdate(df, base, "20240507")
    writers.write_eventdate(spark.range(2).withColumn("v", F.lit("b")), base, "20240507")
    back = spark.read.parquet(base)
    counts = {r.eventdate: r["count"] for r in back.groupBy("eventdate").count().collect()}
    assert counts == {20240506: 5, 20240507: 2}


def test_pluggable_classifier_and_failures(spark):
    df = spark.createDataFrame([("great clean airport",), ("slow and rude",), (None,)], "comment string")

    def replies(s: pd.Series) -> pd.Series:
        return s.fillna("").map(lambda t: "Positive." if "great" in t else "negative")

    got = sorted((r.comment or "", r.sentiment) for r in scoring.score_comments(df, replies).collect())
    assert got == [("", 0), ("great clean airport", 1), ("slow and rude", 0)]

    def broken(s: pd.Series) -> pd.Series:
        raise RuntimeError("service down")

    assert {r.sentiment for r in scoring.score_comments(df, broken).collect()} == {-1}
    rule = {r.comment: r.sentiment for r in scoring.score_comments(df).collect()}
    assert rule["great clean airport"] == 1 and rule["slow and rude"] == 0 and rule[None] == -1
