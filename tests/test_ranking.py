"""Distributed positions and exact quantiles against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.ml.split import stratified_split
from tarmac.operators.ranking import exact_quantiles, running_position


def test_running_position_matches_row_number(spark):
    rows = [(i % 3, f"k{(i * 7919) % 1000:04d}") for i in range(1000)]
    df = spark.createDataFrame(rows, "g int, k string").repartition(7)
    got = {(r.g, r.k): r.p for r in running_position(df, ["k"], ["g"], out="p").collect()}
    for g in range(3):
        keys = sorted(k for gg, k in rows if gg == g)
        assert [got[(g, k)] for k in keys] == list(range(len(keys)))


def test_weighted_positions(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", 2)], "v string, w int")
    got = {r.v: r.s for r in running_position(df, ["v"], weight="w", out="s").collect()}
    assert got == {"a": 0, "b": 3, "c": 4}


def test_exact_quantiles_hot_value(spark):
    vals = [0.0] * 500 + [float(i) for i in range(1, 301)]  # one value holds most rows
    df = spark.createDataFrame([(v, v * 2) for v in vals], "x double, y double").repartition(5)
    q = {r.column: r for r in exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.9]).collect()}
    for c, mult in (("x", 1), ("y", 2)):
        ref = np.percentile(np.array(vals) * mult, [25, 50, 90])
        assert np.allclose([q[c].q25, q[c].q50, q[c].q90], ref)


CONFS = [{"spark.sql.adaptive.enabled": "false"},
         {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.execution.rangeExchange.sampleSizePerPartition": "3"}]


@pytest.mark.parametrize("conf", CONFS)
def test_many_rows_with_wide_payload(spark, conf):
    """2,000,000 rows: no row lost, every position once, exact split sizes and quartiles, AQE on and off."""
    n = 2_000_000
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(n).select((F.col("id") % 2).alias("g"), F.md5(F.col("id").cast("string")).alias("k"),
                                   F.repeat(F.md5(F.col("id").cast("string")), 12).alias("payload"))
        pos = running_position(df, ["k"], ["g"], out="p", rows_per_bucket=100_000).agg(
            F.count("*").alias("n"), F.countDistinct("g", "p").alias("d"), F.max("p").alias("m"), F.max("payload")).first()
        assert (pos.n, pos.d, pos.m) == (n, n, n // 2 - 1)
        split = stratified_split(df, "g", F.col("k"), 0.2, 7).groupBy("g", "is_test").agg(F.count("*").alias("n"), F.max("payload")).collect()
        assert {(r.g, r.is_test): r.n for r in split} == {(g, t): n // 10 if t else 4 * n // 10 for g in (0, 1) for t in (True, False)}
        v = spark.range(n).select(F.col("id").cast("double").alias("x"), (F.col("id") * 3).cast("double").alias("y"))
        q = {r.column: r for r in exact_quantiles(v, ["x", "y"], [0.25, 0.5, 0.75], rows_per_bucket=100_000).collect()}
        for c, k in (("x", 1), ("y", 3)):
            assert [q[c].q25, q[c].q50, q[c].q75] == [k * (n - 1) * p for p in (0.25, 0.5, 0.75)]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
