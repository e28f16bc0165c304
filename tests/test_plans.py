"""Physical-plan properties: broadcast of the small dimensions, partition
pruning of the date scan, column pruning, and no Python in SQL-checked plans."""

from tarmac.plans import tables as T
from tarmac.sources import readers
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_joins_broadcast(spark):
    s = _plan(T.joined(spark, SF_SMALL))
    assert s.count("BroadcastHashJoin") >= 2


def test_date_range_scan_prunes_partitions(spark, scratch):
    from pyspark.sql import functions as F
    df = spark.range(30).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
                                F.col("id"))
    df.write.partitionBy("date").parquet(f"{scratch}/p")
    scan = readers.scan_date_range(spark, f"{scratch}/p", "2024-01-10", "2024-01-12", fmt="parquet")
    plan = _plan(scan)
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert scan.count() == 3


def test_scans_read_only_used_columns(spark):
    plan = _plan(T.weather_clean(spark, SF_SMALL))
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan


def test_no_python_in_cleaning_plans(spark):
    for df in (T.joined(spark, SF_SMALL), T.reviews_clean(spark, SF_SMALL)):
        s = _plan(df)
        assert "BatchEvalPython" not in s and "ArrowEvalPython" not in s and "MapInPandas" not in s


def test_weather_survivor_needs_no_sort_aggregate(spark):
    s = _plan(T.weather_clean(spark, SF_SMALL))
    assert "SortAggregate" not in s and "WindowGroupLimit" in s


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    import pytest
    from tarmac.session import checkpoint_dir

    class Cluster:
        conf = property(lambda self: self)
        sparkContext = property(lambda self: self)
        master = "spark://host:7077"
        get = staticmethod(lambda key, default=None: default)
        getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Cluster())


def test_delay_rate_parses_no_weather_measure(spark):
    from tarmac.plans import catalog
    plan = _plan(catalog.queries()["a1_delay_rate_per_airport"](spark, SF_SMALL))
    assert "_text" in _plan(T.weather_clean(spark, SF_SMALL)) and "_text" not in plan  # texts of measures with units
    assert "WindowGroupLimit" not in plan  # no survivor is chosen for its measures


def test_keys_only_join_has_the_same_rows(spark):
    whole, keys = T.joined(spark, SF_SMALL), T.joined(spark, SF_SMALL, measures=False)
    assert set(keys.columns) < set(whole.columns)
    assert whole.select(*keys.columns).exceptAll(keys).isEmpty() and keys.count() == whole.count()


def test_profiles_read_their_input_once(spark):
    """Describe, box summary and density are made of one written table of value counts."""
    from tarmac.operators import profile
    df = spark.createDataFrame([(float(i % 7), None if i % 5 else float(i)) for i in range(200)], "a double, b double")
    for out in (profile.describe(df, ["a", "b"]), profile.box_summary(df, ["a", "b"]), profile.kde_grid(df, "a")):
        plan = out._jdf.queryExecution().analyzed().toString()
        assert "LocalRelation" not in plan and "LogicalRDD" in plan
    got = {r.column: r for r in profile.describe(df, ["a", "b"]).collect()}
    assert got["b"]["count"] == 40 and got["b"]["mean"] == 97.5 and abs(got["b"]["std"] - 58.4523) < 1e-3


def test_weather_survivor_shuffles_once(spark):
    assert _plan(T.weather_clean(spark, SF_SMALL)).count("Exchange hashpartitioning") == 1
