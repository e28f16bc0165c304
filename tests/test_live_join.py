"""The live join: dealt out to tasks whatever the bytes of its sides, features and codes made before it."""

from datetime import datetime

from pyspark.sql import functions as F

from tarmac.ml.codes import apply_label_codes
from tarmac.ml.predict import encode_for_scoring
from tarmac.operators import joins
from tarmac.schemas import ENCODED_COLUMNS


def sides(spark):
    t = lambda h, m=0: datetime(2024, 1, 5, h, m)
    flights = [("QR1", "a01", "a05", t(9), t(9, 5), t(10, 40), t(11)), ("(QR2)", "a02", "a05", t(9), None, t(10, 50), t(11)), ("QR3", "a01", "a06", t(8), t(8), t(11), t(11)),
               ("QR4", None, "a05", t(8), t(8), None, None), ("QR5", "a01", None, t(8), t(8), t(11), t(11)), ("QR1", "a01", "a05", t(9), t(9, 5), t(10, 40), t(11))]
    f = spark.createDataFrame(flights, "flight string, `from` string, `to` string, scheduled_time_departure timestamp, actual_time_departure timestamp, "
                                       "scheduled_time_arrival timestamp, rounded_hour timestamp")
    f = f.withColumns({"from_city": F.lit("x"), "to_city": F.concat(F.lit("city"), "to"), "date": F.to_date("scheduled_time_departure"), "flight_time": F.lit("1:40")})
    w = spark.createDataFrame([(t(11), i, "a05") for i in range(5)] + [(t(11), 9, "a06"), (None, 1, "a05"), (t(11), 2, None), (t(12), 3, "a05")],
                              "timestamp timestamp, temperature int, location string").withColumn("date", F.to_date("timestamp"))
    a = spark.createDataFrame([("a05", 61), ("a05", 62), ("a06", 7)], "airport string, my_flightradar24_rating int")
    return f, w, a


def plain(f, w, a):
    out = f.join(a, f["to"] == a["airport"]).join(w.drop("date"), (F.col("rounded_hour") == F.col("timestamp")) & (F.col("to") == F.col("location")))
    return sorted(map(str, out.collect()))


def test_rows_are_those_of_a_plain_join(spark):
    f, w, a = sides(spark)
    assert sorted(map(str, joins.join_live(f, w, a).collect())) == plain(f, w, a) and len(plain(f, w, a)) == 31
    one = w.filter("location = 'a05'").withColumn("location", F.lit("a05"))  # a constant, as of live messages
    assert sorted(map(str, joins.join_live(f, one, a).collect())) == plain(f, one, a)


def test_small_sides_keep_many_tasks(spark):
    """AQE would merge them into one: a join whose rows outnumber its sides' ran in a single task."""
    f, w, a = sides(spark)
    for weather in (w, w.withColumn("location", F.lit("a05"))):
        out = joins.join_live(f, weather, a)
        assert out.rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism


def test_features_and_codes_are_made_before_the_join(spark):
    f, w, a = sides(spark)
    codes = spark.createDataFrame([("flight", "QR2", 4), ("to", "a05", 2), ("from", "a01", 1)], "column string, value string, code int")
    late = joins.flight_features(joins.join_live(f, w, a), "score")
    early = joins.score_live(f, w, a)
    assert early.columns == late.columns and sorted(map(str, early.collect())) == sorted(map(str, late.collect()))
    plan = early._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("weekday") > plan.index("Join Inner")
    coded = joins.score_live(apply_label_codes(f, codes, ENCODED_COLUMNS), w, a).select("flight_encoded", "to_encoded", "from_encoded", "temperature")
    want = encode_for_scoring(late, codes).select("flight", "to", "from", "temperature")
    assert sorted(map(tuple, coded.collect())) == sorted(map(tuple, want.collect()))


def test_raw_flights_are_dealt_out(spark):
    from tarmac.sources import fixtures

    plan = fixtures.flights_msg(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
