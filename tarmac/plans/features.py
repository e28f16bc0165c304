"""Model-ready tables: training features (joined history) and scoring
features (live streams), with their row keys and label codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.ml.codes import apply_label_codes, fit_label_codes
from tarmac.ml.split import stratified_split
from tarmac.operators import flights, joins, nulls, weather
from tarmac.plans import tables as T
from tarmac.plans.oracle import LIVE_LOCATION
from tarmac.schemas import ENCODED_COLUMNS
from tarmac.sources import fixtures

_TS = "yyyy-MM-dd HH:mm:ss"


def row_key() -> Column:
    """Identity of a cleaned flight row (text, engine-independent)."""
    return F.concat_ws("|", F.col("flight"), F.col("aircraft"), F.col("from"), F.col("to"),
                       *[F.date_format(c, _TS) for c in ["scheduled_time_departure", "actual_time_departure",
                                                         "scheduled_time_arrival", "actual_time_arrival"]])


ROW_KEY_SQL = ("concat_ws('|', flight, aircraft, \"from\", \"to\", strftime(scheduled_time_departure, '%Y-%m-%d %H:%M:%S'), "
               "strftime(actual_time_departure, '%Y-%m-%d %H:%M:%S'), strftime(scheduled_time_arrival, '%Y-%m-%d %H:%M:%S'), "
               "strftime(actual_time_arrival, '%Y-%m-%d %H:%M:%S'))")


def training_features(spark, sf_dir) -> DataFrame:
    """Joined history without null rows (P8) + D15 train features + row key."""
    j = nulls.require(T.joined(spark, sf_dir))
    return joins.flight_features(j, "train").withColumn("row_key", row_key())


def encoded_training(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Training table with the categorical columns replaced by codes, and
    the code table. The features are written once: codes and rows read them."""
    f = T.materialize(training_features(spark, sf_dir))
    codes = T.materialize(fit_label_codes(f, ENCODED_COLUMNS))
    enc = apply_label_codes(f, codes, ENCODED_COLUMNS, strip_flight=False)
    enc = enc.drop(*ENCODED_COLUMNS).withColumnsRenamed({f"{c}_encoded": c for c in ENCODED_COLUMNS})
    return enc, codes


_MODEL_TABLES: dict = {}
#: Tables that the joined table and its code tables are made of.
_INPUTS = ("events", "lineitem", "nation", "part", "customer", "supplier", "orders")


def input_state(spark, sf_dir) -> tuple:
    """Files, sizes and change times of the input tables, so that a table kept
    for a path is not used once the path holds other data."""
    import os

    state = []
    for t in _INPUTS:
        path = f"{sf_dir}/{t}.parquet"
        fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(fs_path):
            state += [(os.path.basename(str(f.getPath())), f.getLen(), f.getModificationTime()) for f in fs.listStatus(fs_path)]
    return tuple(state)


def model_table(spark, sf_dir, seed: int = 42, test_fraction: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Encoded training table with the stratified ``is_test`` flag (M4),
    materialised once per session and input, and the code table."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, input_state(spark, sf_dir), seed, test_fraction)
    if key not in _MODEL_TABLES:
        enc, codes = encoded_training(spark, sf_dir)
        split = stratified_split(T.materialize(enc), "status", F.col("row_key"), test_fraction, seed)
        _MODEL_TABLES[key] = (T.materialize(split), codes)
    return _MODEL_TABLES[key]


def live_inputs(spark, sf_dir, location: str = LIVE_LOCATION) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Live flights (D12), live forecasts (D13) and airport facts."""
    fl = flights.clean_flights_stream(fixtures.flights_msg(spark, sf_dir))
    w = weather.clean_weather_stream(T.raw(spark, sf_dir, "weather_msg"), location=location)
    return fl, w, T.airports_clean(spark, sf_dir)


def live_joined(spark, sf_dir, location: str = LIVE_LOCATION, forecasts: str = "all") -> DataFrame:
    """Live flights (D12) x airport facts (J4) x live forecast."""
    return joins.join_live(*live_inputs(spark, sf_dir, location), forecasts)


def scoring_features(spark, sf_dir, location: str = LIVE_LOCATION) -> DataFrame:
    return joins.score_live(*live_inputs(spark, sf_dir, location))


def encoded_scoring(spark, sf_dir, codes: DataFrame, location: str = LIVE_LOCATION) -> DataFrame:
    """Scoring features with the codes of the categorical inputs (M2). These are columns of the flights, which get
    their codes before they meet the messages."""
    fl, w, airports = live_inputs(spark, sf_dir, location)
    return joins.score_live(apply_label_codes(fl, codes, ENCODED_COLUMNS), w, airports)


_OVERSAMPLED: dict = {}


def oversampled_train(spark, sf_dir, seed: int = 42) -> DataFrame:
    """Training side of the split grown with SMOTE (M6) on the 19 model
    features, as the classifiers are trained; materialised once per session
    and input. Every neighbour is exact, whatever the number of points."""
    from tarmac.ml.smote import smote
    from tarmac.schemas import FEATURE_COLUMNS

    key = (id(spark), spark.sparkContext.applicationId, sf_dir, input_state(spark, sf_dir), seed)
    if key not in _OVERSAMPLED:
        split, _ = model_table(spark, sf_dir, seed)
        train = split.filter(~F.col("is_test"))
        _OVERSAMPLED[key] = T.materialize(smote(train, "status", FEATURE_COLUMNS, "row_key", seed=seed))
    return _OVERSAMPLED[key]
