"""Registered queries: features (D15), live joins (J4, J5, D12, D13), label
codes, splits, evaluation (M1-M5, M9, M14-M16) and the model runs (M3,
M7-M13, M17, M19, M20, A12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarmac.ml import evaluate, models
from tarmac.ml import predict as P
from tarmac.ml.codes import fit_label_codes
from tarmac.ml.split import random_split, stratified_split
from tarmac.operators import profile
from tarmac.plans import features as FT
from tarmac.plans import tables as T
from tarmac.plans.oracle import with_tables
from tarmac.plans.q_cleaning import JOINED_COLUMNS
from tarmac.plans.registry import query
from tarmac.schemas import ENCODED_COLUMNS, FEATURE_COLUMNS

SEED = 42


def _r(df, digits=6):
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if f.dataType.typeName() in ("double", "float") else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _cal(ts: str) -> str:
    return (f'CAST(year({ts}) AS INTEGER) AS "year", CAST(month({ts}) AS INTEGER) AS "month", '
            f'CAST(day({ts}) AS INTEGER) AS "day", CAST(hour({ts}) AS INTEGER) AS "hour", '
            f'CAST(isodow({ts}) - 1 AS INTEGER) AS dayofweek, CAST(quarter({ts}) AS INTEGER) AS quarter')


TRAIN = """
train AS (
  SELECT flight, "from", "to", from_city, to_city, flight_time,
         date_diff('second', scheduled_time_departure, actual_time_departure) / 60 AS departure_delay,
         temperature, humidity, wind_speed, my_flightradar24_rating, arrival_delay_index, departure_delay_index,
         """ + _cal("scheduled_time_arrival") + """,
         CASE status WHEN 'On Time' THEN 0 WHEN 'Delayed' THEN 1 END AS status,
         CAST(date_diff('second', scheduled_time_departure, actual_time_departure) / 60 > 15 AS INTEGER) AS departure_delay_15,
         CAST(month(scheduled_time_arrival) = 1 AND day(scheduled_time_arrival) = 1 AS INTEGER) AS is_year_start,
         CAST(month(scheduled_time_arrival) = 12 AND day(scheduled_time_arrival) = 31 AS INTEGER) AS is_year_end,
         date_diff('second', scheduled_time_arrival, actual_time_arrival) / 60 AS arrival_delay,
         """ + FT.ROW_KEY_SQL + """ AS row_key
  FROM joined WHERE """ + " AND ".join(f'"{c}" IS NOT NULL' for c in JOINED_COLUMNS) + ")"

SCORE = """
score AS (
  SELECT flight, "from", "to", from_city, to_city,
         date_diff('second', scheduled_time_departure, scheduled_time_arrival) / 3600 AS flight_time,
         date_diff('second', coalesce(actual_time_departure, scheduled_time_departure), scheduled_time_departure) / 60 AS departure_delay,
         temperature, humidity, wind_speed, my_flightradar24_rating, arrival_delay_index, departure_delay_index,
         """ + _cal("scheduled_time_departure") + """,
         aircraft, rounded_hour
  FROM live_joined)"""

CODES = """
stacked AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(\"{c}\" AS VARCHAR) AS value FROM train" for c in ENCODED_COLUMNS) + """),
codes AS (
  SELECT "column", value, CAST(dense_rank() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT "column", value FROM stacked WHERE value IS NOT NULL))"""

TRAIN_COLS = FEATURE_COLUMNS + ["status", "departure_delay_15", "is_year_start", "is_year_end"]
SCORE_COLS = FEATURE_COLUMNS + ["aircraft", "rounded_hour"]


@query("d15_f22_f23_features_train", with_tables("joined", extra=[TRAIN]) + "SELECT * EXCLUDE (row_key, arrival_delay) FROM train")
def d15_features_train(spark, sf_dir):
    return FT.training_features(spark, sf_dir).select(*[F.col(f"`{c}`") for c in TRAIN_COLS])


@query("d15_features_score", with_tables("live_joined", extra=[SCORE]) + "SELECT * FROM score")
def d15_features_score(spark, sf_dir):
    return T.portable(FT.scoring_features(spark, sf_dir).select(*[F.col(f"`{c}`") for c in SCORE_COLS]))


@query("d12_clean_flights_stream", with_tables("flights_live") + "SELECT * FROM flights_live")
def d12_clean_flights_stream(spark, sf_dir):
    from tarmac.operators import flights
    from tarmac.sources import fixtures
    return T.portable(flights.clean_flights_stream(fixtures.flights_msg(spark, sf_dir)))


@query("d13_p7_p15_clean_weather_stream", with_tables("weather_live") + "SELECT * FROM weather_live")
def d13_clean_weather_stream(spark, sf_dir):
    from tarmac.operators import weather
    from tarmac.plans.oracle import LIVE_LOCATION
    return T.portable(weather.clean_weather_stream(T.raw(spark, sf_dir, "weather_msg"), location=LIVE_LOCATION))


@query("j4_j5_live_join", with_tables("live_joined") + """
SELECT flight, "to", airport, rounded_hour, "timestamp", location, my_flightradar24_rating, temperature, precip FROM live_joined""")
def j4_j5_live_join(spark, sf_dir):
    j = FT.live_joined(spark, sf_dir)
    return T.portable(j.select("flight", "to", "airport", "rounded_hour", "timestamp", "location",
                               "my_flightradar24_rating", "temperature", "precip"))


_LATEST = """latest AS (SELECT * FROM weather_live QUALIFY row_number() OVER (PARTITION BY "timestamp", location ORDER BY temperature DESC NULLS LAST,
  wind_direction DESC NULLS LAST, wind_speed DESC NULLS LAST, humidity DESC NULLS LAST, cloud_cover DESC NULLS LAST, precip DESC NULLS LAST) = 1)"""


@query("j5_latest_live_join", with_tables("flights_live", "airports_clean", "weather_live", extra=[_LATEST]) + """
SELECT f.flight, f."to", a.airport, f.rounded_hour, w."timestamp", w.location, a.my_flightradar24_rating, w.temperature, w.precip
FROM flights_live f JOIN airports_clean a ON f."to" = a.airport JOIN latest w ON f.rounded_hour = w."timestamp" AND f."to" = w.location""")
def j5_latest_live_join(spark, sf_dir):
    j = FT.live_joined(spark, sf_dir, forecasts="latest")
    return T.portable(j.select("flight", "to", "airport", "rounded_hour", "timestamp", "location",
                               "my_flightradar24_rating", "temperature", "precip"))


@query("m1_label_codes", with_tables("joined", extra=[TRAIN, CODES]) + "SELECT * FROM codes")
def m1_label_codes(spark, sf_dir):
    return fit_label_codes(FT.training_features(spark, sf_dir), ENCODED_COLUMNS)


@query("m2_apply_label_codes", with_tables("joined", "live_joined", extra=[TRAIN, CODES, SCORE]) + """
SELECT s.flight, s.rounded_hour, """ + ", ".join(
    f"coalesce(c{i}.code, -1) AS {c}_encoded" for i, c in enumerate(ENCODED_COLUMNS)) + """
FROM score s """ + " ".join(
    f"LEFT JOIN codes c{i} ON c{i}.\"column\" = '{c}' AND c{i}.value = "
    + ("trim(s.flight, '()')" if c == "flight" else f's."{c}"') for i, c in enumerate(ENCODED_COLUMNS)))
def m2_apply_label_codes(spark, sf_dir):
    codes = T.materialize(fit_label_codes(FT.training_features(spark, sf_dir), ENCODED_COLUMNS))
    s = FT.encoded_scoring(spark, sf_dir, codes)
    return T.portable(s.select("flight", "rounded_hour", *[f"{c}_encoded" for c in ENCODED_COLUMNS]))


@query("m4_stratified_split", with_tables("joined", extra=[TRAIN]) + """
SELECT row_key, status, pos < ceil(n * CAST(0.2 AS DOUBLE)) AS is_test FROM (
  SELECT row_key, status, row_number() OVER (PARTITION BY status ORDER BY md5(concat('42:', row_key)), row_key) - 1 AS pos,
         count(*) OVER (PARTITION BY status) AS n FROM train)""")
def m4_stratified_split(spark, sf_dir):
    f = T.materialize(FT.training_features(spark, sf_dir).select("row_key", "status"))  # read for the counts and both sides
    return stratified_split(f, "status", F.col("row_key"), 0.2, SEED)


@query("m5_random_split", with_tables("joined", extra=[TRAIN]) + """
SELECT row_key, substr(md5(concat('42:', row_key)), 1, 8) < '33333333' AS is_test FROM train""")
def m5_random_split(spark, sf_dir):
    f = FT.training_features(spark, sf_dir).select("row_key")
    return random_split(f, F.col("row_key"), 0.2, SEED)


RULE_CC = "cc AS (SELECT status AS label, departure_delay_15 AS prediction, count(*) AS cnt FROM train GROUP BY ALL)"


@query("m14_report_departure_rule", with_tables("joined", extra=[TRAIN, RULE_CC, """
cls AS (SELECT label AS c FROM cc UNION SELECT prediction FROM cc)""", """
per AS (SELECT c,
  (SELECT coalesce(sum(cnt), 0) FROM cc WHERE label = c AND prediction = c) AS tp,
  (SELECT coalesce(sum(cnt), 0) FROM cc WHERE prediction = c) AS pred_n,
  (SELECT coalesce(sum(cnt), 0) FROM cc WHERE label = c) AS support FROM cls)""", """
m AS (SELECT c, tp, support,
  CASE WHEN pred_n = 0 THEN 0 ELSE tp / pred_n END AS p, CASE WHEN support = 0 THEN 0 ELSE tp / support END AS r FROM per)""", """
f AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f1 FROM m)"""]) + """
SELECT CAST(c AS VARCHAR) AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
                 CAST(sum(support) AS BIGINT) FROM f""")
def m14_report_departure_rule(spark, sf_dir):
    """Report of the 15-minute departure-delay flag as a predictor of the
    arrival status (a rule the reference computes as a feature)."""
    f = FT.training_features(spark, sf_dir)
    return _r(evaluate.classification_report(f, "status", "departure_delay_15"))


@query("m15_confusion_departure_rule", with_tables("joined", extra=[TRAIN, RULE_CC]) + """
SELECT label, prediction, cnt AS count, round(cnt / sum(cnt) OVER (PARTITION BY label), 6) AS rate FROM cc""")
def m15_confusion_departure_rule(spark, sf_dir):
    f = FT.training_features(spark, sf_dir)
    return _r(evaluate.confusion_matrix(f, "status", "departure_delay_15"))


@query("m16_metrics_departure_delay", with_tables("joined", extra=[TRAIN]) + """
SELECT round(avg((departure_delay - arrival_delay) ^ 2), 6) AS mse, round(sqrt(avg((departure_delay - arrival_delay) ^ 2)), 6) AS rmse,
       round(avg(abs(departure_delay - arrival_delay)), 6) AS mae,
       round(1 - sum((departure_delay - arrival_delay) ^ 2) / (var_pop(arrival_delay) * count(*)), 6) AS r2
FROM train WHERE status = 1""")
def m16_metrics_departure_delay(spark, sf_dir):
    """Departure delay as a predictor of the arrival delay of delayed flights."""
    f = FT.training_features(spark, sf_dir).filter(F.col("status") == 1)
    f = f.withColumn("arrival_delay", (F.unix_timestamp("actual_time_arrival") - F.unix_timestamp("scheduled_time_arrival")) / 60)
    return _r(evaluate.regression_metrics(f, "arrival_delay", "departure_delay"))


@query("m9_linear_regression_one_feature", with_tables("joined", extra=[TRAIN]) + """
SELECT round(regr_slope(arrival_delay, departure_delay), 4) AS slope,
       round(regr_intercept(arrival_delay, departure_delay), 4) AS intercept FROM train WHERE status = 1""")
def m9_linear_regression_one_feature(spark, sf_dir):
    f = FT.training_features(spark, sf_dir).filter(F.col("status") == 1)
    f = f.withColumn("arrival_delay", (F.unix_timestamp("actual_time_arrival") - F.unix_timestamp("scheduled_time_arrival")) / 60)
    m = models.fit(f, "linear", "arrival_delay", "regression", features=["departure_delay"])
    lr = m.stages[-1]
    return spark.range(1).select(F.round(F.lit(float(lr.coefficients[0])), 4).alias("slope"),
                                 F.round(F.lit(float(lr.intercept)), 4).alias("intercept"))


# ------------------------------------------------------------- model runs
def _train_test(spark, sf_dir):
    """Classifier data: the stratified split, its training side grown with
    SMOTE over the 19 model features, as the reference trains."""
    split, codes = FT.model_table(spark, sf_dir, SEED)
    return FT.oversampled_train(spark, sf_dir, SEED), split.filter(F.col("is_test")), codes


_FITTED: dict = {}


def fitted_classifier(spark, sf_dir, kind: str):
    """The classifier ``kind`` on the oversampled training side, fitted once per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir, FT.input_state(spark, sf_dir), kind)
    if key not in _FITTED:
        _FITTED[key] = models.fit(_train_test(spark, sf_dir)[0], kind, "status", "classification", seed=SEED)
    return _FITTED[key]


def _classifier_run(kind: str):
    def run(spark, sf_dir):
        _, test, _ = _train_test(spark, sf_dir)
        return models.predict(fitted_classifier(spark, sf_dir, kind), test, keep=["row_key", "status", "prediction"])
    return run


def _regression_data(spark, sf_dir):
    enc, _ = FT.model_table(spark, sf_dir, SEED)
    d = enc.drop("is_test").filter(F.col("status") == 1).withColumn(
        "arrival_delay", (F.unix_timestamp("actual_time_arrival") - F.unix_timestamp("scheduled_time_arrival")) / 60)
    split = random_split(d, F.col("row_key"), 0.2, SEED)
    return split.filter(~F.col("is_test")), split.filter(F.col("is_test"))


def _regressor_run(kind: str, **params):
    def run(spark, sf_dir):
        train, test = _regression_data(spark, sf_dir)
        m = models.fit(train, kind, "arrival_delay", "regression", seed=SEED, **params)
        return models.predict(m, test, keep=["row_key", "arrival_delay", "prediction"])
    return run


query("m7_gbt_classifier")(_classifier_run("gbt"))
query("m7_second_gbt_classifier")(_classifier_run("gbt_second"))
query("m8_random_forest_classifier")(_classifier_run("random_forest"))
query("m9_linear_regression")(_regressor_run("linear"))
query("m10_decision_tree_regressor")(_regressor_run("decision_tree"))
query("m11_gbt_regressor")(_regressor_run("gbt"))
query("m12_random_forest_regressor")(_regressor_run("random_forest"))


@query("m3_feature_vectors")
def m3_feature_vectors(spark, sf_dir):
    enc, _ = FT.encoded_training(spark, sf_dir)
    return models.feature_arrays(enc).select("row_key", "features", "status")


@query("m13_m14_holdout_report")
def m13_m14_holdout_report(spark, sf_dir):
    return _r(evaluate.classification_report(_classifier_run("random_forest")(spark, sf_dir),
                                             "status", "prediction"))


@query("m15_holdout_confusion")
def m15_holdout_confusion(spark, sf_dir):
    return _r(evaluate.confusion_matrix(_classifier_run("gbt")(spark, sf_dir), "status", "prediction"))


@query("m16_holdout_regression_metrics")
def m16_holdout_regression_metrics(spark, sf_dir):
    return _r(evaluate.regression_metrics(_regressor_run("random_forest")(spark, sf_dir),
                                          "arrival_delay", "prediction"))


@query("a12_predicted_class_counts")
def a12_predicted_class_counts(spark, sf_dir):
    return profile.count_by(_classifier_run("gbt")(spark, sf_dir), "prediction")


@query("m17_feature_importance")
def m17_feature_importance(spark, sf_dir):
    return models.feature_importance(spark, fitted_classifier(spark, sf_dir, "random_forest"))


_SAVED: dict = {}


def saved_models(spark, sf_dir) -> str:
    """Folder with both stages' models and the code table (M18), trained once
    per session and input."""
    key = (spark.sparkContext.applicationId, sf_dir, FT.input_state(spark, sf_dir))
    if key not in _SAVED:
        from tarmac.plans.q_io import scratch
        _, _, codes = _train_test(spark, sf_dir)
        clf = fitted_classifier(spark, sf_dir, "random_forest")
        reg = models.fit(_regression_data(spark, sf_dir)[0], "random_forest", "arrival_delay", "regression", seed=SEED)
        folder = scratch(spark, "models")
        P.save_scoring(folder, clf, reg, codes)
        _SAVED[key] = folder
    return _SAVED[key]


def scored_live(spark, sf_dir, cities: list[str] | None = None, start: str = "2000-01-01", end: str = "2100-01-01", forecasts: str = "all"):
    """M19 as a user calls it: both streams' outputs lie partitioned by date,
    models and codes are loaded, dates (and cities) select the flights."""
    from tarmac.operators import flights, weather
    from tarmac.plans.oracle import LIVE_LOCATION
    from tarmac.plans.q_io import scratch
    f, w = scratch(spark, "live_flights"), scratch(spark, "live_weather")
    flights.clean_flights_stream(T.fixtures.flights_msg(spark, sf_dir)).write.partitionBy("date").parquet(f)
    weather.clean_weather_stream(T.raw(spark, sf_dir, "weather_msg"), location=LIVE_LOCATION).write.partitionBy("date").parquet(w)
    return P.score_dates(spark, f, w, T.airports_clean(spark, sf_dir), saved_models(spark, sf_dir), start, end, cities, forecasts=forecasts)


@query("m19_predict_delays")
def m19_predict_delays(spark, sf_dir):
    out = scored_live(spark, sf_dir)
    return T.portable(out.select("flight_text", "to_text", "rounded_hour", "status", "predicted_delay_time"))


SEARCH = {"cities": ["City4", "CITY24", "city0"], "start": "2024-01-05", "end": "2024-01-20", "forecasts": "latest"}


@query("m19_search_dates_and_cities", with_tables("flights_live", "airports_clean", "weather_live", extra=[_LATEST]) + """
SELECT f.flight, f."to", f.rounded_hour, true AS gated
FROM flights_live f JOIN airports_clean a ON f."to" = a.airport JOIN latest w ON f.rounded_hour = w."timestamp" AND f."to" = w.location
WHERE f."date" BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND w."date" BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
  AND (f.from_city IN ('city4', 'city24', 'city0') OR f.to_city IN ('city4', 'city24', 'city0'))""")
def m19_search_dates_and_cities(spark, sf_dir):
    """The scoring call of a search: two weeks, three cities in any case, the latest forecast of an hour. ``gated``:
    minutes are there for flights predicted as delayed, and for those alone."""
    out = scored_live(spark, sf_dir, **SEARCH)
    gated = F.coalesce(F.col("status") == 1, F.lit(False)) == F.col("predicted_delay_time").isNotNull()
    return T.portable(out.select(F.col("flight_text").alias("flight"), F.col("to_text").alias("to"), "rounded_hour", gated.alias("gated")))


@query("m20_result_projection")
def m20_result_projection(spark, sf_dir):
    return P.result_projection(scored_live(spark, sf_dir))


# -------------------------------------------------------------- first split
SPLIT_FEATURES = ["temperature", "humidity", "wind_speed", "my_flightradar24_rating", "arrival_delay_index",
                  "departure_delay_index", "month", "day", "hour", "dayofweek", "quarter"]


@query("m7_first_split_gains", with_tables("joined", extra=[TRAIN, """
long_ AS (""" + " UNION ALL ".join(f"""SELECT '{c}' AS feature, CAST("{c}" AS DOUBLE) AS x, status AS y FROM train""" for c in SPLIT_FEATURES) + ")", """
tot AS (SELECT count(*) AS n, sum(status) AS pos, avg(status) AS p FROM train)""", """
val AS (SELECT feature, x, count(*) AS n, sum(y) AS pos FROM long_ GROUP BY feature, x)""", """
cut AS (SELECT feature, x, lead(x) OVER w AS nx, sum(n) OVER w AS nl, sum(pos) OVER w AS pl FROM val WINDOW w AS (PARTITION BY feature ORDER BY x))""", """
gain AS (SELECT feature, x + (nx - x) / 2 AS threshold, nl,
  (p * nl - pl) ^ 2 / (p * (1 - p) * nl) + (p * (n - nl) - (pos - pl)) ^ 2 / (p * (1 - p) * (n - nl)) AS gain
  FROM cut, tot WHERE nx IS NOT NULL AND nl >= 20 AND n - nl >= 20)""", """
best AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY gain DESC, threshold) AS o FROM gain)"""]) + """
SELECT feature, round(threshold, 6) AS threshold, round(gain, 6) AS gain, CAST(nl AS BIGINT) AS n_left FROM best WHERE o = 1 AND gain > 0""")
def m7_first_split_gains(spark, sf_dir):
    """The best split of all training rows by each feature, as the leaf-wise trees choose their first."""
    from tarmac.ml import boosting
    f = FT.training_features(spark, sf_dir)
    rows = f.select(F.array(*[F.col(f"`{c}`").cast("double") for c in SPLIT_FEATURES]).alias("x"), F.col("status").cast("double").alias("y"))
    found = [(SPLIT_FEATURES[i], t, g, n) for i, t, g, n in boosting.first_splits(T.materialize(rows), len(SPLIT_FEATURES))]
    out = spark.createDataFrame(found, "feature string, threshold double, gain double, n_left long")
    return out.select("feature", F.round("threshold", 6).alias("threshold"), F.round("gain", 6).alias("gain"), "n_left")


# ------------------------------------------------------------------ SMOTE
def _smote_sql() -> str:
    f = FEATURE_COLUMNS
    code = lambda c: f'dense_rank() OVER (ORDER BY "{c}") - 1' if c in ENCODED_COLUMNS else f'"{c}"'
    cast = ", ".join(f'CAST({code(c)} AS DOUBLE) AS "{c}"' for c in f)
    cols = ", ".join(f'"{c}"' for c in f)
    d2 = " + ".join(f'(a."{c}" - b."{c}") * (a."{c}" - b."{c}")' for c in f)
    on = " AND ".join(f'm."{c}" = p."{c}"' for c in f)
    new = ", ".join(f'cp."{c}" + u * (nv."{c}" - cp."{c}") AS "{c}"' for c in f)
    h = "('0x' || substr(md5('42:' || cp.row_key || ':' || cp.c || ':{t}'), 1, 8))::BIGINT"
    return with_tables("joined", extra=[TRAIN, f"""
base AS (SELECT row_key, {cast}, status FROM train)""", """
cnt AS (SELECT status, count(*) AS n FROM base GROUP BY status)""", """
mx AS (SELECT max(n) AS top FROM cnt)""", """
cls AS (SELECT status AS cls, n, top - n AS need FROM cnt, mx WHERE n < top)""", f"""
mino AS (SELECT b.*, c.n, c.need FROM base b JOIN cls c ON b.status = c.cls)""", f"""
pts AS (SELECT status, {cols}, min(row_key) AS pid, count(*) AS mult FROM mino GROUP BY ALL)""", f"""
pairs AS (SELECT a.status, a.pid, a.mult, b.pid AS cid, b.mult AS cmult, {d2} AS d2
          FROM pts a JOIN pts b ON a.status = b.status AND a.pid <> b.pid)""", """
ranked AS (SELECT *, CAST(coalesce(sum(cmult) OVER (PARTITION BY pid ORDER BY d2, cid
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cum_before FROM pairs)""", """
nn AS (SELECT pid, unnest(generate_series(0, least(mult - 1, 5) - 1)) AS rank, pid AS nid FROM pts WHERE mult > 1
       UNION ALL
       SELECT pid, unnest(generate_series(mult - 1 + cum_before, least(mult - 1 + cum_before + cmult, 5) - 1)) AS rank, cid AS nid
       FROM ranked WHERE cum_before < 5 - (mult - 1))""", f"""
rows_ AS (SELECT m.*, p.pid, row_number() OVER (PARTITION BY m.status ORDER BY md5('42:' || m.row_key), m.row_key) - 1 AS pos
          FROM mino m JOIN pts p ON m.status = p.status AND {on})""", """
cp AS (SELECT * FROM (SELECT r.*, unnest(generate_series(0, need // n + CASE WHEN pos < need % n THEN 1 ELSE 0 END - 1)) AS c
       FROM rows_ r))""", f"""
syn AS (SELECT cp.row_key || '#' || cp.c AS row_key, {new}, cp.status
        FROM (SELECT *, {h.format(t='u')} / 4294967296.0 AS u, {h.format(t='nn')} % 5 AS rk FROM cp) cp
        JOIN nn ON nn.pid = cp.pid AND nn.rank = cp.rk
        JOIN pts nv ON nv.pid = nn.nid)"""]) + """
SELECT * FROM base UNION ALL SELECT * FROM syn"""


@query("m6_smote_train_features", _smote_sql())
def m6_smote_train_features(spark, sf_dir):
    from tarmac.ml.smote import smote
    enc, _ = FT.encoded_training(spark, sf_dir)
    return smote(enc, "status", FEATURE_COLUMNS, "row_key", k=5, seed=SEED)
