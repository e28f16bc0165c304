"""Registered queries: page extraction (X1-X5), W5, W6, W8, comment scoring
(U1, U2)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.operators import pages, scoring
from tarmac.plans import tables as T
from tarmac.plans.oracle import with_tables
from tarmac.plans.registry import query
from tarmac.sources import fixtures

# Allow-list for X1 (a parameter of the operator; the reference used a list
# of country pages).
ALLOW_KEYS = ["The", "and", "to", "the", "of", "in", "für", "la", "de", "und"]


@query("x1_extract_links", """
WITH l AS (SELECT unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages)
SELECT DISTINCT href FROM l WHERE trim(string_split(href, '/')[-1]) IN (""" + ", ".join(f"'{k}'" for k in ALLOW_KEYS) + ")")
def x1_extract_links(spark, sf_dir):
    allow = spark.createDataFrame([(k,) for k in ALLOW_KEYS], "key string")
    return pages.extract_links(fixtures.table(spark, sf_dir, "pages"), allow)


def table_pages(spark, sf_dir):
    """One stored table page per (aircraft, day) built from the raw flights:
    a one-cell date header row, then the day's rows in departure order
    (blank cells included, as on the scraped page)."""
    r = T.raw(spark, sf_dir, "flights_raw").filter(F.col("date") != "")
    cells = ["from", "to", "flight", "temp1", "flight_time", "scheduled_time_departure",
             "actual_time_departure", "scheduled_time_arrival", "status", "temp4"]
    tr = F.concat(F.lit("<tr><td>"), F.concat_ws("</td><td>", *[F.col(f"`{c}`") for c in cells]), F.lit("</td></tr>"))
    rows = r.select("aircraft", "date", F.struct("scheduled_time_departure", "flight", tr.alias("tr")).alias("s"))
    per_page = rows.groupBy("aircraft", "date").agg(F.sort_array(F.collect_list("s")).alias("rows"))
    html = F.concat(F.lit("<table><tbody><tr><td>"), F.col("date"), F.lit("</td></tr>"),
                    F.array_join(F.transform("rows", lambda s: s["tr"]), ""), F.lit("</tbody></table>"))
    return per_page.select(F.concat_ws("|", "aircraft", "date").alias("page_id"), html.alias("html"))


@query("x2_w5_table_rows", with_tables("flights_raw", extra=["""
r AS (SELECT concat_ws('|', aircraft, "date") AS page_id, "date",
        row_number() OVER (PARTITION BY aircraft, "date" ORDER BY scheduled_time_departure, flight,
          concat('<tr><td>', concat_ws('</td><td>', "from", "to", flight, temp1, flight_time, scheduled_time_departure,
                 actual_time_departure, scheduled_time_arrival, status, temp4), '</td></tr>')) AS pos,
        array_to_string(list_filter(["from", "to", flight, temp1, flight_time, scheduled_time_departure,
          actual_time_departure, scheduled_time_arrival, status, temp4], lambda x: trim(x) <> ''), '|') AS cells
      FROM flights_raw WHERE "date" <> '')"""]) + """
SELECT page_id, CAST(pos AS INTEGER) AS pos, cells, replace("date", ',', '') AS header_date FROM r""")
def x2_w5_table_rows(spark, sf_dir):
    rows = pages.extract_table_rows(table_pages(spark, sf_dir))
    out = pages.carry_header_dates(rows)
    return out.select("page_id", "pos", F.array_join("cells", "|").alias("cells"), "header_date")


@query("x3_extract_comments", """
WITH b AS (SELECT trim(string_split(url, '/')[-1]) AS airport,
                  unnest(regexp_extract_all(html, '(?s)<div class="ad"[^>]*>(.*?)</div>', 1)) AS block FROM pages)
SELECT trim(replace(regexp_replace(block, '<[^>]+>', '', 'g'), ',', ' ')) AS comment, airport FROM b""")
def x3_extract_comments(spark, sf_dir):
    return pages.extract_comments(fixtures.table(spark, sf_dir, "pages"), css_class="ad")


@query("w6_x5_hour_labels", """
WITH l AS (SELECT user_id, ts, lower(strftime(ts, '%-I %p')) AS hour FROM events),
s AS (SELECT *, CASE WHEN lag(hour) OVER w IS NULL THEN 1
                     WHEN contains(hour, 'am') AND contains(lag(hour) OVER w, 'pm') THEN 1 ELSE 0 END AS st
      FROM l WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
d AS (SELECT user_id, ts, hour, sum(st) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS day_offset FROM s)
SELECT user_id, ts, hour, CAST(day_offset AS BIGINT) AS day_offset,
       strftime(strptime(strftime(DATE '2024-01-01' + CAST(day_offset AS INTEGER), '%Y-%m-%d') || ' ' || upper(hour), '%Y-%m-%d %I %p'),
                '%Y-%m-%d %H:%M:%S') AS message_date
FROM d""")
def w6_x5_hour_labels(spark, sf_dir):
    ev = fixtures.table(spark, sf_dir, "events").select(
        "user_id", "ts", F.lower(F.date_format("ts", "h a")).alias("hour"))
    d = pages.day_rollover(ev, "user_id", "ts")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("day_offset").cast("int"))
    ts = F.try_to_timestamp(F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), F.upper("hour")), F.lit("yyyy-MM-dd h a"))
    return d.withColumn("message_date", F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))


def forecast_pages(spark, sf_dir):
    """Stored forecast pages built from the events, three to a page: a
    ``<details>`` block with an hour label and label/value items each."""
    e = fixtures.table(spark, sf_dir, "events")
    item = lambda label, *v: F.concat(F.lit(f'<li><span class="label">{label}</span>'), *[
        F.concat(F.lit('<span class="value">'), x, F.lit("</span>")) for x in v], F.lit("</li>"))
    n = F.col("event_id")
    text = lambda x, unit: F.concat((x).cast("string"), F.lit(unit))
    direction = F.element_at(F.array(*map(F.lit, _WINDS)), (n % 4 + 1).cast("int"))
    wind = F.when(n % 3 == 0, F.concat(F.lit("<span>"), direction, F.lit("</span> <span>"), text(n % 40, "</span> mph"))) \
        .otherwise(F.concat(direction, F.lit(" "), text(n % 40, " mph")))
    block = F.concat(
        F.lit('<details><summary><span class="hour">'), F.lower(F.date_format("ts", "h a")), F.lit("</span></summary><ul>"),
        item("Feels Like", text(n % 60 - 10, "°")), item("Wind", wind), item("Humidity", text(n % 100, "%")),
        F.when(n % 2 == 0, item("UV Index", F.lit("low"), text(n % 11, " of 11"))).otherwise(item("UV Index", F.lit("low"))),
        item("Cloud Cover", text(n % 90, "%")), F.when(n % 5 == 0, item("Rain Amount", F.lit(""))).otherwise(item("Rain Amount", text(n % 7, " in"))),
        F.lit("</ul></details>"))
    p = e.groupBy(F.floor(n / 3).alias("page_id")).agg(F.array_sort(F.collect_list(F.struct(n, block.alias("b")))).alias("p"))
    return p.select("page_id", F.array_join(F.transform("p", lambda x: x["b"]), "").alias("html"))


_WINDS = ["N", "ESE", "WSW", "SW"]
_FORECAST_BLOCKS = """b AS (SELECT event_id // 3 AS page_id, row_number() OVER (PARTITION BY event_id // 3 ORDER BY event_id) - 1 AS block,
       lower(strftime(ts, '%-I %p')) AS hour, (event_id % 60 - 10) || '°' AS feels_like,
       (['N', 'ESE', 'WSW', 'SW'])[event_id % 4 + 1] AS wind_direction, (event_id % 40) || ' mph' AS wind_speed, (event_id % 100) || '%' AS humidity,
       CASE WHEN event_id % 2 = 0 THEN (event_id % 11) || ' of 11' END AS uv_index, (event_id % 90) || '%' AS cloud_cover,
       CASE WHEN event_id % 5 <> 0 THEN (event_id % 7) || ' in' END AS rain_amount
     FROM events)"""
_DETAILS = ["feels_like", "wind_direction", "wind_speed", "humidity", "uv_index", "cloud_cover", "rain_amount"]


@query("x4_extract_details", f"WITH {_FORECAST_BLOCKS} SELECT page_id, CAST(block AS INTEGER) AS block, hour, {', '.join(_DETAILS)} FROM b")
def x4_extract_details(spark, sf_dir):
    d = pages.extract_details(forecast_pages(spark, sf_dir))
    return d.select("page_id", "block", "hour", *[F.col("details")[k].alias(k) for k in _DETAILS])


@query("x5_forecast_messages", f"""
WITH {_FORECAST_BLOCKS},
s AS (SELECT *, CASE WHEN lag(hour) OVER w IS NULL THEN 1 WHEN contains(hour, 'am') AND contains(lag(hour) OVER w, 'pm') THEN 1 ELSE 0 END AS st
      FROM b WINDOW w AS (PARTITION BY page_id ORDER BY block)),
d AS (SELECT *, sum(st) OVER (PARTITION BY page_id ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS day_offset FROM s)
SELECT concat('{{"date":"', strftime(strptime(strftime(DATE '2024-05-06' + CAST(day_offset AS INTEGER), '%Y-%m-%d') || ' ' || upper(hour), '%Y-%m-%d %I %p'),
  '%Y-%m-%d %H:%M:%S'), '","hour":"', hour, '","details":{{"feels_like":"', feels_like, '","wind_direction":"', wind_direction, '","wind_speed":"', wind_speed,
  '","humidity":"', humidity, CASE WHEN uv_index IS NULL THEN '' ELSE concat('","uv_index":"', uv_index) END, '","cloud_cover":"', cloud_cover,
  CASE WHEN rain_amount IS NULL THEN '' ELSE concat('","rain_amount":"', rain_amount) END, '"}}}}') AS "value"
FROM d""")
def x5_forecast_messages(spark, sf_dir):
    blocks = pages.day_rollover(pages.extract_details(forecast_pages(spark, sf_dir)), "page_id", "block")
    return pages.forecast_messages(blocks, "2024-05-06", 2024)


@query("w8_date_spine", with_tables("airports_clean") + """
SELECT airport, CAST(unnest(generate_series(DATE '2024-05-07' - 365, DATE '2024-05-07', INTERVAL 1 DAY)) AS DATE) AS "date"
FROM (SELECT DISTINCT airport FROM airports_clean)""")
def w8_date_spine(spark, sf_dir):
    return pages.date_spine(T.airports_clean(spark, sf_dir), "airport", "2024-05-07")


def _score_sql(table: str) -> str:
    pos = ", ".join(f"'{w}'" for w in scoring.POSITIVE_WORDS)
    neg = ", ".join(f"'{w}'" for w in scoring.NEGATIVE_WORDS)
    return f"""
SELECT comment, airport,
  CASE WHEN comment IS NULL OR trim(comment) = '' THEN -1
       WHEN len(list_filter(regexp_split_to_array(lower(comment), '[^a-z0-9]+'), lambda w: list_contains([{pos}], w)))
          > len(list_filter(regexp_split_to_array(lower(comment), '[^a-z0-9]+'), lambda w: list_contains([{neg}], w))) THEN 1
       ELSE 0 END AS sentiment
FROM {table}"""


@query("u1_score_comments", with_tables("reviews_clean") + _score_sql("reviews_clean"))
def u1_score_comments(spark, sf_dir):
    return scoring.score_comments(T.reviews_clean(spark, sf_dir))


@query("u2_resume_scoring", with_tables("reviews_clean") + _score_sql("reviews_clean"))
def u2_resume_scoring(spark, sf_dir):
    """A first run scored part of the comments and stopped; the resumed run
    scores only the rest (anti join) and appends; the union is read back."""
    from tarmac.plans.q_io import scratch
    out = scratch(spark, "scored_comments")
    reviews = T.reviews_clean(spark, sf_dir)
    scoring.score_comments(reviews.filter(F.col("airport") < "a12")).write.mode("append").parquet(out)
    done = spark.read.parquet(out)
    scoring.resume_scoring(reviews, done, ["comment", "airport"]).write.mode("append").parquet(out)
    return spark.read.parquet(out)
