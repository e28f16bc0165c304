"""Raw scraped-table shapes derived from the driver tables.

The driver ships TPC-H-like parquet tables; these adapters turn them into
the all-text flight / weather / aircraft / airport / review records the
cleaning operators expect (deliberately dirty: blank dates, unknown routes,
dash times, ``Landed`` without a time, duplicates, ``N/A``, ``Calm``, nulls).
Each adapter exists twice - Spark SQL for the jobs and DuckDB SQL for the
independent oracle - and both give equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- Spark SQL
# ``{events}`` etc. are DataFrame arguments of ``spark.sql``; literal braces
# are doubled.
SPARK_ADAPTERS = {
    "flights_raw": ("events", """
with e as (select *, 30+user_id*7%270 dur, event_id*13%25 f, (event_id*13+1+user_id%24)%25 t from {events}),
g as (select *, timestampadd(MINUTE,dur,ts) sta, timestampadd(MINUTE,event_id*11%67-9,ts) atd from e),
r as (select event_id, concat('a',event_id*37%240) aircraft, '' temp1, '' temp2,
 case when event_id%97=0 then '' else date_format(ts,'dd MMM yyyy') end `date`,
 concat('City',f,' (A',lpad(f,2,'0'),')') `from`,
 case when event_id%89=0 then 'Unknown' else concat('City',t,' (A',lpad(t,2,'0'),')') end `to`,
 concat('QR',user_id) flight, concat(dur div 60,':',lpad(dur%60,2,'0')) flight_time,
 date_format(ts,'HH:mm') scheduled_time_departure,
 case when event_id%83=0 then '—' else date_format(atd,'HH:mm') end actual_time_departure,
 date_format(sta,'HH:mm') scheduled_time_arrival, '' temp3,
 case when event_type='error' then 'Canceled' when event_id%71=0 then 'Landed'
  else concat('Landed ',date_format(timestampadd(MINUTE,event_id*17%121-40,sta),'HH:mm')) end status, '' temp4 from g)
select * except (event_id) from r union all select * except (event_id) from r where event_id%50=0
"""),
    "weather_raw": ("lineitem", """
select date_format(timestampadd(MINUTE,l_orderkey*31%1440,timestamp'2024-01-01 00:00:00'),'h:mm a') `time`,
 concat(l_linenumber*13%130-20,' °F') temperature, concat(cast(l_quantity as int),' °F') dew_point,
 concat(cast(round(l_discount*900) as int),' %') humidity, l_returnflag wind_direction,
 case when l_linenumber=7 then 'Calm' else concat(cast(l_quantity as int)%30,' mph') end wind_speed,
 concat(l_linenumber,' mph') wind_gust, concat('29.',lpad(cast(round(l_discount*100) as int),2,'0'),' in') pressure,
 concat('0.0',cast(round(l_tax*100) as int),' in') precip,
 case when l_orderkey%101=0 then null else l_linestatus end condition,
 concat('a',lpad(l_suppkey%25,2,'0')) airport, concat('2024-01-',lpad(1+l_partkey%30,2,'0'),' 00:00:00') `date` from {lineitem}
"""),
    "aircrafts_raw": ("part", """
select cast(p_partkey as string) msn, p_type `type`, concat('A',p_partkey) aircraft,
 case when p_partkey%53=0 then null else p_brand end airline,
 case when p_partkey%17=0 then 'N/A' when p_partkey%19=0 then 'Jan 2024 (2024 years)' else concat('Mar 2010 (',p_size,' years)') end first_flight,
 '' photo from {part}
"""),
    "airports_raw": ("nation", """
with r as (select n_regionkey k, case when n_nationkey%11=7 then 'N/A' else concat(50+n_nationkey,'%') end my_flightradar24_rating, cast(null as string) temp,
 case when n_nationkey%6=0 then 'N/A' else concat(n_nationkey%5,'.',n_nationkey%2*5) end arrival_delay_index,
 case when n_nationkey%8=0 then 'N/A' else concat(n_nationkey%4,'.',n_nationkey%2*5) end departure_delay_index,
 concat('UTC ',lpad(n_nationkey%24,2,'0'),':30') utc, '03:30 PM' `local`, concat('a',lpad(n_nationkey,2,'0')) airport from {nation})
select * except (k) from r union all select * except (k) from r where k=0
"""),
    "reviews_raw": ("documents", """
select text comment, concat('a',lpad(doc_id%25,2,'0')) airport from {documents}
"""),
    "weather_msg": ("events", """
select concat('{{"date": "',date_format(ts,'yyyy-MM-dd HH:00:00'),'", "hour": "',hour(ts),'", "details": {{"feels_like": "',event_id%60-10,'°", "wind_direction": "N", "wind_speed": "',user_id%40,' mph", "humidity": "',event_id%100,'%", "cloud_cover": "',user_id%100,'%"',
 case when event_id%9=0 then '' else concat(', "rain_amount": "0.',event_id%10,' in"') end,'}}}}') value from {events}
"""),
}

# --------------------------------------------------------------- DuckDB SQL
DUCKDB_ADAPTERS = {
    "flights_raw": """
with e as (select *, 30+user_id*7%270 dur, event_id*13%25 f, (event_id*13+1+user_id%24)%25 t from events),
g as (select *, ts + to_minutes(dur) sta, ts + to_minutes(event_id*11%67-9) atd from e),
r as (select event_id, concat('a',event_id*37%240) aircraft, '' temp1, '' temp2,
 case when event_id%97=0 then '' else strftime(ts,'%d %b %Y') end "date",
 concat('City',f,' (A',lpad(f::varchar,2,'0'),')') "from",
 case when event_id%89=0 then 'Unknown' else concat('City',t,' (A',lpad(t::varchar,2,'0'),')') end "to",
 concat('QR',user_id) flight, concat(dur//60,':',lpad((dur%60)::varchar,2,'0')) flight_time,
 strftime(ts,'%H:%M') scheduled_time_departure,
 case when event_id%83=0 then '—' else strftime(atd,'%H:%M') end actual_time_departure,
 strftime(sta,'%H:%M') scheduled_time_arrival, '' temp3,
 case when event_type='error' then 'Canceled' when event_id%71=0 then 'Landed'
  else concat('Landed ',strftime(sta+to_minutes(event_id*17%121-40),'%H:%M')) end status, '' temp4 from g)
select * exclude (event_id) from r union all select * exclude (event_id) from r where event_id%50=0
""",
    "weather_raw": """
select strftime(timestamp '2024-01-01'+to_minutes(l_orderkey*31%1440),'%-I:%M %p') "time",
 concat(l_linenumber*13%130-20,' °F') temperature, concat(cast(l_quantity as int),' °F') dew_point,
 concat(cast(round(l_discount*900) as int),' %') humidity, l_returnflag wind_direction,
 case when l_linenumber=7 then 'Calm' else concat(cast(l_quantity as int)%30,' mph') end wind_speed,
 concat(l_linenumber,' mph') wind_gust, concat('29.',lpad(cast(round(l_discount*100) as int)::varchar,2,'0'),' in') pressure,
 concat('0.0',cast(round(l_tax*100) as int),' in') precip,
 case when l_orderkey%101=0 then null else l_linestatus end condition,
 concat('a',lpad((l_suppkey%25)::varchar,2,'0')) airport, concat('2024-01-',lpad((1+l_partkey%30)::varchar,2,'0'),' 00:00:00') "date" from lineitem
""",
    "aircrafts_raw": """
select p_partkey::varchar msn, p_type "type", concat('A',p_partkey) aircraft,
 case when p_partkey%53=0 then null else p_brand end airline,
 case when p_partkey%17=0 then 'N/A' when p_partkey%19=0 then 'Jan 2024 (2024 years)' else concat('Mar 2010 (',p_size,' years)') end first_flight,
 '' photo from part
""",
    "airports_raw": """
with r as (select n_regionkey k, case when n_nationkey%11=7 then 'N/A' else concat(50+n_nationkey,'%') end my_flightradar24_rating, cast(null as varchar) temp,
 case when n_nationkey%6=0 then 'N/A' else concat(n_nationkey%5,'.',n_nationkey%2*5) end arrival_delay_index,
 case when n_nationkey%8=0 then 'N/A' else concat(n_nationkey%4,'.',n_nationkey%2*5) end departure_delay_index,
 concat('UTC ',lpad((n_nationkey%24)::varchar,2,'0'),':30') utc, '03:30 PM' "local", concat('a',lpad(n_nationkey::varchar,2,'0')) airport from nation)
select * exclude (k) from r union all select * exclude (k) from r where k=0
""",
    "reviews_raw": """
select text "comment", concat('a',lpad((doc_id%25)::varchar,2,'0')) airport from documents
""",
    "weather_msg": """
select concat('{"date": "',strftime(ts,'%Y-%m-%d %H:00:00'),'", "hour": "',hour(ts),'", "details": {"feels_like": "',event_id%60-10,'°", "wind_direction": "N", "wind_speed": "',user_id%40,' mph", "humidity": "',event_id%100,'%", "cloud_cover": "',user_id%100,'%"',
 case when event_id%9=0 then '' else concat(', "rain_amount": "0.',event_id%10,' in"') end,'}}') "value" from events
""",
}

FLIGHTS_STREAM_ORDER = (
    "flight, temp1, temp2, date, `from`, `to`, aircraft, flight_time, scheduled_time_departure, "
    "actual_time_departure, scheduled_time_arrival, temp3, status, temp4"
)


#: Messages are costly to parse and have no shuffle before the parsing: their source's rows are dealt out first, in
#: ranges of these columns. A scan gives a row group to one task, whatever its size. Ranges of time, so that each task
#: meets few dates and a write by date leaves few files.
DEALT_BY = {"weather_msg": ("ts", "event_id")}
#: Raw flights have no shuffle before the parsing either, but one after it: dealt out by a hash of these columns.
HASHED_BY = {"flights_raw": ("event_id", "ts", "user_id")}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Raw text table ``name`` (one of SPARK_ADAPTERS) built from ``sf_dir``."""
    source, sql = SPARK_ADAPTERS[name]
    rows = table(spark, sf_dir, source)
    if name in DEALT_BY:
        rows = rows.repartitionByRange(*DEALT_BY[name])
    elif name in HASHED_BY:
        rows = rows.repartition(*HASHED_BY[name])
    return spark.sql(sql, **{source: rows})


def flights_msg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live-flight messages: a JSON string holding the stream-ordered CSV line."""
    return spark.sql(
        "select concat('\"', concat_ws(',', " + FLIGHTS_STREAM_ORDER + "), '\\\\n\"') value from {f}",
        f=raw(spark, sf_dir, "flights_raw"),
    )


def duckdb_with(*names: str) -> str:
    """``WITH`` prefix defining the named raw tables for an oracle query."""
    parts = [f"{n} AS ({DUCKDB_ADAPTERS[n].strip()})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"
