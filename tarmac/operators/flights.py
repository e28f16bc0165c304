"""Flight cleaning (D1-D7, D12): raw text records -> typed, labelled flights.

Every function is ``DataFrame -> DataFrame`` without actions, so the same
code runs on batch frames and on streaming frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import columns as C

CLOCK_COLUMNS = [
    "scheduled_time_departure", "actual_time_departure", "scheduled_time_arrival",
    "actual_time_arrival",
]


# D1
def parse_route(df: DataFrame) -> DataFrame:
    """``'Doha (DOH)'`` -> from/to = ``'doh'``, from_city/to_city = ``'doha'``."""
    return C.parsed(df, {
        "from_city": F.lower(C.token("from", r" \(", 0)),
        "to_city": F.lower(C.token("to", r" \(", 0)),
        "from": F.lower(F.substring(C.token("from", r" \(", 1), 1, 3)),
        "to": F.lower(F.substring(C.token("to", r" \(", 1), 1, 3)),
    })


# D2
def parse_status(df: DataFrame) -> DataFrame:
    """``'Landed 12:34'`` -> status ``'Landed'`` + actual_time_arrival = last 5 chars."""
    s = F.col("status")
    return df.withColumns({
        "status": C.token(s, " ", 0),
        "actual_time_arrival": F.expr("substring(status, length(status) - 4, 5)"),
    })


# D3
def with_clock_times(df: DataFrame, clock_columns: list[str] | None = None) -> DataFrame:
    """Clock texts (``HH:mm``) placed on the row's ``date``."""
    names = [c for c in (clock_columns or CLOCK_COLUMNS) if c in df.columns]
    return C.parsed(df, {c: C.clock_on_date("date", c) for c in names})


# D4
def with_rounded_hour(df: DataFrame, ts: str = "scheduled_time_arrival",
                      midnight: str = "same_day") -> DataFrame:
    return df.withColumn("rounded_hour", C.round_to_hour(ts, midnight))


# D5
def with_delay(df: DataFrame) -> DataFrame:
    """Arrival delay in minutes; Delayed when above 15 (null delay -> On Time)."""
    delay = C.minutes_between("actual_time_arrival", "scheduled_time_arrival")
    return df.withColumn("delay_time", delay).withColumn(
        "status", F.when(F.col("delay_time") > 15, "Delayed").otherwise("On Time"))


# D6
def wrap_delay(df: DataFrame, relabel: bool = False) -> DataFrame:
    """Delays across midnight: +-1440 minutes for rows not labelled Delayed.

    The label is set before the wrap, so ``> 720 and not Delayed`` never
    holds and a wrapped -1390 -> +50 stays On Time. ``relabel=True`` sets the
    label again from the wrapped delay.
    """
    d, not_delayed = F.col("delay_time"), F.col("status") != "Delayed"
    out = df.withColumn(
        "delay_time",
        F.when((d > 720) & not_delayed, d - 1440)
        .when((d <= -720) & not_delayed, d + 1440)
        .otherwise(d))
    if relabel:
        out = out.withColumn(
            "status", F.when(F.col("delay_time") > 15, "Delayed").otherwise("On Time"))
    return out


# D7
def clean_flights(raw: DataFrame, variant: str = "notebook", midnight: str = "same_day",
                  relabel: bool = False) -> DataFrame:
    """Full history-flight cleaning chain.

    ``variant='notebook'``: flight_time in fractional hours, delay wrap,
    null drop. ``variant='job'``: flight_time as a timestamp on the date, no
    wrap, no null drop.
    """
    df = raw.drop("temp1", "temp2", "temp3", "temp4")
    df = df.withColumn("date", C.parse_date("date"))
    df = parse_status(df)
    df = df.filter(F.col("status").rlike("Landed"))
    if variant == "notebook":
        df = df.withColumn("flight_time", C.hours_of_duration("flight_time"))
        df = with_clock_times(df)
    elif variant == "job":
        df = with_clock_times(df, ["flight_time"] + CLOCK_COLUMNS)
    else:
        raise ValueError("variant must be 'notebook' or 'job'")
    df = parse_route(df)
    df = with_rounded_hour(df, midnight=midnight)
    df = df.dropDuplicates()
    df = df.withColumn("airport", F.col("to"))
    df = with_delay(df)
    if variant == "notebook":
        df = wrap_delay(df, relabel=relabel)
        df = df.dropna(subset=["from", "to", "scheduled_time_departure",
                               "actual_time_departure", "scheduled_time_arrival"])
    return df


# D12
def split_stream_line(messages: DataFrame, names: list[str]) -> DataFrame:
    """One text column ``value`` holding a comma line -> named columns."""
    cells = F.split(F.col("value"), ",")
    return messages.select(*[F.get(cells, i).alias(n) for i, n in enumerate(names)])


def clean_flights_stream(messages: DataFrame, midnight: str = "same_day", dedup: bool = True) -> DataFrame:
    """Live flights: message line -> columns, dates and clock times, route,
    nearest hour, full-row dedup, quote strip. No label, delay or null drop.
    ``dedup=False`` leaves deduplication to the caller (streaming modes)."""
    from tarmac.schemas import FLIGHTS_STREAM_COLUMNS

    df = split_stream_line(messages, FLIGHTS_STREAM_COLUMNS).select(
        "flight", "date", "from", "to", "aircraft", "flight_time",
        "scheduled_time_departure", "actual_time_departure", "scheduled_time_arrival", "status")
    df = df.withColumn("date", C.parse_date("date"))
    df = with_clock_times(df, CLOCK_COLUMNS[:3])
    df = parse_route(df)
    df = with_rounded_hour(df, midnight=midnight)
    if not dedup:
        return df
    df = df.dropDuplicates()
    return df.withColumn("flight", C.strip_quotes("flight"))
