"""Scalar helpers: ``Column -> Column``, all built-in Spark expressions.

ANSI mode is on in Spark 4: a bad cast, a bad timestamp or an array index
out of range raises instead of giving null. Scraped text is dirty, so every
parse here uses the ``try_`` form and ``get`` (null when absent).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def digits_text(c: ColumnOrName, extra: str = "") -> Column:
    """Digits (plus optional extra characters) of a text; null when none is
    left, as a cast that fails costs far more than one of a null."""
    return F.nullif(F.regexp_replace(_c(c), f"[^0-9{extra}]+", ""), F.lit(""))


def parsed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` behind a one-row explode. A later filter on the new columns (a null drop, a join's key check)
    then reads them; without it Spark pushes the filter below and parses every text a second time, in one generated
    method that outgrows what the JVM compiles."""
    held = df.withColumn("_parsed", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
    names = [*df.columns, *(n for n in columns if n not in df.columns)]
    return held.select(*[F.col("_parsed")[n].alias(n) if n in columns else F.col(f"`{n}`") for n in names])


# keep digits (plus optional extra characters) and cast.
def keep_digits(c: ColumnOrName, extra: str = "", to: str = "int") -> Column:
    """``'29.92 in'`` -> 29.92 (``extra='.'``); ``'-3 °F'`` -> -3 (``extra='-'``)."""
    return digits_text(c, extra).try_cast(to)


# keep ASCII letters, digits and blanks.
def keep_alnum(c: ColumnOrName) -> Column:
    return F.regexp_replace(_c(c), "[^a-zA-Z0-9 ]", "")


# F8: remove quotes, each optionally escaped by a backslash.
def strip_quotes(c: ColumnOrName) -> Column:
    return F.regexp_replace(_c(c), r'\\?"', "")


# strip a set of characters from both ends.
def strip_chars(c: ColumnOrName, chars: str = "()") -> Column:
    return F.btrim(_c(c), F.lit(chars))


# n-th (0-based) element of a split, null when absent.
def token(c: ColumnOrName, pattern: str, i: int) -> Column:
    return F.get(F.split(_c(c), pattern), i)


# F16: 'h:mm' duration text -> fractional hours.
def hours_of_duration(c: ColumnOrName) -> Column:
    parts = F.split(_c(c), ":")
    return F.get(parts, 0).try_cast("double") + F.get(parts, 1).try_cast("double") / 60


# date + clock text -> timestamp (null when either is bad).
def clock_on_date(date: ColumnOrName, clock: ColumnOrName) -> Column:
    text = F.concat_ws(" ", F.date_format(_c(date), "yyyy-MM-dd"), _c(clock))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd H:mm"))


def parse_date(c: ColumnOrName, fmt: str = "d MMM yyyy") -> Column:
    return F.try_to_date(_c(c), fmt)


def parse_timestamp(c: ColumnOrName, fmt: str) -> Column:
    return F.try_to_timestamp(_c(c), F.lit(fmt))


# differences of timestamps.
def minutes_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    return (F.unix_timestamp(_c(later)) - F.unix_timestamp(_c(earlier))) / 60


def hours_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    return (F.unix_timestamp(_c(later)) - F.unix_timestamp(_c(earlier))) / 3600


# timestamp difference as whole minutes (the interval, exposed numerically).
def interval_minutes(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    return F.timestamp_diff("MINUTE", _c(earlier), _c(later))


# Nearest hour. Reference behaviour keeps the date when 23:30-23:59 rounds
# up (the hour wraps to 00 of the same day); ``midnight='roll'`` moves to the
# next day instead.
def round_to_hour(ts: ColumnOrName, midnight: str = "same_day") -> Column:
    t = _c(ts)
    if midnight == "roll":
        return F.date_trunc("hour", t + F.expr("INTERVAL 30 MINUTES"))
    if midnight != "same_day":
        raise ValueError("midnight must be 'same_day' or 'roll'")
    rounded = (F.hour(t) + F.when(F.minute(t) >= 30, 1).otherwise(0)) % 24
    return F.timestamp_add("HOUR", rounded, F.date_trunc("day", t))


# calendar parts with Monday = 0.
def calendar_parts(ts: ColumnOrName) -> dict[str, Column]:
    t = _c(ts)
    return {
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "hour": F.hour(t),
        "dayofweek": F.weekday(t),
        "quarter": F.quarter(t),
        "is_year_start": ((F.month(t) == 1) & (F.dayofmonth(t) == 1)).cast("int"),
        "is_year_end": ((F.month(t) == 12) & (F.dayofmonth(t) == 31)).cast("int"),
    }


# label text -> field name.
def field_name(c: ColumnOrName) -> Column:
    return F.replace(F.lower(_c(c)), F.lit(" "), F.lit("_"))


# last two blank-separated tokens in reversed order, re-joined.
def last_two_reversed(c: ColumnOrName) -> Column:
    return F.array_join(F.reverse(F.slice(F.split(_c(c), " "), -2, 2)), " ")


# Key of a scraped page = last URL path segment, trimmed.
def url_key(c: ColumnOrName) -> Column:
    return F.trim(F.element_at(F.split(_c(c), "/"), -1))


# Blank or null text falls back to another column.
def blank_fallback(c: ColumnOrName, fallback: ColumnOrName) -> Column:
    return F.coalesce(F.nullif(F.trim(_c(c)), F.lit("")), _c(fallback))


# Null -> '' for text output.
def empty_if_null(c: ColumnOrName) -> Column:
    return F.coalesce(_c(c).cast("string"), F.lit(""))
