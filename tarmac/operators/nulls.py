"""Projections, filters and null handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tarmac.functions import columns as C


# P1
def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop; absent names are ignored."""
    return df.drop(*names)


# P2
def select_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{n}`") for n in names])


# P3
def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


# P5
def regex_filter(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).rlike(pattern))


# P6
def non_blank(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.trim(F.col(column)) != "")


# P7 / P8 / P9
def require(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in ``subset`` (all columns when None)."""
    return df.dropna(how="any", subset=subset)


# P10
def sentinel_to_null(df: DataFrame, sentinel: str = "N/A") -> DataFrame:
    """Sentinel text -> null in every string column."""
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({
        c: F.when(F.col(f"`{c}`") == sentinel, F.lit(None).cast("string")).otherwise(F.col(f"`{c}`"))
        for c in text_cols})


# P11
def fill_constant(df: DataFrame, value: float, subset: list[str]) -> DataFrame:
    return df.fillna(value, subset=subset)


# P12
def fill_with_mean(df: DataFrame, column: str) -> DataFrame:
    """Null -> column mean. The mean is a scalar subquery: Spark computes it as
    its own aggregate (partial + final) and inlines it; nothing is collected by
    user code and no row is paired with another."""
    mean = df.select(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


# P13
def repair_sentinel(c: Column | str, sentinel: float, value: float) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col == sentinel, F.lit(value)).otherwise(col)


# P14
def with_fallback(df: DataFrame, column: str, fallback: str) -> DataFrame:
    return df.withColumn(column, C.blank_fallback(column, fallback))


# P15
def with_constant(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.lit(value))


# P16
def route_by_status(lines: DataFrame, mode: str = "history", column: str = "cells") -> DataFrame:
    """Scraped table rows (array of cell texts): the third-last cell is the
    status. History keeps finished flights (not 'Scheduled'); live keeps rows
    whose first status token is Scheduled or Estimated."""
    status = F.element_at(F.col(column), -3)
    if mode == "history":
        return lines.filter(status != "Scheduled")
    if mode == "live":
        return lines.filter(C.token(status, " ", 0).isin("Scheduled", "Estimated"))
    raise ValueError("mode must be 'history' or 'live'")


# P17
def only_class(df: DataFrame, column: str = "status", value=1) -> DataFrame:
    return df.filter(F.col(column) == value)


# P18
def city_pair(df: DataFrame, departure: str | None = None, destination: str | None = None) -> DataFrame:
    """Optional lower-cased city filter; off when the arguments are None
    (the reference accepts them but does not apply the filter)."""
    if departure:
        df = df.filter(F.col("from_city") == departure.lower())
    if destination:
        df = df.filter(F.col("to_city") == destination.lower())
    return df


# P19
def nulls_to_empty(df: DataFrame) -> DataFrame:
    return df.select(*[C.empty_if_null(F.col(f"`{c}`")).alias(c) for c in df.columns])
