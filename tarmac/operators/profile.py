"""Aggregations and profiles (A1-A12) plus dedup / sort / head.

Everything is a grouped aggregate with map-side partial aggregation; the
only global orders are final sorts of small grouped results, and the
quantiles use the distributed positions of ``ranking``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.operators.ranking import quantiles_of_counts, value_counts as counts_of_values


# A1
def count_by(df: DataFrame, key: str, descending: bool = True) -> DataFrame:
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.desc("count") if descending else F.asc("count"), F.asc(key))


# A3 / A4 / A5
def global_stats(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(column).alias(f"mean_{column}"),
        F.min(column).alias(f"min_{column}"),
        F.max(column).alias(f"max_{column}"),
    )


# A6 / A12
def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Absolute and normalised counts; the total is a scalar subquery."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("share", F.col("count") / total)


# A7
def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: null count and whether any null exists."""
    per_col = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    stacked = per_col.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls")) for c in df.columns
    ])).alias("s")).select("s.*")
    return stacked.withColumn("has_null", F.col("nulls") > 0)


# A8
def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of identical rows."""
    groups = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"))


# A9
def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear interpolation), max
    per numeric column - one row per column."""
    vc = counts_of_values(df, columns)
    n = F.sum(F.when(F.col("value").isNotNull(), F.col("cnt")))
    sums = vc.groupBy("column").agg(F.coalesce(n, F.lit(0)).alias("count"), (F.sum(F.col("value") * F.col("cnt")) / n).alias("mean"),
                                    F.min("value").alias("min"), F.max("value").alias("max"))
    spread = vc.join(F.broadcast(sums.select("column", "mean", F.col("count").alias("n"))), "column").groupBy("column", "n").agg(  # sums: one row per column
        F.sum(F.pow(F.col("value") - F.col("mean"), F.lit(2)) * F.col("cnt")).alias("d2"))
    moments = sums.join(spread, "column").withColumn("std", F.when(F.col("n") > 1, F.sqrt(F.col("d2") / (F.col("n") - 1))))
    q = quantiles_of_counts(vc, [0.25, 0.5, 0.75])
    return moments.join(q, "column", "left").select(
        "column", "count", "mean", "std", "min",
        F.col("q25").alias("p25"), F.col("q50").alias("p50"), F.col("q75").alias("p75"), "max")


# A10
def box_summary(df: DataFrame, columns: list[str], whisker: float = 1.5) -> DataFrame:
    """Box-plot numbers: quartiles, whisker ends (most extreme values inside
    q1 - 1.5 IQR / q3 + 1.5 IQR) and the count of values outside."""
    vc = counts_of_values(df, columns).filter(F.col("value").isNotNull())
    q = quantiles_of_counts(vc, [0.25, 0.75]).select(
        "column", F.col("q25").alias("q1"), F.col("q75").alias("q3"))
    q = q.withColumns({
        "lo_fence": F.col("q1") - whisker * (F.col("q3") - F.col("q1")),
        "hi_fence": F.col("q3") + whisker * (F.col("q3") - F.col("q1")),
    })
    j = vc.join(F.broadcast(q), "column")  # q: one row per column
    inside = (F.col("value") >= F.col("lo_fence")) & (F.col("value") <= F.col("hi_fence"))
    return j.groupBy("column", "q1", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("cnt"))), F.lit(0)).alias("outliers"))


# A11
def kde_grid(df: DataFrame, column: str, gridsize: int = 200, cut: float = 3.0, bins: int | None = None) -> DataFrame:
    """Gaussian kernel density on an evenly spaced grid (Scott bandwidth:
    sample std * n^(-1/5); grid from min - cut*bw to max + cut*bw).

    Equal values are pre-aggregated first; each distinct value then adds its
    weighted kernel to every grid point (explode of a fixed-size grid, not a
    join of rows with rows) and the sums are a grouped aggregate.

    With ``bins`` a column of very many values is linearly binned first: each
    value is shared by the two ends of its bin (``bins`` equal ones from min to
    max, width d), and an end adds its kernel to the grid points within eight
    bandwidths. The kernels then number ``bins + 1`` at most, whatever the
    values, and a density is off by at most d^2 / (8 sqrt(2 pi) bw^3) + 2e-14 / bw.
    """
    vc = counts_of_values(df, [column]).filter(F.col("value").isNotNull()).select(F.col("value").alias("x"), "cnt")
    # Global statistics of the counts as scalar subqueries; no row-to-row join.
    n = vc.select(F.coalesce(F.sum("cnt"), F.lit(0))).scalar()
    mean = vc.select(F.sum(F.col("x") * F.col("cnt")) / F.sum("cnt")).scalar()
    d2 = vc.select(F.sum(F.pow(F.col("x") - mean, F.lit(2)) * F.col("cnt"))).scalar()
    bw = F.when(n > 1, F.sqrt(d2 / (n - 1)) * F.pow(n, F.lit(-0.2)))
    lo = vc.select(F.min("x")).scalar()
    hi = vc.select(F.max("x")).scalar()
    start = lo - cut * bw
    step = (hi - lo + 2 * cut * bw) / (gridsize - 1)
    first, last = F.lit(0), F.lit(gridsize - 1)
    if bins:
        width = (hi - lo) / bins
        at = F.when(width > 0, (F.col("x") - lo) / width).otherwise(0.0)
        low = F.least(F.floor(at), F.lit(bins - 1))
        ends = F.array(F.struct(low.alias("j"), ((1 - (at - low)) * F.col("cnt")).alias("w")), F.struct((low + 1).alias("j"), ((at - low) * F.col("cnt")).alias("w")))
        vc = vc.select(F.inline(ends)).groupBy("j").agg(F.sum("w").alias("cnt")).select((lo + F.col("j") * width).alias("x"), "cnt")
        first = F.greatest(first, F.ceil((F.col("x") - 8 * bw - start) / step).cast("int"))
        last = F.least(last, F.floor((F.col("x") + 8 * bw - start) / step).cast("int"))
    pts = vc.select("x", "cnt", F.explode(F.sequence(first, last)).alias("i"))
    pts = pts.withColumn("g", start + F.col("i") * step)
    z = (F.col("g") - F.col("x")) / bw
    contrib = F.col("cnt") * F.exp(-0.5 * z * z)
    dens = pts.groupBy("i").agg(F.sum(contrib).alias("s"))
    grid = df.sparkSession.range(gridsize).select(F.col("id").cast("int").alias("i"), (start + F.col("id") * step).alias("g")).filter(F.col("g").isNotNull())
    return grid.join(dens, "i", "left").select(F.col("i").alias("point"), F.col("g").alias("value"),
                       (F.coalesce("s", F.lit(0.0)) / (n * bw * math.sqrt(2 * math.pi))).alias("density"))


# W1
def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


# W3 / W4
def top(df: DataFrame, order: list, n: int | None = None) -> DataFrame:
    """Sorted rows; with ``n`` only the first n (a top-k report)."""
    out = df.orderBy(*order)
    return out.limit(n) if n else out
