"""Distributed running positions - the scalable form of ``row_number()`` /
cumulative counts over a global order.

A window without ``PARTITION BY`` (or partitioned by a low-cardinality key
such as a class label) puts every row of a group into one task. Here rows
get a bucket by comparing (group, order) with bounds that are fixed once, as
literals; each bucket counts its rows per group (at most buckets x groups
rows, so its broadcast is bounded), the counts are turned into offsets, and
positions inside a bucket are added to the offset. A row's bucket depends on
its values alone, so both uses of the table agree whatever Spark samples,
coalesces or runs again. Used for dense codes (M1) and exact quantiles (A9,
A10); the stratified split (M4) needs no order of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET, MAX_BUCKETS, SAMPLES_PER_BUCKET = 500_000, 512, 40


def value_buckets(df: DataFrame, columns: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> Column:
    """Bucket number of a row in the order of ``columns``: how many bounds are
    at or below it. Bounds are evenly spaced in a sample of rows chosen by a
    hash of the columns (at most MAX_BUCKETS x SAMPLES_PER_BUCKET rows reach
    the driver); they only affect how evenly rows are dealt."""
    n = df.count()
    buckets = min(MAX_BUCKETS, -(-n // rows_per_bucket))
    if buckets < 2:
        return F.lit(0)
    rate = min(1.0, buckets * SAMPLES_PER_BUCKET / n)
    part = F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < int(rate * (1 << 30))
    sample = df.filter(part).select(*columns).orderBy(*columns).limit(2 * MAX_BUCKETS * SAMPLES_PER_BUCKET).collect()
    rows = [sample[len(sample) * i // buckets] for i in range(1, buckets) if sample]
    types = {f.name: f.dataType for f in df.schema.fields}
    bounds = [F.struct(*[F.lit(r[c]).cast(types[c]).alias(c) for c in columns]) for r in dict.fromkeys(rows)]
    key = F.struct(*[F.col(c).alias(c) for c in columns])
    return F.size(F.filter(F.array(*bounds), lambda b: b <= key)) if bounds else F.lit(0)


def running_position(df: DataFrame, order_cols: list[str], group_cols: list[str] | None = None,
                     weight: str | None = None, out: str = "_start",
                     rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``out`` = total weight (row count when ``weight`` is None) of the
    rows that come before each row inside its group, in ``order_cols`` order.

    ``order_cols`` must order rows totally within a group (unique keys);
    callers pre-aggregate equal values so that hot values cannot pile up in
    one bucket.
    """
    groups = list(group_cols or [])
    w = F.col(weight) if weight else F.lit(1)
    dealt = df.withColumn("_w", w.cast("long")).withColumn(
        "_bucket", value_buckets(df, [*groups, *order_cols], rows_per_bucket))
    counts = dealt.groupBy("_bucket", *groups).agg(F.sum("_w").alias("_n"))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", *groups, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_bucket", *groups).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    return (dealt.join(F.broadcast(offsets), ["_bucket", *groups])
                 .withColumn(out, F.col("_off") + F.coalesce(F.sum("_w").over(inside), F.lit(0)))
                 .drop("_bucket", "_off", "_w"))


def segments(df: DataFrame, group: str, order: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``df``, written, with ``_bucket``: a group's rows in one bucket follow
    each other in ``order``, so a group is a chain of segments (group, bucket)
    of bounded size. Windows run inside segments; what a segment hands on is
    carried over the few rows of ``chained``."""
    from tarmac.plans.tables import materialize

    held = materialize(df)
    return held.withColumn("_bucket", value_buckets(held, [group, order], rows_per_bucket))


def chained(parts: DataFrame, group: str) -> Window:
    """Window over the segments of a group before each: at most MAX_BUCKETS rows a group."""
    return Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)


def carried(df: DataFrame, group: str, order: str, value: Column, out: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``out``: the last non-null ``value`` at or before each row of its group.
    A group that holds most rows is split over tasks."""
    rows = segments(df.withColumn(out, value), group, order, rows_per_bucket)
    here = Window.partitionBy("_bucket", group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.filter(F.col(out).isNotNull()).groupBy("_bucket", group).agg(F.max_by(out, order).alias("_end"))
    parts = rows.select("_bucket", group).distinct().join(ends, ["_bucket", group], "left")
    parts = parts.select("_bucket", group, F.last("_end", ignorenulls=True).over(chained(parts, group)).alias("_before"))
    last = rows.withColumn(out, F.last(out, ignorenulls=True).over(here)).join(parts, ["_bucket", group])
    return last.withColumn(out, F.coalesce(out, "_before")).select(*df.columns, *([] if out in df.columns else [out]))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, cnt) of several numeric columns, nulls counted too: one
    pass over ``df``, hot values collapse map-side. Written, so that counts,
    moments and positions read it and not ``df`` again."""
    from tarmac.plans.tables import materialize

    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value"))
        for c in columns])).alias("s")).select("s.*")
    return materialize(stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt")))


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / DuckDB
    ``quantile_cont``) for several numeric columns: one row per column, one
    ``q<p>`` column per probability (e.g. ``q25``)."""
    return quantiles_of_counts(value_counts(df, columns), probs, rows_per_bucket)


def quantiles_of_counts(counts: DataFrame, probs: list[float], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Quantiles of ``value_counts``: values are positioned with
    ``running_position`` and the two around ``p * (n - 1)`` interpolated."""
    vc = counts.filter(F.col("value").isNotNull())
    pos = running_position(vc, ["value"], ["column"], weight="cnt", rows_per_bucket=rows_per_bucket)
    totals = vc.groupBy("column").agg(F.sum("cnt").alias("n"))
    pos = pos.join(F.broadcast(totals), "column")
    # For each probability, the values at floor/ceil of p*(n-1).
    aggs = []
    for p in probs:
        h = F.lit(p) * (F.col("n") - 1)
        lo, hi = F.floor(h), F.ceil(h)
        covers = lambda k: (F.col("_start") <= k) & (k < F.col("_start") + F.col("cnt"))
        name = _qname(p)
        aggs += [
            F.max(F.when(covers(lo), F.col("value"))).alias(f"{name}_lo"),
            F.max(F.when(covers(hi), F.col("value"))).alias(f"{name}_hi"),
            F.max(h - lo).alias(f"{name}_f"),
        ]
    q = pos.groupBy("column").agg(*aggs)
    return q.select("column", *[
        (F.col(f"{_qname(p)}_lo") + (F.col(f"{_qname(p)}_hi") - F.col(f"{_qname(p)}_lo")) * F.col(f"{_qname(p)}_f"))
        .alias(_qname(p)) for p in probs])


def _qname(p: float) -> str:
    return "q" + (f"{p * 100:g}").replace(".", "_")
