"""Mixing sources to target weights as a time-varying curriculum, with DataFrame functions only.

Each source has a weight schedule w(t) over training time t in [0, 1], piecewise linear between knots.
Its integral is the source's share of the mix; shares become targets in words, limited to
``max_repeats`` passes over the source (what is above the limit goes to the others by weight). A
source's cumulative demand at time t is target * integral(0..t) / integral(0..1). Its documents lie
one after another, in hash order, on the axis of words, pass after pass; the demand curve is inverted at
the middle of each document's copy, which gives the copy's training position. A copy whose middle lies
beyond the target has no position and is not taken. ``curriculum`` range-sorts copies by position.

Defined results: null, empty and white-space texts have size 0 and are never taken. A null source is a
source of its own, last in order. Rows that are equal in id, source and size are interchangeable: which
of them is taken is not told, how many is. An empty table gives an empty result. Input columns named
like a result (``size source_size target taken positions position``) are replaced; others pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm import common as C

NEW = ["size", "source_size", "target", "taken", "positions", "position"]
BUCKET_DIGITS = 4


def cyclic_schedules(sources: DataFrame, weights=(3, 1, 2)) -> DataFrame:
    """(source, knots): sources by code point, null last, get ``weights`` in turn as the integrals of
    schedules that fall (x1.5 to x0.5), stay level, or rise (x0.5 to x1.5). One row a source."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    tilt = [0.5, 0.0, -0.5]
    knot = lambda t, w: F.struct(F.lit(float(t)).alias("t"), F.lit(float(w)).alias("w"))
    kinds = F.array(*[F.array(knot(0, w * (1 + tilt[i % 3])), knot(0.5, w), knot(1, w * (1 - tilt[i % 3])))
                      for i, w in enumerate(weights)])
    return sources.select("source").distinct().select("source", kinds[rank % len(weights)].alias("knots"))


def _segments(knots):
    """Knots to segments with the integral before and after each: (t0, dt, w0, w1, c0, c1)."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(knots) - 1), lambda i: F.struct(
        F.get(knots, i - 1)["t"].alias("t0"), (F.get(knots, i)["t"] - F.get(knots, i - 1)["t"]).alias("dt"),
        F.get(knots, i - 1)["w"].alias("w0"), F.get(knots, i)["w"].alias("w1")))
    empty = F.array().cast("array<struct<t0:double,dt:double,w0:double,w1:double,c0:double,c1:double>>")

    def add(acc, s):
        c0 = F.coalesce(F.try_element_at(acc, F.lit(-1))["c1"], F.lit(0.0))
        c1 = c0 + s["dt"] * (s["w0"] + s["w1"]) / 2
        return F.concat(acc, F.array(F.struct(s["t0"].alias("t0"), s["dt"].alias("dt"), s["w0"].alias("w0"),
                                              s["w1"].alias("w1"), c0.alias("c0"), c1.alias("c1"))))

    return F.aggregate(pairs, empty, add)


def _invert(segs, demand):
    """t at which the integral of the schedule reaches ``demand``: a root of a quadratic in one segment."""
    s = F.get(F.filter(segs, lambda x: x["c1"] > demand), 0)
    s = F.coalesce(s, F.try_element_at(segs, F.lit(-1)))
    r = demand - s["c0"]
    root = F.sqrt(F.greatest(F.lit(0.0), s["w0"] * s["w0"] + 2 * (s["w1"] - s["w0"]) / s["dt"] * r))
    return s["t0"] + F.when(r <= 0, F.lit(0.0)).otherwise(F.least(s["dt"], 2 * r / (s["w0"] + root)))


def source_targets(sizes: DataFrame, schedules: DataFrame, share: float, max_repeats: int) -> DataFrame:
    """(_s, source_size, target, segs), one row a source, from (_s, source, source_size).

    target = min(limit, level * weight), the level such that targets add up to ``share`` of all words:
    sources by limit / weight; those before the first that stays below its limit are at theirs."""
    s = sizes.join(schedules.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_s"), "knots"), "_s")
    s = s.select("_s", "source_size", _segments(F.col("knots")).alias("segs"))
    s = s.select("*", F.try_element_at("segs", F.lit(-1))["c1"].alias("w"), (F.col("source_size") * max_repeats).alias("cap"))
    by = Window.orderBy(F.col("cap") / F.col("w"), "_s")  # one row a source
    before, rest = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()).cast("double") * share
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0)).cast("double")) / F.sum("w").over(rest)
    s = s.select("*", level.alias("level")).select("*", (F.col("cap") <= F.col("level") * F.col("w")).alias("full"))
    level = F.min_by(F.when(~F.col("full"), F.col("level")), F.when(~F.col("full"), F.struct(F.col("cap") / F.col("w"), "_s"))).over(Window.partitionBy())
    cap = F.col("cap").cast("double")
    return s.select("_s", "source_size", "segs", "w", F.coalesce(F.least(cap, level * F.col("w")), cap).alias("target"))


def assign_positions(docs: DataFrame, schedules: DataFrame | None = None, share: float = 1.5, max_repeats: int = 2,
                     seed: str = "mix") -> DataFrame:
    """``docs`` with size, source_size, target, taken and positions (one training position in [0, 1) for
    each copy that the mix takes), one row a document.

    Word offsets inside a source are sums: words per (source, hash prefix) before the document's bucket,
    added up in two levels of 256 prefixes each, and a window inside the bucket. Buckets are a function of the id alone, 65,536 a source, so
    a source with a third of all rows is spread and the offsets agree on every run.
    """
    schedules = cyclic_schedules(docs) if schedules is None else schedules
    row = F.struct(*[F.col(f"`{c}`") for c in C.keep_columns(docs, NEW)])
    d = docs.select(row.alias("_row"), F.coalesce(F.regexp_count("text", F.lit(C.WORD)), F.lit(0)).cast("long").alias("size"),
                    F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_s"),
                    F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")).alias("_h"))
    d = d.withColumn("_b", F.substring("_h", 1, BUCKET_DIGITS))
    buckets = d.groupBy("_s", "_b").agg(F.sum("size").alias("n"))
    targets = source_targets(buckets.groupBy("_s").agg(F.sum("n").alias("source_size")), schedules, share, max_repeats)
    buckets = buckets.withColumn("_c", F.substring("_b", 1, BUCKET_DIGITS // 2))
    summed = lambda by, order: F.coalesce(F.sum("n").over(
        Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    coarse = buckets.groupBy("_s", "_c").agg(F.sum("n").alias("n")).withColumn("off_c", summed(["_s"], "_c")).drop("n")
    offsets = (buckets.withColumn("off_b", summed(["_s", "_c"], "_b")).join(coarse.join(targets, "_s"), ["_s", "_c"])
               .withColumn("off", F.col("off_b") + F.col("off_c")).drop("n", "off_b", "off_c", "_c"))
    inside = Window.partitionBy("_s", "_b").orderBy("_h", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, ["_s", "_b"])
    middle = lambda k: k * F.col("source_size") + F.col("off") + F.col("_in") + F.col("size") / 2
    copies = [F.when((F.col("size") > 0) & (middle(k) < F.col("target")), _invert(F.col("segs"), middle(k) / F.col("target") * F.col("w")))
              for k in range(max_repeats)]
    return d.select("_row.*", "size", "source_size", "target", F.array_compact(F.array(*copies)).alias("positions")) \
            .withColumn("taken", F.size("positions") * F.col("size"))


def range_sorted(df: DataFrame, position: str) -> DataFrame:
    """Rows in ascending order of position across partitions; a null position is last."""
    order = [F.col(position).asc_nulls_last(), F.col("doc_id")]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def curriculum(docs: DataFrame, schedules: DataFrame | None = None, share: float = 1.5, max_repeats: int = 2,
               seed: str = "mix") -> DataFrame:
    """The mix itself: one row a copy, with its ``position``, range-sorted by it."""
    a = assign_positions(docs, schedules, share, max_repeats, seed)
    return range_sorted(a.withColumn("position", F.explode("positions")).drop("positions"), "position")


def op9_query(spark, sf_dir):
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    a = assign_positions(docs).select("doc_id", "size", "source_size", "target", "taken", F.get("positions", F.lit(0)).alias("first_position"))
    return range_sorted(a, "first_position").drop("first_position")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s AS (SELECT *, ([3.0, 1.0, 2.0])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w, 2 * source_size AS cap FROM s0),
l AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
        - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
        / sum(w) OVER (ORDER BY cap / w, source NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s),
f AS (SELECT min_by(level, cap / w) AS level FROM l WHERE cap > level * w),
t AS (SELECT source, source_size, coalesce(least(cap::DOUBLE, (SELECT level FROM f) * w), cap::DOUBLE) AS target FROM s),
p AS (SELECT d.*, t.source_size, t.target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE size * ((start + size / 2.0::DOUBLE < target)::BIGINT
         + (source_size + start + size / 2.0::DOUBLE < target)::BIGINT) END AS taken
FROM p
"""
