"""Scans over a group that holds most rows, split over tasks, against a plain loop."""

import numpy as np
from pyspark.sql import functions as F

from tarmac.operators import pages, ranking, scoring


def labels(n=3000, seed=4):
    rng = np.random.default_rng(seed)
    rows = [(1 if i % 3 else int(rng.integers(2, 40)), i * 7 % 100_003, f"{rng.integers(1, 13)} {'ap'[rng.integers(2)]}m") for i in range(n)]
    return rows + [(99, 5, "7 am"), (98, 1, "11 pm"), (98, 2, "12 am")]


def test_day_rollover_over_segments(spark):
    rows, want = labels(), {}
    for g in {r[0] for r in rows}:
        day, last = 0, None
        for _, o, h in sorted(r for r in rows if r[0] == g):
            day += last is None or ("am" in h and "pm" in last)
            last, want[g, o] = h, day
    df = spark.createDataFrame(rows, "g int, o long, hour string").repartition(5)
    for size in (100, 10**6):
        got = pages.day_rollover(df, "g", "o", rows_per_bucket=size)
        assert got.columns == ["g", "o", "hour", "day_offset"]
        assert {(r.g, r.o): r.day_offset for r in got.collect()} == want
    buckets = ranking.segments(df, "g", "o", 100).filter("g = 1").groupBy("_bucket").count().collect()
    assert len(buckets) > 10 and max(b["count"] for b in buckets) < 600  # the hot group is not in one task


def test_header_dates_over_segments(spark):
    rng = np.random.default_rng(6)
    rows = [(int(i % 4 == 0), i, [f"May {i}, 2024"] if rng.random() < 0.01 else ["a", str(i)]) for i in range(3000)]
    last, want = {}, set()
    for p, i, c in rows:
        if len(c) == 1:
            last[p] = c[0].replace(",", "")
        else:
            want.add((p, i, last.get(p)))
    df = spark.createDataFrame(rows, "page_id int, pos int, cells array<string>").repartition(5)
    got = pages.carry_header_dates(df, rows_per_bucket=150)
    assert {(r.page_id, r.pos, r.header_date) for r in got.collect()} == want


def test_one_failing_comment_does_not_fail_its_batch(spark):
    def classifier(batch):
        if batch.str.contains("bad").any():
            raise ValueError("no reply")
        return ["positive" if "good" in x else "negative" for x in batch]

    df = spark.createDataFrame([("good 1",), ("bad 2",), ("poor 3",), ("good 4",)], "comment string").coalesce(1)
    got = {r.comment: r.sentiment for r in scoring.score_comments(df, classifier).collect()}
    assert got == {"good 1": 1, "bad 2": -1, "poor 3": 0, "good 4": 1}
