"""Interval joins by levels of bins, against plain pairs, and the copies that they make."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandloom.operators import levels
from strandloom.operators.intervals import interval_join

ROW = "chrom string, start0 long, end0 long, name string, b_start0 string"


def rows(rng, n, longest):
    out = []
    for i in range(n):
        s = rng.choice([0, 1023, 1024, 4096, 1 << 20, rng.randrange(3_000_000), -5])
        out.append((rng.choice(["a", "a", "b", None]), s, s + rng.choice([0, 1, 60, 1024, 1025, rng.randrange(1, longest)]), f"n{i}", "clash"))
    return out + [("a", None, 5, "x", None), ("a", 5, None, "y", None), ("a", 9, 3, "z", None), out[0], out[0]]


def meets(x, y):
    return x[0] is not None and x[0] == y[0] and None not in (*x[1:3], *y[1:3]) and x[2] > x[1] and y[2] > y[1] and x[1] < y[2] and y[1] < x[2]


@pytest.mark.parametrize(("long_a", "long_b"), [(100, 100), (50, 2_000_000), (2_000_000, 50), (2_000_000, 2_000_000)])
def test_pairs_are_those_that_overlap(spark, long_a, long_b):
    rng = random.Random(long_a + long_b)
    a, b = rows(rng, 150, long_a), rows(rng, 120, long_b)
    fa, fb = (levels.filed(spark.createDataFrame(x, ROW)) for x in (a, b))
    got = Counter((r.a_name, r.b_name) for r in levels.level_join(fa, fb).collect())
    assert got == Counter((x[3], y[3]) for x in a for y in b if meets(x, y))
    extra = F.col("b_end0") - F.col("a_start0") > 40
    for how in ("left_semi", "left_anti"):
        hit = [x for x in a if any(meets(x, y) and y[2] - x[1] > 40 for y in b)]
        want = Counter(hit) if how == "left_semi" else Counter(a) - Counter(hit)
        assert Counter(tuple(r) for r in levels.level_join(fa, fb, extra, how=how).collect()) == want
        assert Counter(tuple(r) for r in interval_join(spark.createDataFrame(a, ROW), spark.createDataFrame(b, ROW), extra, how=how).collect()) == want


def test_long_intervals_are_copied_by_levels_not_by_length(spark):
    """Spans of megabases beside exons: a fixed width of 4,096 would copy each span 1,000 times."""
    spans = spark.range(300).select(F.lit("a").alias("chrom"), (F.col("id") * 1000).alias("start0"), (F.col("id") * 1000 + 4_000_000).alias("end0"))
    exons = spark.range(20_000).select(F.lit("a").alias("chrom"), (F.col("id") * 200).alias("start0"), (F.col("id") * 200 + 60).alias("end0"))
    a, b = levels.filed(exons), levels.filed(spans)
    assert (a.levels, b.levels) == ((0,), (6,))
    of_a, of_b = levels.copies(a, b)
    assert of_a <= 2 * 20_000 * 2 and of_b <= 2 * 300 * 2
    assert levels.level_join(a, b, how="left_semi").count() == 20_000


def test_empty_sides(spark):
    df = spark.createDataFrame([("a", 1, 5, "n", None)], ROW)
    assert levels.level_join(df.limit(0), df).count() == levels.level_join(df, df.limit(0)).count() == 0
    assert levels.level_join(df, df.limit(0), how="left_anti").count() == 1
    assert levels.level_join(df, df).columns == [f"{p}{c}" for p in ("a_", "b_") for c in df.columns]


def test_levels_that_cannot_meet_are_not_sent(spark):
    """Short intervals on both sides: one join, not a second one whose other side is empty; with a longer one there are two."""
    a = spark.createDataFrame([(i, "c", 100 * i, 100 * i + 60) for i in range(50)], "id int, chrom string, start0 long, end0 long")
    b, long = a.filter("id % 7 = 0"), a.limit(1).selectExpr("-1 as id", "chrom", "0L as start0", "5000L as end0")
    joins = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
    met = levels.level_join(a, b)
    assert joins(met) == 1 and met.count() == 8
    assert joins(levels.level_join(a.unionByName(long), b)) == 2
    assert sorted((r.a_id, r.b_id) for r in levels.level_join(b, a.unionByName(long)).collect()) == sorted([(i, i) for i in range(0, 50, 7)] + [(i, -1) for i in range(0, 50, 7)])
    assert levels.level_join(a, b.limit(0)).count() == 0 and levels.level_join(a, b.limit(0), how="left_anti").count() == 50
