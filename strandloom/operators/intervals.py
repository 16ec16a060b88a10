"""Interval joins, unions and subtraction by equi-joins and windows.

Spark has no range join: an overlap predicate alone is a nested loop. Here both sides are cut at the borders of fixed
bins and joined on (chromosome, bin); a pair is kept only in the bin where its overlap begins, so there is nothing to
make distinct. Long intervals take several bins, so the bin width should be near the longer side's usual length:
``bin_width`` measures it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.lineage import cut

BIN = 4096


def binned(df: DataFrame, start: Column, end: Column, width: int = BIN) -> DataFrame:
    """``df`` once for each bin that [start, end) touches, with the bin's number; empty intervals have none."""
    first, last = F.floor(start / width), F.floor((end - 1) / width)
    return df.filter(end > start).withColumn("__bin", F.explode(F.sequence(first, last)))


def bin_width(df: DataFrame, least: int = BIN, most: int = 1 << 24) -> int:
    """A power of two near the length that nine in ten intervals of ``df`` stay below; one number comes to the driver."""
    long = df.agg(F.percentile_approx(F.col("end0") - F.col("start0"), 0.9, 1000).alias("w")).first()["w"]
    return max(least, min(most, 1 << int(long or 0).bit_length()))


def interval_join(a: DataFrame, b: DataFrame, extra: Column | None = None, keys: tuple[str, ...] = ("chrom",), how: str = "inner", width: int = BIN) -> DataFrame:
    """Pairs of rows of ``a`` (columns prefixed a_) and ``b`` (b_) that share at least one base, equal on ``keys``.

    Both have start0 and end0. ``extra``: a further condition on prefixed columns. how: ``inner``, ``left_semi`` or
    ``left_anti`` (rows of ``a``, its own columns unprefixed). Null keys never match. Skewed bins fall to Spark's
    handling of skewed joins.
    """
    own = a
    if how != "inner":  # written with a number for each row, which alone goes through the join and back
        own = cut(a.withColumn("___row", F.monotonically_increasing_id()), "intervals")
    left = own.select(*(F.col(f"`{c}`").alias(f"a_{c}") for c in own.columns))
    right = b.select(*(F.col(f"`{c}`").alias(f"b_{c}") for c in b.columns))
    lb = binned(left, F.col("a_start0"), F.col("a_end0"), width).withColumnRenamed("__bin", "__ba")
    rb = binned(right, F.col("b_start0"), F.col("b_end0"), width).withColumnRenamed("__bin", "__bb")
    on = F.col("__ba") == F.col("__bb")
    for k in keys:
        on &= F.col(f"a_{k}") == F.col(f"b_{k}")
    on &= (F.col("a_start0") < F.col("b_end0")) & (F.col("b_start0") < F.col("a_end0"))
    on &= F.col("__ba") == F.floor(F.greatest("a_start0", "b_start0") / width)
    if extra is not None:
        on &= extra
    if how == "inner":
        return lb.join(rb, on).drop("__ba", "__bb")
    hits = lb.join(rb, on, "left_semi").select(F.col("a____row").alias("h")).distinct()
    return own.join(hits, F.col("___row") == F.col("h"), how).select(*(F.col(f"`{c}`") for c in a.columns))


def _islands(df: DataFrame, keys: tuple[str, ...], touching: bool) -> DataFrame:
    """Merged intervals of each key, by a running maximum of the ends before."""
    w = Window.partitionBy(*keys).orderBy("start0", "end0")
    reach = F.max("end0").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = reach.isNull() | ((F.col("start0") > reach) if touching else (F.col("start0") >= reach))
    rows = df.select(*keys, "start0", "end0").withColumn("__new", new.cast("int"))
    rows = rows.withColumn("__g", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "__g").agg(F.min("start0").alias("start0"), F.max("end0").alias("end0")).drop("__g")


def union_intervals(df: DataFrame, keys: tuple[str, ...] = ("chrom",), touching: bool = True, width: int = 1 << 16) -> DataFrame:
    """Merged intervals by ``keys``: overlapping ones fuse, and touching ones (half-open end = start) if asked.

    First within bins of their starts, by as many tasks as there are bins; then what is left, by key. What is left is
    disjoint within a bin, so the last step reads no more than the genome's size allows, however many rows came in.
    """
    local = _islands(df.withColumn("__bin", F.floor(F.col("start0") / width)), (*keys, "__bin"), touching)
    return _islands(local, keys, touching)


def subtract_intervals(a: DataFrame, b: DataFrame, own: tuple[str, ...], keys: tuple[str, ...] = ("chrom",), extra: Column | None = None, width: int = BIN) -> DataFrame:
    """Rows of ``a`` without the bases that overlapping rows of ``b`` cover: an interval may split or go.

    ``own`` names the columns that identify a row of ``a`` beside its interval. A row's hits are gathered beside it as
    one sorted array: cuts of one interval, not of a whole chromosome.
    """
    hits = interval_join(a, b, extra, keys, width=width).groupBy(*(f"a_{c}" for c in (*own, "start0", "end0"))).agg(F.array_sort(F.collect_set(F.struct(F.col("b_start0").alias("s"), F.col("b_end0").alias("e")))).alias("cuts"))
    on = None
    for c in (*own, "start0", "end0"):
        on = (F.col(c).eqNullSafe(F.col(f"a_{c}"))) if on is None else on & F.col(c).eqNullSafe(F.col(f"a_{c}"))
    rows = a.join(hits, on, "left").select(*a.columns, "cuts")
    kind = "array<struct<start0:bigint,end0:bigint>>"
    piece = lambda s, e: F.when(e > s, F.array(F.struct(s.alias("start0"), e.alias("end0"))).cast(kind)).otherwise(F.array().cast(kind))
    left = F.aggregate(
        F.coalesce("cuts", F.array().cast("array<struct<s:bigint,e:bigint>>")),
        F.struct(F.col("start0").cast("bigint").alias("at"), F.array().cast(kind).alias("out")),
        lambda acc, c: F.struct(F.greatest(acc["at"], c["e"]).alias("at"), F.concat(acc["out"], piece(acc["at"], F.least(c["s"], F.col("end0")))).alias("out")),
        lambda acc: F.concat(acc["out"], piece(acc["at"], F.col("end0").cast("bigint"))),
    )
    return rows.withColumn("__left", left).drop("start0", "end0", "cuts").withColumn("__p", F.explode("__left")).select(*(c for c in a.columns if c not in ("start0", "end0")), "__p.start0", "__p.end0")
