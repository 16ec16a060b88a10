"""End regions: start and end points that lie near each other, chained into regions, with their counts by sample.

Points are counted by position first. Within bins of the position, a point more than ``gap`` beyond the one before begins a
region; across bins, the last point of the bins before decides, and the region that runs into a bin is carried over to it.
So a chromosome is as many tasks as it has bins, and only a row a bin is ordered by chromosome.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.lineage import cut

LOCUS = ("chrom", "strand")


def _same(keys: tuple[str, ...], prefix: str):
    on = F.lit(True)
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return on


def chained(points: DataFrame, keys: tuple[str, ...] = LOCUS, gap: int = 50, width: int = 1 << 16) -> DataFrame:
    """Distinct (keys, pos) with n (sum of ``n``) and ``region``, the first position of the chain that it belongs to.

    Two points of a key are in one region if no step between neighbours on the way is longer than ``gap``. Null positions
    are in none and go.
    """
    counts = points.filter("pos is not null").groupBy(*keys, "pos").agg(F.sum("n").alias("n")).withColumn("bin", F.floor(F.col("pos") / width))
    counts = cut(counts, "points")
    order = Window.partitionBy(*keys).orderBy("bin")
    bins = counts.groupBy(*keys, "bin").agg(F.max("pos").alias("last")).select(*(F.col(k).alias(f"b_{k}") for k in keys), F.col("bin").alias("b_bin"), F.lag("last").over(order).alias("b_last"))
    inside = Window.partitionBy(*keys, "bin").orderBy("pos")
    before = F.coalesce(F.lag("pos").over(inside), "b_last")
    flagged = counts.join(bins, _same(keys, "b_") & (F.col("bin") == F.col("b_bin"))).withColumn("begin", F.when(before.isNull() | (F.col("pos") - before > gap), F.col("pos")))
    flagged = cut(flagged.select(*keys, "pos", "n", "bin", "begin"), "chains")
    carried = flagged.groupBy(*keys, "bin").agg(F.max("begin").alias("begin"))
    carried = carried.select(*(F.col(k).alias(f"b_{k}") for k in keys), F.col("bin").alias("b_bin"), F.last("begin", True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("b_begin"))
    region = F.coalesce(F.last("begin", True).over(inside.rowsBetween(Window.unboundedPreceding, 0)), "b_begin")
    return flagged.join(carried, _same(keys, "b_") & (F.col("bin") == F.col("b_bin"))).select(*keys, "pos", "n", region.alias("region"))


def end_regions(points: DataFrame, keys: tuple[str, ...] = LOCUS, gap: int = 50, min_reads: int = 1, width: int = 1 << 16) -> tuple[DataFrame, DataFrame]:
    """Regions (keys, start0, end0, n, n_pos, mode) of points (keys, sample, pos, n), and counts (keys, start0, sample, n).

    mode: the most frequent position, ties to the smallest. Regions of fewer than ``min_reads`` in all samples go, and
    their counts. A sample without points in a region has no row there.
    """
    placed = cut(chained(points, keys, gap, width), "placed")
    regions = placed.groupBy(*keys, F.col("region").alias("start0")).agg((F.max("pos") + 1).alias("end0"), F.sum("n").alias("n"), F.count("*").alias("n_pos"), (-F.max(F.struct("n", (-F.col("pos")).alias("p")))["p"]).alias("mode"))
    regions = regions.filter(F.col("n") >= min_reads)
    by_sample = points.filter("pos is not null").groupBy(*keys, "sample", "pos").agg(F.sum("n").alias("n"))
    large = placed if min_reads <= 1 else placed.join(regions.select(*(F.col(k).alias(f"r_{k}") for k in keys), F.col("start0").alias("r_start")), _same(keys, "r_") & (F.col("region") == F.col("r_start")), "left_semi")
    where = large.select(*(F.col(k).alias(f"p_{k}") for k in keys), F.col("pos").alias("p_pos"), "region")
    counts = by_sample.join(where, _same(keys, "p_") & (F.col("pos") == F.col("p_pos"))).groupBy(*keys, F.col("region").alias("start0"), "sample").agg(F.sum("n").alias("n"))
    return regions, counts


def in_regions(points: DataFrame, regions: DataFrame, keys: tuple[str, ...] = LOCUS, width: int = 1 << 12) -> DataFrame:
    """Points (keys, pos, ...) with the region (start0, end0, mode) that holds them, null in none; regions of a key don't overlap."""
    bins = F.explode(F.sequence(F.floor(F.col("start0") / width), F.floor((F.col("end0") - 1) / width)))
    held = regions.select(*(F.col(k).alias(f"r_{k}") for k in keys), F.col("start0").alias("region_start"), F.col("end0").alias("region_end"), F.col("mode").alias("region_mode"), bins.alias("r_bin"))
    inside = (F.floor(F.col("pos") / width) == F.col("r_bin")) & (F.col("pos") >= F.col("region_start")) & (F.col("pos") < F.col("region_end"))
    return points.join(held, _same(keys, "r_") & inside, "left").drop("r_bin", *(f"r_{k}" for k in keys))


def with_region_modes(tx: DataFrame, starts: DataFrame, ends: DataFrame) -> DataFrame:
    """Transcripts (chrom, strand, lo, hi) whose start and end move to the mode of the region that holds them.

    Points are those of ``coords.tss`` and ``tes``. An end in no region stays, and both do where they would cross.
    """
    minus = F.col("strand") == "-"
    rows = tx
    for name, regions in (("tss", starts), ("tes", ends)):
        own = F.when(minus, F.col("hi")).otherwise(F.col("lo")) if name == "tss" else F.when(minus, F.col("lo")).otherwise(F.col("hi"))
        rows = in_regions(rows.withColumn("pos", own), regions).withColumn(f"__{name}", F.coalesce("region_mode", "pos")).drop("pos", "region_start", "region_end", "region_mode")
    lo, hi = F.when(minus, F.col("__tes")).otherwise(F.col("__tss")), F.when(minus, F.col("__tss")).otherwise(F.col("__tes"))
    right = lo < hi
    return rows.withColumns({"__lo": F.when(right, lo).otherwise(F.col("lo")), "__hi": F.when(right, hi).otherwise(F.col("hi"))}).select(*(F.col(f"__{c}").alias(c) if c in ("lo", "hi") else F.col(f"`{c}`") for c in tx.columns))
