"""Pruning of rare isoforms within clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.lineage import Observation, cut

from .expression import dense, samples_of
from .numbering import MOST_ROWS, running


def scored(expr: DataFrame, clusters: DataFrame, score: str = "sum", samples: list | None = None, *more: Column) -> DataFrame:
    """clusters with expr_sum, expr_max, expr_mean over all samples (missing values are 0), score, and ``more`` aggregates (named) of a transcript's rows."""
    samples = samples_of(expr) if samples is None else samples
    n = len(samples)
    sums = expr.groupBy("tx").agg(F.sum("value").cast("double").alias("expr_sum"), F.max("value").cast("double").alias("m"), F.count("*").alias("c"), *more)
    top = F.when(F.col("c") < n, F.greatest("m", F.lit(0.0))).otherwise(F.col("m"))
    rows = clusters.join(sums, "tx").select(*clusters.columns, "expr_sum", top.alias("expr_max"), (F.col("expr_sum") / n).alias("expr_mean"), *(c for c in sums.columns if c not in ("tx", "expr_sum", "m", "c")))
    return rows.withColumn("score", F.col(f"expr_{score}"))


def _per_cluster(rows: DataFrame, by: DataFrame) -> DataFrame:
    """``rows`` with what ``by`` (cluster, ...) says of their cluster."""
    return rows.join(by, F.col("cluster_id").eqNullSafe(F.col("cluster"))).drop("cluster")


def keep_percentile(rows: DataFrame, pct: float = 98.0, min_keep: int = 1, most: int = MOST_ROWS) -> DataFrame:
    """Adds kept and cutoff: the best max(min_keep, ceil(pct %)) of each cluster by score, ties by tx. Clusters of more than ``most`` are ranked in ranges."""
    ranked = running(cut(rows, "scored"), ["cluster_id"], [F.desc("score"), F.asc("tx")], most=most)
    quota = F.greatest(F.lit(min_keep), F.least(F.col("n"), F.ceil(F.lit(pct / 100) * F.col("n"))))
    ranked = cut(ranked.withColumn("kept", F.col("rank") <= quota).select(*rows.columns, "kept"), "ranked")
    return _per_cluster(ranked, ranked.groupBy(F.col("cluster_id").alias("cluster")).agg(F.min(F.when(F.col("kept"), F.col("score"))).alias("cutoff")))


def cumulative_keep(values: DataFrame, fraction: float, most: int = MOST_ROWS) -> DataFrame:
    """Rows (cluster_id, sample, tx, value), and whether each is in the smallest prefix, by value, that reaches ``fraction`` of its total (kept).

    Where rounding leaves the last running sum below the mark, all rows are in; some tools keep one row then, which is
    an accident of theirs and not followed. Clusters of more than ``most`` rows in a sample are summed in ranges.
    """
    v = F.greatest("value", F.lit(0.0))
    summed = running(values, ["cluster_id", "sample"], [F.desc(v), F.asc("tx")], {"v": v}, most)
    return summed.withColumn("kept", (F.col("total_v") > 0) & (F.col("before_v") < fraction * F.col("total_v"))).select(*values.columns, "kept")


def sample_support(expr: DataFrame, clusters: DataFrame, min_rel: float = 0.0, pct: float | None = 97.0, min_samples: int = 2, min_keep: int = 1, score: str = "sum", samples: list | None = None, most: int = MOST_ROWS) -> DataFrame:
    """scored rows with passes (samples that support) and kept.

    A sample supports a transcript that has at least ``min_rel`` of the cluster's largest value, or belongs to the
    smallest prefix that makes up ``pct`` % of the cluster. Kept: at least ``min_samples`` of them; a cluster that
    keeps fewer than ``min_keep`` keeps its best by score instead. With fewer samples than ``min_samples`` that is
    what happens everywhere.
    """
    if min_rel <= 0 and pct is None:
        raise ValueError("sample support needs min_rel above 0, or pct")
    samples = samples_of(expr) if samples is None else samples
    asked = [s for s in samples if s is not None]
    cell = F.when(F.col("sample").isin(asked), F.struct("sample", F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value")))
    rows = cut(scored(expr, clusters, score, samples, F.collect_list(cell).alias("cells")), "scored")  # read twice
    many = Observation()
    large = rows.groupBy(F.col("cluster_id").alias("cluster")).agg(F.count("*").alias("n")).filter(F.col("n") > most).select("cluster")
    large = cut(large, "large-clusters", (many, F.count("*").alias("n")))
    if not many.get["n"]:
        return _supported(rows, min_rel, pct, min_samples, min_keep, samples)
    same = F.col("cluster_id").eqNullSafe(F.col("cluster"))
    small, rest = rows.join(large, same, "left_anti"), rows.join(large, same, "left_semi").drop("cells")
    return _supported(small, min_rel, pct, min_samples, min_keep, samples).unionByName(_spread_support(expr, rest, min_rel, pct, min_samples, min_keep, samples, most))


def _supported(rows: DataFrame, min_rel: float, pct: float | None, min_samples: int, min_keep: int, samples: list) -> DataFrame:
    """``sample_support`` of scored rows with cells (sample, value), a cluster in one task: one shuffle brings a cluster together, and the windows need no other."""
    kind = dict(rows.dtypes)["cells"]
    of = kind[len("array<struct<sample:") : kind.index(",value:")]
    absent = F.array_except(F.array(*map(F.lit, samples)).cast(f"array<{of}>"), F.col("cells.sample"))
    each = F.concat("cells", F.transform(absent, lambda s: F.struct(s.alias("sample"), F.lit(0.0).alias("value"))))
    own = [c for c in rows.columns if c != "cells"]
    # A row a sample; the first of them has the row's columns.
    values = rows.repartition("cluster_id").select("cluster_id", "tx", F.struct(*own).alias("own"), F.posexplode(each).alias("at", "cell"))
    values = values.select("cluster_id", "tx", F.when(F.col("at") == 0, F.col("own")).alias("own"), "cell.sample", "cell.value")
    by, ok = Window.partitionBy("cluster_id", "sample"), F.lit(False)
    if pct is not None:
        v = F.greatest("value", F.lit(0.0))
        ahead = by.orderBy(F.desc(v), "tx").rowsBetween(Window.unboundedPreceding, -1)
        values = values.withColumns({"before": F.coalesce(F.sum(v).over(ahead), v * 0), "total": F.sum(v).over(by)})
        ok |= (F.col("total") > 0) & (F.col("before") < pct / 100 * F.col("total"))
    if min_rel > 0:
        values = values.withColumn("least", F.max("value").over(by) * min_rel)
        ok |= F.col("value") >= F.col("least")
    passes = F.sum(ok.cast("int")).over(Window.partitionBy("cluster_id", "tx"))
    out = values.select("own", passes.alias("passes")).filter("own is not null").select("own.*", "passes")
    ok, whole = F.col("passes") >= min_samples, Window.partitionBy("cluster_id")
    out = out.withColumns({"few": F.sum(ok.cast("int")).over(whole) < min_keep, "best": F.rank().over(whole.orderBy(F.desc("score"), "tx")) <= min_keep})
    return out.withColumn("kept", F.when(F.col("few"), F.col("best")).otherwise(ok)).drop("few", "best")


def _spread_support(expr: DataFrame, rows: DataFrame, min_rel: float, pct: float | None, min_samples: int, min_keep: int, samples: list, most: int) -> DataFrame:
    """``sample_support`` of scored rows of large clusters, none of which is one task's."""
    rows = cut(rows, "large-scored")
    values = cut(dense(expr, rows.select("tx", "cluster_id"), samples), "dense")
    ok = F.lit(False)
    if pct is not None:
        values = cumulative_keep(values, pct / 100, most)
        ok |= F.col("kept")
    if min_rel > 0:
        top = values.groupBy(F.col("cluster_id").alias("c"), F.col("sample").alias("s")).agg((F.max("value") * min_rel).alias("least"))
        values = values.join(top, F.col("cluster_id").eqNullSafe(F.col("c")) & F.col("sample").eqNullSafe(F.col("s"))).drop("c", "s")
        ok |= F.col("value") >= F.col("least")
    passes = values.withColumn("ok", ok.cast("int")).groupBy("tx").agg(F.sum("ok").alias("passes"))
    rows = cut(rows.join(passes, "tx").withColumn("ok", F.col("passes") >= min_samples), "supported")
    few = rows.groupBy(F.col("cluster_id").alias("cluster")).agg((F.sum(F.col("ok").cast("int")) < min_keep).alias("few"))
    # The best of those clusters: Spark keeps min_keep of each task before the shuffle.
    poor = _per_cluster(rows.select("cluster_id", "tx", "score"), few.filter("few"))
    best = poor.withColumn("r", F.row_number().over(Window.partitionBy("cluster_id").orderBy(F.desc("score"), "tx"))).filter(F.col("r") <= min_keep).select(F.col("tx").alias("best"))
    out = _per_cluster(rows, few).join(best, F.col("tx") == F.col("best"), "left")
    return out.withColumn("kept", F.when(F.col("few"), F.col("best").isNotNull()).otherwise(F.col("ok"))).drop("few", "best", "ok")
