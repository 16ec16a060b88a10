"""Row numbers and running sums in an order, without a window over a whole key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.lineage import cut


def number_by_range(rows: DataFrame, keys: list[str], piece: Column, order: list[str], name: str) -> DataFrame:
    """Adds ``name``: the rank (from 0) of a row among those of its keys, in ``order``.

    ``piece`` never falls along the order (the position over some width, say). Rows are ranked within (keys, piece); the
    counts of the pieces before give the first rank, so only those are read key by key.
    """
    cutting = rows.withColumn("__piece", piece)
    counts = cut(cutting.groupBy(*keys, "__piece").agg(F.count("*").alias("__n")), "piece-counts")
    first = counts.withColumn("__first", F.sum("__n").over(Window.partitionBy(*keys).orderBy("__piece")) - F.col("__n")).drop("__n")
    rank = F.row_number().over(Window.partitionBy(*keys, "__piece").orderBy(*order)) - 1
    first = first.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("__piece").alias("__p"), "__first")
    same = F.col("__piece").eqNullSafe(F.col("__p"))
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    out = cutting.withColumn("__rank", rank).join(first, same)
    return out.withColumn(name, F.col("__rank") + F.col("__first")).drop("__piece", "__p", "__rank", "__first", *(f"__{k}" for k in keys))


#: Rows of a key that one task may order.
MOST_ROWS = 100_000


def _same(keys: list[str], prefix: str) -> Column:
    on = F.lit(True)
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return on


def _windowed(rows: DataFrame, keys: list[str], order: list[Column], sums: dict[str, Column]) -> DataFrame:
    by = Window.partitionBy(*keys)
    ahead = by.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = {"rank": F.row_number().over(by.orderBy(*order)).cast("bigint"), "n": F.count("*").over(by)}
    for name, value in sums.items():
        out |= {f"before_{name}": F.coalesce(F.sum(value).over(ahead), value * 0), f"total_{name}": F.sum(value).over(by)}
    return rows.withColumns(out)


def ranged(rows: DataFrame, keys: list[str], order: list[Column], sums: dict[str, Column] | None = None) -> DataFrame:
    """What ``running`` adds, by ranges of (keys, order): each range is summed alone, after what the ranges before it add up to."""
    sums = sums or {}
    values = {f"__rgv_{name}": value for name, value in sums.items()}
    pieces = cut(rows.withColumns(values).repartitionByRange(*keys, *order).withColumn("__rg_piece", F.spark_partition_id()), "ranges")
    totals = pieces.groupBy(*keys, "__rg_piece").agg(F.count("*").alias("__rg_n"), *(F.sum(v).alias(f"__s{v}") for v in values))  # a row a range and key
    by = Window.partitionBy(*keys)
    upto = by.orderBy("__rg_piece")
    found = [(F.sum("__rg_n").over(upto) - F.col("__rg_n")).alias("__rg_before"), F.sum("__rg_n").over(by).alias("__rg_rows")]
    for v in values:
        found += [(F.sum(f"__s{v}").over(upto) - F.col(f"__s{v}")).alias(f"__b{v}"), F.sum(f"__s{v}").over(by).alias(f"__t{v}")]
    totals = totals.select(*(F.col(k).alias(f"__rgk_{k}") for k in keys), F.col("__rg_piece").alias("__rg_p"), *found)
    inside = Window.partitionBy(*keys, "__rg_piece").orderBy(*order)
    joined = pieces.join(totals, _same(keys, "__rgk_") & (F.col("__rg_piece") == F.col("__rg_p")))
    out = {"rank": F.row_number().over(inside) + F.col("__rg_before"), "n": F.col("__rg_rows")}
    for name in sums:
        v = f"__rgv_{name}"
        out |= {f"before_{name}": F.coalesce(F.sum(v).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.col(v) * 0) + F.col(f"__b{v}"), f"total_{name}": F.col(f"__t{v}")}
    return joined.select(*rows.columns, *(c.alias(name) for name, c in out.items()))


def running(rows: DataFrame, keys: list[str], order: list[Column], sums: dict[str, Column] | None = None, most: int = MOST_ROWS) -> DataFrame:
    """Adds rank (from 1, in ``order``, which has no ties) and n (rows of the key), and for each of ``sums`` before_ (over the rows before) and total_.

    Keys of more than ``most`` rows are dealt out by ranges of the order, so none is one task's; the rest are windows.
    ``rows`` are read several times: give them written.
    """
    sums = sums or {}
    large = rows.groupBy(*keys).agg(F.count("*").alias("__c")).filter(F.col("__c") > most).select(*(F.col(k).alias(f"__l_{k}") for k in keys))
    large = cut(large, "large-keys")
    if large.isEmpty():
        return _windowed(rows, keys, order, sums)
    on = _same(keys, "__l_")
    return _windowed(rows.join(large, on, "left_anti"), keys, order, sums).unionByName(ranged(rows.join(large, on, "left_semi"), keys, order, sums))
