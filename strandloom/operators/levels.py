"""Interval joins by levels of bins, for intervals of very different lengths.

A level's bins are four times as wide as those of the level below. An interval is filed at the lowest level whose bins are
as wide as it is long, in the one or two of them that it touches. Two overlapping intervals meet at the higher of their
two levels, in the bin in which the overlap begins: there one is filed, and the other, which is shorter, is in one or two
bins as well. So each side is copied at most twice for each level that the other side has, however long the intervals
are, and no width needs to fit both. A pair is kept only in that one bin, so there is nothing to make distinct.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.lineage import Observation, cut

#: Width of the lowest level's bins as a power of two, powers between levels, and levels.
LOWEST, STEP, LEVELS = 10, 2, 14


@dataclass(frozen=True)
class Filed:
    """Intervals, written with a number of their own and their level, and the levels that occur."""

    rows: DataFrame
    columns: list[str]
    levels: tuple[int, ...]


def filed(df: DataFrame) -> Filed:
    """Files the rows of ``df`` (start0, end0, ...) once, for any number of joins. Empty intervals, and null ones, have no level."""
    length = F.col("end0") - F.col("start0")
    level = sum(((length > (1 << (LOWEST + STEP * k))).cast("int") for k in range(LEVELS - 1)), F.lit(0))
    seen = Observation()
    rows = df.withColumns({"__id": F.monotonically_increasing_id(), "__level": F.when(length > 0, level)})
    rows = cut(rows, "filed", (seen, F.bit_or(F.expr("shiftleft(1, __level)")).alias("mask")))
    mask = seen.get["mask"] or 0
    return Filed(rows, df.columns, tuple(k for k in range(LEVELS) if mask >> k & 1))


def _side(x: Filed, prefix: str, levels: tuple[int, ...], own: bool) -> DataFrame:
    """Rows of ``x`` with prefixed columns, once for each bin (level, bin): of their own level, or of those of ``levels`` above it."""
    rows = x.rows.filter("__level is not null").select(*(F.col(f"`{c}`").alias(f"{prefix}{c}") for c in (*x.columns, "__id", "__level")))
    if own:
        rows = rows.withColumn(f"{prefix}__at", F.col(f"{prefix}__level"))
    else:
        every = F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")
        rows = rows.withColumn(f"{prefix}__at", F.explode(F.filter(every, lambda m: m > F.col(f"{prefix}__level"))))
    shift = f"{LOWEST} + {STEP} * {prefix}__at"
    return rows.withColumn(f"{prefix}__bin", F.explode(F.expr(f"sequence(shiftright({prefix}start0, {shift}), shiftright({prefix}end0 - 1, {shift}))")))


def copies(a: Filed, b: Filed) -> tuple[int, int]:
    """Rows of both sides that ``level_join`` makes of them."""
    count = lambda x, y, p: sum(_side(x, p, y.levels, own).count() for own in (True, False))
    return count(a, b, "a_"), count(b, a, "b_")


def _all(met: list[DataFrame], columns) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.select(*columns) for df in met])


def level_join(a: DataFrame | Filed, b: DataFrame | Filed, extra: Column | None = None, keys: tuple[str, ...] = ("chrom",), how: str = "inner") -> DataFrame:
    """Pairs of rows of ``a`` (columns prefixed a_) and ``b`` (b_) that share at least one base, equal on ``keys``.

    Both have start0 and end0. ``extra``: a further condition on prefixed columns. how: ``inner``, ``left_semi`` or
    ``left_anti`` (rows of ``a``, its own columns unprefixed). Null keys never match; repeated rows each count.
    """
    a, b = (x if isinstance(x, Filed) else filed(x) for x in (a, b))
    on = (F.col("a___at") == F.col("b___at")) & (F.col("a___bin") == F.col("b___bin"))
    for k in keys:
        on &= F.col(f"a_{k}") == F.col(f"b_{k}")
    on &= (F.col("a_start0") < F.col("b_end0")) & (F.col("b_start0") < F.col("a_end0"))
    on &= F.col("a___bin") == F.expr(f"shiftright(greatest(a_start0, b_start0), {LOWEST} + {STEP} * a___at)")
    if extra is not None:
        on &= extra
    kind = "inner" if how == "inner" else "left_semi"
    # At b's own level, where it is a's or above; then at a's, where that is above b's. Only rows of levels that can meet
    # the other side's are sent, and a case that no two levels make is left out.
    up, down = (any(y > x for x in s for y in t) for s, t in ((a.levels, b.levels), (b.levels, a.levels)))
    sent = _side(a, "a_", b.levels, True).filter(F.col("a___at").isin(*b.levels))
    if up:
        sent = sent.unionByName(_side(a, "a_", b.levels, False))
    low = sent.join(_side(b, "b_", a.levels, True).filter(F.col("b___at") >= min(a.levels, default=0)), on, kind)
    met = [low]
    if down:
        met.append(_side(a, "a_", b.levels, True).filter(F.col("a___at") > min(b.levels)).join(_side(b, "b_", a.levels, False), on, kind))
    if how == "inner":
        return _all(met, [*(f"`a_{c}`" for c in a.columns), *(f"`b_{c}`" for c in b.columns)])
    if how == "left_semi" and not any("map<" in t for _, t in a.rows.dtypes):
        # What meets something takes its columns along: the rows need no join with their numbers.
        own = ("a___id", *(f"`a_{c}`" for c in a.columns))
        return _all(met, own).distinct().select(*(F.col(f"`a_{c}`").alias(c) for c in a.columns))
    hits = _all(met, ["a___id"]).distinct()
    return a.rows.join(hits, F.col("__id") == F.col("a___id"), how).select(*(F.col(f"`{c}`") for c in a.columns))
