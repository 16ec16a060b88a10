"""Column expressions over exon arrays (0-based, half-open) and intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def adjacent(arr: Column, pair) -> Column:
    """``pair(left, right)`` of each two adjacent elements."""
    n = F.greatest(F.size(arr) - 1, F.lit(0))
    return F.zip_with(F.slice(arr, 1, n), F.slice(arr, 2, n), pair)


def splice_chain(exons: Column) -> Column:
    """Junctions (donor, acceptor) of sorted exons. Touching exons keep theirs: donor <= acceptor in 0-based half-open."""
    return F.filter(adjacent(exons, lambda a, b: F.struct(a["end0"].alias("donor"), b["start0"].alias("acceptor"))), lambda j: j["donor"] <= j["acceptor"])


def introns(exons: Column) -> Column:
    """Introns of positive length between sorted exons."""
    return F.filter(adjacent(exons, lambda a, b: F.struct(a["end0"].alias("start0"), b["start0"].alias("end0"))), lambda i: i["end0"] > i["start0"])


def tss(strand: Column, lo: Column, hi: Column) -> Column:
    return F.when(strand == "-", hi).otherwise(lo)


def tes(strand: Column, lo: Column, hi: Column) -> Column:
    return F.when(strand == "-", lo).otherwise(hi)


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Bases that two half-open intervals share; 0 or less where none."""
    return F.least(e1, e2) - F.greatest(s1, s2)


def slop(start: Column, end: Column, d: int | Column, length: Column | None = None) -> tuple[Column, Column]:
    """An interval extended by ``d`` on both sides, clipped to [0, length]."""
    return F.greatest(start - d, F.lit(0)), end + d if length is None else F.least(end + d, length)


def safe_fraction(value: Column, total: Column) -> Column:
    """value / total, 0 where total is null or not positive."""
    return F.when(total > 0, value / total).otherwise(F.lit(0.0))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; two empty ones are equal, an empty one and another have nothing in common."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def contiguous(short: Column, long: Column) -> Column:
    """Whether ``short`` is a run of ``long`` (elements of ``long`` are distinct); an empty one always is."""
    at = F.array_position(long, F.get(short, F.lit(0)))
    return (F.size(short) == 0) | ((at > 0) & (F.slice(long, F.greatest(at, F.lit(1)).cast("int"), F.size(short)) == short))
