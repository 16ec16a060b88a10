"""Mixing sources to target weights by Pfair scheduling.

Each source's rows are numbered in hashed order and cut into blocks. In the fluid mix all sources flow at once, each in
proportion to its weight, and when one has run out the others share its part; one block flows in one slot. A block may
go out from the slot in which it begins to flow and must be out by the end of that in which it has flowed (by Pfair
with weights w that stay: from slot floor((i - 1) / w) and by ceil(i / w) for the i-th block). Earliest deadline first
among the released blocks meets all deadlines, since the fluid mix does; so every source is within one block of the
fluid mix at every slot. Weights are exact rationals, nothing is rounded, and sources may be any number.

With ``period``, weights are rounded to integers over it and the schedule of one period serves them all: block i of a
source falls into period (i - 1) div a at a slot known from the table of one period. When a source has no blocks left,
the others go on with their weights in a new phase, with schedule and deviation counted from there.

A block is of 64 rows, or of as many more as keep the blocks below ``MAX_BLOCKS`` and one a source: the schedule is made
on the driver, which holds one number of rows a source and one slot a block, however large the table.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections.abc import Mapping
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.operators.numbering import ranged

from .common import cut, whole

BLOCK_ROWS = 64
#: Blocks of the schedule, beside one a source, at most.
MAX_BLOCKS = 250_000
#: Rows that one window numbers, about; and rows of the tables of first numbers and of blocks that are broadcast at most.
BUCKET_ROWS, BROADCAST_ROWS = 100_000, 100_000
#: A range of the hash with this many times the usual rows is dealt out further.
HOT = 8


#: Of one source, each block's slot, first slot and deadline.
Slots = dict[str | None, list[tuple[int, int, int]]]


def fluid(blocks: Mapping[str | None, int], weights: Mapping[str | None, float]) -> Slots:
    """Slot, release and deadline of each block by source, within one block of the fluid mix; those without weight last."""
    share = {s: Fraction(str(weights[s])) for s, n in blocks.items() if n}
    if any(w < 0 for w in share.values()):
        raise ValueError("weights are not negative")
    rest = [s for s, w in share.items() if not w]
    unit = math.lcm(*(w.denominator for w in share.values()))
    share = {s: int(w * unit) for s, w in share.items() if w}
    # The fluid mix: a source ends when its blocks by its weight have flowed; what has gone by then, who flows after.
    last = sorted((Fraction(blocks[s], w), w, blocks[s]) for s, w in share.items())
    ends, gone, active = [x[0] for x in last], [0], [sum(share.values())]
    for _, w, n in last:
        gone.append(gone[-1] + n)
        active.append(active[-1] - w)

    def flowed(s: str | None, i: int) -> tuple[int, int]:
        """Slot in which i blocks of a source have flowed, rounded down and up."""
        w = share[s]
        k = bisect_right(ends, Fraction(i, w))
        return gone[k] + i * active[k] // w, gone[k] - -i * active[k] // w

    out: Slots = {s: [] for s in share}
    names = sorted(share, key=str)
    ready: list[tuple[int, int, int]] = []  # deadline, source, release
    later = [(0, k) for k in range(len(names))]  # release, source
    for slot in range(gone[-1]):
        while later and later[0][0] <= slot:
            release, k = heapq.heappop(later)
            heapq.heappush(ready, (flowed(names[k], len(out[names[k]]) + 1)[1], k, release))
        deadline, k, release = heapq.heappop(ready)
        s = names[k]
        out[s].append((slot, release, deadline))
        if len(out[s]) < blocks[s]:
            heapq.heappush(later, (flowed(s, len(out[s]))[0], k))
    if rest:
        out |= {s: [tuple(x + gone[-1] for x in t) for t in own] for s, own in fluid({s: blocks[s] for s in rest}, dict.fromkeys(rest, 1)).items()}
    return out


def integer_weights(weights: Mapping[str | None, float], period: int) -> dict[str | None, int]:
    """Weights as integers of at least 1 that add up to ``period``, by largest remainders."""
    total = sum(weights.values())
    share = {s: max(Fraction(w).limit_denominator(10**9) / Fraction(total).limit_denominator(10**9) * period, Fraction(1)) for s, w in weights.items()}
    out = {s: math.floor(x) for s, x in share.items()}
    order = sorted(share, key=lambda s: (-(share[s] - out[s]), str(s)))
    for s in order[: max(0, period - sum(out.values()))]:
        out[s] += 1
    while sum(out.values()) > period:
        out[max(out, key=lambda s: (out[s], str(s)))] -= 1
    return out


def one_period(a: Mapping[str | None, int]) -> dict[str | None, list[int]]:
    """Slots of each source's blocks in one period of sum(a) slots: earliest deadline first among released blocks."""
    period = sum(a.values())
    out: dict[str | None, list[int]] = {s: [] for s in a}
    waiting = sorted(a, key=str)
    later = [(0, i, s) for i, s in enumerate(waiting)]  # release slot
    ready: list[tuple[int, int, str | None]] = []  # deadline
    heapq.heapify(later)
    for t in range(period):
        while later and later[0][0] <= t:
            _, i, s = heapq.heappop(later)
            heapq.heappush(ready, (-(-(len(out[s]) + 1) * period // a[s]), i, s))
        _, i, s = heapq.heappop(ready)
        out[s].append(t)
        if len(out[s]) < a[s]:
            heapq.heappush(later, (len(out[s]) * period // a[s], i, s))
    return out


@dataclass(frozen=True)
class Phase:
    """From ``slot`` on, ``sources`` go by ``slots`` (of one period), after ``blocks`` of each have gone out before."""

    slot: int
    period: int
    slots: dict[str | None, list[int]]
    blocks: dict[str | None, int]


def place(phase: Phase, source: str | None, i: int) -> int:
    """Slot of a source's i-th block (from 0, over all phases) under ``phase``."""
    j, a = i - phase.blocks[source], len(phase.slots[source])
    return phase.slot + j // a * phase.period + phase.slots[source][j % a]


def phases(blocks: Mapping[str | None, int], weights: Mapping[str | None, float], period: int) -> list[Phase]:
    """The schedule of ``blocks`` by source: a new phase begins where the first source runs out."""
    left = {s: n for s, n in blocks.items() if n}
    gone = dict.fromkeys(blocks, 0)
    slot, out = 0, []
    while left:
        a = integer_weights({s: weights[s] for s in left}, max(period, len(left)))
        g = math.gcd(*a.values())
        a = {s: x // g for s, x in a.items()}
        p = Phase(slot, sum(a.values()), one_period(a), {s: gone[s] for s in left})
        out.append(p)
        end = min(place(p, s, blocks[s] - 1) for s in left) + 1
        rounds, rest = divmod(end - slot, p.period)
        for s in left:
            gone[s] += rounds * a[s] + sum(x < rest for x in p.slots[s])
        slot = end
        left = {s: n for s, n in left.items() if gone[s] < n}
    return out


def periodic(blocks: Mapping[str | None, int], weights: Mapping[str | None, float], period: int) -> Slots:
    """As ``fluid``, from ``phases``; release and deadline are slots since the block's phase began."""
    plan = phases(blocks, weights, period)
    out: Slots = {s: [] for s in blocks}
    for p, after in zip(plan, [*plan[1:], None], strict=True):
        for s, slots in p.slots.items():
            for j in range((after.blocks.get(s, blocks[s]) if after else blocks[s]) - p.blocks[s]):
                out[s].append((place(p, s, p.blocks[s] + j), j * p.period // len(slots), -(-(j + 1) * p.period // len(slots))))
    return out


def fingerprint(docs: DataFrame) -> Column:
    """A hash of a row's columns (maps can't be hashed and are left out): orders rows of one id the same way each time."""
    return F.xxhash64(*(F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind))


def default_weights(rows: Mapping[str | None, int], temperature: float = 0.5) -> dict[str | None, float]:
    """Weights in proportion to a source's rows to the power ``temperature``."""
    return {s: float(n) ** temperature for s, n in rows.items()}


def schedule(docs: DataFrame, weights: Mapping[str | None, float] | None = None, source_col: str = "source", id_col: str = "doc_id", block_rows: int | None = None, period: int | None = None, bucket_rows: int = BUCKET_ROWS, order: Column | None = None) -> DataFrame:
    """Adds block (of its source, from 0), slot (of the whole mix, from 0), release, deadline and place (within the block).

    Sorting by (slot, place) gives the mix. Rows of a source go in the order of a hash of the whole row, ties by id, so a
    task that is run again numbers them as before, and rows of one id, or without one, are spread like others; only rows
    that are equal in every column lie together (``order``: a number of its own instead). Null sources are one
    source, named null; null ids are ids. A source without a weight is an error, one without rows is passed over; an
    empty table gives no rows. All columns of ``docs`` stay (own names given above are replaced). Numbering a source
    needs no task of its own: rows are numbered within ranges of their hash of about ``bucket_rows`` rows, and each
    range's first number comes from the counts of those before. Sources of weight zero go after all others, in equal
    shares. With ``period``, weights are rounded to integers that add up to it, and release and deadline are slots
    since the block's phase began.
    """
    own = ("block", "slot", "release", "deadline", "place")
    id_ = F.col(f"`{id_col}`")
    rows = docs.select(whole(docs), F.coalesce(F.concat(F.lit("s"), F.col(f"`{source_col}`").cast("string")), F.lit("null")).alias("__s"), F.xxhash64(fingerprint(docs) if order is None else order, F.lit(10)).alias("__h"), id_.alias("__id"))
    total = docs.count()
    block_rows = block_rows or max(BLOCK_ROWS, -(-total // MAX_BLOCKS))
    bits = max(6, (total // bucket_rows).bit_length())
    rows = rows.withColumn("__b", F.shiftrightunsigned("__h", 64 - bits))
    counts = cut(rows.groupBy("__s", "__b").count(), "mix-counts")
    sizes = {r["__s"][1:] if r["__s"] != "null" else None: r["n"] for r in counts.groupBy("__s").agg(F.sum("count").alias("n")).collect()}
    weights = default_weights(sizes) if weights is None else weights
    blocks = {s: -(-n // block_rows) for s, n in sizes.items()}
    plan = fluid(blocks, weights) if period is None else periodic(blocks, weights, period)
    before = counts.select(F.col("__s").alias("__s2"), F.col("__b").alias("__b2"), (F.sum("count").over(Window.partitionBy("__s").orderBy("__b")) - F.col("count")).alias("__first"))
    # Beyond the bound the join is a shuffle by the keys of the window that follows, which then needs none of its own.
    before = F.broadcast(before) if len(sizes) << bits <= BROADCAST_ROWS else before
    rows = rows.join(before, (F.col("__s") == F.col("__s2")) & (F.col("__b") == F.col("__b2"))).drop("__s2", "__b2")
    spark = docs.sparkSession
    table = [("null" if s is None else f"s{s}", i, *t) for s, own_ in plan.items() for i, t in enumerate(own_)]
    table = spark.createDataFrame(table, "s string, i long, slot long, release long, deadline long")
    table = F.broadcast(table) if sum(blocks.values()) <= BROADCAST_ROWS else table
    rank = F.row_number().over(Window.partitionBy("__s", "__b").orderBy("__h", "__id"))
    # Rows that are equal in all that the hash knows fill one range of it, however many: such ranges are dealt out further.
    hot = cut(counts.filter(F.col("count") > HOT * bucket_rows).select(F.col("__s").alias("__s3"), F.col("__b").alias("__b3")), "hot-ranges")
    if hot.isEmpty():
        rows = rows.withColumn("__r", rank)
    else:
        same = (F.col("__s") == F.col("__s3")) & (F.col("__b") == F.col("__b3"))
        crowd = rows.join(F.broadcast(hot), same, "left_semi").withColumn("__at", F.monotonically_increasing_id())  # at most a row for each HOT ranges
        crowd = ranged(crowd, ["__s", "__b"], [F.asc("__h"), F.asc("__id"), F.asc("__at")]).withColumnRenamed("rank", "__r").drop("n", "__at")
        rows = rows.join(F.broadcast(hot), same, "left_anti").withColumn("__r", rank).unionByName(crowd)
    rows = rows.withColumn("__n", F.col("__r") - 1 + F.col("__first")).withColumn("block", F.floor(F.col("__n") / block_rows)).withColumn("place", (F.col("__n") % block_rows).cast("int"))
    # Joined last: the table doesn't travel with the rows.
    rows = rows.join(table, (F.col("__s") == F.col("s")) & (F.col("block") == F.col("i")))
    return rows.select(*(F.col("row")[c].alias(c) for c in docs.columns if c not in own), *own)


def mixed(docs: DataFrame, weights: Mapping[str | None, float] | None = None, **options) -> DataFrame:
    """The rows of ``docs`` with their own columns, in the order of the mix: range-partitioned by slot and sorted within.

    Null sources are one source, null ids are ids; equal rows stay repeated and lie together; texts play no part in the
    order but by their hash, however long; columns of any name stay; an empty table gives no rows.
    """
    boxed = docs.select(whole(docs), F.col("source"), F.col("doc_id"), fingerprint(docs).alias("order"))
    out = schedule(boxed, weights, order=F.col("order"), **options)
    return out.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place").select(*(F.col("row")[c].alias(c) for c in docs.columns))
