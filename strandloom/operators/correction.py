"""Junctions of reads moved to known ones nearby.

A read's junction is moved to the known junction of its chromosome and strand whose donor and acceptor are both at most
``max_offset`` bases away and together nearest; ties go to the one with more support, then the smaller donor and acceptor.
Known junctions with a motif class of 0 (no accepted motif) are no targets, and a junction that is known itself, with
whatever motif, stays. A transcript keeps all its junctions as they were if a move would leave one of its exons without
a base, or would let one run over its neighbour.

Junctions meet by both their bins, of four times ``max_offset`` bases, so a junction meets the known ones of one to four
cells (two and a quarter on average), however many share its donor. Distinct junctions are moved, not each read's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.lineage import cut

PLACE = ("chrom", "strand", "donor", "acceptor")


def _cell(at: Column, max_offset: int) -> Column:
    return F.floor(at / max(4 * max_offset, 1))


def _around(junctions: DataFrame, max_offset: int) -> DataFrame:
    """Adds bd and ba: a row for each cell with a place at most ``max_offset`` bases away at both ends."""
    cells = lambda c: F.explode(F.array_distinct(F.array(_cell(F.col(c) - max_offset, max_offset), _cell(F.col(c) + max_offset, max_offset))))
    return junctions.withColumn("bd", cells("donor")).withColumn("ba", cells("acceptor"))


def moves(junctions: DataFrame, known: DataFrame, max_offset: int = 5) -> DataFrame:
    """chrom, strand, donor, acceptor of the junctions that move, with new_donor, new_acceptor and offset (both ends' together).

    known: chrom, strand, donor, acceptor and, where it has them, motif and unique_reads; its repeated junctions are one.
    Junctions with a null in any of the four stay.
    """
    own = junctions.select(*PLACE).dropna().distinct()
    motif = F.max("motif") if "motif" in known.columns else F.lit(1)
    support = F.sum("unique_reads") if "unique_reads" in known.columns else F.lit(0)
    table = cut(known.groupBy(*PLACE).agg(motif.alias("motif"), support.cast("bigint").alias("support")), "known-junctions")
    open_ = own.join(table.select(*PLACE), list(PLACE), "left_anti")
    cell = lambda c: _cell(F.col(c), max_offset)
    probes = _around(open_, max_offset)
    targets = table.filter("motif > 0").select(F.col("chrom").alias("kc"), F.col("strand").alias("ks"), F.col("donor").alias("new_donor"), F.col("acceptor").alias("new_acceptor"), "support", cell("donor").alias("kd"), cell("acceptor").alias("ka"))
    near = (F.abs(F.col("donor") - F.col("new_donor")) <= max_offset) & (F.abs(F.col("acceptor") - F.col("new_acceptor")) <= max_offset)
    met = probes.join(targets, (F.col("chrom") == F.col("kc")) & (F.col("strand") == F.col("ks")) & (F.col("bd") == F.col("kd")) & (F.col("ba") == F.col("ka")) & near)
    offset = F.abs(F.col("donor") - F.col("new_donor")) + F.abs(F.col("acceptor") - F.col("new_acceptor"))
    best = F.min_by(F.struct("new_donor", "new_acceptor", offset.alias("offset")), F.struct(offset.alias("o"), (-F.col("support")).alias("s"), "new_donor", "new_acceptor"))
    return met.groupBy(*PLACE).agg(best.alias("b")).select(*PLACE, "b.new_donor", "b.new_acceptor", "b.offset")


def correct_junctions(tx: DataFrame, known: DataFrame, max_offset: int = 5) -> DataFrame:
    """Transcripts (tx, chrom, strand, exons, chain, lo, hi, ...) with corrected exons and chain, n_moved, and ``corrected``.

    corrected: junctions were moved; where they could not be (see above), n_moved tells how many should have been.
    Transcripts without junctions come back as they are; rows of one tx are transcripts of their own.
    """
    rows = cut(tx.withColumn("__row", F.monotonically_increasing_id()), "uncorrected")
    each = rows.select("__row", "chrom", "strand", F.posexplode("chain").alias("__k", "j")).select("__row", "__k", "chrom", "strand", "j.donor", "j.acceptor")
    found = cut(moves(each, known, max_offset), "moves")
    same = F.lit(True)
    for c in PLACE:
        same &= F.col(c) == F.col(f"m_{c}")
    moved = each.join(found.select(*(F.col(c).alias(f"m_{c}") for c in PLACE), "new_donor", "new_acceptor"), same).select("__row", F.col("__k").alias("k"), F.struct(F.col("new_donor").alias("donor"), F.col("new_acceptor").alias("acceptor")).alias("j"))
    # A transcript's moves only; its junctions are beside it already.
    moved = moved.groupBy(F.col("__row").alias("__r")).agg(F.map_from_entries(F.collect_list(F.struct("k", "j"))).alias("__moves"))
    out = rows.join(moved, F.col("__row") == F.col("__r"), "left")
    chain = F.transform("chain", lambda j, k: F.coalesce(F.try_element_at("__moves", k), F.struct(j["donor"].alias("donor"), j["acceptor"].alias("acceptor"))))
    out = out.withColumn("__chain", F.when(F.col("__moves").isNull(), F.col("chain")).otherwise(chain))
    starts = F.concat(F.array("lo"), F.transform("__chain", lambda j: j["acceptor"]))
    ends = F.concat(F.transform("__chain", lambda j: j["donor"]), F.array("hi"))
    exons = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start0"), e.alias("end0")))
    out = out.withColumn("__exons", exons)
    whole = F.forall("__exons", lambda e: e["end0"] > e["start0"]) & F.forall("__chain", lambda j: j["donor"] <= j["acceptor"])
    corrected = F.col("__moves").isNotNull() & whole
    values = {"exons": F.when(corrected, F.col("__exons")).otherwise(F.col("exons")), "chain": F.when(corrected, F.col("__chain")).otherwise(F.col("chain"))}
    return out.select(*(values[c].alias(c) if c in values else F.col(f"`{c}`") for c in tx.columns), F.coalesce(F.size("__moves"), F.lit(0)).alias("n_moved"), corrected.alias("corrected"))


def correction_log(junctions: DataFrame, known: DataFrame, max_offset: int = 5) -> DataFrame:
    """Each junction (tx, chrom, strand, junction, donor, acceptor) that moves, with where to: one row a transcript's junction."""
    found = cut(moves(junctions, known, max_offset), "moves")
    return junctions.join(found, list(PLACE)).select("tx", "chrom", "strand", "junction", "donor", "acceptor", "new_donor", "new_acceptor", "offset")
