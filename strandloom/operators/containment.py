"""Splice chains contained in longer chains of the same gene and locus.

A child whose junctions are adjacent in its parents meets them by the digest of its chain: parents are filed under the
digests of their runs, of those lengths alone that some child has which begins with the run's first junction. So every
row of the join is an edge, however many chains of a gene share a junction, and where only the smallest supersets count,
the least parent of each run is found by a grouped minimum before children meet any. A child whose junctions may lie
apart meets those chains that hold its rarest junction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.lineage import cut

from .intervals import interval_join

GROUP = ("gene", "chrom", "strand")


def containment(tx: DataFrame, terminal_only: bool = True, minimal_superset: bool = True, protect_chains: DataFrame | None = None, near_tss: DataFrame | None = None, near_tes: DataFrame | None = None, window: int = 50) -> DataFrame:
    """Edges (group, child, parent, extra): child's junctions are a proper subset of parent's; extra = how many fewer.

    A chain without junctions is contained in every other of its group. terminal_only: the child's junctions are
    adjacent in the parent. minimal_superset: only parents with the fewest extra junctions. protect_chains (chrom,
    strand, chain): children whose chain equals one of them are passed over. near_tss / near_tes: transcripts (tx)
    with a known end nearby; where child or parent has one, their ends must lie within ``window``.

    Children with junctions meet parents by runs, or by their rarest junction (see above). A child without junctions meets its group's
    shortest chains; only where all supersets are asked for, or known ends decide, does it meet every chain of the group.
    """
    base = tx.select(*GROUP, "tx", "chain", "lo", "hi")
    if near_tss is not None:
        base = base.join(near_tss.select(F.col("tx").alias("k"), F.lit(True).alias("tss_known")), F.col("tx") == F.col("k"), "left").drop("k")
    if near_tes is not None:
        base = base.join(near_tes.select(F.col("tx").alias("k"), F.lit(True).alias("tes_known")), F.col("tx") == F.col("k"), "left").drop("k")
    child, parent = (base.select(*(F.col(c).alias(p + c) for c in base.columns)) for p in ("c_", "p_"))
    if protect_chains is not None:
        guard = protect_chains.select(F.col("chrom").alias("g_chrom"), F.col("strand").alias("g_strand"), F.col("chain").alias("g_chain")).distinct()
        child = child.join(guard, (F.col("c_chrom") == F.col("g_chrom")) & (F.col("c_strand") == F.col("g_strand")) & (F.col("c_chain") == F.col("g_chain")), "left_anti")
    same = F.lit(True)
    for c in GROUP:
        same &= F.col(f"c_{c}") == F.col(f"p_{c}")
    pruned = minimal_superset and near_tss is None and near_tes is None
    own = child.filter(F.size("c_chain") > 0)
    chained = by_runs(own, parent, same, pruned) if terminal_only else by_rarest(own, parent, same)
    holders = parent.filter(F.size("p_chain") > 0)
    if pruned:
        # A chain-less child's minimal supersets are its group's shortest chains: no others meet it.
        least = holders.groupBy(*(F.col(f"p_{c}").alias(f"l_{c}") for c in GROUP)).agg(F.min(F.size("p_chain")).alias("l_size"))
        here = F.col("p_gene").eqNullSafe(F.col("l_gene")) & (F.col("p_chrom") == F.col("l_chrom")) & (F.col("p_strand") == F.col("l_strand"))
        holders = holders.join(least, here & (F.size("p_chain") == F.col("l_size")), "left_semi")
    bare = child.filter(F.size("c_chain") == 0).join(holders, same)
    edges = chained.unionByName(bare)
    plus = F.col("c_strand") == "+"
    if near_tss is not None:
        gap = F.abs(F.when(plus, F.col("c_lo") - F.col("p_lo")).otherwise(F.col("c_hi") - F.col("p_hi")))
        edges = edges.filter(F.coalesce("c_tss_known", "p_tss_known").isNull() | (gap <= window))
    if near_tes is not None:
        gap = F.abs(F.when(plus, F.col("c_hi") - F.col("p_hi")).otherwise(F.col("c_lo") - F.col("p_lo")))
        edges = edges.filter(F.coalesce("c_tes_known", "p_tes_known").isNull() | (gap <= window))
    edges = edges.select(*(F.col(f"c_{c}").alias(c) for c in GROUP), F.col("c_tx").alias("child"), F.col("p_tx").alias("parent"), (F.size("p_chain") - F.size("c_chain")).alias("extra"))
    if minimal_superset:
        edges = edges.withColumn("least", F.min("extra").over(Window.partitionBy("child"))).filter("extra = least").drop("least")
    return edges


def _digests(run: Column) -> list[Column]:
    """Two independent hashes of a run: together a name that no other run has."""
    return [F.xxhash64(run), F.xxhash64(F.lit(7), run)]


def runs_of(child: DataFrame, parent: DataFrame) -> DataFrame:
    """p_ columns of parents, n (length of the run), r1 and r2 (its digests): the runs that a child of n junctions may be, in longer chains."""
    heads = child.select(*(F.col(f"c_{c}").alias(f"h_{c}") for c in GROUP), F.get("c_chain", F.lit(0)).alias("h_j"), F.size("c_chain").alias("n")).distinct()
    opened = parent.select("*", F.posexplode("p_chain").alias("p_at", "p_j"))
    same = F.col("p_j") == F.col("h_j")
    for c in GROUP:
        same &= F.col(f"p_{c}") == F.col(f"h_{c}")
    fits = (F.size("p_chain") > F.col("n")) & (F.col("p_at") + F.col("n") <= F.size("p_chain"))
    r1, r2 = _digests(F.slice("p_chain", F.col("p_at") + 1, F.col("n")))
    return opened.join(heads, same & fits).select(*parent.columns, "n", r1.alias("r1"), r2.alias("r2"))


def by_runs(child: DataFrame, parent: DataFrame, same: Column, least: bool) -> DataFrame:
    """Children (c_) beside the longer chains (p_) in which their junctions are adjacent; ``least``: only the shortest of these."""
    runs = runs_of(child, parent)
    if least:
        runs = cut(runs, "runs")  # read twice, and the join then has a shuffle of its own, whose hot keys Spark splits
        shortest = runs.groupBy(*(F.col(f"p_{c}").alias(f"s_{c}") for c in GROUP), F.col("n").alias("s_n"), F.col("r1").alias("s_r1"), F.col("r2").alias("s_r2")).agg(F.min(F.size("p_chain")).alias("s_size"))
        here = (F.col("n") == F.col("s_n")) & (F.col("r1") == F.col("s_r1")) & (F.col("r2") == F.col("s_r2")) & (F.size("p_chain") == F.col("s_size"))
        for c in GROUP:
            here &= F.col(f"p_{c}") == F.col(f"s_{c}")
        runs = runs.join(shortest, here, "left_semi")
    c1, c2 = _digests(F.col("c_chain"))
    met = child.withColumns({"c_r1": c1, "c_r2": c2}).join(runs, same & (F.col("c_r1") == F.col("r1")) & (F.col("c_r2") == F.col("r2")) & (F.size("c_chain") == F.col("n")))
    return met.drop("c_r1", "c_r2", "n", "r1", "r2")


def by_rarest(child: DataFrame, parent: DataFrame, same: Column) -> DataFrame:
    """Children (c_) beside the longer chains (p_) that have all their junctions: those that have the child's rarest one are looked at."""
    opened = parent.withColumn("p_j", F.explode("p_chain"))
    counts = cut(opened.groupBy(*(F.col(f"p_{c}").alias(f"k_{c}") for c in GROUP), F.col("p_j").alias("k_j")).agg(F.count("*").alias("k_n")), "junction-counts")
    each = child.select(*(f"c_{c}" for c in GROUP), "c_chain").distinct()
    asked = F.col("c_j") == F.col("k_j")
    for c in GROUP:
        asked &= F.col(f"c_{c}") == F.col(f"k_{c}")
    rare = each.withColumn("c_j", F.explode("c_chain")).join(counts, asked).groupBy(*(F.col(f"c_{c}").alias(f"r_{c}") for c in GROUP), F.col("c_chain").alias("r_chain")).agg(F.min_by("k_j", F.struct("k_n", "k_j")).alias("r_j"))
    mine = F.col("c_chain") == F.col("r_chain")
    for c in GROUP:
        mine &= F.col(f"c_{c}") == F.col(f"r_{c}")
    keyed = child.join(rare, mine).drop("r_chain", *(f"r_{c}" for c in GROUP))
    inside = (F.size("p_chain") > F.size("c_chain")) & (F.size(F.array_except("c_chain", "p_chain")) == 0)
    return keyed.join(opened, same & (F.col("r_j") == F.col("p_j")) & inside).drop("r_j", "p_j")


def containment_map(edges: DataFrame) -> DataFrame:
    """contained_transcript, superset_transcripts (sorted names, comma-joined)."""
    return edges.groupBy(F.col("child").cast("string").alias("contained_transcript")).agg(F.array_join(F.array_sort(F.collect_set(F.col("parent").cast("string"))), ",").alias("superset_transcripts"))


def near_regions(points: DataFrame, regions: DataFrame, window: int = 50) -> DataFrame:
    """Transcripts (tx) of points (tx, chrom, strand, pos) within ``window`` of a region of their strand or of '.'.

    Closed comparison: region start - window <= pos <= region end + window.
    """
    p = points.select("tx", "chrom", "strand", F.col("pos").alias("start0"), (F.col("pos") + 1).alias("end0"))
    r = regions.select("chrom", "strand", (F.col("start0") - window).alias("start0"), (F.col("end0") + window + 1).alias("end0"))
    return interval_join(p, r, F.col("b_strand").isin(".") | (F.col("a_strand") == F.col("b_strand")), how="left_semi").select("tx").distinct()
