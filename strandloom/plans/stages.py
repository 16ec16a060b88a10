"""The stages as one plan: screens, defragmentation with redistribution, pruning."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.config import EngineConfig
from strandloom.lineage import cut
from strandloom.operators import containment as con
from strandloom.operators import expression as ex
from strandloom.operators import graph, prune, screens, splice


@dataclass(frozen=True)
class Inputs:
    """exons (tx, gene, chrom, strand, start0, end0, ord), expr (tx, sample, value), and what the active screens need."""

    exons: DataFrame
    expr: DataFrame
    reference: DataFrame | None = None  # exon rows
    genome: DataFrame | None = None  # contig, seq
    junctions: DataFrame | None = None  # on the genome's contigs, where these aren't the chromosomes of the exons
    reference_tss: DataFrame | None = None
    repeats: DataFrame | None = None
    par: DataFrame | None = None
    segdups: DataFrame | None = None
    gene_regions: DataFrame | None = None
    tss: DataFrame | None = None


def run_screens(inp: Inputs, cfg: EngineConfig) -> DataFrame:
    """(screen, tx) of every active screen whose inputs are there; with none, no rows."""
    tx = cut(splice.transcripts(inp.exons), "screened")  # read by nearly every screen, as is the reference
    ref = None if inp.reference is None else cut(splice.transcripts(inp.reference).withColumn("ord", F.col("tx")), "reference")
    out: dict[str, DataFrame] = {}
    if cfg.filter_monoexon_tss and inp.reference_tss is not None:
        tss = inp.tss
        if tss is None:
            ends = splice.ends(tx)
            tss = ends.select("tx", "chrom", F.col("tss").alias("start0"), (F.col("tss") + 1).alias("end0"))
        out["monoexon_tss"] = screens.monoexon_no_tss(tx, tss, inp.reference_tss, distance=cfg.tss_max_distance)
    if cfg.filter_premrna and ref is not None:
        out["premrna"] = screens.premrna_monoexon(tx, ref, cfg.premrna_min_intron_overlap)
    if inp.genome is not None:
        j = splice.junctions(tx).withColumn("contig", F.col("chrom")) if inp.junctions is None else inp.junctions
        found = screens.rt_switching_mismatch if cfg.rt_allow_mismatch else screens.rt_switching
        if cfg.filter_noncanonical and cfg.filter_rt_switching:
            bases, windows = screens.motifs_and_windows(j.select("tx", "junction", "chrom", "strand", "contig", "donor", "acceptor"), inp.genome, cfg.rt_wiggle)
            out["noncanonical"] = screens.noncanonical_motifs(bases, cfg.allowed_motifs).select("tx")
            out["rt_switching"] = found(windows, cfg.rt_min_match, cfg.rt_wiggle).select("tx")
        elif cfg.filter_noncanonical:
            out["noncanonical"] = screens.noncanonical_splice(j, inp.genome, cfg.allowed_motifs).select("tx")
        elif cfg.filter_rt_switching:
            out["rt_switching"] = found(screens.rt_windows(j, inp.genome, cfg.rt_wiggle), cfg.rt_min_match, cfg.rt_wiggle).select("tx")
    if cfg.filter_antisense and ref is not None:
        out["antisense"] = screens.antisense(tx, ref, cfg.antisense_mode)
    if cfg.filter_repeats and inp.repeats is not None:
        out["repeats"] = screens.region_overlap(inp.exons, inp.repeats, cfg.repeat_min_overlap_fraction)
    if cfg.filter_par and inp.par is not None:
        out["par"] = screens.region_overlap(inp.exons, inp.par, cfg.par_min_overlap_fraction)
    if cfg.filter_tpm:
        out["tpm"] = ex.low_expression(inp.expr, cfg.tpm_min, cfg.tpm_min_samples)
    if cfg.filter_segdup and inp.segdups is not None and inp.gene_regions is not None:
        report = screens.segdup_report(tx, inp.segdups, inp.gene_regions, cfg.segdup_levels, cfg.segdup_exon_fraction, cfg.strict_compat)
        out["segdup"] = screens.segdup_terminal(report, cfg.segdup_min_intron)
    return screens.failed(out) if out else tx.select(F.lit("none").alias("screen"), "tx").limit(0)


def defragment(exons: DataFrame, expr: DataFrame, cfg: EngineConfig, samples: list) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edges, redistributed and rounded expression, original expression of the survivors)."""
    tx = splice.transcripts(exons)
    tx = tx.join(exons.groupBy("tx").agg(F.min("ord").alias("ord")), "tx") if "ord" in exons.columns else tx.withColumn("ord", F.col("tx"))
    tx = cut(tx, "transcripts")
    edges = cut(con.containment(tx, cfg.terminal_only, cfg.minimal_superset), "containment")
    guard = None if cfg.merge_min_frac is None else cut(ex.protected(expr, tx, cfg.merge_min_frac, cfg.merge_min_samples), "protected")
    moved = ex.drop_contained(ex.cascade(expr, tx, edges, guard, cfg.proportional, samples), edges, guard)
    return edges, ex.round_preserve_sum(moved, cfg.rounding), ex.drop_contained(expr, edges, guard)


def prune_clusters(exons: DataFrame, expr: DataFrame, cfg: EngineConfig, samples: list) -> DataFrame:
    """Cluster, score and decision of every expressed transcript."""
    options = {} if cfg.match_mode == "exact" else {"min_shared": cfg.min_shared, "min_jaccard": cfg.min_jaccard, "strong": cfg.bridge_strong, "weak": cfg.bridge_weak_jaccard}
    groups = graph.clusters(splice.transcripts(exons).join(expr.select("tx").distinct(), "tx", "left_semi"), cfg.match_mode, **options)
    if cfg.sample_support:
        return prune.sample_support(expr, groups, cfg.sample_min_rel_expr, cfg.retain_locus_pct, cfg.min_support_samples, cfg.min_keep, cfg.score, samples)
    return prune.keep_percentile(prune.scored(expr, groups, cfg.score, samples), cfg.retain_top_pct, cfg.min_keep)


def run_all(inp: Inputs, cfg: EngineConfig | None = None) -> dict[str, DataFrame]:
    """Screens, then defragmentation of what passes, then pruning on the original counts of the survivors.

    Each stage's tables are written to the shared folder and reread: later stages use them several times.
    """
    cfg = cfg or EngineConfig()
    inp = replace(inp, expr=cut(inp.expr, "input-expression"))
    samples = ex.samples_of(inp.expr)
    failures = cut(run_screens(inp, cfg), "failures")
    gone = failures.select("tx").distinct()
    exons, expr = cut(inp.exons.join(gone, "tx", "left_anti"), "exons"), cut(inp.expr.join(gone, "tx", "left_anti"), "expression")
    edges, redistributed, survivors = defragment(exons, expr, cfg, samples)
    survivors = cut(survivors, "survivors")
    decided = cut(prune_clusters(exons.join(survivors.select("tx").distinct(), "tx", "left_semi"), survivors, cfg, samples), "decisions")
    kept = decided.filter("kept").select("tx")
    return {"failures": failures, "edges": edges, "redistributed": redistributed, "decisions": decided, "exons": exons.join(kept, "tx", "left_semi"), "expr": survivors.join(kept, "tx", "left_semi")}
