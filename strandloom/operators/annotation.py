"""Collapsing an annotation to one model a gene, without bases that other genes share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .intervals import subtract_intervals, union_intervals

EXCLUDED_TAGS = ("retained_intron", "readthrough_transcript")


def usable(exons: DataFrame, blacklist: DataFrame | None = None) -> DataFrame:
    """Exon rows without blacklisted transcripts, retained introns and readthrough tags; transcript_type and tags may be missing."""
    rows = exons if blacklist is None else exons.join(blacklist.select("tx"), "tx", "left_anti")
    if "transcript_type" in rows.columns:
        rows = rows.filter(~F.col("transcript_type").eqNullSafe(F.lit("retained_intron")))
    if "tags" in rows.columns:
        rows = rows.filter(~F.coalesce(F.arrays_overlap("tags", F.array(*map(F.lit, EXCLUDED_TAGS))), F.lit(False)))
    return rows


def collapse(exons: DataFrame, blacklist: DataFrame | None = None, collapse_only: bool = False, stranded: bool = False) -> DataFrame:
    """gene, chrom, strand, exon (numbered in the direction of transcription), start0, end0 of each gene's model.

    Exons of one gene fuse where they share a base. Unless collapse_only, bases of other genes' models go (on the same
    strand only, if stranded), and with them genes all of whose exons are a single base.
    """
    keys = ("gene", "chrom", "strand")
    # Closed intervals fuse when they share a base, not when they only touch.
    merged = union_intervals(usable(exons, blacklist), keys, touching=False)
    model = merged
    if not collapse_only:
        model = subtract_intervals(merged, merged, ("gene", "strand", "chrom"), ("chrom", "strand") if stranded else ("chrom",), F.col("a_gene") != F.col("b_gene"))
        wide = model.groupBy("gene").agg(F.max(F.col("end0") - F.col("start0")).alias("w")).filter("w > 1").select("gene")
        model = model.join(wide, "gene", "left_semi")
    order = F.when(F.col("strand") == "-", -F.col("start0")).otherwise(F.col("start0"))
    number = F.row_number().over(Window.partitionBy("gene").orderBy(order))
    return model.select("gene", "chrom", "strand", number.alias("exon"), "start0", "end0")


REQUIRED = ("gene_id", "transcript_id", "gene_type", "gene_name", "transcript_type", "transcript_name")


def complete_attributes(attrs: Column) -> Column:
    """A gene's attribute map with the missing transcript_* filled from gene_*, as text: required ones in order (then level), the rest after."""
    value = {k: attrs[k] for k in (*REQUIRED, "gene_status", "transcript_status", "level")}
    value["gene_name"] = F.coalesce(value["gene_name"], value["gene_id"])
    value["transcript_id"] = F.coalesce(value["transcript_id"], value["gene_id"])
    for k in ("type", "name", "status"):
        value[f"transcript_{k}"] = F.coalesce(value[f"transcript_{k}"], value[f"gene_{k}"])
    order = ["gene_id", "transcript_id", "gene_type", "gene_status", "gene_name", "transcript_type", "transcript_status", "transcript_name", "level"]
    said = F.filter(F.array(*(F.concat(F.lit(f"{k} "), F.concat(F.lit('"'), value[k], F.lit('"'))) for k in order)), lambda x: x.isNotNull())
    rest = F.transform(F.filter(F.array_sort(F.map_entries(attrs)), lambda e: ~e["key"].isin(*order)), lambda e: F.concat(e["key"], F.lit(' "'), e["value"], F.lit('"')))
    return F.concat(F.array_join(F.concat(said, rest), "; "), F.lit(";"))


def to_gtf(model: DataFrame, genes: DataFrame | None = None, source: str = "strandloom") -> DataFrame:
    """GTF rows of a collapsed model: gene, transcript and exon rows; genes (gene, attributes text) is optional. 1-based closed."""
    base = model.groupBy("gene", "chrom", "strand").agg(F.min("start0").alias("start0"), F.max("end0").alias("end0"))
    attr = F.concat(F.lit('gene_id "'), F.col("gene").cast("string"), F.lit('"; transcript_id "'), F.col("gene").cast("string"), F.lit('";'))
    if genes is not None:
        base = base.join(genes.select("gene", F.col("attributes").alias("__a")), "gene", "left")
        model = model.join(genes.select("gene", F.col("attributes").alias("__a")), "gene", "left")
        attr = F.coalesce("__a", attr)
    row = lambda df, feature, extra, order: df.select("gene", F.lit(order).alias("o"), *([F.col("exon")] if feature == "exon" else [F.lit(0).alias("exon")]), F.concat_ws("\t", "chrom", F.lit(source), F.lit(feature), (F.col("start0") + 1).cast("string"), F.col("end0").cast("string"), F.lit("."), "strand", F.lit("."), F.concat(attr, extra)).alias("value"))
    number = F.concat(F.lit(' exon_id "'), F.col("gene").cast("string"), F.lit("_"), F.col("exon").cast("string"), F.lit('"; exon_number "'), F.col("exon").cast("string"), F.lit('";')) if "exon" in model.columns else F.lit("")
    rows = row(base, "gene", F.lit(""), 0).union(row(base, "transcript", F.lit(""), 1)).union(row(model, "exon", number, 2))
    return rows.orderBy("gene", "o", "exon").select("value")
