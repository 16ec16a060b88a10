"""Reads: capped sampling, collapsing by splice chain, merging samples, modal ends, alignment statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.lineage import cut

from .intervals import union_intervals
from .levels import level_join

UNMAPPED, SECONDARY, SUPPLEMENTARY, REVERSE = 4, 256, 2048, 16
MITO = ("chrM", "MT", "chrMT", "M")


def primary(flag: Column) -> Column:
    return (flag.bitwiseAND(UNMAPPED | SECONDARY | SUPPLEMENTARY)) == 0


def portable_hash(read_id: Column, seed: int) -> Column:
    """A hexadecimal hash of an id of any type with the seed, the same in every engine that has MD5."""
    return F.md5(F.concat(read_id.cast("string"), F.lit(f":{seed}")).cast("binary"))


def reservoir_cap(reads: DataFrame, cap: int = 50_000, seed: int = 4232, mito: str | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Primary reads, of the mitochondrion at most ``cap`` by ``keys`` (all together without): those with the smallest hashes.

    mito: the contig; else the first of MITO that occurs. Without one the reads stay as they are, secondary ones too.
    The choice depends on ids (names or numbers) and seed alone, not on partitions. Counts by 65,536 ranges of the hash
    tell in which range the cap is reached; whole ranges before it stay, and only that one's reads are ranked.
    """
    if mito is None:
        present = {r["chrom"] for r in reads.filter(F.col("chrom").isin(*MITO)).select("chrom").distinct().collect()}
        mito = next((c for c in MITO if c in present), None)
        if mito is None:
            return reads
    kept = reads.filter(primary(F.col("flag")))
    on = kept.filter(F.col("chrom") == mito).withColumn("__h", F.coalesce(portable_hash(F.col("read_id"), seed), F.lit("g")))
    on = on.withColumn("__u", F.substring("__h", 1, 4))
    counts = on.groupBy(*keys, "__u").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("__u"))
    edge = counts.withColumn("upto", upto).filter((F.col("upto") >= cap) & (F.col("upto") - F.col("n") < cap))
    room = F.lit(cap) - F.col("upto") + F.col("n")
    if keys:
        edge = edge.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col("__u").alias("__edge"), room.alias("__room"))
        same = F.lit(True)
        for k in keys:
            same &= F.col(k).eqNullSafe(F.col(f"__{k}"))
        on = on.join(edge, same, "left")
    else:
        found = edge.select("__u", room.alias("room")).first()  # one row
        on = on.withColumns({"__edge": F.lit(found["__u"] if found else None).cast("string"), "__room": F.lit(found["room"] if found else 0)})
    full = on.filter(F.col("__edge").isNull() | (F.col("__u") < F.col("__edge")))
    rank = F.row_number().over(Window.partitionBy(*keys, "__u").orderBy("__h", "read_id"))
    last = on.filter(F.col("__u") == F.col("__edge")).withColumn("__r", rank).filter(F.col("__r") <= F.col("__room"))
    chosen = full.select(*reads.columns).unionByName(last.select(*reads.columns))
    return kept.filter((F.col("chrom") != mito) | F.col("chrom").isNull()).unionByName(chosen)


def drop_singletons(features: DataFrame, depth: str = "depth", key: str = "tx") -> DataFrame:
    """All features but those of transcripts with a row whose depth is exactly 1; a missing depth drops nothing."""
    once = features.filter(F.col(depth) == 1).select(F.col(key).alias("__once")).distinct()
    return features.join(once, F.col(key) == F.col("__once"), "left_anti")


def on_chromosomes(rows: DataFrame, pattern: str = r"^chr([0-9]+|[XY])$") -> DataFrame:
    """Rows whose chromosome fits ``pattern``, capitals or not."""
    return rows.filter(F.col("chrom").rlike(f"(?i){pattern}"))


def covered(pileup: DataFrame, min_depth: int = 1) -> DataFrame:
    """Positions of a pileup (chrom, pos, depth, ...) with a depth of at least ``min_depth``."""
    return pileup.filter(F.col("depth") >= min_depth)


def called_variants(pileup: DataFrame, min_coverage: int = 20, min_reads2: int = 4) -> DataFrame:
    """Positions (depth, reads2: reads of the variant) with enough coverage and enough reads of the variant."""
    return pileup.filter((F.col("depth") >= min_coverage) & (F.col("reads2") >= min_reads2))


def _place(columns: list[str]) -> Column:
    """What tells isoforms without junctions apart: their locus, where there is one, or else their ends; null with a chain."""
    return F.when(F.coalesce(F.size("chain"), F.lit(0)) <= 0, F.col("locus") if "locus" in columns else F.struct("lo", "hi")).alias("__place")


def with_loci(tx: DataFrame) -> DataFrame:
    """Adds ``locus`` (lo, hi): what mono-exons of a chromosome and strand that overlap cover together; null with a chain.

    Mono-exons that share a base, by whatever others between them, have one locus; those that only touch don't. Loci are
    unions of intervals within bins first, so a chromosome is no single task's.
    """
    rows = cut(tx, "transcripts")
    mono = rows.filter(F.coalesce(F.size("chain"), F.lit(0)) <= 0).select("chrom", "strand", F.col("lo").alias("start0"), F.col("hi").alias("end0")).distinct()
    loci = union_intervals(mono, ("chrom", "strand"), touching=False)
    held = level_join(mono, loci, keys=("chrom", "strand")).select(F.col("a_chrom").alias("c"), F.col("a_strand").alias("s"), F.col("a_start0").alias("l"), F.col("a_end0").alias("h"), F.struct(F.col("b_start0").alias("lo"), F.col("b_end0").alias("hi")).alias("locus"))
    same = (F.col("chrom") == F.col("c")) & (F.col("strand") == F.col("s")) & (F.col("lo") == F.col("l")) & (F.col("hi") == F.col("h")) & (F.coalesce(F.size("chain"), F.lit(0)) <= 0)
    return rows.join(held, same, "left").drop("c", "s", "l", "h")


def collapse_reads(tx: DataFrame) -> DataFrame:
    """Transcripts (reads with sample) with one chain, locus and sample as one isoform: depth, outermost ends.

    Mono-exons are one by sample and locus, if ``with_loci`` gave them one (which then stays beside them), else by their ends.
    """
    locus = [F.first("locus").alias("locus")] if "locus" in tx.columns else []
    return tx.groupBy("sample", "chrom", "strand", "chain", _place(tx.columns)).agg(F.count("*").alias("depth"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), *locus).drop("__place")


def merge_samples(collapsed: DataFrame, samples: list) -> DataFrame:
    """Isoforms over all samples: chrom, strand, chain, ends, and a depth column a sample (0 where absent). Mono-exons meet by their loci, or else by their ends."""
    depth = [F.sum(F.when(F.col("sample") == s, F.col("depth")).otherwise(0)).alias(f"depth_{s}") for s in samples]
    return collapsed.groupBy("chrom", "strand", "chain", _place(collapsed.columns)).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), *depth).drop("__place")


def modal_ends(points: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The most frequent pos by ``keys`` with its count and the number of different ones; ties to the smallest."""
    counts = points.groupBy(*keys, "pos").agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(F.max(F.struct("n", (-F.col("pos")).alias("p"))).alias("top"), F.count("*").alias("n_pos")).select(*keys, (-F.col("top.p")).alias("pos"), F.col("top.n").alias("n"), "n_pos")


def with_modal_ends(tx: DataFrame, starts: DataFrame, ends: DataFrame, key: str = "tx") -> DataFrame:
    """Transcripts (key, strand, lo, hi) with the modal transcription start and end (key, pos as ``coords.tss`` and ``tes`` give it) in place of their own.

    Where a mode is missing, or lies beyond the transcript's other end, that end stays. Adds nothing and drops nothing.
    """
    one = lambda df, name: df.select(F.col(key).alias(f"__{name}"), F.col("pos").alias(f"__{name}_pos"))
    rows = tx.join(one(starts, "tss"), F.col(key) == F.col("__tss"), "left").join(one(ends, "tes"), F.col(key) == F.col("__tes"), "left")
    minus = F.col("strand") == "-"
    lo = F.when(minus, F.col("__tes_pos")).otherwise(F.col("__tss_pos"))
    hi = F.when(minus, F.col("__tss_pos")).otherwise(F.col("__tes_pos"))
    rows = rows.withColumns({"__lo": F.coalesce(lo, "lo"), "__hi": F.coalesce(hi, "hi")})
    right = F.col("__lo") < F.col("__hi")
    moved = {"lo": F.when(right, F.col("__lo")).otherwise(F.col("lo")), "hi": F.when(right, F.col("__hi")).otherwise(F.col("hi"))}
    return rows.select(*((moved[c].alias(c) if c in moved else F.col(f"`{c}`")) for c in tx.columns))


def flagstat(reads: DataFrame) -> DataFrame:
    """Counts by sample: total, primary, secondary, supplementary, mapped, primary mapped."""
    has = lambda bit: F.col("flag").bitwiseAND(bit) != 0
    n = lambda c, name: F.sum(c.cast("bigint")).alias(name)
    first = ~has(SECONDARY) & ~has(SUPPLEMENTARY)
    return reads.groupBy("sample").agg(F.count("*").alias("total"), n(first, "primary"), n(has(SECONDARY), "secondary"), n(has(SUPPLEMENTARY), "supplementary"), n(~has(UNMAPPED), "mapped"), n(first & ~has(UNMAPPED), "primary_mapped"))


def idxstats(reads: DataFrame) -> DataFrame:
    """Mapped and unmapped records by sample and contig."""
    un = F.col("flag").bitwiseAND(UNMAPPED) != 0
    return reads.groupBy("sample", "chrom").agg(F.sum((~un).cast("bigint")).alias("mapped"), F.sum(un.cast("bigint")).alias("unmapped"))


def mito_status(stats: DataFrame, threshold: int) -> DataFrame:
    """sample, n (mapped on the mitochondrion) and status: PASS (n <= threshold) or FAIL (n > threshold)."""
    n = stats.groupBy("sample").agg(F.sum(F.when(F.col("chrom").isin(*MITO, "ChrM"), F.col("mapped")).otherwise(0)).alias("n"))
    said = F.when(F.col("n") <= threshold, F.concat(F.lit("PASS ("), F.col("n").cast("string"), F.lit(f" <= {threshold})"))).otherwise(F.concat(F.lit("FAIL ("), F.col("n").cast("string"), F.lit(f" > {threshold})")))
    return n.select("sample", "n", said.alias("status"))


def qc_summary(reads: DataFrame, threshold: int) -> DataFrame:
    """Long metrics (sample, metric, value as text) of one pass over the reads."""
    flags, mito = flagstat(reads), mito_status(idxstats(reads), threshold)
    wide = flags.join(mito, "sample")
    share = lambda m, t: F.when(F.col(t) == 0, F.lit("NA")).otherwise(F.format_string("%.4f", F.col(m) / F.col(t) * 100))
    values = {"total": F.col("total"), "primary": F.col("primary"), "secondary": F.col("secondary"), "supplementary": F.col("supplementary"), "mapped": F.col("mapped"), "primary_mapped": F.col("primary_mapped"), "pct_mapped": share("mapped", "total"), "chrM_reads": F.col("n"), "chrM_status": F.col("status")}
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), v.cast("string").alias("value")) for k, v in values.items())))
    return wide.select("sample", rows.alias("x")).select("sample", "x.metric", "x.value")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
