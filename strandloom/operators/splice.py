"""Transcripts from exon rows and between the exon, BED12, intron and junction forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.functions import coords

KEYS = ("tx", "gene", "chrom", "strand")


def transcripts(exons: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One row a transcript: keys, sorted exons, splice chain, ends. One shuffle; a transcript's exons are few."""
    rows = exons.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct("start0", "end0"))).alias("exons"))
    return rows.withColumns({"chain": coords.splice_chain(F.col("exons")), "lo": F.col("exons")[0]["start0"], "hi": F.array_max(F.transform("exons", lambda e: e["end0"]))})


def exon_rows(tx: DataFrame) -> DataFrame:
    """One row an exon: keys, start0, end0; what ``transcripts`` has gathered, without its shuffle."""
    return tx.select(*KEYS, F.explode("exons").alias("e")).select(*KEYS, "e.start0", "e.end0")


def junctions(tx: DataFrame) -> DataFrame:
    """One row a junction: keys, number (from 1), donor, acceptor."""
    return tx.select(*KEYS, F.posexplode("chain").alias("k", "j")).select(*KEYS, (F.col("k") + 1).alias("junction"), "j.donor", "j.acceptor")


def introns(tx: DataFrame) -> DataFrame:
    return tx.select(*KEYS, F.explode(coords.introns(F.col("exons"))).alias("i")).select(*KEYS, "i.start0", "i.end0")


def to_bed12(tx: DataFrame) -> DataFrame:
    """BED12: chrom, start, end, name, score, strand, thick ends, rgb, block count, sizes and starts (comma-joined, relative)."""
    joined = lambda f: F.array_join(F.transform("exons", lambda e: f(e).cast("string")), ",")
    return tx.select(
        "chrom", F.col("lo").alias("start"), F.col("hi").alias("end"), F.col("tx").alias("name"), F.lit(0).alias("score"), "strand", F.col("lo").alias("thick_start"), F.col("hi").alias("thick_end"), F.lit("0,0,0").alias("rgb"),
        F.size("exons").alias("block_count"), joined(lambda e: e["end0"] - e["start0"]).alias("block_sizes"), joined(lambda e: e["start0"] - F.col("lo")).alias("block_starts"),
    )


def bed12_exons(bed: DataFrame) -> DataFrame:
    """Exon rows of BED12 rows: name, chrom, strand, number (from 1), start0, end0. A trailing comma is tolerated."""
    ints = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("bigint"))
    blocks = F.arrays_zip(ints("block_sizes").alias("z"), ints("block_starts").alias("s"))
    rows = bed.select("name", "chrom", "strand", "start", F.posexplode(blocks).alias("k", "b"))
    return rows.select("name", "chrom", "strand", (F.col("k") + 1).alias("exon"), (F.col("start") + F.col("b.s")).alias("start0"), (F.col("start") + F.col("b.s") + F.col("b.z")).alias("end0"))


def bed12_junctions(bed: DataFrame) -> DataFrame:
    """Junctions of BED12 rows, none of them filtered: name, chrom, strand, number (from 1), donor, acceptor."""
    ints = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("bigint"))
    rows = bed.withColumn("b", F.arrays_zip(ints("block_sizes").alias("z"), ints("block_starts").alias("s")))
    pairs = coords.adjacent(F.col("b"), lambda a, b: F.struct((a["s"] + a["z"]).alias("d"), b["s"].alias("a")))
    rows = rows.select("name", "chrom", "strand", "start", F.posexplode(pairs).alias("k", "j"))
    return rows.select("name", "chrom", "strand", (F.col("k") + 1).alias("junction"), (F.col("start") + F.col("j.d")).alias("donor"), (F.col("start") + F.col("j.a")).alias("acceptor"))


def numbered(tx: DataFrame) -> DataFrame:
    """Exons and introns with their number and count: tx, kind (ex or in), ord, cnt, chrom, start0, end0."""
    row = lambda kind, arr: tx.select("tx", F.lit(kind).alias("kind"), F.posexplode(arr).alias("k", "x"), F.size(arr).alias("cnt"), "chrom")
    rows = row("ex", F.col("exons")).unionByName(row("in", coords.introns(F.col("exons"))))
    return rows.select("tx", "kind", (F.col("k") + 1).alias("ord"), "cnt", "chrom", "x.start0", "x.end0")


def ends(tx: DataFrame) -> DataFrame:
    """tx, tss, tes by strand."""
    return tx.select("tx", "chrom", "strand", coords.tss(F.col("strand"), F.col("lo"), F.col("hi")).alias("tss"), coords.tes(F.col("strand"), F.col("lo"), F.col("hi")).alias("tes"))
