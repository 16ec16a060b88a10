"""FASTA, FASTQ, FAI, SAM text, splice-junction tables and other small inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.lineage import cut


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, line (from 0 within its file) and value of text files; gz files are opened by their suffix.

    Large plain files are read in splits by many tasks: the lines are written with their split and place in it, and the
    number of lines in the splits before gives each split its first.
    """
    at = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))
    lines = cut(spark.read.text(path).select(*at, F.monotonically_increasing_id().alias("id"), "value"), "lines")
    splits = lines.groupBy("file", "split").agg(F.min("id").alias("least"), F.count("*").alias("n"))  # one row a split
    before = F.sum("n").over(Window.partitionBy("file").orderBy("split")) - F.col("n")
    splits = splits.select(F.col("file").alias("f"), F.col("split").alias("s"), (before - F.col("least")).alias("shift"))
    return lines.join(splits, (F.col("file") == F.col("f")) & (F.col("split") == F.col("s"))).select("file", (F.col("id") + F.col("shift")).alias("line"), "value")


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """contig (the name up to the first white space) and seq of each record; gz files are opened by their suffix.

    A record begins at ``>`` at the start of a line, and nowhere else. One contig is one row; ``screens.chunked`` cuts it.
    """
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", r"^\s*>", "").alias("value"))
    rows = rows.filter(F.length(F.trim("value")) > 0)
    at = F.locate("\n", F.col("value"))
    body = F.when(at > 0, F.substring("value", at + 1, F.length("value"))).otherwise("")
    return rows.select(F.regexp_extract(F.substring_index("value", "\n", 1), r"^(\S+)", 1).alias("contig"), F.translate(body, "\n\r\t ", "").alias("seq"))


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    """chrom, length."""
    c = F.split("value", "\t")
    return spark.read.text(path).filter(F.size(c) >= 2).select(F.get(c, F.lit(0)).alias("chrom"), F.get(c, F.lit(1)).cast("bigint").alias("length"))


def fasta_index(genome: DataFrame) -> DataFrame:
    return genome.select(F.col("contig").alias("chrom"), F.length("seq").cast("bigint").alias("length"))


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """read_id, seq, qual of four-line records, of plain files of any size (read by many tasks) and of gz files."""
    lines = numbered_lines(spark, path).withColumns({"record": F.floor(F.col("line") / 4), "part": F.col("line") % 4})
    of = lambda k: F.max(F.when(F.col("part") == k, F.rtrim("value")))
    records = lines.groupBy("file", "record").agg(of(0).alias("head"), of(1).alias("seq"), of(3).alias("qual"))
    return records.filter("head <> ''").select(F.regexp_extract("head", r"^@?(\S+)", 1).alias("read_id"), F.coalesce("seq", F.lit("")).alias("seq"), F.coalesce("qual", F.lit("")).alias("qual"))


def read_sam(spark: SparkSession, path: str | list[str], sample: str | None = None) -> DataFrame:
    """read_id, sample, chrom (null for *), flag, pos (0-based), cigar, seq, mapq, qual and tags (values by key) of SAM text; header lines are skipped."""
    c = F.split("value", "\t")
    at = lambda i: F.get(c, F.lit(i))
    tag = lambda x: F.struct(F.substring(x, 1, 2).alias("k"), F.substring(x, 6, F.length(x)).alias("v"))
    tags = F.map_from_entries(F.transform(F.filter(F.slice(c, 12, F.greatest(F.size(c) - 11, F.lit(0))), lambda x: F.length(x) >= 5), tag))
    rows = spark.read.text(path).filter(~F.startswith("value", F.lit("@"))).filter(F.size(c) >= 11)
    return rows.select(at(0).alias("read_id"), F.lit(sample).alias("sample"), F.nullif(at(2), F.lit("*")).alias("chrom"), at(1).cast("int").alias("flag"), (at(3).cast("bigint") - 1).alias("pos"), at(5).alias("cigar"), at(9).alias("seq"), at(4).cast("int").alias("mapq"), at(10).alias("qual"), tags.alias("tags"))


def read_splice_table(spark: SparkSession, path: str) -> DataFrame:
    """Nine-column junction table: chrom, donor and acceptor (0-based half-open), strand, motif class, annotated, unique and multiple reads, overhang."""
    c = F.split("value", "\t")
    at = lambda i: F.get(c, F.lit(i)).cast("int")
    strand = F.when(at(3) == 1, "+").when(at(3) == 2, "-").otherwise(".")
    return spark.read.text(path).filter(F.size(c) >= 9).select(F.get(c, F.lit(0)).alias("chrom"), (F.get(c, F.lit(1)).cast("bigint") - 1).alias("donor"), F.get(c, F.lit(2)).cast("bigint").alias("acceptor"), strand.alias("strand"), at(4).alias("motif"), (at(5) == 1).alias("annotated"), at(6).alias("unique_reads"), at(7).alias("multi_reads"), at(8).alias("overhang"))


def read_first_column(spark: SparkSession, path: str, name: str = "tx") -> DataFrame:
    """Distinct non-blank first columns of a tab file: id lists and blacklists."""
    v = F.trim(F.get(F.split("value", "\t"), F.lit(0)))
    return spark.read.text(path).select(v.alias(name)).filter(F.length(name) > 0).distinct()


def read_insert_lengths(spark: SparkSession, path: str, sample: str) -> DataFrame:
    """sample, len from the ``insertlen`` column of a headed table; no other column is read further."""
    sep = "\t" if "\t" in spark.read.text(path).first()[0] else ","
    return spark.read.csv(path, header=True, sep=sep).select(F.lit(sample).alias("sample"), F.col("insertlen").cast("int").alias("len"))


def read_group_map(spark: SparkSession, path: str) -> DataFrame:
    """sample, grp from a table with columns File and Group."""
    sep = "\t" if "\t" in spark.read.text(path).first()[0] else ","
    rows = spark.read.csv(path, header=True, sep=sep)
    if missing := {"File", "Group"} - set(rows.columns):
        raise ValueError(f"group map lacks {', '.join(sorted(missing))}")
    return rows.select(F.col("File").alias("sample"), F.col("Group").alias("grp"))


def read_ref_flat(spark: SparkSession, path: str) -> DataFrame:
    """Exon rows of a refFlat table: gene, tx, chrom, strand, exon (from 0, by position), start0, end0."""
    c = F.split("value", "\t")
    at = lambda i: F.get(c, F.lit(i))
    numbers = lambda i: F.transform(F.filter(F.split(at(i), ","), lambda x: x != ""), lambda x: x.cast("bigint"))
    rows = spark.read.text(path).filter(~F.startswith("value", F.lit("#"))).filter(F.size(c) >= 11)
    rows = rows.select(at(0).alias("gene"), at(1).alias("tx"), at(2).alias("chrom"), at(3).alias("strand"), F.posexplode(F.arrays_zip(numbers(9).alias("s"), numbers(10).alias("e"))).alias("exon", "x"))
    return rows.select("gene", "tx", "chrom", "strand", "exon", F.col("x.s").alias("start0"), F.col("x.e").alias("end0"))


def read_pileup(spark: SparkSession, path: str) -> DataFrame:
    """chrom, pos (0-based), base, depth of a pileup table; lines with fewer than four columns or no depth are skipped."""
    c = F.split("value", "\t")
    at = lambda i: F.get(c, F.lit(i))
    rows = spark.read.text(path).filter(F.size(c) >= 4).select(at(0).alias("chrom"), (F.expr("try_cast(split(value, '\t')[1] as bigint)") - 1).alias("pos"), at(2).alias("base"), F.expr("try_cast(split(value, '\t')[3] as bigint)").alias("depth"))
    return rows.filter("pos is not null and depth is not null")
