"""BED3, BED6 and BED12 text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BED12 = ("chrom", "start", "end", "name", "score", "strand", "thick_start", "thick_end", "rgb", "block_count", "block_sizes", "block_starts")


def _columns(spark: SparkSession, path: str | list[str], least: int) -> DataFrame:
    c = F.split("value", "\t")
    return spark.read.text(path).filter(~F.col("value").rlike("^(#|track|browser)")).withColumn("c", c).filter(F.size("c") >= least)


def read_bed(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """chrom, start0, end0, name, score, strand ('.' where missing); lines with fewer than three columns or bad numbers are skipped."""
    at = lambda i: F.get("c", F.lit(i))
    rows = _columns(spark, path, 3).select(at(0).alias("chrom"), F.try_to_number(at(1), F.lit("999999999999")).cast("bigint").alias("start0"), F.try_to_number(at(2), F.lit("999999999999")).cast("bigint").alias("end0"), at(3).alias("name"), at(4).alias("score"), F.coalesce(at(5), F.lit(".")).alias("strand"))
    return rows.filter("start0 is not null and end0 is not null")


def read_bed12(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The twelve columns; shorter lines are skipped."""
    number = {"start", "end", "thick_start", "thick_end", "block_count"}
    return _columns(spark, path, 12).select(*((F.get("c", F.lit(i)).cast("bigint") if n in number else F.get("c", F.lit(i))).alias(n) for i, n in enumerate(BED12)))


def to_bed12_lines(bed: DataFrame) -> DataFrame:
    return bed.orderBy("chrom", "start", "name").select(F.concat_ws("\t", *(F.col(c).cast("string") for c in BED12)).alias("value"))
