"""New samples as a stream of Parquet files: reads are counted by sample and contig as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strandloom.operators.reads import primary


def stream_reads(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    """Reads from files that appear in ``path``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def contig_counts(reads: DataFrame) -> DataFrame:
    """Running counts of primary reads by sample and contig (state: one row each)."""
    return reads.filter(primary(F.col("flag"))).groupBy("sample", "chrom").agg(F.count("*").alias("n"))


def windowed_counts(reads: DataFrame, time_col: str = "ts", late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Counts by sample and arrival window; state older than the watermark is let go."""
    return reads.withWatermark(time_col, late).groupBy(F.window(time_col, width).alias("w"), "sample").agg(F.count("*").alias("n")).select("w.start", "w.end", "sample", "n")
