"""A store sorted by place, with an index that tells which files a region needs.

Rows are dealt by ranges of (chrom, start0) and sorted, so each file holds a stretch of one or a few chromosomes. Beside
them lies the index: a row for each file, stripe of rows and chromosome, with the first and last start and how far the
intervals reach. A region's scan opens the files that the index names and no others; within them, Spark passes over row
groups and pages by the statistics that sorted columns make sharp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.operators.intervals import interval_join

#: Rows of a file that one row of the index speaks for.
STRIPE = 1 << 16
INDEX = "_index"


def write_indexed(rows: DataFrame, path: str, files: int | None = None, stripe: int = STRIPE, row_group_bytes: int = 16 << 20) -> None:
    """Rows with chrom, start0 and end0 as a sorted store at ``path``; ``files`` at least so many ranges, if there are as many places.

    Rows without a chromosome or a start are kept, last, and no region finds them. Rows of one place are dealt on by their
    content, so a hot place doesn't make a file of its own size.
    """
    tie = F.xxhash64(*(F.col(f"`{c}`") for c, kind in rows.dtypes if not kind.startswith("map")))
    order = [F.asc_nulls_last("chrom"), F.asc_nulls_last("start0"), F.asc("__tie")]
    dealt = rows.withColumn("__tie", tie)
    dealt = dealt.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order).drop("__tie")
    dealt.write.option("parquet.block.size", row_group_bytes).parquet(path)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(path)
    at = (F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.floor(F.col("_metadata.row_index") / stripe).alias("stripe"), "chrom")
    index = stored.groupBy(*at).agg(F.min("start0").alias("first"), F.max("start0").alias("last"), F.max("end0").alias("reach"), F.count("*").alias("n"))
    index.coalesce(1).write.parquet(f"{path}/{INDEX}")  # after its shuffle: a few rows a file


def index_of(spark: SparkSession, path: str) -> DataFrame:
    """file, stripe, chrom, first and last start, reach (largest end) and n."""
    return spark.read.parquet(f"{path}/{INDEX}")


def _opened(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    """The rows of those files; without any, none, with the store's columns."""
    if files:
        return spark.read.parquet(*(f"{path}/{f}" for f in files))
    return spark.read.parquet(path).limit(0)


def scan_region(spark: SparkSession, path: str, chrom: str, start: int, end: int) -> DataFrame:
    """Rows that share a base with [start, end) of a chromosome."""
    found = index_of(spark, path).filter((F.col("chrom") == chrom) & (F.col("first") < end) & (F.col("reach") > start))
    files = [r["file"] for r in found.select("file").distinct().orderBy("file").collect()]
    return _opened(spark, path, files).filter((F.col("chrom") == chrom) & (F.col("start0") < end) & (F.col("end0") > start))


def scan_regions(spark: SparkSession, path: str, regions: DataFrame) -> DataFrame:
    """Rows that share a base with any of ``regions`` (chrom, start0, end0), each once.

    The regions meet the index's stripes first; only files with a stripe that one of them meets are opened. The names of
    files pass through the driver, as they do whenever Spark lists a table.
    """
    stripes = index_of(spark, path).select("file", "chrom", F.col("first").alias("start0"), F.col("reach").alias("end0"))
    met = interval_join(stripes, regions.select("chrom", "start0", "end0"), how="left_semi", width=1 << 20)
    files = [r["file"] for r in met.select("file").distinct().orderBy("file").collect()]
    return interval_join(_opened(spark, path, files), regions.select("chrom", "start0", "end0"), how="left_semi")


def read_sorted(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The whole store."""
    rows = spark.read.parquet(path)
    return rows if where is None else rows.filter(where)
