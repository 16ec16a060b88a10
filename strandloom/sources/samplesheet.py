"""The sample sheet: one row a part, several parts a sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EXTENSIONS = {"path_to_bam": (".bam",), "path_to_fastq": (".fastq", ".fastq.gz")}


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file is there, in any store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def read_sample_sheet(spark: SparkSession, path: str, check_files: bool = False) -> DataFrame:
    """sample, path, part (from 0, by order of appearance). Raises ValueError for a sheet that can't be used.

    Wants ``sample`` and exactly one of path_to_bam and path_to_fastq, no empty cells and the column's extensions;
    with ``check_files`` also that every file is there (a sheet has a few hundred lines).
    """
    rows = spark.read.csv(path, header=True).withColumn("__line", F.monotonically_increasing_id())
    found = [c for c in EXTENSIONS if c in rows.columns]
    if "sample" not in rows.columns or len(found) != 1:
        raise ValueError("a sample sheet has sample and exactly one of path_to_bam and path_to_fastq")
    col = found[0]
    fits = F.lit(False)
    for e in EXTENSIONS[col]:
        fits |= F.endswith(F.col(col), F.lit(e))
    bad = rows.agg(F.count_if(F.col("sample").isNull() | F.col(col).isNull()).alias("na"), F.count_if(~fits).alias("ext")).first()
    if bad["na"]:
        raise ValueError(f"{bad['na']} rows of the sample sheet have empty cells")
    if bad["ext"]:
        raise ValueError(f"{bad['ext']} paths don't end in {' or '.join(EXTENSIONS[col])}")
    if check_files and (gone := sorted(r[0] for r in rows.select(col).distinct().collect() if not exists(spark, r[0]))):
        raise ValueError(f"files that aren't there: {', '.join(gone)}")
    part = F.row_number().over(Window.partitionBy("sample").orderBy("__line")) - 1
    return rows.select("sample", F.col(col).alias("path"), part.alias("part"))
