"""Writers of id lists, tables, matrices and GTF lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandloom.lineage import cut


def write_ids(ids: DataFrame, path: str, col: str = "tx") -> None:
    """Distinct ids, sorted, one a line."""
    ids.select(F.col(col).cast("string").alias("value")).distinct().orderBy("value").write.text(path)


def write_ids_in_order(ids: DataFrame, path: str, order: list[str], col: str = "tx") -> None:
    """Ids in the order of other columns (as a BED file has them), one a line; repeated ones at their first place."""
    first = ids.groupBy(F.col(col).cast("string").alias("value")).agg(F.min(F.struct(*order)).alias("o"))
    first.orderBy("o", "value").select("value").write.text(path)


def write_parts(df: DataFrame, path: str, rows: int) -> None:
    """Tables of ``rows`` rows, the last of what is left, one file each in ``part=`` folders, written by as many tasks as there are.

    Rows go in the order in which they come. They are numbered by the counts of the partitions before theirs.
    """
    at = F.monotonically_increasing_id()
    pieces = cut(df.withColumn("__at", at), "parts")
    index = F.shiftright("__at", 33).alias("__of")
    counts = pieces.groupBy(index).agg(F.count("*").alias("__n"))  # one row a partition
    before = counts.select(F.col("__of").alias("__o"), (F.sum("__n").over(Window.orderBy("__of")) - F.col("__n")).alias("__first"))
    number = F.col("__at").bitwiseAND((1 << 33) - 1) + F.col("__first")
    dealt = pieces.withColumn("__of", F.shiftright("__at", 33)).join(before, F.col("__of") == F.col("__o")).withColumn("part", F.floor(number / rows))
    n = max(1, -(-pieces.count() // rows))
    dealt.repartition(min(n, 10_000), "part").sortWithinPartitions("part", "__at").drop("__at", "__of", "__o", "__first").write.partitionBy("part").parquet(path)


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.text(path)


def write_tsv(df: DataFrame, path: str, sort: list[str] | None = None) -> None:
    (df.orderBy(*sort) if sort else df).write.csv(path, sep="\t", header=True)


def to_matrix(long: DataFrame, samples: list, id_name: str = "#TranscriptID", missing: float | int | None = 0) -> DataFrame:
    """Wide matrix of (tx, sample, value), sorted by id."""
    wide = long.groupBy(F.col("tx").alias(id_name)).pivot("sample", samples).agg(F.first("value"))
    return (wide.na.fill(missing) if missing is not None else wide).orderBy(F.col(f"`{id_name}`"))


def write_matrix(long: DataFrame, samples: list, path: str, id_name: str = "#TranscriptID") -> None:
    to_matrix(long, samples, id_name).write.csv(path, sep="\t", header=True)


def path_token(path: str, place: int) -> str:
    """A component of a path: from the front (1, 2, ...) or the back (-1, -2, ...); the path itself where it has no such."""
    parts = [p for p in path.split("/") if p]
    at = place - 1 if place > 0 else place
    return parts[at] if -len(parts) <= at < len(parts) else path


def path_tokens(path: Column, place: int) -> Column:
    """``path_token`` of a column."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.coalesce(F.try_element_at(parts, F.lit(place)), path)


def read_short_matrix(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A headed table with its header as ``short_header`` rewrites it."""
    rows = spark.read.csv(path, header=True, sep=sep)
    return rows.toDF(*short_header(rows.columns))


def short_header(columns: list[str]) -> list[str]:
    """First column #TranscriptID; others, if paths, their second component."""
    return ["#TranscriptID", *(c.split("/")[1] if "/" in c else c for c in columns[1:])]


def track_groups(samples: DataFrame) -> DataFrame:
    return samples.select("sample", F.lit("ALL").alias("grp"))


def failed_rows(source: DataFrame, ids: DataFrame, key: str = "name", order: list[str] | None = None) -> DataFrame:
    """Rows of ``source`` whose key is among the failing ids; in the order of ``order``, columns that hold the source's order."""
    rows = source.join(ids.select(F.col("tx").cast("string").alias("__id")).distinct(), F.col(key).cast("string") == F.col("__id"), "left_semi")
    return rows.orderBy(*order) if order else rows
