"""Expression matrices: wide text tables (first column or a named one = id, the others = samples), held long."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def to_long(wide: DataFrame, id_col: str, samples: list[str] | None = None, keep_missing: bool = True, strict: bool = False) -> DataFrame:
    """(id, sample, value double) of a wide table. A cell that isn't a number, or is NaN, is 0; ``strict`` wants integers and fails on others.

    keep_missing: null cells become 0, else their rows are left out.
    """
    samples = samples or [c for c in wide.columns if c != id_col]
    cells = wide.select(F.col(f"`{id_col}`"), *(F.col(f"`{c}`").cast("string").alias(c) for c in samples))
    rows = cells.unpivot([F.col(f"`{id_col}`")], [F.col(f"`{c}`") for c in samples], "sample", "cell")
    if not keep_missing:
        rows = rows.filter("cell is not null")
    value = F.col("cell").cast("bigint") if strict else F.coalesce(F.nanvl(F.expr("try_cast(cell as double)"), F.lit(0.0)), F.lit(0.0))
    return rows.select(f"`{id_col}`", "sample", value.alias("value"))


def read_matrix(spark: SparkSession, path: str, id_col: str | None = None, columns: list[str] | str = "*", strict: bool = False) -> DataFrame:
    """(tx, sample, value) from a TSV or CSV; the delimiter is the header's, the id column is found without regard to case."""
    head = spark.read.text(path).first()
    sep = "," if head is None or head[0].count(",") > head[0].count("\t") else "\t"
    wide = spark.read.csv(path, header=True, sep=sep)
    found = wide.columns[0] if id_col is None else next((c for c in wide.columns if c.lower().lstrip("#") == id_col.lower().lstrip("#")), None)
    if found is None:
        raise ValueError(f"no column {id_col} in {path}")
    if columns in ("*", "ALL"):
        names = [c for c in wide.columns if c != found]
    else:
        names = [columns] if isinstance(columns, str) else list(columns)
        if missing := [c for c in names if c not in wide.columns]:
            raise ValueError(f"no columns {', '.join(missing)} in {path}")
    return to_long(wide.withColumnRenamed(found, "tx"), "tx", names, strict=strict)
