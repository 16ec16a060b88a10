"""Lineage cuts: tables written to the folder that the cluster shares, and read again.

The folder is ``spark.checkpoint.dir``, which every executor reaches; a lost executor then costs a re-read and not a
recomputation of everything before. Where it is unset, a session on one machine (tests) gets a temporary folder, and a
cluster an error: a folder of one machine would leave the reread incomplete there.
"""

from __future__ import annotations

import tempfile
import uuid
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is unset: set it to a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='strandloom-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame, name: str, observed: tuple | None = None) -> DataFrame:
    """The same rows as ``df``, reread from a table in the shared folder; ``observed``: (Observation, *aggregates) of the write."""
    path = f"{shared_dir(df.sparkSession)}/strandloom/{name}-{uuid.uuid4().hex}"
    (df if observed is None else df.observe(*observed)).write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._strandloom_path = path
    if (step := _now.get()) is not None:
        step.made.append(out)
    return out


@dataclass(eq=False)
class Mark:
    """The tables that a step has made since; each thread, and each step within a step, has its own."""

    outer: Mark | None
    made: list[DataFrame] = field(default_factory=list)


_now: ContextVar[Mark | None] = ContextVar("strandloom_mark", default=None)


def mark() -> Mark:
    """From here on, what ``cut`` makes in this thread belongs to the step that begins, until ``forget_since`` ends it."""
    point = Mark(_now.get())
    _now.set(point)
    return point


def forget_since(point: Mark, keep: tuple[DataFrame, ...] = ()) -> None:
    """Ends a step: forgets its tables but for those in ``keep``, which the step around it has from then on. Once a step's result is written, what it was made from can go."""
    kept = {id(df) for df in keep}
    forget(*(df for df in point.made if id(df) not in kept))
    if point.outer is not None:
        point.outer.made += [df for df in point.made if id(df) in kept]
    _now.set(point.outer)


def forget(*tables: DataFrame) -> None:
    """Deletes tables made by ``cut``; only for those that nothing later reads, a lost executor's tasks included."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._strandloom_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    gone = {id(df) for df in tables}
    step = _now.get()
    while step is not None:
        step.made = [df for df in step.made if id(df) not in gone]
        step = step.outer


__all__ = ["Mark", "Observation", "cut", "forget", "forget_since", "mark", "shared_dir"]
