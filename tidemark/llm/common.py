"""Helpers shared by the operators: scratch tables, size estimates, block counts."""

from __future__ import annotations

import math
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

#: Plan estimates above this are Spark's "unknown" default, not a size.
UNKNOWN_BYTES = 1 << 56


def ship(spark: SparkSession) -> None:
    """Makes this package importable in Python workers. Nothing to do where PYTHONPATH has it;
    else its files go out with the job, once for each application."""
    top, context = Path(__file__).resolve().parents[2], spark.sparkContext
    if str(top) in os.environ.get("PYTHONPATH", "").split(":") or getattr(context, "_tidemark_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="tidemark-")) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((top / "tidemark").rglob("*.py")):
            out.write(file, file.relative_to(top))
    context.addPyFile(str(archive))
    context._tidemark_shipped = True


class Scratch:
    """Written tables below ``spark.checkpoint.dir``: they cut lineage, every executor can read
    them, and a lost executor costs nothing that was finished. ``drop`` removes one table. The
    executors' shuffle files of a written table are removed with the query that wrote it."""

    CLEAN = "spark.sql.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark, self.root, self.n = spark, scratch_dir(spark, name), 0

    def save(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        before = self.spark.conf.get(self.CLEAN, None)
        self.spark.conf.set(self.CLEAN, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.unset(self.CLEAN) if before is None else self.spark.conf.set(self.CLEAN, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(table._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def input_bytes(df: DataFrame) -> int:
    """Bytes of a frame as Spark's planner sees them (file sizes, no scan). Frames without
    statistics are measured by one aggregate over their columns' text form."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size < UNKNOWN_BYTES:
        return size
    width = [F.coalesce(F.length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns]
    total = df.select(sum(width, F.lit(0)).alias("w")).agg(F.sum("w")).first()[0]
    return int(total or 0)


def blocks_for(size: int, per_block: int, least: int = 1) -> int:
    """Number of blocks so that each holds about ``per_block`` bytes, at any input size."""
    return max(least, math.ceil(size / per_block))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of ``df`` (case-insensitively)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        name = f"_llm_{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str):
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
