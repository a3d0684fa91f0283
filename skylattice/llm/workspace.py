"""Stages of a long job, written to the shared folder of the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skylattice import files
from skylattice.session import materialize, scratch_dir


class Workspace:
    """Tables under one fresh folder of ``spark.checkpoint.dir``.

    A staged table cuts the lineage in a way that survives lost executors.
    ``drop`` removes tables that no later step reads; what a returned DataFrame
    still reads stays until the folder is cleared.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = scratch_dir(spark)
        self.staged: list[tuple[DataFrame, str]] = []

    def path(self) -> str:
        return f"{self.root}/{len(self.staged)}"

    def stage(self, df: DataFrame) -> DataFrame:
        path = self.path()
        self.staged.append((df, path))
        self.staged[-1] = (materialize(df, path), path)
        return self.staged[-1][0]

    def drop(self, *tables: DataFrame) -> None:
        for df, path in self.staged:
            if any(df is table for table in tables):
                files.delete(self.spark, path)
