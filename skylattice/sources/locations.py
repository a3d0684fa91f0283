"""The list of places to watch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.schemas import LOCATION_LIST


def explode_locations(documents: DataFrame) -> DataFrame:
    """One row per place; a document without a ``neighborhoods`` list is an error."""
    listed = F.coalesce(
        F.col("neighborhoods"),
        F.raise_error(F.lit("location list has no 'neighborhoods' key")).cast(
            LOCATION_LIST["neighborhoods"].dataType
        ),
    )
    return documents.select(F.explode(listed).alias("place")).select("place.*")


def read_locations(spark: SparkSession, path: str, line_delimited: bool = False) -> DataFrame:
    """``name, latitude, longitude`` from one document per file, or one per line."""
    reader = spark.read.schema(LOCATION_LIST).option("mode", "FAILFAST")
    return explode_locations(reader.option("multiLine", not line_delimited).json(path))
