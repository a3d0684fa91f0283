"""Polygons of the places; the shapes themselves are passed through as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.schemas import FEATURE, FEATURE_COLLECTION

UNNAMED = "Unknown"


def read_features(spark: SparkSession, path: str, line_delimited: bool = False) -> DataFrame:
    """``hood, geometry`` from feature collections, or from one feature per line.

    A whole collection is one record and so one task; a large set of polygons
    should be landed line by line, which splits.
    """
    if line_delimited:
        features = spark.read.schema(FEATURE).json(path)
    else:
        collections = spark.read.schema(FEATURE_COLLECTION).option("multiLine", True).json(path)
        features = collections.select(F.explode("features").alias("f")).select("f.*")
    named = F.coalesce(F.map_contains_key("properties", "hood"), F.lit(False))
    return features.select(
        F.when(named, F.col("properties")["hood"]).otherwise(UNNAMED).alias("hood"),
        "geometry",
    )
