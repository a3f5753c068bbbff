"""Literal rows that a rate card starts with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Big-and-bulky rating, dollars, percent.
SIZE_RATINGS = [(0, 0.0, 0.0), (1, 0.0, 0.1), (2, 0.0, 0.18)]
SIZE_RATING_VALUES = ["bb_surcharged", "bb_surchargep"]


def size_ratings(spark: SparkSession) -> DataFrame:
    """Seeds of bb_v6, to be merged by rating with ``upsert``."""
    schema = "bb_rating int, bb_surcharged double, bb_surchargep double"
    return spark.createDataFrame(SIZE_RATINGS, schema)
