"""Literal rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def from_rows(spark: SparkSession, rows: Iterable[Sequence], names: Sequence[str]) -> DataFrame:
    """A DataFrame of a few rows written out in the program; types follow the Python values."""
    return spark.createDataFrame(list(rows), list(names))
