"""Columns added to every row of a load."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.functions.dates import instant, run_instant


def with_logical_date(df: DataFrame, logical_date: str | date) -> DataFrame:
    """Add ``logical_date``, the run the rows belong to, as a timestamp constant."""
    return df.withColumn("logical_date", instant(run_instant(df.sparkSession, logical_date)))


def with_load_times(df: DataFrame, *names: str) -> DataFrame:
    """Add columns holding the time of the load; all of one load are equal."""
    return df.withColumns({name: F.current_timestamp() for name in names})
