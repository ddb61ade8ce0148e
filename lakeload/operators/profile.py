"""One-row summaries of a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.numbers import formatted
from lakeload.names import column

_AGGREGATES = {
    "count": F.count,
    "approx_count_distinct": F.approx_count_distinct,
    "avg": lambda c: F.avg(c).cast("double"),
    "sum": F.sum,
    "max": F.max,
    "min": F.min,
}


def _aggregate(function: str, name: str) -> Column:
    if name == "*":
        if function != "count":
            raise ValueError(f"{function}(*) is not an aggregate")
        return F.count("*")
    return _AGGREGATES[function](column(name))


def profile(df: DataFrame, stats: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Aggregate the whole of ``df`` to one row.

    ``stats`` maps each result column to ``(function, column)``, for example
    ``{"users": ("count", "*"), "mean_age": ("avg", "age")}``. Counts are exact, but for
    ``approx_count_distinct``; averages over no rows are null.

    All but ``count_distinct`` come out of one scan of just their columns, a row from each task.
    Every distinct count has a scan of its column alone, and only that column's values are
    shuffled, after each task has dropped its own repeats: a value in most of the rows does not
    crowd into one task, and no other figure travels with it.
    """
    plain = {out: stat for out, stat in stats.items() if stat[0] != "count_distinct"}
    figures = [_aggregate(fn, name).alias(out) for out, (fn, name) in plain.items()]
    row = df.agg(*figures) if figures else None
    for out, (_, name) in stats.items():
        if out not in plain:
            counted = _distinct_count(df, name).alias(out)
            row = df.sparkSession.range(1).select(counted) if row is None else row.select("*", counted)
    if row is None:
        raise ValueError("no statistics are asked for")
    return row.select(*[column(out) for out in stats])


def _distinct_count(df: DataFrame, name: str) -> Column:
    if name == "*":
        raise ValueError("count_distinct(*) is not an aggregate")
    values = df.select(column(name).alias("value")).filter("value IS NOT NULL").distinct()
    return values.agg(F.count("*")).scalar()


def report(profiled: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """A profile as text: the columns in ``patterns`` by their pattern, the others plainly."""
    return profiled.select(
        *[
            (
                formatted(column(name), patterns[name])
                if name in patterns
                else column(name).cast("string")
            ).alias(name)
            for name in profiled.columns
        ]
    )
