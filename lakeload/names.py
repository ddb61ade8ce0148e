"""Table and column names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column(name: str) -> Column:
    """The column of exactly that name, dots included."""
    return F.col(quoted(name))


def folding(spark: SparkSession) -> Callable[[str], str]:
    """How the session compares column names."""
    return str if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower


def sibling(table: str, suffix: str) -> str:
    """A name next to ``table`` in Spark's own catalog, where names are plain words."""
    return f"{table.replace('`', '')}__{suffix}"


def in_builtin_catalog(spark: SparkSession, table: str) -> bool:
    """Whether the table lives in Spark's own session catalog.

    Any other catalog (Iceberg and the like) takes all writes through ``DataFrame.writeTo``.
    """
    parts = table.replace("`", "").split(".")
    catalog = parts[0] if len(parts) > 2 else spark.catalog.currentCatalog()
    builtin = spark.conf.get("spark.sql.catalog.spark_catalog", None) in (None, "builtin")
    return catalog == "spark_catalog" and builtin
