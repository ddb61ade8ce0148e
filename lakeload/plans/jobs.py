"""The batch jobs: file in, table out, one row of figures back."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeload.names import column, folding
from lakeload.operators.daily import load_day
from lakeload.operators.profile import profile
from lakeload.operators.stamp import with_load_times
from lakeload.operators.tables import exists, replace, widened
from lakeload.sources.csv import load_csv

USERS_STATS = {
    "total_users": ("count", "*"),
    "unique_departments": ("count_distinct", "department"),
    "avg_age": ("avg", "age"),
    "avg_salary": ("avg", "salary"),
}
PRODUCTS_STATS = {
    "total_products": ("count", "*"),
    "unique_categories": ("count_distinct", "category"),
    "avg_price": ("avg", "price"),
    "total_stock": ("sum", "stock_quantity"),
}

# How the figures of each job appear in its report.
USERS_PATTERNS = {"avg_age": "0.0", "avg_salary": "$#,##0.00"}
PRODUCTS_PATTERNS = {"avg_price": "$0.00"}


def refresh_and_profile(
    spark: SparkSession,
    path: str | os.PathLike,
    table: str,
    stats: Mapping[str, tuple[str, str]],
    *,
    stamps: Sequence[str] = (),
    root: str | os.PathLike | None = None,
    schema: StructType | str | None = None,
    infer: bool = False,
    missing: str | None = None,
    **options,
) -> DataFrame:
    """Replace a table by a CSV file plus load times; return ``table_name`` and ``stats``.

    Once the table exists it supplies the types of the columns it has, so the text is read once;
    ``infer`` has them inferred anew. Columns may come; what happens to those that the file lacks
    is up to ``missing``: ``drop`` lets them go, which is so unless told otherwise, ``null`` keeps
    them without values, and ``error`` refuses the file. Pass ``schema`` for a large first load, see
    :func:`lakeload.load_csv`; there ``error`` is the default.

    The figures are worked out from the new rows as written, a column-pruned scan, before these
    take the table's place: if a column that ``stats`` needs is missing or no number, or an
    aggregate fails, the old table stays. They are returned as computed, so they stay readable
    whatever becomes of the table.
    """
    if missing not in (None, "error", "null", "drop"):
        raise ValueError(f"missing must be error, null or drop, not {missing!r}")
    before = spark.table(table).schema if schema is None and exists(spark, table) else None
    fold = folding(spark)
    own = set(map(fold, stamps))
    stored = StructType([f for f in before or () if fold(f.name) not in own])
    if before is not None and not infer:
        loaded = load_csv(
            spark,
            path,
            root=root,
            schema=stored,
            infer_new=True,
            missing=missing or "drop",
            **options,
        )
    else:
        loaded = load_csv(spark, path, root=root, schema=schema, missing=missing or "error", **options)
        loaded = _with_missing(loaded, stored, missing or "drop", path)
    stamped = with_load_times(loaded, *stamps)
    _check_columns(stamped, stats)
    figures: list = []

    def compute(rows: DataFrame) -> None:
        named = profile(rows, stats).select(F.lit(table).alias("table_name"), "*")
        figures.extend((named.collect(), named.schema))

    replace(stamped, table, check=compute)
    return spark.createDataFrame(*figures)


def _with_missing(
    loaded: DataFrame, stored: StructType, missing: str, path: str | os.PathLike
) -> DataFrame:
    """Rows whose types were inferred, with the table's columns that they lack as ``missing`` says."""
    fold = folding(loaded.sparkSession)
    there = {fold(name) for name in loaded.columns}
    absent = [field for field in stored if fold(field.name) not in there]
    if absent and missing == "error":
        raise ValueError(f"{path} lacks columns of the table: {[f.name for f in absent]}")
    if missing == "drop":
        return loaded
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in absent]
    return loaded.select(*map(column, loaded.columns), *nulls)


def _check_columns(df: DataFrame, stats: Mapping[str, tuple[str, str]]) -> None:
    fold = folding(df.sparkSession)
    types = {fold(field.name): field.dataType for field in df.schema}
    for function, name in stats.values():
        if name == "*":
            continue
        if fold(name) not in types:
            raise ValueError(f"{function} needs a column {name!r}; there are {df.columns}")
        kind = types[fold(name)]
        # A file without rows has columns of text; their figures are null.
        if function in ("avg", "sum") and isinstance(kind, StringType) and not df.isEmpty():
            raise ValueError(f"{function} needs numbers, but {name!r} is {kind.simpleString()}")


def refresh_users(spark: SparkSession, path: str | os.PathLike, table: str, **kw) -> DataFrame:
    """Refresh a table of users, stamped ``processed_at``."""
    return refresh_and_profile(spark, path, table, USERS_STATS, stamps=["processed_at"], **kw)


def refresh_products(spark: SparkSession, path: str | os.PathLike, table: str, **kw) -> DataFrame:
    """Refresh a table of products, stamped ``created_at`` and ``updated_at``."""
    stamps = ["created_at", "updated_at"]
    return refresh_and_profile(spark, path, table, PRODUCTS_STATS, stamps=stamps, **kw)


def daily_load(
    spark: SparkSession,
    path: str | os.PathLike,
    table: str,
    logical_date: str | date,
    *,
    root: str | os.PathLike | None = None,
    schema: StructType | str | None = None,
    mode: str = "append",
    evolve: bool = False,
    **options,
) -> DataFrame:
    """Load a CSV file into a daily table; return one row saying what was done.

    Once the table exists it supplies the column types. Later days are then read in a single
    pass, and a column that happens to look different on one day keeps its type. With ``evolve``
    types are inferred again, which reads the file once more: columns may be new or missing, and a
    number that needs it makes its column wider, for which a table in the session catalog is
    written anew.
    """
    if schema is None and exists(spark, table):
        fold = folding(spark)
        stored = [f for f in spark.table(table).schema if fold(f.name) != "logical_date"]
        schema = StructType(stored)
        if evolve:
            schema = _merged(schema, load_csv(spark, path, root=root, **options).schema, fold)
        # A file's own column of that name is replaced, whatever it holds.
        schema = schema.add("logical_date", StringType())
    rows = load_csv(
        spark,
        path,
        root=root,
        schema=schema,
        infer_new=evolve,
        missing="drop" if evolve else "error",
        optional=["logical_date"],
        **options,
    )
    return load_day(rows, table, logical_date, mode=mode, evolve=evolve).to_df(spark)


def _merged(
    stored: StructType, inferred: StructType, fold: Callable[[str], str]
) -> StructType:
    """The table's types, wider where a day's file needs it, names compared as the session does."""
    found = {fold(field.name): field.dataType for field in inferred}
    return StructType(
        [
            StructField(f.name, widened(found.get(fold(f.name), f.dataType), f.dataType) or f.dataType)
            for f in stored
        ]
    )
