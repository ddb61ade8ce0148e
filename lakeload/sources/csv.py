"""CSV files with a header row."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lakeload.names import column, folding

_URI = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:/")


def resolve_path(path: str | os.PathLike, root: str | os.PathLike | None = None) -> str:
    """Absolute paths and URIs as given, anything else under ``root``, itself a path or URI."""
    path = os.fspath(path)
    if root is None or path.startswith("/") or _URI.match(path):
        return path
    return f"{os.fspath(root).rstrip('/')}/{path}"


def load_csv(
    spark: SparkSession,
    path: str | os.PathLike,
    *,
    root: str | os.PathLike | None = None,
    schema: StructType | str | None = None,
    infer_new: bool = False,
    missing: str = "error",
    optional: Sequence[str] = (),
    names: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Scan CSV files that all have the same header.

    Without a schema the types are inferred, which reads the whole input once more: fine for
    small files, a second pass over everything at scale. With a schema (a ``StructType`` or a DDL
    string) the input is read once. The schema is matched to the header by name, in any order. A
    header column it lacks is an error, or inferred when ``infer_new`` is set; one that the header
    lacks is an error, or null, or left out as ``missing`` says: ``error``, ``null`` or ``drop``;
    those in ``optional`` are left out.

    A row with too many or too few cells, or with a cell that does not fit its type, fails the
    read. To keep such rows, pass ``mode="PERMISSIVE"`` and a schema with a string column of the
    name in ``columnNameOfCorruptRecord`` (by default ``_corrupt_record``): it holds their whole
    line, and null for good ones. Spark converts only the columns a query needs, so a cell of the
    wrong type in another shows when that is read; a load reads all.

    Header cells must be distinct and not empty, unless ``names`` gives the columns in the order of
    the files; then headers are skipped, not looked at. Otherwise every file's header is checked.
    ``options`` are those of Spark's CSV source.
    """
    if missing not in ("error", "null", "drop"):
        raise ValueError(f"missing must be error, null or drop, not {missing!r}")
    path = resolve_path(path, root)
    # Unless told otherwise, Spark lays the schema over every file without a look at its header.
    options = {"header": True, "mode": "FAILFAST", "enforceSchema": names is not None, **options}
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if schema is None:
        inferred = _inferred(spark, path, options)
        header = _header(spark, path, inferred.columns, names, options)
        types = zip(header, inferred.schema, strict=True)
        typed = StructType([StructField(name, field.dataType) for name, field in types])
        return spark.read.options(**options).schema(typed).csv(path)

    fold = folding(spark)
    first = names or spark.read.options(**{**options, "mode": "PERMISSIVE"}).csv(path).columns
    header = _header(spark, path, first, names, options)
    bad = _corrupt_column(spark, schema, header, options)
    if bad:
        # Parsing only some columns, Spark would not see what is wrong with a row.
        options = {"columnPruning": False, **options}
    types = {fold(field.name): field.dataType for field in schema if field is not bad}
    new = [name for name in header if fold(name) not in types]
    if new and not infer_new:
        raise ValueError(f"{path} has columns the schema lacks: {new}")
    if new:
        inferred = _inferred(spark, path, options).schema
        types.update((fold(n), f.dataType) for n, f in zip(header, inferred, strict=True) if n in new)
    there = {fold(name) for name in header}
    may_lack = there | {fold(name) for name in optional}
    absent = [f for f in schema if f is not bad and fold(f.name) not in may_lack]
    if absent and missing == "error":
        raise ValueError(f"{path} lacks columns of the schema: {[f.name for f in absent]}")
    fields = [StructField(name, types[fold(name)]) for name in header]
    scanned = spark.read.options(**options).schema(StructType([*fields, *([bad] if bad else [])]))
    rows = scanned.csv(path)
    if absent and missing == "null":
        nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in absent]
        rows = rows.select(*map(column, rows.columns), *nulls)
    return rows


def _inferred(spark: SparkSession, path: str, options: dict) -> DataFrame:
    # A row of the wrong length is for the read to find, which says more of it than inference.
    return spark.read.options(**{**options, "mode": "PERMISSIVE", "inferSchema": True}).csv(path)


def _header(
    spark: SparkSession,
    path: str,
    found: Sequence[str],
    names: Sequence[str] | None,
    options: dict,
) -> list[str]:
    """The names of the columns, given Spark's, which numbers empty and doubled header cells."""
    if names is not None:
        if len(set(map(folding(spark), names))) < len(names) or len(found) != len(names):
            raise ValueError(f"names must be distinct and as many as {path} has columns: {names}")
        return list(names)
    if any(name.endswith(str(i)) for i, name in enumerate(found)):
        first = spark.read.options(**{**options, "header": False, "mode": "PERMISSIVE"}).csv(path)
        cells = list(first.first() or found)
        if cells != list(found):
            raise ValueError(
                f"{path} has empty or doubled header cells, give the columns as names=: {cells}"
            )
    return list(found)


def _corrupt_column(
    spark: SparkSession, schema: StructType, header: Sequence[str], options: dict
) -> StructField | None:
    default = spark.conf.get("spark.sql.columnNameOfCorruptRecord", "_corrupt_record")
    name = options.get("columnNameOfCorruptRecord", default)
    return next((f for f in schema if f.name == name and f.name not in header), None)
