"""Create, append to, replace and drop catalog tables.

Names have two parts in Spark's session catalog and three in any other. Tables in the session
catalog are Parquet.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import timedelta
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    IntegralType,
    LongType,
    MapType,
    NumericType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from lakeload.names import column, folding, in_builtin_catalog, quoted, sibling, text_literal

FORMAT = "parquet"

# What marks an entry of the catalog as this library's: the place of the files that it wrote for the
# entry, and, for a version that was replaced, the table it belonged to.
_FILES = "lakeload.files"
_RETIRED = "lakeload.retired"


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def drop(spark: SparkSession, table: str) -> None:
    """Drop the table if it is there, with its files and those that it replaced.

    Files that this library did not write for an external table stay, and so does every other
    table, whatever its name.
    """
    if in_builtin_catalog(spark, table) and exists(spark, table):
        purge(spark, table, timedelta(0))
        _drop_whole(spark, table, description(spark, table))
    else:
        drop_entry(spark, table)


def create(df: DataFrame, table: str) -> None:
    """Write a new table. It is an error if it exists."""
    if in_builtin_catalog(df.sparkSession, table):
        df.write.format(FORMAT).saveAsTable(table)
    else:
        df.writeTo(table).create()


def append(df: DataFrame, table: str, *, evolve: bool = False) -> None:
    """Add rows to an existing table, columns matched by name.

    Columns that only one side has are an error, and so are types that would cut values. With
    ``evolve`` new columns are added to the table, missing ones filled with null, and a column that
    must be wider to take the rows is made so. The table's entry changes last, once all rows are
    written: if anything fails before, columns and rows are as they were.
    """
    with conforming(df, table, evolve=evolve) as (rows, target):
        insert(rows, target)


def insert(rows: DataFrame, table: str) -> None:
    """Add rows that have the table's columns in the table's order."""
    if in_builtin_catalog(rows.sparkSession, table):
        rows.write.insertInto(table)
    else:
        rows.writeTo(table).append()


def replace(
    df: DataFrame,
    table: str,
    *,
    partition_by: Sequence[str] | None = None,
    check: Callable[[DataFrame], object] | None = None,
) -> None:
    """Put ``df`` in place of the table's rows and schema, creating it if need be.

    The new rows are written out in full before the old ones are given up: a failing write leaves
    the table as it was, and ``df`` may read the very table it replaces. So does ``check``, called
    with the rows as written (in other catalogs: with ``df``), if it raises. ``partition_by``
    defaults to the table's own partitioning, as far as ``df`` has the columns.

    In the session catalog the new files lie in a folder of their own, and one change of the
    catalog's entry turns the table to it; no file moves. Comments and properties stay. The old
    files stay too, for queries that still read them, until :func:`purge`. A partitioned table
    that stays so, with the same columns, has its partitions overwritten by the new rows instead,
    and those that are gone dropped; partitioned another way or with other columns it is dropped
    for the new one. Either ends queries running on it.
    """
    spark = df.sparkSession
    there = exists(spark, table)
    if partition_by is None:
        before = description(spark, table).get("partition_columns", []) if there else []
        partition_by = [name for name in before if name in df.columns]
    if not in_builtin_catalog(spark, table):
        if check:
            check(df)
        writer = df.writeTo(table)
        if partition_by:
            writer = writer.partitionedBy(*map(column, partition_by))
        writer.createOrReplace()
        return

    old = description(spark, table) if there else None
    staged = sibling(table, f"stage_{uuid.uuid4().hex}") if old else table
    _write_version(df, staged, old, partition_by)
    try:
        if check:
            check(spark.table(staged))
        if old:
            _take_place(spark, staged, table, old)
    except Exception:
        if old is None:
            drop(spark, table)
        elif exists(spark, table) and exists(spark, staged):
            _discard(spark, staged, table)
        raise


def purge(spark: SparkSession, table: str, older_than: timedelta = timedelta(days=7)) -> int:
    """Delete the files that :func:`replace` left for running queries; how many versions went.

    Only entries that say they are versions of this table are touched.
    """
    limit = int((time.time() - older_than.total_seconds()) * 1000)
    gone = 0
    for name, retired in _retired(spark, table):
        if retired <= limit:
            _drop_whole(spark, name, description(spark, name))
            gone += 1
    return gone


def _write_version(df: DataFrame, name: str, old: dict | None, partition_by: Sequence[str]) -> None:
    """Write rows as a new table: beside the files of the one whose place it is to take, unless
    there is none or partitions are to be overwritten or dropped, which a managed table does."""
    writer = df.write.format(FORMAT)
    if partition_by:
        # In a partitioned table's folder names instants are written in one zone; see load_day.
        writer = writer.option("timeZone", "UTC").partitionBy(*partition_by)
    elif old:
        writer = writer.option("path", f"{_folder(old)}__v_{uuid.uuid4().hex}")
    writer.saveAsTable(name)


def _take_place(spark: SparkSession, staged: str, table: str, old: dict) -> None:
    """Give a table the rows and columns of a stage, which goes."""
    new = description(spark, staged)
    if not new.get("partition_columns") and not old.get("partition_columns"):
        _turn(spark, staged, table, old, new)
    elif _layout(old) == _layout(new):
        _overwrite_partitions(spark, staged, table)
        drop_entry(spark, staged)
    else:
        # All rows are in the stage, under its entry, until it has the table's name.
        _drop_whole(spark, table, old)
        _rename(spark, staged, table)
        if new.get("partition_columns"):
            # The folder has moved, but its partitions' entries still name the old place.
            spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        else:
            _mark(spark, table, new["location"])
        _describe(spark, table, old)


def _overwrite_partitions(spark: SparkSession, staged: str, table: str) -> None:
    """The stage's rows in place of the table's, both partitioned alike."""
    gone = set(_partitions(spark, table)) - set(_partitions(spark, staged))
    spark.sql(
        f"INSERT OVERWRITE {table} WITH ('partitionOverwriteMode' = 'dynamic') SELECT * FROM {staged}"
    )
    if gone:
        specs = ", ".join(f"PARTITION ({_spec(name)})" for name in sorted(gone))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def _partitions(spark: SparkSession, table: str) -> list[str]:
    """Names of a table's partitions, as in its folder."""
    return [row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def _spec(partition: str) -> str:
    """A partition's name as SQL."""
    pairs = (part.split("=", 1) for part in partition.split("/"))
    return ", ".join(
        f"{quoted(unquote(name))} = "
        + ("null" if value == "__HIVE_DEFAULT_PARTITION__" else text_literal(unquote(value)))
        for name, value in pairs
    )


def drop_entry(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def _drop_whole(spark: SparkSession, table: str, described: dict) -> None:
    """Drop an entry, with its files if they are its own."""
    drop_entry(spark, table)
    if described["type"] != "MANAGED" and _ours(described):
        _delete(spark, described["location"])


def _retired(spark: SparkSession, table: str) -> Iterator[tuple[str, int]]:
    """The entries of replaced versions of a table, and when each was replaced (in ms)."""
    prefix = sibling(table, "old_")
    database, _, name = prefix.rpartition(".")
    within = f" IN {database}" if database else ""
    for row in spark.sql(f"SHOW TABLES{within} LIKE '{name}*'").collect():
        found = f"{database}.{row.tableName}" if database else row.tableName
        owner, _, when = _property(description(spark, found), _RETIRED).rpartition("@")
        if owner == _own_name(spark, table):
            yield found, int(when)


def _own_name(spark: SparkSession, table: str) -> str:
    """A table's full name as the catalog keeps it."""
    described = description(spark, table)
    return ".".join([*described["namespace"], described["table_name"]])


def _property(described: dict, key: str) -> str:
    return (described.get("table_properties") or {}).get(key, "")


def _folder(described: dict) -> str:
    """Where a table's versions lie side by side."""
    return re.sub("__v_[0-9a-f]{32}$", "", described["location"].rstrip("/"))


def _ours(described: dict) -> bool:
    """Whether the files are the table's own: managed, or written for it by an earlier replace."""
    return described["type"] == "MANAGED" or _property(described, _FILES) == described["location"]


def _mark(spark: SparkSession, table: str, location: str) -> None:
    """Note that the files at a place were written for this entry."""
    pair = f"{text_literal(_FILES)} = {text_literal(location)}"
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pair})")


def _turn(spark: SparkSession, staged: str, table: str, old: dict, new: dict) -> None:
    """Let the table's entry name the staged files.

    Whatever dies in between, each set of files keeps an entry that owns none of them: dropping
    left-over entries deletes nothing. With another schema there is a moment, of two statements
    about the catalog, in which only the left-over entries name the rows.
    """
    if _ours(old):
        now = int(time.time() * 1000)
        retired = sibling(table, f"old_{now}_{uuid.uuid4().hex}")
        pairs = {_FILES: old["location"], _RETIRED: f"{_own_name(spark, table)}@{now}"}
        spark.sql(
            f"CREATE TABLE {_two_parts(retired)} LIKE {_two_parts(table)} USING {FORMAT} "
            f"TBLPROPERTIES ({_pairs(pairs)}) LOCATION {text_literal(old['location'])}"
        )
    if _layout(old) == _layout(new):
        _set_location(spark, table, new["location"])
        _mark(spark, table, new["location"])
        drop_entry(spark, staged)
        return
    # Another schema needs another entry. The old one lets go of its files before it goes.
    if old["type"] == "MANAGED":
        _set_location(spark, table, new["location"] + "__none")
    drop_entry(spark, table)
    _rename(spark, staged, table)
    _mark(spark, table, new["location"])
    _describe(spark, table, old)


def _pairs(properties: Mapping[str, str]) -> str:
    return ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in properties.items())


def _describe(spark: SparkSession, table: str, old: dict) -> None:
    """Carry comments and properties over to a new entry."""
    if old.get("comment"):
        spark.sql(f"COMMENT ON TABLE {table} IS {text_literal(old['comment'])}")
    properties = {k: v for k, v in (old.get("table_properties") or {}).items() if k != _FILES}
    if properties:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_pairs(properties)})")
    kept = set(spark.table(table).columns)
    for col in old["columns"]:
        if col.get("comment") and col["name"] in kept:
            comment = text_literal(col["comment"])
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN {quoted(col['name'])} COMMENT {comment}")


def _discard(spark: SparkSession, staged: str, table: str) -> None:
    """Drop a stage that is not needed any more; not its files if they are the table's."""
    location = description(spark, staged)["location"]
    shared = description(spark, table)["location"].rstrip("/") == location.rstrip("/")
    drop_entry(spark, staged)
    if not shared:
        _delete(spark, location)


def _delete(spark: SparkSession, location: str) -> None:
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def _set_location(spark: SparkSession, table: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION {text_literal(location)}")


def _rename(spark: SparkSession, table: str, name: str) -> None:
    spark.sql(f"ALTER TABLE {table} RENAME TO {_two_parts(name)}")


def _two_parts(name: str) -> str:
    return name.replace("`", "").removeprefix("spark_catalog.")


def description(spark: SparkSession, table: str) -> dict:
    """What the catalog knows of the table."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])


def _layout(described: dict) -> dict:
    """What of an entry depends on the files: not comments or properties."""
    columns = [(col["name"], col["type"]) for col in described["columns"]]
    keys = ("provider", "partition_columns", "bucket_columns")
    return {"columns": columns} | {key: described[key] for key in keys if described.get(key)}


@contextmanager
def conforming(
    df: DataFrame, table: str, *, evolve: bool = False
) -> Iterator[tuple[DataFrame, str]]:
    """``df`` with the columns of a table to insert it into, in its order, and that table's name.

    Where ``evolve`` has to change the table, the name is that of a stand-in: an entry with the new
    columns over the same files or, if columns become wider, over a copy of them. When all is
    inserted the table's entry changes; if that fails, the table is as it was.
    """
    spark = df.sparkSession
    fold = folding(spark)
    target = spark.table(table).schema
    given = {fold(field.name): field for field in df.schema}
    wanted = {fold(field.name): field for field in target}
    new = [field for key, field in given.items() if key not in wanted]
    missing = [field.name for key, field in wanted.items() if key not in given]
    if (new or missing) and not evolve:
        raise ValueError(
            f"columns do not match {table}: not in the table {[f.name for f in new]}, "
            f"not in the rows {missing}"
        )
    wider: dict[str, DataType] = {}
    for key in given.keys() & wanted.keys():
        source, sink = given[key].dataType, wanted[key].dataType
        both = widened(source, sink) if evolve and not _holds(source, sink) else None
        if both is not None:
            wider[wanted[key].name] = both
        elif _loses(source, sink):
            raise ValueError(
                f"{table}.{wanted[key].name} is {sink.simpleString()}, which would cut "
                f"incoming {source.simpleString()} values"
            )

    def fitting(name: str) -> DataFrame:
        return df.select(
            *[
                (column(f.name) if fold(f.name) in given else F.lit(None).cast(f.dataType)).alias(
                    f.name
                )
                for f in spark.table(name).schema
            ]
        )

    if not (new or wider):
        yield fitting(table), table
        return
    change = _changed if in_builtin_catalog(spark, table) else _altered
    with change(spark, table, new, wider) as name:
        yield fitting(name), name


@contextmanager
def _changed(
    spark: SparkSession, table: str, new: Sequence[StructField], wider: Mapping[str, DataType]
) -> Iterator[str]:
    """A stand-in for a table of the session catalog, which becomes like it in the end."""
    old = description(spark, table)
    name = sibling(table, f"stage_{uuid.uuid4().hex}")
    if wider:
        stored = spark.table(table)
        casts = {n: column(n).cast(kind) for n, kind in wider.items()}
        _write_version(stored.withColumns(casts), name, old, old.get("partition_columns", []))
    else:
        place = text_literal(old["location"])
        entry = f"{_two_parts(name)} LIKE {_two_parts(table)}"
        spark.sql(f"CREATE TABLE {entry} USING {FORMAT} LOCATION {place}")
    try:
        if new:
            _add_columns(spark, name, new)
        yield name
        if wider:
            _take_place(spark, name, table, old)
            return
        _add_columns(spark, table, new)
        written = _partitions(spark, name) if old.get("partition_columns") else []
        if written:
            specs = " ".join(f"PARTITION ({_spec(part)})" for part in written)
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
        spark.catalog.refreshTable(table)
    finally:
        if not wider:
            drop_entry(spark, name)  # the files are the table's
        elif exists(spark, name) and exists(spark, table):
            _discard(spark, name, table)


@contextmanager
def _altered(
    spark: SparkSession, table: str, new: Sequence[StructField], wider: Mapping[str, DataType]
) -> Iterator[str]:
    """A table of a catalog that can alter columns. Added ones go again if the rest fails; one that
    was made wider stays so."""
    for name, kind in wider.items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN {quoted(name)} TYPE {kind.simpleString()}")
    if new:
        _add_columns(spark, table, new)
    try:
        yield table
    except Exception:
        if new:
            names = ", ".join(quoted(field.name) for field in new)
            spark.sql(f"ALTER TABLE {table} DROP COLUMNS ({names})")
        raise


def _add_columns(spark: SparkSession, table: str, new: Sequence[StructField]) -> None:
    added = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in new)
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")


_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
# Decimal digits that come back unchanged, and whole bits that are kept.
_FLOAT_DIGITS = {FloatType: 6, DoubleType: 15}
_KEPT_BY = {FloatType: (ByteType, ShortType), DoubleType: (ByteType, ShortType, IntegerType)}


def widened(source: DataType, sink: DataType) -> DataType | None:
    """The narrowest type that holds all values of two numeric types, if there is one."""
    candidates = [sink, source, LongType(), DoubleType()]
    parts = [_as_decimal(kind) for kind in (source, sink)]
    if None not in parts:
        scale = max(part.scale for part in parts)
        precision = scale + max(part.precision - part.scale for part in parts)
        if precision <= 38:
            candidates.insert(2, DecimalType(precision, scale))
    if any(isinstance(kind, (FloatType, DoubleType)) for kind in (source, sink)):
        candidates = [kind for kind in candidates if isinstance(kind, (FloatType, DoubleType))]
    return next((c for c in candidates if _holds(source, c) and _holds(sink, c)), None)


def _holds(source: DataType, wide: DataType) -> bool:
    """Whether every value of a numeric type is one of the other, too."""
    if not all(isinstance(kind, NumericType) for kind in (source, wide)):
        return False
    if source == wide:
        return True
    if isinstance(wide, (FloatType, DoubleType)):
        return not _loses(source, wide)
    one, two = _as_decimal(source), _as_decimal(wide)
    if one is None or two is None:
        return False
    whole = (one.precision - one.scale, two.precision - two.scale)
    return one.scale <= two.scale and whole[0] <= whole[1]


def _as_decimal(kind: DataType) -> DecimalType | None:
    if isinstance(kind, DecimalType):
        return kind
    return DecimalType(_DIGITS[type(kind)], 0) if type(kind) in _DIGITS else None


def _loses(source: DataType, sink: DataType) -> bool:
    """Store assignments that Spark lets through although they cut values, or that may overflow.

    It rejects senseless ones (text into numbers) by itself.
    """
    if isinstance(source, StructType) and isinstance(sink, StructType):
        pairs = zip(source, sink, strict=False)
        return any(_loses(one.dataType, two.dataType) for one, two in pairs)
    if isinstance(source, ArrayType) and isinstance(sink, ArrayType):
        return _loses(source.elementType, sink.elementType)
    if isinstance(source, MapType) and isinstance(sink, MapType):
        keys = _loses(source.keyType, sink.keyType)
        return keys or _loses(source.valueType, sink.valueType)
    if isinstance(source, (FloatType, DoubleType)):
        if isinstance(source, DoubleType) and isinstance(sink, FloatType):
            return True
        return isinstance(sink, (IntegralType, DecimalType))
    if isinstance(source, IntegralType) and type(sink) in _KEPT_BY:
        return not isinstance(source, _KEPT_BY[type(sink)])
    if isinstance(source, DecimalType):
        if type(sink) in _FLOAT_DIGITS:
            return source.precision > _FLOAT_DIGITS[type(sink)]
        kept = sink.scale if isinstance(sink, DecimalType) else 0
        return isinstance(sink, (IntegralType, DecimalType)) and source.scale > kept
    return isinstance(source, (TimestampType, TimestampNTZType)) and isinstance(sink, DateType)
