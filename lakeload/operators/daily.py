"""Tables loaded one run date at a time."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.dates import as_datetime, instant, iso_text, run_instant
from lakeload.names import in_builtin_catalog, text_literal
from lakeload.operators.tables import FORMAT, conforming, description, exists, insert


@dataclass(frozen=True)
class DayLoad:
    """What one load did. The date is in UTC and can be given back as a run date in any session."""

    table_name: str
    logical_date: str
    records_processed: int
    operation: str

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.sql(
            "SELECT table_name, logical_date, "
            "CAST(records_processed AS BIGINT) AS records_processed, operation "
            "FROM VALUES (:table_name, :logical_date, :records_processed, :operation) "
            "AS t(table_name, logical_date, records_processed, operation)",
            args=asdict(self),
        )


def load_day(
    df: DataFrame,
    table: str,
    logical_date: str | date,
    *,
    mode: str = "append",
    evolve: bool = False,
) -> DayLoad:
    """Load ``df`` as the rows of one run date, creating the table if need be.

    The table is partitioned by ``logical_date``. ``mode="append"`` adds to whatever the date
    holds; ``mode="overwrite"`` puts the rows in place of the date's and leaves other dates alone,
    so that a run can be repeated. Old rows stay until the new ones are written in full.
    ``evolve`` is that of :func:`lakeload.append`.

    The rows are counted as they are written. There is no shuffle and no sort: all rows share one
    partition value, and each task writes its own file.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be append or overwrite, not {mode!r}")
    spark = df.sparkSession
    micros = run_instant(spark, logical_date)
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("records")).withColumn(
        "logical_date", instant(micros)
    )
    if not exists(spark, table):
        _create(rows, table)
        operation = "created"
    else:
        with conforming(rows, table, evolve=evolve) as (fitting, target):
            if mode == "append":
                insert(fitting, target)
                operation = "appended"
            else:
                _overwrite(fitting, target, micros)
                operation = "overwritten"
        if mode == "overwrite" and counted.get["records"] == 0:
            _drop_day(spark, table, micros)
    return DayLoad(
        table_name=table,
        logical_date=iso_text(micros),
        records_processed=counted.get["records"],
        operation=operation,
    )


def day_slice(df: DataFrame, logical_date: str | date) -> DataFrame:
    """The rows of one run date; on a daily table only that partition is read."""
    return df.filter(F.col("logical_date") == instant(run_instant(df.sparkSession, logical_date)))


def _create(rows: DataFrame, table: str) -> None:
    if in_builtin_catalog(rows.sparkSession, table):
        # Parquet partitions keep the timestamp as text in the directory name. Pinning its zone
        # lets sessions in different zones agree on the instant.
        writer = rows.write.format(FORMAT).option("timeZone", "UTC")
        writer.partitionBy("logical_date").saveAsTable(table)
    else:
        rows.writeTo(table).partitionedBy(F.col("logical_date")).create()


def _overwrite(rows: DataFrame, table: str, micros: int) -> None:
    spark = rows.sparkSession
    if not in_builtin_catalog(spark, table):
        rows.writeTo(table).overwrite(F.col("logical_date") == instant(micros))
        return
    if description(spark, table).get("partition_columns") != ["logical_date"]:
        raise ValueError(f"{table} is not partitioned by logical_date")
    # Dynamic, because a static overwrite deletes the old partition before it starts writing, and
    # as an option of the statement, because the session's setting is not ours to change.
    spark.sql(
        f"INSERT OVERWRITE {table} WITH ('partitionOverwriteMode' = 'dynamic') "
        "SELECT * FROM {rows}",
        rows=rows,
    )


def _drop_day(spark: SparkSession, table: str, micros: int) -> None:
    """Drop the rows of a date that was overwritten by none: there was no partition to overwrite."""
    if not in_builtin_catalog(spark, table):
        return
    zone = description(spark, table).get("storage_properties", {}).get("timeZone")
    spark.sql(
        f"ALTER TABLE {table} DROP IF EXISTS PARTITION "
        f"(logical_date = {text_literal(_partition_value(spark, micros, zone))})"
    )


def _partition_value(spark: SparkSession, micros: int, zone: str | None) -> str:
    """The date as Spark spells it in the table's partition names."""
    if zone == "UTC":
        text = as_datetime(micros).replace(tzinfo=None).isoformat(sep=" ")
        return text.rstrip("0") if "." in text else text
    return spark.range(1).select(instant(micros).cast("string")).first()[0]
