"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lakeload.workspace import shared_folder


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder; see :func:`lakeload.workspace.shared_folder`."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *, batch_bytes: int | None = None) -> DataFrame:
    """``df``, written once and read from there: its lineage ends, and a lost executor costs
    nothing that was finished. The files of its shuffles go as soon as it is written; otherwise they
    stay until the driver happens to collect its garbage.

    ``batch_bytes`` bounds the batches in which Python gets rows meanwhile, if the session's bound
    is larger."""
    spark = df.sparkSession
    path = new_path(spark, name)
    settings = {_CLEANUP: "true"}
    if batch_bytes and not 0 < _bytes(spark.conf.get(_BATCH_BYTES)) <= batch_bytes:
        settings[_BATCH_BYTES] = str(batch_bytes)
    with _set(spark, settings):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _bytes(setting: str) -> int:
    """A size as Spark shows it: a number, perhaps with a unit."""
    number = setting.lower().rstrip("b").rstrip("kmgtp")
    unit = setting.lower().rstrip("b")[len(number) :]
    return int(number) << (10 * (" kmgtp".index(unit) if unit else 0))


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings that hold in this block."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
