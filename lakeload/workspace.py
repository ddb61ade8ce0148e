"""Scratch databases for trial runs: the registered queries, the bench and the tests."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass
from functools import cache

from pyspark.sql import SparkSession

from lakeload.names import text_literal


@dataclass(frozen=True)
class Workspace:
    """A database of its own with a folder every executor can reach."""

    database: str
    location: str

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def path(self, name: str) -> str:
        return f"{self.location}/_files/{name}"

    def drop(self, spark: SparkSession) -> None:
        """Drop the database with its tables and files."""
        spark.sql(f"DROP DATABASE IF EXISTS {self.database} CASCADE")


def new_workspace(spark: SparkSession) -> Workspace:
    """A fresh, empty workspace under the shared folder the cluster names."""
    database = f"lakeload_{uuid.uuid4().hex}"
    location = f"{shared_folder(spark)}/{database}"
    spark.sql(f"CREATE DATABASE {database} LOCATION {text_literal(location)}")
    return Workspace(database, location)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; unset on a local master, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.conf.get("spark.master", "").startswith("local"):
        folder = _local_folder()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="lakeload-")
