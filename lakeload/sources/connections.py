"""Where tables are stored: a connection record as Spark session properties.

For whoever starts the session::

    SparkSession.builder.config(map=spark_properties(record, packages=[...])).getOrCreate()

A record is a mapping with ``conn_id``, ``conn_type`` and optionally ``host``, ``port``,
``login``, ``password`` and ``extra`` (a mapping or JSON text).
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping, Sequence

from lakeload.sources.csv import resolve_path

# Connection types, names of the extras, and the public property names of the
# Iceberg catalog and of Hadoop's S3A file system.
LOCAL_TYPES = ("fs", "file", "local")
S3_TYPES = ("s3", "aws")
DEFAULT_WAREHOUSE = "warehouse"
DEFAULT_BUCKET = "iceberg-warehouse"
DEFAULT_CATALOG_TYPE = "hadoop"
CATALOG_CLASS = "org.apache.iceberg.spark.SparkCatalog"
EXTENSIONS_CLASS = "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"
REST_EXTRAS = {
    "rest_credential": "credential",
    "rest_oauth2_token": "token",
    "rest_oauth2_server_uri": "oauth2-server-uri",
}
S3_TIMEOUT_EXTRAS = {
    "s3_connection_establish_timeout": ("connection.establish.timeout", 10),
    "s3_connection_timeout": ("connection.timeout", 30),
}
SECRET_EXTRAS = ("rest_credential", "rest_oauth2_token")


def spark_properties(
    record: Mapping,
    catalog: str = "local",
    *,
    root: str = ".",
    packages: Sequence[str] = (),
) -> dict[str, str]:
    """Session properties that bind ``catalog`` to the record's storage.

    ``root`` is where a local warehouse lies. ``packages`` names the Iceberg runtime (and for S3
    the hadoop-aws package) that fits the running Spark.
    """
    extra = _extra(record)
    prefix = f"spark.sql.catalog.{catalog}"
    properties = {
        "spark.sql.extensions": EXTENSIONS_CLASS,
        prefix: CATALOG_CLASS,
        f"{prefix}.type": _catalog_type(extra),
        f"{prefix}.warehouse": _warehouse(record, extra, root),
    }
    if packages:
        properties["spark.jars.packages"] = ",".join(packages)
    if _catalog_type(extra) == "rest":
        if not extra.get("rest_uri"):
            raise ValueError(f"connection {record['conn_id']}: a REST catalog needs rest_uri")
        properties[f"{prefix}.uri"] = extra["rest_uri"]
        for name, suffix in REST_EXTRAS.items():
            if name in extra:
                properties[f"{prefix}.{suffix}"] = extra[name]
        for header, value in (extra.get("rest_headers") or {}).items():
            properties[f"{prefix}.header.{header}"] = value
    if record["conn_type"] in S3_TYPES:
        properties.update(_s3a(record, extra))
    return properties


def storage_summary(record: Mapping, *, root: str = ".") -> dict:
    """What a log may say about the storage; secrets show as ``***``."""
    extra = _extra(record)
    summary = {
        "connection_id": record["conn_id"],
        "connection_type": record["conn_type"],
        "warehouse_path": _warehouse(record, extra, root),
        "catalog_type": _catalog_type(extra),
        "is_local": record["conn_type"] in LOCAL_TYPES,
        "is_s3": record["conn_type"] in S3_TYPES,
    }
    shown = [*S3_TIMEOUT_EXTRAS] if summary["is_s3"] else []
    if summary["catalog_type"] == "rest":
        shown += ["rest_uri", *REST_EXTRAS]
    for name in shown:
        if name in extra:
            summary[name] = "***" if name in SECRET_EXTRAS else extra[name]
    return summary


def _extra(record: Mapping) -> dict:
    extra = record.get("extra") or {}
    return json.loads(extra) if isinstance(extra, str) else dict(extra)


def _catalog_type(extra: Mapping) -> str:
    return extra.get("catalog_type", DEFAULT_CATALOG_TYPE)


def _warehouse(record: Mapping, extra: Mapping, root: str) -> str:
    if record["conn_type"] in LOCAL_TYPES:
        # A relative path would mean another folder in each process.
        path = resolve_path(extra.get("warehouse_path", DEFAULT_WAREHOUSE), root)
        return path if ":/" in path else os.path.abspath(path)
    if record["conn_type"] in S3_TYPES:
        return f"s3a://{extra.get('bucket', DEFAULT_BUCKET)}/"
    raise ValueError(f"connection {record['conn_id']}: no storage of type {record['conn_type']!r}")


def _s3a(record: Mapping, extra: Mapping) -> dict[str, str]:
    """An own endpoint is addressed by path, over TLS if its URL says so; without one, AWS's."""
    settings = {"impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}
    endpoint = extra.get("endpoint_url")
    if not endpoint and record.get("host"):
        port = f":{record['port']}" if record.get("port") else ""
        endpoint = f"http://{record['host']}{port}"
    if endpoint:
        settings["endpoint"] = endpoint
        settings["path.style.access"] = "true"
        settings["connection.ssl.enabled"] = str(endpoint.startswith("https:")).lower()
    access_key = extra.get("aws_access_key_id", record.get("login"))
    secret_key = extra.get("aws_secret_access_key", record.get("password"))
    if access_key and secret_key:
        settings["access.key"] = access_key
        settings["secret.key"] = secret_key
    for name, (suffix, default) in S3_TIMEOUT_EXTRAS.items():
        settings[suffix] = str(int(float(extra.get(name, default)) * 1000))
    return {f"spark.hadoop.fs.s3a.{key}": value for key, value in settings.items()}
