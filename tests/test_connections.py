import os
import json

import pytest

from lakeload import spark_properties, storage_summary

LOCAL = {"conn_id": "store", "conn_type": "fs", "extra": '{"warehouse_path": "wh"}'}


def s3(**extra):
    return {
        "conn_id": "store",
        "conn_type": "aws",
        "login": "user",
        "password": "pass",
        "host": "minio",
        "port": 9000,
        "extra": {"bucket": "lake", **extra},
    }


def test_local():
    properties = spark_properties(LOCAL, "cat", root="/srv", packages=["g:a:1", "g:b:2"])
    assert properties["spark.sql.catalog.cat"] == "org.apache.iceberg.spark.SparkCatalog"
    assert properties["spark.sql.catalog.cat.type"] == "hadoop"
    assert properties["spark.sql.catalog.cat.warehouse"] == "/srv/wh"
    assert properties["spark.jars.packages"] == "g:a:1,g:b:2"
    assert not any(key.startswith("spark.hadoop") for key in properties)


@pytest.mark.parametrize("conn_type", ["fs", "file", "local"])
def test_local_defaults(conn_type):
    record = {"conn_id": "store", "conn_type": conn_type, "extra": None}
    properties = spark_properties(record, root="/srv")
    assert properties["spark.sql.catalog.local.warehouse"] == "/srv/warehouse"


def test_s3():
    properties = spark_properties(s3(s3_connection_timeout=60))
    s3a = {k.removeprefix("spark.hadoop.fs.s3a."): v for k, v in properties.items()}
    assert properties["spark.sql.catalog.local.warehouse"] == "s3a://lake/"
    assert s3a["endpoint"] == "http://minio:9000"
    assert (s3a["access.key"], s3a["secret.key"]) == ("user", "pass")
    assert s3a["path.style.access"] == "true"
    assert s3a["connection.ssl.enabled"] == "false"
    assert s3a["connection.establish.timeout"] == "10000"
    assert s3a["connection.timeout"] == "60000"


def test_s3_endpoints():
    key = "spark.hadoop.fs.s3a.endpoint"
    ssl = "spark.hadoop.fs.s3a.connection.ssl.enabled"
    own = spark_properties(s3(endpoint_url="https://store:9443"))
    assert (own[key], own[ssl]) == ("https://store:9443", "true")
    assert spark_properties({**s3(), "port": None})[key] == "http://minio"
    assert key not in spark_properties({**s3(), "host": None})


def test_rest_catalog():
    extra = {
        "catalog_type": "rest",
        "rest_uri": "http://catalog:8181",
        "rest_credential": "id:secret",
        "rest_oauth2_token": "token",
        "rest_oauth2_server_uri": "http://login",
        "rest_headers": {"X-Tenant": "a"},
    }
    record = {**LOCAL, "extra": json.dumps(extra)}
    properties = spark_properties(record, "cat")
    prefix = "spark.sql.catalog.cat."
    assert {k.removeprefix(prefix): v for k, v in properties.items() if k.startswith(prefix)} == {
        "type": "rest",
        "warehouse": os.path.abspath("warehouse"),
        "uri": "http://catalog:8181",
        "credential": "id:secret",
        "token": "token",
        "oauth2-server-uri": "http://login",
        "header.X-Tenant": "a",
    }
    summary = storage_summary(record)
    assert summary["rest_uri"] == "http://catalog:8181"
    assert summary["rest_credential"] == summary["rest_oauth2_token"] == "***"


def test_rest_catalog_needs_an_address():
    with pytest.raises(ValueError, match="rest_uri"):
        spark_properties({**LOCAL, "extra": {"catalog_type": "rest"}})


def test_other_catalog_types_pass_through():
    properties = spark_properties({**LOCAL, "extra": {"catalog_type": "hive"}})
    assert properties["spark.sql.catalog.local.type"] == "hive"


def test_unknown_storage():
    with pytest.raises(ValueError, match="ftp"):
        spark_properties({"conn_id": "store", "conn_type": "ftp"})


def test_summary():
    assert storage_summary(s3(s3_connection_timeout=60)) == {
        "connection_id": "store",
        "connection_type": "aws",
        "warehouse_path": "s3a://lake/",
        "catalog_type": "hadoop",
        "is_local": False,
        "is_s3": True,
        "s3_connection_timeout": 60,
    }
