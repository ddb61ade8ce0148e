"""Every registered query against its SQL counterpart in DuckDB."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from lakeload.queries import ORACLES, QUERIES, as_csv

SF_DIR = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(SF_DIR.glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)

    def cell(value):
        return "nan" if isinstance(value, float) and math.isnan(value) else value

    return [columns[i] for i in order], sorted(
        (tuple(cell(row[i]) for i in order) for row in rows), key=repr
    )


TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("key", QUERIES)
def test_same_as_duckdb(spark, duck, key):
    df = entry.queries()[key](spark, str(SF_DIR))
    ours = canonical(df.columns, [tuple(row) for row in df.collect()])
    result = duck.execute(entry.oracle_sql()[key])
    theirs = canonical([d[0] for d in result.description], result.fetchall())
    assert ours == theirs
    assert ours[1]
    described = duck.execute(f"DESCRIBE {entry.oracle_sql()[key]}").fetchall()
    assert dict(df.dtypes) == {name: TYPES[kind.split("_")[0]] for name, kind, *_ in described}


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row.total_products > 0


def test_csv_input_is_compressed_and_in_many_files(spark, tmp_path):
    columns = ["id AS l_orderkey", "id % 7 AS l_quantity", "concat('line number ', id % 1000) AS l_comment"]
    rows = spark.range(400_000, numPartitions=1).selectExpr(*columns)
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    path = as_csv(spark, str(tmp_path), "lineitem")
    files = list(Path(path).glob("part-*"))
    text = rows.selectExpr("sum(length(concat_ws(',', *)) + 1)").first()[0]
    assert sum(file.stat().st_size for file in files) < text / 2
    assert len(files) > 3  # none of them can be split
    again = spark.read.csv(path, header=True, schema=rows.schema)
    assert again.exceptAll(rows).isEmpty() and again.count() == 400_000
