import os
from datetime import timedelta
from unittest.mock import MagicMock
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

import lakeload as ll
from lakeload.names import in_builtin_catalog, sibling
from lakeload.operators import tables
from lakeload.operators.tables import conforming, widened


def values(spark, table):
    return sorted(tuple(row) for row in spark.table(table).collect())


def failing(df):
    """The same rows, except that the last one cannot be computed."""
    return df.withColumn(
        "id", F.when(F.col("id") == 9, F.raise_error(F.lit("boom")).cast("bigint")).otherwise(F.col("id"))
    )


def rows(spark, start=0, end=10):
    return spark.range(start, end, 1, 2)


def test_create_exists_drop(spark, place):
    table = place.table("t")
    assert not ll.exists(spark, table)
    ll.create(rows(spark), table)
    assert ll.exists(spark, table)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        ll.create(rows(spark), table)
    ll.drop(spark, table)
    ll.drop(spark, table)
    assert not ll.exists(spark, table)


def test_three_part_and_quoted_names(spark, place):
    table = f"`spark_catalog`.{place.database}.`t`"
    ll.replace(rows(spark, 0, 2), table)
    ll.replace(rows(spark, 0, 3), table)
    ll.replace(rows(spark).selectExpr("string(id) AS name"), table)
    ll.append(rows(spark).selectExpr("string(id) AS name"), table)
    assert spark.table(table).count() == 20


def test_failed_create_leaves_nothing(spark, place):
    table = place.table("t")
    with pytest.raises(Exception, match="boom"):
        ll.create(failing(rows(spark)), table)
    assert not ll.exists(spark, table)
    ll.create(rows(spark), table)
    assert spark.table(table).count() == 10


def test_append_matches_columns_by_name(spark, place):
    table = place.table("t")
    ll.create(spark.sql("SELECT 1 AS a, 'x' AS b"), table)
    ll.append(spark.sql("SELECT 'y' AS B, 2 AS a"), table)
    assert values(spark, table) == [(1, "x"), (2, "y")]


def test_append_to_no_table(spark, place):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        ll.append(rows(spark), place.table("t"))
    assert not ll.exists(spark, place.table("t"))


def test_append_of_other_columns(spark, place):
    table = place.table("t")
    ll.create(spark.sql("SELECT 1 AS a, 'x' AS b"), table)
    with pytest.raises(ValueError, match=r"not in the table \['c'\], not in the rows \['b'\]"):
        ll.append(spark.sql("SELECT 2 AS a, 2.5D AS c"), table)
    assert spark.table(table).columns == ["a", "b"]
    ll.append(spark.sql("SELECT 2 AS a, 2.5D AS c"), table, evolve=True)
    assert values(spark, table) == [(1, "x", None), (2, None, 2.5)]


def test_evolution_with_dotted_and_nested_columns(spark, place):
    table = place.table("t")
    ll.create(spark.sql("SELECT 1 AS `a.b`"), table)
    ll.append(spark.sql("SELECT 2 AS `a.b`, named_struct('x', array(1L)) AS s"), table, evolve=True)
    assert spark.table(table).schema["s"].dataType.simpleString() == "struct<x:array<bigint>>"
    assert spark.table(table).filter("s IS NULL").first()[0] == 1


@pytest.mark.parametrize(
    "stored, incoming",
    [
        ("1", "2.5D"),
        ("1L", "float(2.5)"),
        ("float(1)", "2.5D"),
        ("1", "2.5BD"),
        ("1.5BD", "2.25BD"),
        ("1.5BD", "2.5D"),
        ("2.5D", "9007199254740993L"),
        ("float(2.5)", "16777217"),
        ("2.5D", "12345678901234567.89BD"),
        ("float(2.5)", "1234567.5BD"),
        ("named_struct('x', 1)", "named_struct('x', 2.7D)"),
        ("array(1)", "array(2.7D)"),
        ("map('a', 1)", "map('a', 2.7D)"),
        ("array(named_struct('x', 1.5D))", "array(named_struct('x', 9007199254740993L))"),
        ("DATE'2024-01-01'", "TIMESTAMP'2024-01-01 01:00:00'"),
        ("DATE'2024-01-01'", "TIMESTAMP_NTZ'2024-01-01 01:00:00'"),
    ],
)
def test_append_never_cuts_values(spark, place, stored, incoming):
    table = place.table("t")
    ll.create(spark.sql(f"SELECT {stored} AS v"), table)
    with pytest.raises(ValueError, match="would cut"):
        ll.append(spark.sql(f"SELECT {incoming} AS v"), table)
    assert spark.table(table).count() == 1


@pytest.mark.parametrize(
    "stored, incoming, kept",
    [
        ("1.5D", "2", 2.0),
        ("1L", "2", 2),
        ("1", "2L", 2),
        ("'x'", "7", "7"),
        ("CAST(1 AS DECIMAL(10,2))", "2.5BD", 2.5),
        ("1.5D", "2.25BD", 2.25),
        ("float(1.5)", "smallint(300)", 300.0),
    ],
)
def test_append_of_fitting_types(spark, place, stored, incoming, kept):
    table = place.table("t")
    ll.create(spark.sql(f"SELECT {stored} AS v"), table)
    ll.append(spark.sql(f"SELECT {incoming} AS v"), table)
    assert kept in {row.v for row in spark.table(table).collect()}


@pytest.mark.parametrize("incoming", ["3000000000L", "'x'"])
def test_append_of_misfits(spark, place, incoming):
    table = place.table("t")
    ll.create(spark.sql("SELECT 1 AS v"), table)
    with pytest.raises(Exception):
        ll.append(spark.sql(f"SELECT {incoming} AS v"), table)
    assert values(spark, table) == [(1,)]


def test_replace_creates(spark, place):
    ll.replace(rows(spark), place.table("t"))
    assert spark.table(place.table("t")).count() == 10


def names(spark, place):
    return [t.name for t in spark.catalog.listTables(place.database)]


def there(uri):
    return os.path.exists(unquote(uri.removeprefix("file://")))


def folders(place):
    return sorted(os.listdir(place.location))


def test_replace_moves_no_files_and_keeps_the_old_until_purged(spark, place):
    table = place.table("t")
    ll.create(rows(spark, 0, 5), table)
    first = set(spark.table(table).inputFiles())
    for end in (6, 7):
        reader = spark.table(table)
        before = values(spark, table)
        ll.replace(rows(spark, 0, end), table)
        assert values(spark, table) == [(n,) for n in range(end)]
        assert sorted(tuple(r) for r in reader.collect()) == before  # opened before, read after
    assert all(map(there, first))
    assert len(folders(place)) == 3
    assert ll.purge(spark, table) == 0  # too young
    assert ll.purge(spark, table, timedelta(0)) == 2
    assert len(folders(place)) == 1
    assert names(spark, place) == ["t"]
    ll.append(rows(spark, 7, 8), table)
    assert spark.table(table).count() == 8
    ll.drop(spark, table)
    assert folders(place) == []


def test_replace_with_another_schema(spark, place):
    table = place.table("t")
    ll.create(rows(spark), table)
    for _ in range(2):
        reader = spark.table(table)
        ll.replace(spark.sql("SELECT 'x' AS name"), table)
        assert values(spark, table) == [("x",)]
        assert reader.count() == 10
        ll.replace(rows(spark), table)
        assert spark.table(table).columns == ["id"]
    ll.append(rows(spark, 10, 12), table)
    assert spark.table(table).count() == 12
    ll.drop(spark, table)
    assert folders(place) == []


@pytest.mark.parametrize("new", ["SELECT 5L AS id, 'x' AS name", "SELECT 5L AS id"])
def test_replace_keeps_comments_and_properties(spark, place, new):
    table = place.table("t")
    spark.sql(
        f"CREATE TABLE {table} (id BIGINT COMMENT 'key') USING parquet COMMENT 'mine' "
        "TBLPROPERTIES ('team' = 'me')"
    )
    ll.replace(spark.sql(new), table)
    described = tables.description(spark, table)
    assert described["comment"] == "mine"
    assert described["table_properties"]["team"] == "me"
    assert described["columns"][0]["comment"] == "key"


@pytest.mark.parametrize("renamed", [False, True])
@pytest.mark.parametrize("dies_at", range(1, 8))
def test_a_crash_at_any_step_loses_no_rows(spark, place, monkeypatch, renamed, dies_at):
    """Every statement may be the last; then all left-over entries are dropped."""
    table = place.table("t")
    ll.create(rows(spark, 0, 3), table)
    new = rows(spark, 7, 9)
    old_files = spark.table(table).inputFiles()
    calls = 0

    class Death(BaseException):
        pass

    for step in ("_set_location", "_rename", "drop_entry", "description"):
        def dying(*args, real=getattr(tables, step), **kw):
            nonlocal calls
            calls += 1
            if calls == dies_at:
                raise Death
            return real(*args, **kw)

        monkeypatch.setattr(tables, step, dying)
    try:
        ll.replace(new.withColumnRenamed("id", "n") if renamed else new, table)
    except Death:
        pass
    monkeypatch.undo()
    for name in names(spark, place):
        if name != "t":
            spark.sql(f"DROP TABLE {place.table(name)}")
    kept = values(spark, table) if "t" in names(spark, place) else []
    # With another schema there is a moment in which only the files are left.
    assert kept in ([(0,), (1,), (2,)], [(7,), (8,)]) or (renamed and kept == [])
    assert all(map(there, old_files))


def test_replace_is_checked_before_it_shows(spark, place):
    table = place.table("t")

    def refuse(written):
        assert written.count() == 10
        raise ValueError("not these")

    with pytest.raises(ValueError, match="not these"):
        ll.replace(rows(spark), table, check=refuse)
    assert names(spark, place) == []
    ll.create(rows(spark, 0, 1), table)
    with pytest.raises(ValueError, match="not these"):
        ll.replace(rows(spark), table, check=refuse)
    assert (values(spark, table), names(spark, place)) == ([(0,)], ["t"])
    assert len(folders(place)) == 1


def test_replace_from_itself(spark, place):
    table = place.table("t")
    ll.create(rows(spark), table)
    ll.replace(spark.table(table).filter("id > 6"), table)
    assert values(spark, table) == [(7,), (8,), (9,)]


@pytest.mark.parametrize("renamed", [False, True])
def test_failed_replace_keeps_the_old_rows(spark, place, renamed):
    table = place.table("t")
    ll.create(rows(spark, 0, 3), table)
    new = failing(rows(spark))
    with pytest.raises(Exception, match="boom"):
        ll.replace(new.withColumnRenamed("id", "n") if renamed else new, table)
    assert values(spark, table) == [(0,), (1,), (2,)]
    assert [t.name for t in spark.catalog.listTables(place.database)] == ["t"]


def test_replace_leaves_external_files_alone(spark, place):
    table, path = place.table("t"), place.path("outside")
    rows(spark, 0, 3).write.parquet(path)
    spark.sql(f"CREATE TABLE {table} (id BIGINT) USING parquet LOCATION '{path}'")
    ll.replace(rows(spark, 5, 7), table)
    assert values(spark, table) == [(5,), (6,)]
    assert spark.read.parquet(path).count() == 3


def test_replace_of_a_partitioned_table(spark, place):
    table = place.table("t")
    ll.load_day(rows(spark), table, "2024-11-10")
    ll.replace(rows(spark, 0, 2), table)
    assert values(spark, table) == [(0,), (1,)]


def test_replace_keeps_the_partitioning(spark, place):
    table = place.table("t")
    ll.load_day(rows(spark), table, "2024-11-10T00:00:00Z")
    ll.replace(spark.table(table).filter("id < 4"), table)
    assert tables.description(spark, table)["partition_columns"] == ["logical_date"]
    ll.load_day(rows(spark, 0, 2), table, "2024-11-10T00:00:00Z", mode="overwrite")
    assert [r[0] for r in values(spark, table)] == [0, 1]
    ll.replace(rows(spark).withColumn("k", F.col("id") % 2), table, partition_by=["k"])
    assert tables.description(spark, table)["partition_columns"] == ["k"]
    ll.replace(spark.table(table), table, partition_by=[])
    assert not tables.description(spark, table).get("partition_columns")


def test_conforming_adds_no_shuffle(spark, place):
    table = place.table("t")
    ll.create(spark.sql("SELECT 1 AS a, 'x' AS b"), table)
    with conforming(spark.sql("SELECT 'y' AS b, 2 AS a"), table) as (df, name):
        assert name == table and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "stored, incoming, wide",
    [
        ("int", "bigint", "bigint"),
        ("int", "double", "double"),
        ("float", "double", "double"),
        ("float", "int", "double"),
        ("smallint", "float", "float"),
        ("decimal(10,2)", "decimal(12,1)", "decimal(13,2)"),
        ("decimal(10,2)", "decimal(12,4)", "decimal(12,4)"),
        ("int", "decimal(4,2)", "decimal(12,2)"),
        ("bigint", "double", None),
        ("string", "int", None),
    ],
)
def test_widened(spark, stored, incoming, wide):
    kinds = spark.createDataFrame([], f"a {incoming}, b {stored}").schema
    found = widened(kinds["a"].dataType, kinds["b"].dataType)
    assert (found and found.simpleString()) == wide


def test_columns_become_wider_for_rows_that_need_it(spark, place):
    table = place.table("t")
    ll.create(spark.sql("SELECT 2 AS price, 'a' AS name"), table)
    ll.append(spark.sql("SELECT 2.5D AS price, 'b' AS name, 1 AS more"), table, evolve=True)
    assert dict(spark.table(table).dtypes) == {"price": "double", "name": "string", "more": "int"}
    assert values(spark, table) == [(2.0, "a", None), (2.5, "b", 1)]
    with pytest.raises(ValueError, match="would cut"):
        ll.append(spark.sql("SELECT 9007199254740993L AS price, 'c' AS name, 1 AS more"), table, evolve=True)


def test_a_load_that_fails_undoes_its_evolution(spark, place):
    table = place.table("t")
    ll.create(spark.sql("SELECT 2 AS price"), table)
    bad = failing(rows(spark)).select((F.col("id") / 2).alias("price"), F.lit(1).alias("more"))
    with pytest.raises(Exception, match="boom"):
        ll.append(bad, table, evolve=True)
    assert spark.table(table).dtypes == [("price", "int")]
    assert values(spark, table) == [(2,)]
    assert names(spark, place) == ["t"]


class Lost(Exception):
    pass


@pytest.mark.parametrize("when", ["before the rows", "after the rows"])
@pytest.mark.parametrize(
    "incoming", ["SELECT 3 AS id, 'x' AS more", "SELECT 2.5D AS id", "SELECT 2.5D AS id, 1 AS more"]
)
def test_evolution_ends_with_the_insert(spark, place, monkeypatch, incoming, when):
    table = place.table("t")
    ll.create(spark.sql("SELECT 1 AS id"), table)
    real = tables.insert

    def failing_insert(df, name):
        if when == "after the rows" and name != table:
            real(df, name)
        raise Lost

    if when == "before the rows" or "2.5" in incoming:
        monkeypatch.setattr(tables, "insert", failing_insert)
        with pytest.raises(Lost):
            ll.append(spark.sql(incoming), table, evolve=True)
        assert spark.table(table).dtypes == [("id", "int")]
        assert values(spark, table) == [(1,)]
        assert names(spark, place) == ["t"] and len(folders(place)) == 1
    monkeypatch.undo()
    ll.append(spark.sql(incoming), table, evolve=True)
    assert spark.table(table).count() == 2
    assert names(spark, place)[0] == "t"


def test_purge_and_drop_leave_tables_of_others(spark, place):
    table, other = place.table("sales"), place.table("sales__old_2023")
    ll.create(rows(spark, 0, 3), table)
    ll.create(rows(spark, 0, 4), other)
    own = place.table("sales__old_1700000000000_" + "0" * 32)
    ll.create(rows(spark, 0, 6), own)
    assert ll.purge(spark, table, timedelta(0)) == 0
    ll.replace(rows(spark, 0, 5), table)
    assert ll.purge(spark, table, timedelta(0)) == 1
    ll.replace(rows(spark, 0, 5), table)
    ll.drop(spark, table)
    assert (spark.table(other).count(), spark.table(own).count()) == (4, 6)
    assert len(names(spark, place)) == 2


def test_drop_beside_a_backup(spark, place):
    table, backup = place.table("cust"), place.table("cust__old_backup")
    ll.create(rows(spark), table)
    ll.create(rows(spark), backup)
    ll.drop(spark, table)
    assert names(spark, place) == ["cust__old_backup"]
    assert spark.table(backup).count() == 10


def test_versions_belong_to_one_table(spark, place):
    """A table whose name begins with another's, versions included."""
    table, longer = place.table("t"), place.table("t__old_t")
    for name in (table, longer):
        ll.create(rows(spark, 0, 2), name)
        ll.replace(rows(spark, 0, 3), name)
    assert ll.purge(spark, table, timedelta(0)) == 1
    assert ll.purge(spark, table, timedelta(0)) == 0
    assert ll.purge(spark, longer, timedelta(0)) == 1
    assert (spark.table(table).count(), spark.table(longer).count()) == (3, 3)


def test_drop_leaves_files_that_only_look_like_a_version(spark, place):
    table, path = place.table("t"), place.path("data__v_" + "a" * 32)
    rows(spark, 0, 3).write.parquet(path)
    spark.sql(f"CREATE TABLE {table} (id BIGINT) USING parquet LOCATION '{path}'")
    ll.drop(spark, table)
    assert spark.read.parquet(path).count() == 3


def test_drop_leaves_files_of_a_place_set_by_others(spark, place):
    table, path = place.table("t"), place.path("outside")
    ll.create(rows(spark, 0, 3), table)
    ll.replace(rows(spark).withColumn("x", F.lit(1)), table)
    rows(spark, 0, 5).withColumn("x", F.lit(1)).write.parquet(path)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    ll.drop(spark, table)
    assert spark.read.parquet(path).count() == 5


def partitioned(spark, *pairs):
    return spark.createDataFrame(pairs, "id bigint, k string")


def test_replace_of_partitions_overwrites_and_drops(spark, place):
    table = place.table("t")
    ll.replace(partitioned(spark, (1, "a"), (2, "b/=%"), (3, None)), table, partition_by=["k"])
    reader = spark.table(table)
    location = tables.description(spark, table)["location"]
    ll.replace(partitioned(spark, (7, "b/=%"), (8, "c")), table)
    assert values(spark, table) == [(7, "b/=%"), (8, "c")]
    assert sorted(map(tuple, reader.collect())) == [(7, "b/=%"), (8, "c")]  # opened before, read after
    assert tables.description(spark, table)["location"] == location
    assert names(spark, place) == ["t"] and len(folders(place)) == 1
    ll.replace(partitioned(spark).limit(0), table)
    assert values(spark, table) == []
    ll.append(partitioned(spark, (9, "a")), table)
    assert values(spark, table) == [(9, "a")]


def test_replace_of_partitions_by_other_columns(spark, place):
    table = place.table("t")
    ll.replace(partitioned(spark, (1, "a"), (2, "b")), table, partition_by=["k"])
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('team' = 'me')")
    ll.replace(spark.sql("SELECT 1.5D AS price, 'a' AS k UNION ALL SELECT 2.5D, 'z'"), table)
    described = tables.description(spark, table)
    assert described["partition_columns"] == ["k"] and described["table_properties"]["team"] == "me"
    assert values(spark, table) == [(1.5, "a"), (2.5, "z")]
    ll.append(spark.sql("SELECT 3.5D AS price, 'a' AS k"), table)
    assert spark.table(table).filter("k = 'a'").count() == 2
    ll.replace(rows(spark, 0, 2), table, partition_by=[])
    assert values(spark, table) == [(0,), (1,)]
    ll.drop(spark, table)
    assert folders(place) == [] and names(spark, place) == []


def test_a_stage_is_kept_when_only_it_has_the_rows(spark, place, monkeypatch):
    table = place.table("t")
    ll.replace(partitioned(spark, (1, "a")), table, partition_by=["k"])

    def lost(*args):
        raise Lost

    monkeypatch.setattr(tables, "_rename", lost)
    with pytest.raises(Lost):
        ll.replace(spark.sql("SELECT 1.5D AS price, 'a' AS k"), table)
    (left,) = names(spark, place)
    assert spark.table(place.table(left)).count() == 1


@pytest.mark.parametrize(
    "table, name",
    [("t", "t__x"), ("db.t", "db.t__x"), ("spark_catalog.`db`.`t`", "spark_catalog.db.t__x")],
)
def test_sibling(table, name):
    assert sibling(table, "x") == name


# Other catalogs are not available here, so only which calls they get is checked.


@pytest.mark.parametrize("table", ["lake.db.t", "lake.a.b.t", "`lake`.db.t"])
def test_other_catalogs_are_recognised(spark, table):
    assert not in_builtin_catalog(spark, table)


def test_builtin_catalog_is_recognised(spark):
    assert all(in_builtin_catalog(spark, name) for name in ("t", "db.t", "spark_catalog.db.t"))


def test_writes_to_other_catalogs():
    df = MagicMock()
    df.sparkSession.conf.get.return_value = None
    ll.create(df, "lake.db.t")
    df.writeTo.return_value.create.assert_called_once_with()
    df.writeTo.return_value.using.assert_not_called()
    df.sparkSession.catalog.tableExists.return_value = False
    ll.replace(df, "lake.db.t")
    df.writeTo.return_value.createOrReplace.assert_called_once_with()


def names(spark, place):
    return [t.name for t in spark.catalog.listTables(place.database)]
