"""The three jobs on the small files with known results."""

from datetime import date, timedelta

import pytest
from golden import EMPLOYEES, PRODUCTS, USERS
from pyspark.sql import functions as F

import lakeload as ll
from lakeload.plans import PRODUCTS_PATTERNS, USERS_PATTERNS


def test_users(spark, place, csv):
    table = place.table("users")
    row = ll.refresh_users(spark, csv(USERS), table).first()
    assert row.asDict() == {
        "table_name": table,
        "total_users": 8,
        "unique_departments": 5,
        "avg_age": 34.25,
        "avg_salary": 88500.0,
    }
    stored = spark.table(table)
    assert dict(stored.dtypes) == {
        "user_id": "string",
        "name": "string",
        "age": "int",
        "department": "string",
        "salary": "int",
        "join_date": "date",
        "processed_at": "timestamp",
    }
    assert stored.filter(F.col("department") == "Engineering").count() == 3
    assert stored.agg(F.min("join_date")).first()[0] == date(2018, 5, 30)
    assert stored.filter("processed_at IS NULL").count() == 0


def test_products(spark, place, csv):
    table = place.table("products")
    figures = ll.refresh_products(spark, csv(PRODUCTS), table)
    row = figures.first()
    assert (row.total_products, row.unique_categories, row.total_stock) == (15, 5, 2465)
    assert row.avg_price == pytest.approx(162.19)
    stored = spark.table(table)
    assert stored.columns[-2:] == ["created_at", "updated_at"]
    assert stored.filter("created_at <> updated_at").count() == 0
    assert stored.filter(F.col("category") == "Electronics").count() == 5
    assert ll.report(figures, PRODUCTS_PATTERNS).drop("table_name").first().asDict() == {
        "total_products": "15",
        "unique_categories": "5",
        "avg_price": "$162.19",
        "total_stock": "2465",
    }


def test_users_report(spark, place, csv):
    figures = ll.refresh_users(spark, csv(USERS), place.table("users"))
    text = ll.report(figures, USERS_PATTERNS).first()
    assert (text.avg_age, text.avg_salary) == ("34.2", "$88,500.00")


def test_refresh_again_replaces(spark, place, csv):
    table = place.table("users")
    ll.refresh_users(spark, csv(USERS, name="first"), table)
    fewer = "".join(USERS.splitlines(keepends=True)[:4])
    assert ll.refresh_users(spark, csv(fewer, name="second"), table).first().total_users == 3
    assert spark.table(table).count() == 3


@pytest.mark.parametrize(
    "change, error",
    [
        (lambda text: text.replace(",salary,", ",pay,"), "'salary'"),
        (lambda text: text.replace(",95000,", ",n/a,"), "Malformed|MALFORMED"),
    ],
)
def test_a_refresh_that_does_not_fit_leaves_the_table(spark, place, csv, change, error):
    table = place.table("users")
    before = ll.refresh_users(spark, csv(USERS, name="first"), table)
    rows = sorted(map(tuple, spark.table(table).collect()))
    with pytest.raises(Exception, match=error):
        ll.refresh_users(spark, csv(change(USERS), name="second"), table)
    assert sorted(map(tuple, spark.table(table).collect())) == rows
    assert [t.name for t in spark.catalog.listTables(place.database)] == ["users"]
    assert before.first().total_users == 8  # figures stay readable


def test_text_where_numbers_are_needed(spark, place, csv):
    table = place.table("users")
    ll.refresh_users(spark, csv(USERS, name="first"), table)
    with pytest.raises(ValueError, match="needs numbers"):
        text = USERS.replace(",95000,", ",n/a,")
        ll.refresh_users(spark, csv(text, name="second"), table, infer=True)
    assert spark.table(table).count() == 8


def test_a_failing_aggregate_leaves_the_table(spark, place, csv):
    table, stats = place.table("t"), {"total": ("sum", "n")}
    ll.refresh_and_profile(spark, csv("n\n5\n", name="one"), table, stats, schema="n bigint")
    most = 2**63 - 1
    with pytest.raises(Exception, match="(?i)overflow"):
        path = csv(f"n\n{most}\n{most}\n", name="two")
        ll.refresh_and_profile(spark, path, table, stats)
    assert spark.table(table).first()[0] == 5


def test_figures_outlive_the_next_refresh(spark, place, csv):
    table = place.table("users")
    first = ll.refresh_users(spark, csv(USERS, name="first"), table)
    fewer = "".join(USERS.splitlines(keepends=True)[:4])
    ll.refresh_users(spark, csv(fewer, name="second"), table)
    ll.purge(spark, table, timedelta(0))
    assert first.first().total_users == 8


def test_a_second_refresh_takes_its_types_from_the_table(spark, place, csv):
    table = place.table("users")
    ll.refresh_users(spark, csv(USERS, name="first"), table)
    status = spark.sparkContext.statusTracker()
    jobs = {}
    for name, infer in (("second", False), ("third", True)):
        spark.sparkContext.setJobGroup(name, name)
        ll.refresh_users(spark, csv(USERS, name=name), table, infer=infer)
        jobs[name] = len(status.getJobIdsForGroup(name))
    spark.sparkContext.setJobGroup("tests", "tests")
    assert jobs["second"] < jobs["third"]


def test_days_become_wider(spark, place, csv):
    table = place.table("prices")
    for day, cell in (("2024-11-10", "2"), ("2024-11-11", "2.5"), ("2024-11-12", "3")):
        path = csv(f"price\n{cell}\n", name=day)
        ll.daily_load(spark, path, table, f"{day}T00:00:00Z", evolve=True)
    assert dict(spark.table(table).dtypes)["price"] == "double"
    assert sorted(r.price for r in spark.table(table).collect()) == [2.0, 2.5, 3.0]


def test_empty_file_gives_nulls_not_errors(spark, place, csv):
    header = USERS.splitlines(keepends=True)[0]
    schema = "user_id string, name string, age int, department string, salary int, join_date date"
    figures = ll.refresh_users(spark, csv(header), place.table("users"), schema=schema)
    row = figures.first()
    assert (row.total_users, row.unique_departments) == (0, 0)
    assert row.avg_age is None and row.avg_salary is None
    assert ll.report(figures, USERS_PATTERNS).first().avg_salary is None


def test_employees_on_two_days(spark, place, csv):
    table = place.table("daily_employees")
    path = csv(EMPLOYEES)
    first = ll.daily_load(spark, path, table, "2024-11-10").first()
    assert first.asDict() == {
        "table_name": table,
        "logical_date": "2024-11-10T00:00:00Z",
        "records_processed": 10,
        "operation": "created",
    }
    assert ll.daily_load(spark, path, table, "2024-11-11").first().operation == "appended"
    stored = spark.table(table)
    assert dict(stored.dtypes) == {
        "id": "int",
        "name": "string",
        "age": "int",
        "city": "string",
        "salary": "double",
        "logical_date": "timestamp",
    }
    assert stored.count() == 20
    assert stored.select("logical_date").distinct().count() == 2
    for day in ("2024-11-10", "2024-11-11"):
        assert ll.day_slice(stored, day).count() == 10


def test_queries_on_employees(spark, place, csv):
    table = place.table("employees")
    ll.replace(ll.load_csv(spark, csv(EMPLOYEES)), table)
    stored = spark.table(table)
    alice = stored.filter(stored.name == "Alice").first()
    assert (alice.age, alice.city, alice.salary) == (30, "New York", 75000.50)
    assert stored.filter(stored.city == "New York").count() == 1
    assert {r.name for r in stored.filter(stored.salary > 80000).collect()} == {
        "Bob",
        "Charlie",
        "Iris",
    }
    assert stored.filter(stored.age > 30).count() == 4
    assert stored.agg({"salary": "avg"}).first()[0] == pytest.approx(78300.3)
    stats = {
        "n": ("count", "id"),
        "mean": ("avg", "salary"),
        "high": ("max", "salary"),
        "low": ("min", "salary"),
    }
    row = ll.profile(stored, stats).first()
    assert (row.n, row.high, row.low) == (10, 95000.00, 69000.75)
    assert row.mean == pytest.approx(78300.3)


def test_later_days_take_their_types_from_the_table(spark, place, csv):
    table = place.table("daily")
    ll.daily_load(spark, csv("code,amount\nA1,1.5\n", name="one"), table, "2024-11-10")
    # By itself this day would be read as two integers, and lose the leading zeros.
    ll.daily_load(spark, csv("code,amount\n007,2\n", name="two"), table, "2024-11-11")
    assert ll.day_slice(spark.table(table), "2024-11-11").first()[:2] == ("007", 2.0)


def test_new_and_missing_columns(spark, place, csv):
    table = place.table("daily")
    ll.daily_load(spark, csv("id,a\n1,x\n", name="one"), table, "2024-11-10")
    wider = csv("b,id\n2.5,2\n", name="two")
    with pytest.raises(ValueError, match="'b'"):
        ll.daily_load(spark, wider, table, "2024-11-11")
    ll.daily_load(spark, wider, table, "2024-11-11", evolve=True)
    stored = spark.table(table)
    assert dict(stored.dtypes)["b"] == "double"
    assert sorted(map(tuple, stored.select("id", "a", "b").collect())) == [
        (1, "x", None),
        (2, None, 2.5),
    ]


def test_relative_path(spark, place, csv, tmp_path):
    csv(EMPLOYEES, name="inbox")
    report = ll.daily_load(
        spark, "inbox/part-0.csv", place.table("daily"), "2024-11-10", root=tmp_path
    )
    assert report.first().records_processed == 10


def test_a_logical_date_column_in_the_file_is_replaced_on_every_day(spark, place, csv):
    table = place.table("daily")
    path = csv("id,logical_date\n1,long ago\n")
    for day in ("2024-11-10", "2024-11-11"):
        ll.daily_load(spark, path, table, day)
    assert ll.day_slice(spark.table(table), "2024-11-11").count() == 1
    assert dict(spark.table(table).dtypes)["logical_date"] == "timestamp"


@pytest.mark.parametrize("infer", [False, True])
def test_a_refresh_without_a_column(spark, place, csv, infer):
    """It goes, stays without values, or the file is refused, as the caller says."""
    table = place.table("users")
    stats = {"n": ("count", "*"), "age": ("avg", "age")}
    full = csv("id,Name,age\n1,a,30\n2,b,40\n", name="full")
    short = csv("id,age\n1,31\n", name="short")

    def refresh(path, **kw):
        return ll.refresh_and_profile(spark, path, table, stats, stamps=["at"], infer=infer, **kw).first()

    for missing, columns in (("null", ["id", "age", "Name", "at"]), ("drop", ["id", "age", "at"])):
        refresh(full, missing="error" if missing == "null" else None)
        assert refresh(short, missing=missing).age == 31
        assert spark.table(table).columns == columns
        if missing == "null":
            assert dict(spark.table(table).dtypes)["Name"] == "string"
            assert [r.Name for r in spark.table(table).collect()] == [None]
    refresh(full)
    with pytest.raises(ValueError, match="lacks columns.*Name"):
        refresh(short, missing="error")
    assert spark.table(table).count() == 2 and "Name" in spark.table(table).columns
    refresh(short)
    assert spark.table(table).columns == ["id", "age", "at"]
    with pytest.raises(ValueError, match="missing must be"):
        refresh(short, missing="ignore")


def test_users_and_products_take_missing(spark, place, csv):
    table = place.table("users")
    ll.refresh_users(spark, csv(USERS), table)
    short = csv("user_id,age,department,salary\nU1,30,X,1\n", name="short")
    with pytest.raises(ValueError, match="lacks columns"):
        ll.refresh_users(spark, short, table, missing="error")
    assert spark.table(table).count() == 8
    ll.refresh_users(spark, short, table, missing="null")
    assert spark.table(table).select("name", "join_date").first()[:] == (None, None)


def test_stamps_are_told_from_columns_by_any_case(spark, place, csv):
    table = place.table("t")
    for stamp in ("at", "At"):
        path = csv("id\n1\n", name=stamp)
        ll.refresh_and_profile(spark, path, table, {"n": ("count", "*")}, stamps=[stamp])
    assert len(spark.table(table).columns) == 2


def test_a_header_in_another_case_widens_its_column(spark, place, csv):
    table = place.table("daily")
    ll.daily_load(spark, csv("id,price\n1,2\n", name="one"), table, "2024-11-10")
    done = ll.daily_load(spark, csv("ID,Price\n2,2.5\n", name="two"), table, "2024-11-11", evolve=True)
    assert done.first().records_processed == 1
    assert dict(spark.table(table).dtypes) == {"id": "int", "price": "double", "logical_date": "timestamp"}
    assert sorted(r.price for r in spark.table(table).collect()) == [2.0, 2.5]


def test_case_counts_where_the_session_says_so(spark, place, csv):
    table = place.table("daily")
    ll.daily_load(spark, csv("id,price\n1,2\n", name="one"), table, "2024-11-10")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="columns"):
            ll.daily_load(spark, csv("id,Price\n2,2\n", name="two"), table, "2024-11-11")
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert spark.table(table).count() == 1
