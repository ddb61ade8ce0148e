import re

import pytest
from pyspark.sql import functions as F

import lakeload as ll


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [(1, "a", 10.0), (2, "a", None), (None, "b", 20.0), (4, None, 30.0)],
        "id int, `the.group` string, pay double",
    )


def test_every_aggregate(people):
    stats = {
        "n": ("count", "*"),
        "ids": ("count", "id"),
        "groups": ("count_distinct", "the.group"),
        "mean": ("avg", "pay"),
        "total": ("sum", "id"),
        "high": ("max", "pay"),
        "low": ("min", "pay"),
    }
    df = ll.profile(people, stats)
    assert df.first()[:] == (4, 3, 2, 20.0, 7, 30.0, 10.0)
    assert [t for _, t in df.dtypes] == ["bigint", "bigint", "bigint", "double", "bigint"] + [
        "double"
    ] * 2


def test_no_rows(people):
    df = ll.profile(people.filter("id > 9"), {"n": ("count", "*"), "mean": ("avg", "pay")})
    assert df.first()[:] == (0, None)
    assert ll.report(df, {"mean": "0.0"}).first()[:] == ("0", None)


def test_average_of_decimals_is_a_double(spark):
    df = ll.profile(spark.sql("SELECT 1.5BD AS v"), {"mean": ("avg", "v")})
    assert df.dtypes == [("mean", "double")]


@pytest.mark.parametrize("stat", [("sum", "*"), ("count_distinct", "*")])
def test_star_only_counts(people, stat):
    with pytest.raises(ValueError):
        ll.profile(people, {"x": stat})


def test_unknown_aggregate(people):
    with pytest.raises(KeyError):
        ll.profile(people, {"x": ("median", "pay")})


def test_dict_aggregate(people):
    df = people.agg({"pay": "avg"})
    assert df.columns == ["avg(pay)"]
    assert df.first()[0] == 20.0


def test_strict_and_case_sensitive_filters(people):
    assert people.filter(F.col("pay") > 20).count() == 1
    assert people.filter(F.col("`the.group`") == "A").count() == 0


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_scans_read_only_the_profiled_columns(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    df = ll.profile(lines, {"orders": ("count_distinct", "l_orderkey"), "price": ("avg", "l_tax")})
    assert sorted(re.findall("ReadSchema: struct<.*?>", plan_of(df))) == [
        "ReadSchema: struct<l_orderkey:bigint>",
        "ReadSchema: struct<l_tax:double>",
    ]


def test_distinct_counts_travel_alone(spark):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    stats = {
        "orders": ("count_distinct", "l_orderkey"),
        "parts": ("count_distinct", "l_partkey"),
        "price": ("avg", "l_tax"),
    }
    df = ll.profile(lines, stats)
    assert df.columns == list(stats)
    plan = plan_of(df)
    assert "Expand" not in plan
    shuffled = re.findall(r"Exchange\nInput \[\d\]: \[([^\]]*)\]\nArguments: hashpartitioning", plan)
    assert len(shuffled) == 2
    assert all("," not in columns for columns in shuffled)
    only = ll.profile(lines, {"orders": ("count_distinct", "l_orderkey")})
    assert only.first()[0] == lines.select("l_orderkey").distinct().count()


def test_approximate_distinct_counts_have_a_name_of_their_own(spark):
    row = ll.profile(spark.range(1000), {"n": ("approx_count_distinct", "id")}).first()
    assert 900 < row.n < 1100


def test_hot_values_are_thinned_before_the_shuffle(spark):
    """A third of the rows share one value; each task sends it on once."""
    hot = spark.range(0, 30000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 1000).alias("k")
    )
    df = ll.profile(hot, {"n": ("count", "*"), "keys": ("count_distinct", "k")})
    assert df.first()[:] == (30000, 1001)
    plan = plan_of(df)
    assert plan.index("HashAggregate") < plan.index("hashpartitioning(value")


def test_load_times(spark):
    row = ll.with_load_times(spark.range(1), "created_at", "updated_at").first()
    assert row.created_at == row.updated_at


def test_filters_reach_the_scan(spark):
    customers = spark.read.parquet("/root/testdata/sf0.01/customer.parquet")
    df = customers.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_mktsegment,BUILDING)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan
