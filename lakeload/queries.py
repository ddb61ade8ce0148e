"""The registered queries: every operator over the given tables, each with its SQL counterpart.

A query that writes tables does so in a workspace of its own. It stays when the query returns,
since the returned DataFrame reads from it; :func:`drop_workspaces` removes what a session made.
Dates carry an offset, so results do not depend on the session's zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import lakeload as ll
from lakeload.names import column
from lakeload.workspace import Workspace, new_workspace

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Rows of a compressed input file: each is read by one task, so there are many.
CSV_FILE_ROWS = 1 << 17

_workspaces: dict[str, list[Workspace]] = {}
_csv_inputs: dict[tuple, str] = {}

DAY_1, DAY_2, DAY_3 = "2024-11-10T00:00:00Z", "2024-11-11T00:00:00Z", "2024-11-12T00:00:00Z"

# The given tables in the columns of the batch jobs.
USER_COLUMNS = {
    "c_custkey": "user_id",
    "c_name": "name",
    "c_nationkey": "age",
    "c_mktsegment": "department",
    "c_acctbal": "salary",
}
PRODUCT_COLUMNS = {
    "p_partkey": "product_id",
    "p_name": "product_name",
    "p_brand": "category",
    "p_retailprice": "price",
    "p_size": "stock_quantity",
    "p_type": "supplier",
}


def query(oracle: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        ORACLES[run.__name__] = " ".join(oracle.split())
        return run

    return register


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def workspace(spark: SparkSession) -> Workspace:
    made = new_workspace(spark)
    _workspaces.setdefault(spark.conf.get("spark.app.id"), []).append(made)
    return made


def drop_workspaces(spark: SparkSession, *, keep_inputs: bool = False) -> None:
    """Drop what the queries of this session left behind."""
    app = spark.conf.get("spark.app.id")
    inputs = {place for key, place in _csv_inputs.items() if key[0] == app}
    for made in _workspaces.pop(app, []):
        if keep_inputs and any(place.startswith(made.location) for place in inputs):
            _workspaces.setdefault(app, []).append(made)
        else:
            made.drop(spark)
    if not keep_inputs:
        for key in [key for key in _csv_inputs if key[0] == app]:
            del _csv_inputs[key]


def as_csv(
    spark: SparkSession, sf_dir: str, table: str, columns: dict[str, str] | None = None
) -> str:
    """The whole table as CSV files, the input of the loads; written once per session.

    As text a table is several times its Parquet files, so the CSV is compressed.
    """
    key = (spark.conf.get("spark.app.id"), sf_dir, table, tuple((columns or {}).items()))
    if key not in _csv_inputs:
        rows = given(spark, sf_dir, table)
        if columns:
            rows = rows.select(*[column(old).alias(new) for old, new in columns.items()])
        path = workspace(spark).path(table)
        # By default only three decimals are written; the tables hold microseconds.
        times = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
        options = {"timestampNTZFormat": times, "maxRecordsPerFile": CSV_FILE_ROWS}
        rows.write.options(**options).csv(path, header=True, compression="gzip")
        _csv_inputs[key] = path
    return _csv_inputs[key]


def day_text(ts: Column) -> Column:
    return F.substring(ll.iso_utc(ts), 1, 10)


# Sources


@query("SELECT * FROM customer")
def csv_scan(spark, sf_dir):
    """Inferred types; the file's narrower integers are widened back for the comparison."""
    scanned = ll.load_csv(spark, as_csv(spark, sf_dir, "customer"))
    types = given(spark, sf_dir, "customer").schema
    return scanned.select(*[column(f.name).cast(f.dataType).alias(f.name) for f in types])


@query("SELECT * FROM lineitem")
def csv_scan_typed(spark, sf_dir):
    """A given schema: one pass over the text."""
    schema = given(spark, sf_dir, "lineitem").schema
    return ll.load_csv(spark, as_csv(spark, sf_dir, "lineitem"), schema=schema)


@query("SELECT * FROM events")
def csv_scan_quoted(spark, sf_dir):
    """Cells with commas and quotes, and times to the microsecond."""
    schema = given(spark, sf_dir, "events").schema
    return ll.load_csv(spark, as_csv(spark, sf_dir, "events"), schema=schema)


@query(
    """
    SELECT 'p_partkey' AS column_name,
           CASE WHEN max(p_partkey) > 2147483647 THEN 'bigint' ELSE 'int' END AS data_type,
           count(p_partkey) AS n_values
    FROM part
    UNION ALL SELECT 'p_name', 'string', count(p_name) FROM part
    UNION ALL SELECT 'p_brand', 'string', count(p_brand) FROM part
    UNION ALL SELECT 'p_type', 'string', count(p_type) FROM part
    UNION ALL SELECT 'p_size', 'int', count(p_size) FROM part
    UNION ALL SELECT 'p_retailprice', 'double', count(p_retailprice) FROM part
    """
)
def csv_inferred_schema(spark, sf_dir):
    """What inference makes of each column, and how many values it found there."""
    scanned = ll.load_csv(spark, as_csv(spark, sf_dir, "part"))
    found = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(data_type).alias("data_type"),
            F.count(column(name)).alias("n_values"),
        )
        for name, data_type in scanned.dtypes
    ]
    return scanned.agg(F.array(*found).alias("found")).select(F.inline("found"))


@query(
    """
    SELECT p_name AS name, p_partkey AS value FROM part
    UNION ALL
    SELECT * FROM (VALUES ('test1', CAST(100 AS BIGINT)), ('test2', CAST(200 AS BIGINT))) t(n, v)
    """
)
def literal_rows(spark, sf_dir):
    """Rows from the program put into a table next to stored ones."""
    table = workspace(spark).table("named_values")
    stored = given(spark, sf_dir, "part")
    ll.create(stored.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("value")), table)
    ll.append(ll.from_rows(spark, [("test1", 100), ("test2", 200)], ["name", "value"]), table)
    return spark.table(table)


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def csv_relative_path(spark, sf_dir):
    """A path under a root."""
    names = {"o_orderkey": "o_orderkey", "o_orderstatus": "o_orderstatus"}
    root, _, name = as_csv(spark, sf_dir, "orders", names).rpartition("/")
    schema = "o_orderkey bigint, o_orderstatus string"
    return ll.load_csv(spark, name, root=root, schema=schema)


@query(
    """
    SELECT o_orderstatus AS status, count(*) AS n_good, CAST(0 AS BIGINT) AS n_bad
    FROM orders GROUP BY o_orderstatus
    UNION ALL
    SELECT 'bad', CAST(0 AS BIGINT), 3 * count(*) FROM orders WHERE o_orderkey % 7 = 0
    """
)
def csv_bad_rows(spark, sf_dir):
    """Good rows next to ones with too many cells, too few, and one of the wrong type."""
    path = workspace(spark).path("orders_with_bad_rows")
    orders = given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"), F.col("o_orderstatus").alias("status")
    )
    broken = orders.filter(F.col("key").cast("bigint") % 7 == 0)
    lines = orders.select(F.concat_ws(",", "key", "status").alias("line"))
    for bad in (
        F.concat_ws(",", "key", "status", F.lit("more")),
        F.col("key"),
        F.concat_ws(",", F.lit("x"), "status"),
    ):
        lines = lines.unionByName(broken.select(bad.alias("line")))
    lines.write.text(path)
    scanned = ll.load_csv(
        spark,
        path,
        names=["o_orderkey", "o_orderstatus"],
        schema="o_orderkey bigint, o_orderstatus string, bad string",
        mode="PERMISSIVE",
        columnNameOfCorruptRecord="bad",
        header=False,
    )
    # Both columns are read, so that what is wrong with either shows.
    good = F.col("bad").isNull() & F.col("o_orderkey").isNotNull()
    status = F.when(good, F.col("o_orderstatus")).otherwise("bad").alias("status")
    return scanned.groupBy(status).agg(
        F.count(F.when(good, 1)).alias("n_good"), F.count("bad").alias("n_bad")
    )


# Tables


@query("SELECT * FROM part")
def table_create_scan(spark, sf_dir):
    table = workspace(spark).table("part")
    ll.create(given(spark, sf_dir, "part"), table)
    return spark.table(table)


@query("SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def table_append(spark, sf_dir):
    table = workspace(spark).table("supplier")
    suppliers = given(spark, sf_dir, "supplier")
    ll.create(suppliers, table)
    ll.append(suppliers, table)
    return spark.table(table)


@query("SELECT * FROM orders WHERE o_orderstatus = 'F'")
def table_replace(spark, sf_dir):
    table = workspace(spark).table("orders")
    orders = given(spark, sf_dir, "orders")
    ll.create(orders, table)
    ll.replace(orders.filter(F.col("o_orderstatus") == "F"), table)
    return spark.table(table)


@query("SELECT * FROM part WHERE p_size > 25")
def table_refresh(spark, sf_dir):
    """A table replaced by a part of itself."""
    table = workspace(spark).table("part")
    ll.replace(given(spark, sf_dir, "part"), table)
    ll.replace(spark.table(table).filter(F.col("p_size") > 25), table)
    return spark.table(table)


@query(
    """
    SELECT 'before' AS step, false AS present, CAST(0 AS BIGINT) AS n_rows
    UNION ALL SELECT 'created', true, count(*) FROM supplier
    UNION ALL SELECT 'dropped', false, CAST(0 AS BIGINT)
    """
)
def table_lifecycle(spark, sf_dir):
    table = workspace(spark).table("supplier")

    def state(step):
        present = ll.exists(spark, table)
        return step, present, spark.table(table).count() if present else 0

    ll.drop(spark, table)
    states = [state("before")]
    ll.create(given(spark, sf_dir, "supplier"), table)
    states.append(state("created"))
    ll.drop(spark, table)
    states.append(state("dropped"))
    return spark.createDataFrame(states, "step string, present boolean, n_rows bigint")


# Daily tables


def two_days_from_csv(spark, sf_dir):
    table = workspace(spark).table("daily_customer")
    path = as_csv(spark, sf_dir, "customer")
    return table, [ll.daily_load(spark, path, table, day) for day in (DAY_1, DAY_2)]


def daily_customers(spark, sf_dir):
    """Two days of customers, loaded as they are."""
    table = workspace(spark).table("daily_customer")
    customers = given(spark, sf_dir, "customer")
    for day in (DAY_1, DAY_2):
        ll.load_day(customers, table, day)
    return table


def rows_per_day(df):
    return df.groupBy(day_text(F.col("logical_date")).alias("logical_date")).agg(
        F.count("*").alias("n")
    )


@query(
    """
    SELECT d AS logical_date, count(*) AS n
    FROM customer, (VALUES ('2024-11-10'), ('2024-11-11')) v(d) GROUP BY d
    """
)
def daily_load(spark, sf_dir):
    table, _ = two_days_from_csv(spark, sf_dir)
    return rows_per_day(spark.table(table))


@query(
    """
    SELECT d AS logical_date, op AS operation, count(*) AS records_processed
    FROM customer,
         (VALUES ('2024-11-10T00:00:00Z', 'created'), ('2024-11-11T00:00:00Z', 'appended')) v(d, op)
    GROUP BY d, op
    """
)
def daily_load_report(spark, sf_dir):
    _, (first, second) = two_days_from_csv(spark, sf_dir)
    return first.union(second).drop("table_name")


@query("SELECT c_custkey, '2024-11-11' AS logical_date FROM customer")
def daily_slice(spark, sf_dir):
    day = ll.day_slice(spark.table(daily_customers(spark, sf_dir)), DAY_2)
    return day.select("c_custkey", day_text(F.col("logical_date")).alias("logical_date"))


@query(
    """
    SELECT '2024-11-10' AS logical_date, count(*) AS n FROM customer
    UNION ALL
    SELECT '2024-11-11', count(*) FROM customer WHERE c_mktsegment = 'BUILDING'
    """
)
def daily_overwrite(spark, sf_dir):
    """The second day run again with other rows."""
    table = daily_customers(spark, sf_dir)
    corrected = given(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    ll.load_day(corrected, table, DAY_2, mode="overwrite")
    return rows_per_day(spark.table(table))


@query("SELECT 3 * count(*) AS n_rows, count(c_acctbal) AS n_acctbal FROM customer")
def daily_evolution(spark, sf_dir):
    """A column that only the second of three days has."""
    table = workspace(spark).table("daily_customer")
    customers = given(spark, sf_dir, "customer")
    narrow = customers.drop("c_acctbal")
    for rows, day in ((narrow, DAY_1), (customers, DAY_2), (narrow, DAY_3)):
        ll.load_day(rows, table, day, evolve=True)
    return ll.profile(
        spark.table(table), {"n_rows": ("count", "*"), "n_acctbal": ("count", "c_acctbal")}
    )


@query(
    """
    SELECT round(sum(v), 2) AS total, count(*) AS n_rows, 'double' AS kind
    FROM (SELECT floor(c_acctbal) AS v FROM customer
          UNION ALL SELECT c_acctbal + 0.5 FROM customer)
    """
)
def daily_widening(spark, sf_dir):
    """Whole numbers on the first day, fractions on the second."""
    table = workspace(spark).table("daily_customer")
    customers = given(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    whole = customers.select("c_custkey", F.floor("c_acctbal").cast("int").alias("v"))
    ll.load_day(whole, table, DAY_1)
    half = customers.select("c_custkey", (F.col("c_acctbal") + 0.5).alias("v"))
    ll.load_day(half, table, DAY_2, evolve=True)
    kind = dict(spark.table(table).dtypes)["v"]
    return spark.table(table).agg(
        F.round(F.sum("v"), 2).alias("total"),
        F.count("*").alias("n_rows"),
        F.lit(kind).alias("kind"),
    )


@query(
    """
    SELECT '2024-11-10' AS logical_date, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING'
    UNION ALL
    SELECT '2024-11-11', count(*) FROM customer WHERE c_acctbal > 0
    """
)
def replace_keeps_partitions(spark, sf_dir):
    """A daily table replaced by a part of itself, then one of its days run again."""
    table = daily_customers(spark, sf_dir)
    ll.replace(spark.table(table).filter(F.col("c_mktsegment") == "BUILDING"), table)
    again = given(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0)
    ll.load_day(again, table, DAY_2, mode="overwrite")
    return rows_per_day(spark.table(table))


@query(
    """
    SELECT count(*) AS n_lines, count(DISTINCT l_orderkey) AS n_orders,
           round(avg(l_extendedprice), 4) AS avg_price, sum(l_quantity) AS total_quantity,
           max(l_discount) AS max_discount, min(l_tax) AS min_tax
    FROM lineitem
    """
)
def daily_load_facts(spark, sf_dir):
    """The largest table as one day's file of known types, loaded, run again, and profiled."""
    table = workspace(spark).table("daily_lineitem")
    path = as_csv(spark, sf_dir, "lineitem")
    schema = given(spark, sf_dir, "lineitem").schema
    for _ in range(2):
        ll.daily_load(spark, path, table, DAY_1, schema=schema, mode="overwrite")
    stats = {
        "n_lines": ("count", "*"),
        "n_orders": ("count_distinct", "l_orderkey"),
        "avg_price": ("avg", "l_extendedprice"),
        "total_quantity": ("sum", "l_quantity"),
        "max_discount": ("max", "l_discount"),
        "min_tax": ("min", "l_tax"),
    }
    figures = ll.profile(ll.day_slice(spark.table(table), DAY_1), stats)
    return figures.withColumn("avg_price", F.round("avg_price", 4))


# Columns


@query("SELECT p_partkey, true AS stamped, true AS same_time FROM part")
def audit_columns(spark, sf_dir):
    table = workspace(spark).table("part")
    ll.create(ll.with_load_times(given(spark, sf_dir, "part"), "created_at", "updated_at"), table)
    return spark.table(table).select(
        "p_partkey",
        F.col("created_at").isNotNull().alias("stamped"),
        (F.col("created_at") == F.col("updated_at")).alias("same_time"),
    )


@query(
    """
    SELECT o_orderkey,
           strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS logical_date
    FROM orders
    """
)
def parse_logical_date(spark, sf_dir):
    """Order dates as ISO text two hours ahead of UTC, read as instants and shown in UTC."""
    local = F.replace(F.col("o_orderdate").cast("string"), F.lit(" "), F.lit("T"))
    text = F.concat(local, F.lit("+02:00"))
    return given(spark, sf_dir, "orders").select(
        "o_orderkey", ll.iso_utc(ll.parse_iso(text)).alias("logical_date")
    )


# Filters and aggregates, over tables that the library loaded


def loaded(spark, sf_dir, name):
    table = workspace(spark).table(name)
    ll.create(given(spark, sf_dir, name), table)
    return spark.table(table)


@query("SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(spark, sf_dir):
    return loaded(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")


@query("SELECT * FROM supplier WHERE s_acctbal > 5000")
def filter_gt(spark, sf_dir):
    return loaded(spark, sf_dir, "supplier").filter(F.col("s_acctbal") > 5000)


@query("SELECT DISTINCT c_mktsegment FROM customer")
def distinct_values(spark, sf_dir):
    return loaded(spark, sf_dir, "customer").select("c_mktsegment").distinct()


@query(
    """
    SELECT count(s_suppkey) AS total_employees, round(avg(s_acctbal), 6) AS avg_salary,
           max(s_acctbal) AS max_salary, min(s_acctbal) AS min_salary
    FROM supplier
    """
)
def employee_stats(spark, sf_dir):
    stats = {
        "total_employees": ("count", "s_suppkey"),
        "avg_salary": ("avg", "s_acctbal"),
        "max_salary": ("max", "s_acctbal"),
        "min_salary": ("min", "s_acctbal"),
    }
    figures = ll.profile(given(spark, sf_dir, "supplier"), stats)
    return figures.withColumn("avg_salary", F.round("avg_salary", 6))


@query("SELECT round(avg(s_acctbal), 6) AS avg_salary FROM supplier")
def dict_agg(spark, sf_dir):
    averaged = loaded(spark, sf_dir, "supplier").agg({"s_acctbal": "avg"})
    return averaged.select(F.round(column("avg(s_acctbal)"), 6).alias("avg_salary"))


# Jobs


@query(
    """
    SELECT count(*) AS total_products, count(DISTINCT p_brand) AS unique_categories,
           round(avg(p_retailprice), 6) AS avg_price, CAST(sum(p_size) AS BIGINT) AS total_stock
    FROM part
    """
)
def profile_products(spark, sf_dir):
    path = as_csv(spark, sf_dir, "part", PRODUCT_COLUMNS)
    figures = ll.refresh_products(spark, path, workspace(spark).table("products"))
    return figures.drop("table_name").withColumn("avg_price", F.round("avg_price", 6))


@query(
    """
    SELECT count(*) AS total_users, count(DISTINCT c_mktsegment) AS unique_departments,
           round(avg(c_nationkey), 6) AS avg_age, round(avg(c_acctbal), 6) AS avg_salary
    FROM customer
    """
)
def profile_users(spark, sf_dir):
    path = as_csv(spark, sf_dir, "customer", USER_COLUMNS)
    figures = ll.refresh_users(spark, path, workspace(spark).table("users"))
    return figures.drop("table_name").withColumns(
        {name: F.round(name, 6) for name in ("avg_age", "avg_salary")}
    )


@query(
    """
    SELECT format('{}', count(*)) AS total_users,
           format('{}', count(DISTINCT c_mktsegment)) AS unique_departments,
           format('{:.1f}', avg(c_nationkey)) AS avg_age,
           '$' || format('{:,.2f}', avg(c_acctbal)) AS avg_salary
    FROM customer
    """
)
def formatted_report(spark, sf_dir):
    renamed = given(spark, sf_dir, "customer").withColumnsRenamed(USER_COLUMNS)
    return ll.report(ll.profile(renamed, ll.plans.USERS_STATS), ll.plans.USERS_PATTERNS)
