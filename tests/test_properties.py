"""Random inputs against plain Python."""

import csv as python_csv
import io
import math
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import lakeload as ll

few = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)

# Any text but line ends, and no blanks at its ends, which the reader would be right to keep but
# which a cell of nothing else would lose.
words = st.text(
    st.characters(exclude_categories=["Cs", "Cc", "Zl", "Zp"]), min_size=1, max_size=20
).filter(lambda text: text == text.strip())
cells = st.tuples(
    st.integers(-(2**63), 2**63 - 1),
    st.floats(allow_nan=False, allow_infinity=False),
    words,
    st.none() | st.integers(-(2**31), 2**31 - 1),
)


@few
@given(table=st.lists(cells, min_size=1, max_size=60))
def test_csv_cells_come_back_as_written(spark, tmp_path_factory, table):
    text = io.StringIO()
    writer = python_csv.writer(text, lineterminator="\n")
    writer.writerow(["n", "id", "ratio", "name", "maybe"])
    for n, row in enumerate(table):
        writer.writerow([n, *("" if cell is None else cell for cell in row)])
    path = tmp_path_factory.mktemp("csv") / "in.csv"
    path.write_text(text.getvalue(), encoding="utf-8")
    schema = "n int, id bigint, ratio double, name string, maybe int"
    read = ll.load_csv(spark, path, schema=schema, escape='"').orderBy("n").collect()
    assert [tuple(row)[1:] for row in read] == table


@few
@given(
    data=st.lists(
        st.tuples(
            st.none() | st.integers(-1000, 1000),
            st.none() | st.sampled_from("abcdef"),
            st.none() | st.integers(-10000, 10000).map(lambda n: n / 4),
        ),
        max_size=80,
    )
)
def test_profile(spark, data):
    df = spark.createDataFrame(data, "i int, s string, d double").repartition(3)
    stats = {
        "n": ("count", "*"),
        "some": ("count", "i"),
        "kinds": ("count_distinct", "s"),
        "mean": ("avg", "d"),
        "total": ("sum", "i"),
        "high": ("max", "d"),
        "low": ("min", "d"),
    }
    row = ll.profile(df, stats).first()
    i, s, d = ([v for v in column if v is not None] for column in (zip(*data) if data else ([],) * 3))
    assert (row.n, row.some, row.kinds) == (len(data), len(i), len(set(s)))
    assert row.total == (sum(i) if i else None)
    assert (row.high, row.low) == ((max(d), min(d)) if d else (None, None))
    assert row.mean is None if not d else math.isclose(row.mean, sum(d) / len(d), abs_tol=1e-9)


instants = st.datetimes(datetime(1902, 1, 1), datetime(2090, 1, 1)).map(
    lambda at: at.replace(tzinfo=timezone.utc)
)


@pytest.mark.parametrize("name", ["UTC", "America/New_York", "Asia/Kathmandu"])
@few
@given(moments=st.lists(instants, min_size=1, max_size=40), hours=st.integers(-12, 12))
def test_dates_survive_any_zone(spark, zone, name, moments, hours):
    zone(name)
    shifted = [at.astimezone(timezone(timedelta(hours=hours))) for at in moments]
    expected = [
        int((at - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1))
        for at in moments
    ]
    assert [ll.run_instant(spark, at) for at in shifted[:3]] == expected[:3]
    texts = spark.createDataFrame(list(enumerate(at.isoformat() for at in shifted)), "n int, t string")
    parsed = ll.parse_iso(F.col("t"))
    rows = texts.select("n", F.unix_micros(parsed).alias("us"), ll.iso_utc(parsed).alias("iso"))
    rows = rows.orderBy("n").collect()
    assert [row.us for row in rows] == expected
    assert [datetime.fromisoformat(row.iso) for row in rows] == moments


@few
@given(
    loads=st.lists(
        st.tuples(
            st.sampled_from(["2024-03-09T23:00:00", "2024-03-10", "2024-11-03T06:30:00Z"]),
            st.sampled_from(["append", "overwrite"]),
            st.integers(0, 5),
        ),
        min_size=1,
        max_size=6,
    )
)
def test_any_order_of_daily_loads(spark, loads):
    from lakeload.workspace import new_workspace

    place = new_workspace(spark)
    table, held = place.table("daily"), {}
    for day, mode, rows in loads:
        created = not held
        done = ll.load_day(spark.range(rows), table, day, mode=mode)
        assert done.records_processed == rows
        assert (done.operation == "created") == created
        held[day] = rows + (held.get(day, 0) if mode == "append" else 0)
    stored = spark.table(table)
    assert {day: ll.day_slice(stored, day).count() for day in held} == held
    assert stored.count() == sum(held.values())
    place.drop(spark)


@pytest.mark.parametrize("name", ["UTC", "America/New_York", "Asia/Kathmandu"])
@settings(few, max_examples=4)
@given(day=st.sampled_from(["2024-11-10", "2024-03-10 02:30:00", "2024-11-03 01:30:00.250"]))
def test_a_reported_date_finds_the_same_rows(spark, zone, name, day):
    from lakeload.workspace import new_workspace

    zone(name)
    place = new_workspace(spark)
    table = place.table("daily")
    done = ll.load_day(spark.range(5), table, day)
    assert ll.day_slice(spark.table(table), done.logical_date).count() == 5
    zone("Europe/Berlin")  # in any other session too
    again = ll.load_day(spark.range(3), table, done.logical_date, mode="overwrite")
    assert again.logical_date == done.logical_date
    assert spark.table(table).count() == 3
    place.drop(spark)
