from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import lakeload as ll
from lakeload.functions import as_datetime

MIDNIGHT = 1731196800000000  # 2024-11-10T00:00:00Z


@pytest.mark.parametrize(
    "when",
    [
        "2024-11-10",
        "2024-11-10T00:00:00",
        "2024-11-10 00:00:00",
        "2024-11-10T00:00:00Z",
        "2024-11-10T00:00:00+00:00",
        "2024-11-10T02:00:00+02:00",
        date(2024, 11, 10),
        datetime(2024, 11, 10),
        datetime(2024, 11, 10, tzinfo=timezone.utc),
        datetime(2024, 11, 10, 5, 30, tzinfo=timezone(timedelta(hours=5, minutes=30))),
    ],
)
def test_run_instant(spark, when):
    assert ll.run_instant(spark, when) == MIDNIGHT


def test_without_offset_the_session_zone_counts(spark, zone):
    zone("America/New_York")
    assert ll.run_instant(spark, "2024-11-10") == MIDNIGHT + 5 * 3600 * 10**6
    assert ll.run_instant(spark, datetime(2024, 11, 10)) == MIDNIGHT + 5 * 3600 * 10**6
    assert ll.run_instant(spark, "2024-11-10T00:00:00Z") == MIDNIGHT


@pytest.mark.parametrize("when", [None, "", "yesterday", "12:30", "2024", "2024-13-01", "{{ date }}"])
def test_no_date_is_an_error(spark, when):
    with pytest.raises(ValueError, match="not an ISO date"):
        ll.run_instant(spark, when)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_malformed_dates_raise_with_and_without_ansi(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(ValueError):
            ll.run_instant(spark, "2024-11-10 25:00:00")
        with pytest.raises(Exception, match="not an ISO date"):
            spark.range(1).select(ll.parse_iso(F.lit("soon"))).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_as_datetime():
    assert as_datetime(MIDNIGHT) == datetime(2024, 11, 10, tzinfo=timezone.utc)


@pytest.mark.parametrize("name", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_iso_utc_in_any_zone(spark, zone, name):
    zone(name)
    # The second and third fall into the hour New York skips and the one it repeats.
    texts = [
        "2024-11-10T00:00:00Z",
        "2024-03-10T02:30:00Z",
        "2024-11-03T05:30:00Z",
        "2024-11-03T06:30:00Z",
        "1969-12-31T23:59:59.5Z",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], ["text"])
    instants = ll.parse_iso(F.col("text"))
    assert [r[0] for r in rows.select(ll.iso_utc(instants)).collect()] == texts


@pytest.mark.parametrize("text", ["soon", "", "12:30", "2024", "2024-11-10 25:00:00"])
def test_parse_iso_wants_a_whole_date(spark, text):
    with pytest.raises(Exception, match="not an ISO date"):
        spark.range(1).select(ll.parse_iso(F.lit(text))).collect()


def test_parse_iso_keeps_nulls(spark):
    rows = spark.createDataFrame([(None,)], "text string")
    assert rows.select(ll.parse_iso(F.col("text"))).first()[0] is None


@pytest.mark.parametrize(
    "value, pattern, text",
    [
        (34.25, "0.0", "34.2"),
        (0.35, "0.0", "0.3"),
        (88500.0, "$#,##0.00", "$88,500.00"),
        (1234567.125, "#,##0.00", "1,234,567.12"),
        (162.19, "$0.00", "$162.19"),
        (0.5, "0.00", "0.50"),
        (None, "0.00", None),
    ],
)
def test_formatted(spark, value, pattern, text):
    if value is not None and "$" not in pattern:
        spec = {"0.0": ".1f", "0.00": ".2f", "#,##0.00": ",.2f"}[pattern]
        assert format(value, spec) == text
    column = ll.formatted(F.lit(value).cast("double"), pattern)
    assert spark.range(1).select(column).first()[0] == text
