"""Run dates and ISO text.

An instant travels as microseconds since 1970-01-01 UTC, never as a naive Python datetime:
Spark would read that in the zone of the Python process instead of the zone of the session.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Spark would complete "2024" to its first day and "12:30" by the current date.
_STARTS_WITH_A_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def run_instant(spark: SparkSession, when: str | date) -> int:
    """Microseconds of a run date given as ISO text, a date or a datetime.

    Without an offset it is taken in the session's time zone. A missing or malformed date
    raises: a load is never filed under the current time by accident.
    """
    text = str(when) if isinstance(when, date) else when
    if not text or not re.match(_STARTS_WITH_A_DATE, text):
        raise ValueError(f"not an ISO date or timestamp: {when!r}")
    # Over a literal row the optimizer works out the result; no Spark job runs.
    [(micros,)] = spark.sql(
        "SELECT unix_micros(try_cast(text AS TIMESTAMP)) FROM VALUES (:text) AS t(text)",
        args={"text": text},
    ).collect()
    if micros is None:
        raise ValueError(f"not an ISO date or timestamp: {when!r}")
    return micros


def instant(micros: int) -> Column:
    """The instant as a timestamp literal; Catalyst folds it, so filters on it prune partitions."""
    return F.timestamp_micros(F.lit(micros))


def as_datetime(micros: int) -> datetime:
    return _EPOCH + timedelta(microseconds=micros)


def iso_text(micros: int) -> str:
    """The instant as ISO text in UTC, spelled as :func:`iso_utc` does."""
    text = as_datetime(micros).replace(tzinfo=None).isoformat()
    return (text.rstrip("0") if "." in text else text) + "Z"


def parse_iso(text: Column) -> Column:
    """ISO text column to timestamp; malformed text raises, absent text stays null."""
    complaint = F.raise_error(F.concat(F.lit("not an ISO date or timestamp: "), text))
    return F.coalesce(
        F.when(text.rlike(_STARTS_WITH_A_DATE), F.try_to_timestamp(text)),
        F.when(text.isNotNull(), complaint.cast("timestamp")),
    )


def iso_utc(ts: Column) -> Column:
    """Timestamp to ISO text in UTC, whatever the session's zone, ending in ``Z``.

    Read back, by :func:`parse_iso` or as a run date, it is the same instant in any session.

    Counting microseconds up from a zone-free 1970 avoids rendering through the session's zone,
    where hours skipped or repeated by daylight saving would come out wrong.
    """
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    wall_clock = F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch)
    return F.concat(F.replace(wall_clock.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
