"""Load files into analytic tables with Spark and query them."""

from lakeload.functions import formatted, iso_utc, parse_iso, run_instant
from lakeload.operators import (
    DayLoad,
    append,
    create,
    day_slice,
    drop,
    exists,
    load_day,
    profile,
    purge,
    replace,
    report,
    with_load_times,
    with_logical_date,
)
from lakeload.plans import daily_load, refresh_and_profile, refresh_products, refresh_users
from lakeload.sources import from_rows, load_csv, resolve_path, spark_properties, storage_summary

__all__ = [
    "DayLoad",
    "append",
    "create",
    "daily_load",
    "day_slice",
    "drop",
    "exists",
    "formatted",
    "from_rows",
    "iso_utc",
    "load_csv",
    "load_day",
    "parse_iso",
    "profile",
    "purge",
    "refresh_and_profile",
    "refresh_products",
    "refresh_users",
    "replace",
    "report",
    "resolve_path",
    "run_instant",
    "spark_properties",
    "storage_summary",
    "with_load_times",
    "with_logical_date",
]
