from lakeload.operators.daily import DayLoad, day_slice, load_day
from lakeload.operators.profile import profile, report
from lakeload.operators.stamp import with_load_times, with_logical_date
from lakeload.operators.tables import append, conforming, create, drop, exists, purge, replace

__all__ = [
    "DayLoad",
    "append",
    "conforming",
    "create",
    "day_slice",
    "drop",
    "exists",
    "load_day",
    "profile",
    "purge",
    "replace",
    "report",
    "with_load_times",
    "with_logical_date",
]
