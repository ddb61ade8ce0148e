from lakeload.functions.dates import as_datetime, instant, iso_text, iso_utc, parse_iso, run_instant
from lakeload.functions.numbers import formatted

__all__ = ["as_datetime", "formatted", "instant", "iso_text", "iso_utc", "parse_iso", "run_instant"]
