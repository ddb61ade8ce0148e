"""Number formatting for reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def formatted(value: Column, pattern: str) -> Column:
    """Number to text by a pattern such as ``0.0``, ``#,##0.00`` or ``$#,##0.00``.

    Rounds half to even on the exact binary value, as printf-style formatting of a double does
    elsewhere; Spark's own ``printf`` rounds half up. Null stays null.
    """
    return F.call_function("format_number", value, F.lit(pattern))
