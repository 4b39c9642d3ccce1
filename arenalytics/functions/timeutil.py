"""Zone-free literals for 'now' and batch times.

A naive Python ``datetime`` passed to ``F.lit`` is interpreted in the Python
process's local time zone; on a driver not running in UTC the wall-clock value
would shift.  These helpers go through ISO text instead.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz_literal(value: dt.datetime | dt.date) -> Column:
    """A ``timestamp_ntz`` literal with exactly this wall-clock value."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def date_literal(value: dt.datetime | dt.date) -> Column:
    d = value.date() if isinstance(value, dt.datetime) else value
    return F.lit(d.isoformat()).cast("date")
