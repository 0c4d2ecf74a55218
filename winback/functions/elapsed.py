"""Zone-less moments and the whole days between them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_days(start: Column, end: Column) -> Column:
    """Elapsed days rounded towards minus infinity: +23 h is 0, -6 h is -1.

    ``datediff`` counts midnights and ``timestampdiff`` cuts towards zero, so neither fits.
    Subtracting zone-less timestamps gives an exact interval whatever the session time zone
    is; its day field is cut towards zero and corrected by one below zero.
    """
    elapsed = end - start
    days = F.extract(F.lit("DAY"), elapsed)
    return days - (F.make_dt_interval(days) > elapsed).cast("int")


def moment(value: dt.datetime | None) -> Column:
    """A zone-less timestamp constant, untouched by the time zones of Python and the session."""
    return F.lit(value and value.isoformat(sep=" ")).cast("timestamp_ntz")
