"""Activity times."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# Where spreadsheets start to count days, and the counts up to the year 9999.
SERIAL_START, SERIAL_DAYS = "1899-12-30", (1, 2_958_465)


def parse_activity(c: Column, formats: Sequence[str] = ()) -> Column:
    """Wall-clock time, null when it cannot be read.

    ISO text and real timestamps are read as they are; ``formats`` lists further
    patterns, tried in turn. A plain number is the day count of a spreadsheet, never a year.
    """
    text = F.btrim(c.cast("string"))
    days = F.when(text.rlike(r"^[0-9]{1,7}([.][0-9]+)?$"), text.try_cast("double"))
    whole = F.floor(days)
    offset = F.make_dt_interval(whole.cast("int"), F.lit(0), F.lit(0), F.round((days - whole) * 86400).cast("decimal(18,6)"))
    serial = F.when(whole.between(*SERIAL_DAYS), F.lit(SERIAL_START).cast("timestamp_ntz") + offset)
    tries = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    read = F.coalesce(c.try_cast("timestamp_ntz"), *tries)
    return F.when(text.rlike(r"^[+-]?[0-9]+([.][0-9]*)?$"), serial).otherwise(read)


def active_since(c: Column, since: dt.date | None) -> Column:
    """True for rows active on or after ``since``; without a date every row is kept."""
    if since is None:
        return F.lit(True)
    return c >= F.lit(since.isoformat()).cast("timestamp_ntz")
