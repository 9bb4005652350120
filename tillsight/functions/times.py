"""India-time text."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ZONE = "Asia/Kolkata"
FORMAT = "yyyy-MM-dd HH:mm:ss"


def ist_text(ts: Column, zone: str | Column = "UTC") -> Column:
    """Text of a zone-less timestamp given in `zone`, as India time."""
    source = F.lit(zone) if isinstance(zone, str) else zone
    return F.date_format(F.convert_timezone(source, F.lit(ZONE), ts), FORMAT)


def ist_now() -> Column:
    """Current India time; right in any session time zone."""
    return ist_text(F.localtimestamp(), F.current_timezone())


def read_clock() -> str:
    """The current India time, from the driver's clock."""
    return datetime.now(ZoneInfo(ZONE)).strftime("%Y-%m-%d %H:%M:%S")
