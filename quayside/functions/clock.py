"""Times as text and as epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: how run-log times are shown.
DISPLAY_FORMAT = "dd-MM-yyyy HH:mm:ss"


def to_display(at: Column) -> Column:
    return F.date_format(at, DISPLAY_FORMAT)


def from_display(text: Column) -> Column:
    return F.to_timestamp(text, DISPLAY_FORMAT)


def epoch_millis(col: Column, data_type: T.DataType) -> Column:
    """Milliseconds since 1970, rounded down. Zone-less times count as UTC.

    A zone-less time is taken apart field by field, so the session's zone plays no part.
    """
    if isinstance(data_type, T.TimestampType):
        return F.unix_millis(col)
    day = F.unix_date(col.cast("date")).cast("long") * 86_400_000
    if isinstance(data_type, T.DateType):
        return day
    clock = F.hour(col) * 3_600_000 + F.minute(col) * 60_000
    seconds = F.floor(F.date_part(F.lit("SECONDS"), col) * 1000).cast("long")
    return day + clock + seconds
