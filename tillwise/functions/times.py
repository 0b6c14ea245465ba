"""Invoice time parsing and reference times."""

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwise.constants import INVOICE_TIME_FORMAT


def parse_invoice_time(text: Column) -> Column:
    """US-style text first, ISO text second, null when neither fits (also under ANSI)."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit(INVOICE_TIME_FORMAT)), F.try_to_timestamp(text)
    )


def moment(value: datetime | date | str | Column | None) -> Column:
    """A reference time as a column; the current time when none is given."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")
