"""Bronze annotations: when a line was ingested and from where."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.constants import MANUAL_SOURCE
from tillwise.functions.times import moment

SOURCE_COLUMN = "source_file"


def annotate(lines: DataFrame, as_of: datetime | str | Column | None = None) -> DataFrame:
    """Add ``ingestion_timestamp``, and ``source_file`` where the scan did not set it."""
    source = (
        F.coalesce(F.col(SOURCE_COLUMN), F.lit(MANUAL_SOURCE))
        if SOURCE_COLUMN in lines.columns
        else F.lit(MANUAL_SOURCE)
    )
    return lines.withColumns({"ingestion_timestamp": moment(as_of), SOURCE_COLUMN: source})
