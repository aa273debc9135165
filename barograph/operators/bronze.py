"""Bronze lake rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barograph.schema import BRONZE


def bronze_rows(measurements: DataFrame) -> DataFrame:
    """Measurements with ingest time and event date, in lake order."""
    added = {"ingestTime": F.current_timestamp(), "eventDate": F.to_date("eventTime")}
    return measurements.withColumns(added).select(*BRONZE.fieldNames())


def bad_rows(bronze: DataFrame) -> DataFrame:
    """Messages kept in the lake although no event time could be read from them.

    They share the default date partition, so this reads only that one.
    """
    return bronze.filter(F.col("eventDate").isNull() & F.col("jsonValue").isNotNull())
