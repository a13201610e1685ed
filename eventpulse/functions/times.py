"""Event time, minute and date expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FULL = r"^\s*\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"


def event_time(text: str | Column) -> Column:
    """ISO-8601 date and time to an instant; NULL for any other text, a mere time of day included."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(FULL), F.try_to_timestamp(text))


def minute_start(window: str = "window") -> Column:
    return F.col(f"{window}.start").alias("minute")


def event_date(time: str = "event_created_at") -> Column:
    return F.col(time).cast("date").alias("event_date")


def at_rest(df: DataFrame) -> DataFrame:
    """Zone-less timestamps, as tables store them (the session zone is UTC)."""
    return df.withColumns(
        {
            f.name: F.col(f.name).cast("timestamp_ntz")
            for f in df.schema.fields
            if isinstance(f.dataType, T.TimestampType)
        }
    )
