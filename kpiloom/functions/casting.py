"""Lenient typing of text columns (string → date / number / timestamp).

Spark 4 runs in ANSI mode, where ``cast``/``to_date`` on bad text fails the
whole job. Cleaning must instead turn a bad cell into NULL, so every
conversion here uses the ``try_*`` family. Columns that already have the
target type pass through untouched, which keeps Parquet filters pushable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, StringType, TimestampType

ISO_DATE = "yyyy-MM-dd"  # the cast reads it by itself; a format that does not fit costs an exception for each row


def typed_column(df: DataFrame, name: str, target: DataType, date_format: str | None = None) -> Column:
    """``name`` converted to ``target``; bad or out-of-range text becomes NULL."""
    current = df.schema[name].dataType
    col = F.col(name)
    if current == target:
        return col.alias(name)
    if isinstance(target, DateType) and isinstance(current, StringType):
        # Text with a time after the date is a date, too; other text is NULL.
        converted = col.try_cast(target)
        if date_format and date_format != ISO_DATE:
            converted = F.coalesce(F.try_to_date(col, date_format), converted)
    elif isinstance(target, TimestampType) and isinstance(current, StringType):
        converted = F.try_to_timestamp(col, F.lit(date_format)) if date_format else F.try_to_timestamp(col)
    elif isinstance(target, IntegralType) and isinstance(current, StringType):
        # "1500.0" is a whole number, too. Text with a point or letters is none to the first cast, which would make an exception for each such row.
        number = col.try_cast("double").try_cast(target)
        converted = F.when(col.rlike("[.a-zA-Z]"), number).otherwise(F.coalesce(col.try_cast(target), number))
    else:
        converted = col.try_cast(target)
    return converted.alias(name)


def with_types(df: DataFrame, types: dict[str, DataType], formats: dict[str, str] | None = None) -> DataFrame:
    """One projection converting every listed column present in ``df``; others are kept.

    When every listed column already has its type, ``df`` is returned as is.
    """
    formats = formats or {}
    fields = {f.name: f.dataType for f in df.schema.fields}
    if all(fields[c] == t for c, t in types.items() if c in fields):
        return df
    return df.select(*[
        typed_column(df, c, types[c], formats.get(c)) if c in types else F.col(c)
        for c in df.columns
    ])


def iso_timestamp_text(col: Column) -> Column:
    """Timestamp → ISO-8601 text with microseconds and no zone."""
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
