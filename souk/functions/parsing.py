"""Text values read as the types that contracts name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampType

from souk.functions.dates import TIMESTAMP_FORMAT, parse_timestamp
from souk.functions.text import is_blank


def parsed(text: Column, target: DataType) -> Column:
    """The value as ``target``; NULL if it does not parse."""
    if isinstance(target, StringType):
        return text
    if isinstance(target, TimestampType):
        return parse_timestamp(text, TIMESTAMP_FORMAT)
    return text.try_cast(target)


def breaks(text: Column, target: DataType) -> Column:
    """Whether there is a value, blanks aside, that does not parse."""
    return ~is_blank(text) & parsed(text, target).isNull()
