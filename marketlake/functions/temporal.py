"""Timestamps without zone: from epoch, from text, to text, and their calendar parts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"
_PARTS = {
    "day": F.dayofmonth, "month": F.month, "year": F.year, "quarter": F.quarter,
    "hour": F.hour, "minute": F.minute, "second": F.second,
}


def from_epoch_millis(millis: Column) -> Column:
    """Epoch milliseconds to a zone-free UTC timestamp, whatever the session zone is."""
    return F.timestamp_add("MILLISECOND", millis, F.lit(EPOCH).cast("timestamp_ntz"))


def from_offset_text(text: Column) -> Column:
    """Timestamp text to the wall-clock time it shows; a zone offset at the end is dropped."""
    return F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", "").cast("timestamp_ntz")


def to_micros_text(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def calendar_parts(timestamp: Column, names: Mapping[str, str]) -> list[Column]:
    """Integer parts of a timestamp; ``names`` maps the output column to day, month, year, ..."""
    return [_PARTS[part](timestamp).cast("int").alias(name) for name, part in names.items()]


def as_of(moment=None) -> Column:
    """The load time: a given datetime or text, else the session's current time."""
    return F.localtimestamp() if moment is None else F.lit(str(moment)).cast("timestamp_ntz")
