"""Casts that give NULL instead of failing, with the text forms a warehouse accepts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms accepted besides ISO 8601.
DATE_FORMATS = ("M/d/yyyy", "d-MMM-yyyy")
TIMESTAMP_FORMATS = ("M/d/yyyy H:mm:ss", "M/d/yyyy", "d-MMM-yyyy H:mm:ss", "d-MMM-yyyy")

# Below each bound, digits count seconds, milliseconds, microseconds; else nanoseconds.
_EPOCH_UNITS = ((31536000000, 1000000), (31536000000000, 1000), (31536000000000000, 1))

_DIGITS = r"^\d+$"


def _from_epoch(text: Column) -> Column:
    """Digits only: an epoch count whose unit follows from its size."""
    number = text.try_cast("bigint")
    micros = F.call_function("div", number, F.lit(1000))
    for bound, factor in reversed(_EPOCH_UNITS):
        micros = F.when(number < F.lit(bound), number * F.lit(factor)).otherwise(micros)
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def _is_iso(text: Column) -> Column:
    """Starts with a four-digit year and is long enough for a whole day; no pattern match, this is hot."""
    bare = F.trim(text)
    return (F.substring(bare, 5, 1) == "-") & (F.length(bare) >= len("2025-1-1"))


def _first_format(text: Column, formats: Sequence[str]) -> list[Column]:
    return [F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz") for fmt in formats]


def try_timestamp(column: Column | str, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """Timestamp without zone; NULL for text that is none. ISO text takes the first, cheap branch."""
    text = F.col(column) if isinstance(column, str) else column
    return (
        F.when(_is_iso(text), text.try_cast("timestamp_ntz"))
        .when(text.rlike(_DIGITS), _from_epoch(text))
        .otherwise(F.coalesce(*_first_format(text, formats)))
    )


def try_date(column: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date; NULL for text that is none."""
    text = F.col(column) if isinstance(column, str) else column
    return (
        F.when(_is_iso(text), text.try_cast("date"))
        .when(text.rlike(_DIGITS), F.to_date(_from_epoch(text)))
        .otherwise(F.to_date(F.coalesce(*_first_format(text, formats))))
    )
