"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that stands for NULL in a key, and the separator.
NULL_TEXT = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*columns: Column | str) -> Column:
    """MD5 of the columns' text forms joined with ``-``."""
    parts = [F.col(column) if isinstance(column, str) else column for column in columns]
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_TEXT)) for part in parts]
    return F.md5(F.concat_ws(SEPARATOR, *texts))
