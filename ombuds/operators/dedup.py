"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ombuds.schemas import AUDIT

_RANK = "_rank"


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: str = AUDIT,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep one row per key: the greatest ``order_by``, NULL counting as greatest.

    Rows with a NULL key form one group. Ties fall to ``tie_break`` (default: ``load_time``, then all
    other columns), so the result does not depend on row order.

    The filter on the row number lets Spark cut every map task to one row per key before the shuffle
    (``WindowGroupLimit``), so a key holding a third of the rows costs one row per task, not a hot task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if tie_break is None:
        rest = [name for name in df.columns if name not in keys and name != order_by]
        tie_break = sorted(rest, key=lambda name: name != "load_time")
    order = [F.desc_nulls_first(order_by), *(F.desc_nulls_last(name) for name in tie_break)]
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)
