"""Merge a batch into a target by key, as joins.

``source`` holds at most one row per non-NULL key (see ``latest_per_key``); ``target`` may repeat keys, and
then every match is updated. NULL keys match nothing: such target rows stay, such source rows are inserted.
Target rows without a match always survive.

The target is always the streamed side of its join, never the built one. A batch that was measured to be
small is broadcast, and then the target is not shuffled at all. A larger one is shuffled on the key together
with the target, and a hot target key is split by the adaptive skew join (left outer and left anti joins
allow that, a full outer join does not). NULL-key target rows by-pass the join, so they never pile up in one
task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: most memory a broadcast batch may take, and what a row takes beside its text
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_BYTES = 128

_HIT = "_matched"
_NEWER, _NEW, _SLOT = "_newer", "_new", "_slot"


@dataclass(frozen=True)
class BatchSize:
    """Exact size of a batch, measured while it was written."""

    rows: int
    key_bytes: int
    all_bytes: int

    @property
    def keys_fit(self) -> bool:
        return self.key_bytes + self.rows * ROW_BYTES <= BROADCAST_BYTES

    @property
    def rows_fit(self) -> bool:
        return self.all_bytes + self.rows * ROW_BYTES <= BROADCAST_BYTES


def measured(df: DataFrame, key: str) -> tuple[DataFrame, Observation]:
    """``df`` with its size taken along the next action on it."""

    texts = [field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)]

    def bytes_of(names: list[str]):
        """Bytes of text; other columns are part of ``ROW_BYTES``."""
        lengths = (F.coalesce(F.octet_length(name), F.lit(0)).cast("bigint") for name in names)
        return F.sum(reduce(Column.__add__, lengths, F.lit(0).cast("bigint")))

    seen = Observation()
    sizes = (F.count(F.lit(1)), bytes_of([key] if key in texts else []), bytes_of(texts))
    names = ("rows", "key_bytes", "all_bytes")
    return df.observe(seen, *(size.alias(name) for size, name in zip(sizes, names))), seen


def batch_size(seen: Observation) -> BatchSize:
    return BatchSize(**{name: value or 0 for name, value in seen.get.items()})


def spread_keys(keys: DataFrame, size: BatchSize | None) -> DataFrame:
    return F.broadcast(keys) if size is not None and size.keys_fit else keys


def spread_rows(rows: DataFrame, size: BatchSize | None) -> DataFrame:
    return F.broadcast(rows) if size is not None and size.rows_fit else rows


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    update: Sequence[str] | None = None,
    size: BatchSize | None = None,
    unique_target: bool = False,
) -> DataFrame:
    """Insert new keys; on a match overwrite ``update`` columns, or all when it is ``None``.

    ``size`` is the measured size of ``source``; without it Spark's own estimate picks the join.
    ``unique_target`` says that no target key repeats. Then overwriting all columns is replacing the row,
    which needs the batch's keys only.
    """
    columns = target.columns
    source = source.select(*columns)
    if update is None:
        update = [name for name in columns if name != key]
    if unique_target and set(columns) <= {key, *update}:
        return _replace_rows(target, source, key, size)
    return _update_columns(target, source, key, update, size)


def upsert_in_place(
    target: DataFrame, source: DataFrame, key: str, update: Sequence[str] | None, place: Column, slots: int
) -> DataFrame:
    """``upsert`` where no target key repeats, with one shuffle of both sides and none of it for a join.

    ``place`` is a number from 0 to ``slots`` that follows from the key; rows of one number stay in one task. A key has two
    rows at most, the old and the new one, and so no task is hot. NULL keys match nothing and by-pass the shuffle.
    """
    columns = target.columns
    source = source.select(*columns)
    fresh = [name for name in columns if name != key and (update is None or name in update)]
    whole = set(columns) <= {key, *fresh}
    sides = [df.where(F.col(key).isNotNull()).withColumn(_NEWER, F.lit(new)) for df, new in ((target, False), (source, True))]
    both = sides[0].unionByName(sides[1]).withColumn(_SLOT, place.cast("int")).repartitionById(slots, F.col(_SLOT))
    pair = Window.partitionBy(_SLOT, key).orderBy(F.desc(_NEWER))
    if whole:
        merged = both.withColumn(_HIT, F.row_number().over(pair)).where(F.col(_HIT) == 1)
    else:
        new = F.lag(F.struct(F.lit(True).alias(_HIT), *fresh)).over(pair).alias(_NEW)
        # A new row goes if the old one follows it, which has taken its columns.
        old_follows = F.lead(F.lit(True)).over(pair).alias(_HIT)
        found = both.select("*", new, old_follows).where(~F.col(_NEWER) | F.col(_HIT).isNull())
        hit = F.col(_NEW)[_HIT]
        merged = found.select(
            *(F.when(hit, F.col(_NEW)[name]).otherwise(F.col(name)).alias(name) if name in fresh else name for name in columns)
        )
    return merged.select(*columns)


def without_key(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows of both sides whose key is NULL."""
    return target.unionByName(source.select(*target.columns)).where(F.col(key).isNull())


def _replace_rows(target: DataFrame, source: DataFrame, key: str, size: BatchSize | None) -> DataFrame:
    keyless, keyed = _split_null_keys(target, key)
    keys = source.select(key).where(F.col(key).isNotNull())
    kept = keyed.join(spread_keys(keys, size), key, "left_anti")
    return kept.select(*target.columns).unionByName(keyless).unionByName(source)


def _update_columns(
    target: DataFrame, source: DataFrame, key: str, update: Sequence[str], size: BatchSize | None
) -> DataFrame:
    keyless, keyed = _split_null_keys(target, key)
    keyed_source = source.where(F.col(key).isNotNull())
    fresh = {name: f"_new_{name}" for name in update if name != key}
    patch = keyed_source.select(
        F.col(key), F.lit(True).alias(_HIT), *(F.col(name).alias(new) for name, new in fresh.items())
    )
    patched = keyed.join(spread_rows(patch, size), key, "left").select(
        *(
            F.when(F.col(_HIT), F.col(fresh[name])).otherwise(F.col(name)).alias(name)
            if name in fresh
            else F.col(name)
            for name in target.columns
        )
    )
    # Keys found in the target, at most one row each: small whenever the batch is.
    keys = spread_keys(keyed_source.select(key), size)
    found = keyed.select(key).join(keys, key, "left_semi").distinct()
    added = source.join(found, key, "left_anti").select(*target.columns)
    return patched.unionByName(keyless).unionByName(added)


def _split_null_keys(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(key).isNull()), df.where(F.col(key).isNotNull())
