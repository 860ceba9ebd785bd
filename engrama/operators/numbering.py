"""Dense row numbers and running totals that never put one key, or the table, into one task.

``row_number()`` over a whole table, or over a session holding a third of it,
runs in a single task.  Here the rows are range-partitioned on key *and* order
columns, so a hot key spreads over many partitions; the partitions are pinned
by a reliable checkpoint; each numbers its own rows; and only one small row per
(partition, key) is needed to shift the numbers into place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from engrama.session import join_null_safe, materialize

_SEGMENT, _SLOT, _LOCAL, _BEFORE = "_segment", "_slot", "_local", "_before"


def pinned_segments(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[Column | str] = ("*",)
) -> DataFrame:
    """Range-partition and sort by ``keys + order``, pin, and expose the partition as ``_segment``.

    ``keep`` are the columns to pin, so that a wide column that only orders rows is not stored.
    """
    columns = [*keys, *order]
    laid_out = materialize(df.repartitionByRange(*columns).sortWithinPartitions(*columns).select(*keep))
    # the high bits of this id are the partition, the low 33 bits the row's place in it
    slot = F.monotonically_increasing_id()
    return laid_out.withColumn(_SLOT, slot).withColumn(_SEGMENT, F.shiftright(_SLOT, 33))


def _own(segments: DataFrame) -> list[str]:
    return [c for c in segments.columns if c not in (_SEGMENT, _SLOT)]


def _shift(segments: DataFrame, keys: Sequence[str], amount: Column) -> DataFrame:
    """Sum of ``amount`` in earlier segments of the same key: one row per (segment, key)."""
    per_segment = segments.groupBy(_SEGMENT, *keys).agg(amount.alias("_amount"))
    earlier = Window.partitionBy(*keys).orderBy(_SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    return per_segment.select(
        _SEGMENT, *keys, F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias(_BEFORE)
    )


def dense_number(
    df: DataFrame, order: Sequence[str], keys: Sequence[str] = (), name: str = "row_index"
) -> DataFrame:
    """Add a 0-based number in ``order``, restarting per ``keys``; give a unique order for stable numbers."""
    return number_segments(pinned_segments(df, keys, order), keys, name)


def number_segments(segments: DataFrame, keys: Sequence[str] = (), name: str = "row_index") -> DataFrame:
    """``dense_number`` over rows already pinned by ``pinned_segments``, which are numbered as they lie."""
    if keys:
        first_slot = segments.groupBy(_SEGMENT, *keys).agg(
            F.min(_SLOT).alias("_first"), F.count(F.lit(1)).alias("_rows")
        )
        earlier = Window.partitionBy(*keys).orderBy(_SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
        shift = first_slot.select(
            _SEGMENT, *keys, "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(_BEFORE)
        )
        numbered = join_null_safe(segments, shift, [_SEGMENT, *keys]).withColumn(
            name, F.col(_SLOT) - F.col("_first") + F.col(_BEFORE)
        )
    else:
        # at most one row per partition, so this side is small by construction
        per_segment = segments.groupBy(_SEGMENT).agg(F.count(F.lit(1)).alias("_rows"))
        earlier = Window.orderBy(_SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
        shift = per_segment.select(
            _SEGMENT, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(_BEFORE)
        )
        low_bits = F.col(_SLOT) - F.shiftleft(F.col(_SEGMENT), 33)
        numbered = segments.join(F.broadcast(shift), _SEGMENT).withColumn(name, low_bits + F.col(_BEFORE))
    return numbered.select(*_own(segments), F.col(name).cast("bigint").alias(name))


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str = "running_total"
) -> DataFrame:
    """Inclusive running sum of ``value`` per ``keys`` in ``order``."""
    return total_segments(pinned_segments(df, keys, order), keys, value, name)


def total_segments(segments: DataFrame, keys: Sequence[str], value: str, name: str = "running_total") -> DataFrame:
    """``running_total`` over rows already pinned by ``pinned_segments``."""
    shift = _shift(segments, keys, F.sum(value))
    inside = (
        Window.partitionBy(_SEGMENT, *keys).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, 0)
    )
    local = segments.withColumn(_LOCAL, F.sum(value).over(inside))
    return join_null_safe(local, shift, [_SEGMENT, *keys]).select(
        *_own(segments), (F.col(_LOCAL) + F.col(_BEFORE)).alias(name)
    )


def batch_of(row_index: Column, batch_size: int, limit: int) -> Column:
    """Number of the consecutive batch a dense row index falls into."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    return F.floor(row_index / F.lit(min(batch_size, limit))).cast("bigint")
