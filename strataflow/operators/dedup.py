"""Dedup on a natural key.

``latest_wins`` keeps, per key, the row with the greatest ``order_cols`` and
breaks remaining ties on every other column, so the result never depends on
partitioning or task order. It is written as ``max(struct(...))`` in a plain
group-by instead of ``row_number()`` over a window: the aggregate is partial
(map-side), so a key holding a large share of all rows is collapsed to one row
per input task before the shuffle and never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_wins(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str] = (),
                tie_cols: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per ``keys``: greatest ``order_cols``, then greatest
    ``tie_cols`` (default: all remaining columns in schema order). Nulls rank
    below every value."""
    keys, order_cols = list(keys), list(order_cols)
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    if tie_cols is None:
        tie_cols = rest
    ranked = list(order_cols) + list(tie_cols) + [c for c in rest if c not in tie_cols]
    if not ranked:
        return df.select(*keys).distinct()
    packed = F.max(F.struct(*[F.col(c).alias(c) for c in ranked])).alias("_latest")
    out = df.groupBy(*keys).agg(packed)
    return out.select(*[F.col(c) for c in keys], *[F.col("_latest").getField(c).alias(c) for c in ranked]) \
              .select(*df.columns)
