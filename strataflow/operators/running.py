"""Running (cumulative) aggregates that stay parallel under key skew.

``avg/count over (partition by k order by o rows between unbounded preceding
and current row)`` sends every row of a key to one task. Here the rows are
range-partitioned on ``(k, o)`` instead, so a key that holds a large share of
the data is cut into several contiguous chunks, and the cumulative value is
assembled as a parallel prefix sum:

1. range-partition on ``(k, o)`` and write the rows once, each with its chunk
   id, as a table bucketed by that id in the shared scratch folder. This is the
   only exchange of rows: whatever is grouped by the chunk reads its bucket;
2. per (chunk, k): totals, and per k the totals of its earlier chunks. Chunks
   are contiguous, so at most the first key of a chunk began earlier: at most
   one offset a chunk is left, few enough to broadcast by construction;
3. per (chunk, k): local running values (a window bounded by one chunk) plus
   that offset.

``o`` must order rows of a key totally (append a unique column as tie-break).
A null key is a key like any other.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.session import scratch_path
from strataflow.sources.tables import input_bytes

CHUNK = "_chunk"
CHUNK_BYTES = 128 << 20


def _chunks_for(df: DataFrame) -> int:
    """Chunks by the size of the files that are read, so a hot key's chunks stay bounded as it grows."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), input_bytes(df) // CHUNK_BYTES)


def _stored_by_chunk(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """``df`` in ``n`` ranges of ``keys``, written once and read back with Spark knowing that a chunk lies in one bucket."""
    spark = df.sparkSession
    name = f"running_{uuid.uuid4().hex}"
    (df.repartitionByRange(n, *keys).withColumn(CHUNK, F.spark_partition_id())
       .write.bucketBy(n, CHUNK).option("path", scratch_path(spark, "running_totals")).saveAsTable(name))
    rows = spark.table(name)
    spark.sql(f"drop table {name}")         # the name only: the files are the scratch folder's, and the plan knows them
    return rows


def running_totals(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[str],
                   sums: Mapping[str, str] | None = None, counts: Mapping[str, str] | None = None,
                   num_chunks: int | None = None, lasts: Mapping[str, str] | None = None) -> DataFrame:
    """Add cumulative ``sum(col)`` (as ``sums`` alias -> column), ``count(col)``
    (as ``counts`` alias -> column, nulls not counted) and the latest value that is not
    null (as ``lasts`` alias -> column) to every row.

    A prefix holding only nulls sums to 0; divide by the matching count (0 ->
    null under SQL division semantics) to get a running average."""
    sums, counts, lasts = dict(sums or {}), dict(counts or {}), dict(lasts or {})
    parts, order, names = list(partition_cols), list(order_cols), list(sums) + list(counts)
    ranged = _stored_by_chunk(df, [*parts, *order], num_chunks or _chunks_for(df))

    totals = ranged.groupBy(CHUNK, *parts).agg(*[F.sum(c).alias(f"_t_{a}") for a, c in sums.items()],
                                               *[F.count(c).alias(f"_t_{a}") for a, c in counts.items()],
                                               *[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"_t_{a}")
                                                 for a, c in lasts.items()])
    by_chunk = Window.partitionBy(*parts).orderBy(CHUNK)
    earlier = by_chunk.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (totals.select(F.col(CHUNK).alias("_c"), *[F.col(p).alias(f"_k{i}") for i, p in enumerate(parts)],
                             F.row_number().over(by_chunk).alias("_place"),
                             *[F.coalesce(F.sum(f"_t_{a}").over(earlier), F.lit(0)).alias(f"_o_{a}") for a in names],
                             *[F.last(f"_t_{a}", ignorenulls=True).over(earlier).alias(f"_o_{a}") for a in lasts])
               .filter("_place > 1").drop("_place"))

    upto = Window.partitionBy(CHUNK, *parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", *[F.sum(c).over(upto).alias(f"_l_{a}") for a, c in sums.items()],
                          *[F.count(c).over(upto).alias(f"_l_{a}") for a, c in counts.items()],
                          *[F.last(c, ignorenulls=True).over(upto).alias(f"_l_{a}") for a, c in lasts.items()])
    same = reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_k{i}")) for i, p in enumerate(parts)], F.col(CHUNK) == F.col("_c"))
    joined = local.join(F.broadcast(offsets), same, "left")     # at most one row a chunk
    return joined.select(*df.columns, *[
        (F.coalesce(F.col(f"_l_{a}"), F.lit(0)) + F.coalesce(F.col(f"_o_{a}"), F.lit(0))).alias(a) for a in names],
        *[F.coalesce(F.col(f"_l_{a}"), F.col(f"_o_{a}")).alias(a) for a in lasts])
