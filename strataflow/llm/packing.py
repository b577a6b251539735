"""Best-fit packing of documents into training sequences under several limits.

A piece of ``L`` tokens needs (L tokens, 1 document, L*L attention cost). All
three follow from ``L``, so best fit needs only the *histogram* of lengths: at
most ``capacity`` rows however large the corpus. The driver runs best-fit
decreasing over that histogram, handling all pieces of one length and all open
sequences of one residual state at once, and gets a table of runs ("ranks lo to
hi of length L go, k each, to sequences from s on, at offset o"). Spark then
ranks the pieces of each length (in salted buckets plus prefix sums, so a length
that a third of all pieces share is still many tasks) and joins the runs.

Defined cases: null text counts as empty; repeated rows are packed as often as
they come; lengths tie by a stored row number; an empty table gives no rows.
Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataflow.llm.common import TextBytes, partitions, stored
from strataflow.llm.tokens import encoder

BATCH_BYTES = 1 << 20
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
RUN = "length long, lo long, hi long, first long, per long, at long"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int,
               id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pieces of every document: its ids, then ``end_id``, cut every ``capacity`` ids only if longer.

    Returns doc_id, piece, start, length, ids_crc32 and, if asked, ids (array of int).
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), TextBytes(batch.column(1))
            for s in texts.slices(BATCH_BYTES):
                rows = []
                for name, ids in zip(names[s], enc.encode(texts[s])):
                    ids = np.frombuffer(ids, enc.width).astype("<u4").tobytes() + end
                    for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[a:a + 4 * capacity]
                        row = (name, k, a // 4, len(part) // 4, zlib.crc32(part))
                        rows.append((*row, np.frombuffer(part, "<u4").astype("i4")) if keep_ids else row)
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(rows[0])])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(cut, PIECE + (", ids array<int>" if keep_ids else "")))


def best_fit_runs(histogram: list[tuple[int, int]], capacity: int, max_docs: int, max_cost: int,
                  weights: tuple[float, float, float] = (1.0, 0.05, 0.05), rule: str = "norm") -> list[tuple]:
    """Best-fit decreasing over (length, count) rows; returns rows of ``RUN``.

    Open sequences with equal residuals (tokens, documents, cost) and adjacent
    numbers form one group. For the next length, the feasible group with the
    least weighted residual norm after placement (``norm``) or the least
    weighted dot product of residual and need (``dot``) takes as many pieces as
    every limit allows; only if no group is feasible do new sequences open.
    """
    caps, w = np.array([capacity, max_docs, max_cost], float), np.array(weights)
    left = np.empty((0, 3), np.int64)      # residuals of each group
    count = np.empty(0, np.int64)          # its sequences
    first = np.empty(0, np.int64)          # number of its first sequence
    runs, made = [], 0
    for length, n in sorted(histogram, reverse=True):
        need = np.array([length, 1, length * length], np.int64)
        if length > capacity or max_docs < 1 or need[2] > max_cost:
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        rank = 0
        while n:
            fits = np.flatnonzero((left >= need).all(axis=1) & (count > 0))
            if len(fits):
                if rule == "norm":
                    score = (w * ((left[fits] - need) / caps) ** 2).sum(axis=1)
                else:
                    score = (w * (left[fits] / caps) * (need / caps)).sum(axis=1)
                g = fits[np.argmin(score)]
                state, room, base = left[g].copy(), int(count[g]), int(first[g])
            else:
                g, state, room, base = None, caps.astype(np.int64), n, made
            per = int(min(q for q in (s // d for s, d in zip(state.tolist(), need.tolist()) if d)))
            full = min(n // per, room)
            rest = min(n - full * per, per - 1) if full < room else 0
            used = full + (rest > 0)
            took = full * per + rest
            runs.append((length, rank, rank + took, base, per, int(capacity - state[0])))
            new = [(state - need * per, full, base)] * (full > 0) + [(state - need * rest, 1, base + full)] * (rest > 0)
            if g is None:
                made += used
            else:
                first[g] += used
                count[g] -= used
            left = np.concatenate([left, np.array([x[0] for x in new], np.int64).reshape(-1, 3)])
            count = np.append(count, [x[1] for x in new])
            first = np.append(first, [x[2] for x in new])
            n, rank = n - took, rank + took
        alive = (count > 0) & (left[:, 0] > 0) & (left[:, 1] > 0)
        left, count, first = left[alive], count[alive], first[alive]
    return runs


def pack(pieces: DataFrame, capacity: int, max_docs: int | None = None, max_cost: int | None = None,
         weights: tuple[float, float, float] = (1.0, 0.05, 0.05), rule: str = "norm") -> DataFrame:
    """Add sequence_id and offset to every piece (which has a ``length`` of 1 to ``capacity``).

    ``max_docs`` and ``max_cost`` (sum of squared lengths) bound a sequence
    besides its tokens; left out, they are what ``capacity`` implies.
    """
    spark = pieces.sparkSession
    keep = pieces.columns
    rows = stored(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    # one row per length, at most `capacity` of them
    histogram = [tuple(r) for r in rows.groupBy("length").count().collect()]
    runs = best_fit_runs(histogram, capacity, max_docs or capacity, max_cost or capacity * capacity, weights, rule)
    total, tasks = sum(n for _, n in histogram), partitions(spark)
    salts = spark.createDataFrame([(ln, max(1, -(-n * 4 * tasks // total))) for ln, n in histogram] or [(0, 1)],
                                  "length long, _salts long")
    salted = (rows.join(F.broadcast(salts), "length")
              .withColumn("_salt", F.pmod(F.xxhash64("_row"), "_salts")))
    size = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)
    base = size.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    ranked = (salted.withColumn("_rank", F.row_number().over(W.partitionBy("length", "_salt").orderBy("_row")) - 1)
              .join(base, ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_base")))
    plan = spark.createDataFrame(runs or [(0, 0, 0, 0, 1, 0)], RUN).withColumnRenamed("length", "_length")
    j = F.col("_rank") - F.col("lo")
    return (ranked.join(F.broadcast(plan), (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("lo"))
                        & (F.col("_rank") < F.col("hi")))
            .select(*keep, (F.col("first") + F.floor(j / F.col("per"))).cast("long").alias("sequence_id"),
                    (F.col("at") + (j % F.col("per")) * F.col("length")).cast("long").alias("offset")))
