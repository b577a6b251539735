"""Token-id files: flat unsigned integers, 64-bit document offsets, memory-mapped reads.

A folder holds, per shard ``k`` in ascending document id order:

- ``k.ids``: token ids, one after another, unsigned little-endian, 2 bytes
  each where the vocabulary has at most 65,536 ids, else 4;
- ``k.off``: n + 1 signed 64-bit offsets (in ids) into ``k.ids``;
- ``k.doc``: n signed 64-bit document ids (the smallest value stands for null);

and the Parquet table ``shards`` (shard, n_docs, n_tokens, base): ``base`` is
the number of ids in all earlier shards, a prefix sum over the shard table.

Defined cases: null or empty text is a document with only the end id; a null
document id sorts first; rows that share an id stand in the order of their
first 16 characters; exact repeats are kept; an empty table gives an empty ``shards`` table. Other columns
of the input are not read.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataflow.llm.common import TextBytes, mapped, open_store, partitions, put_file
from strataflow.llm.tokens import encoder
from strataflow.sources.tables import input_bytes

NULL_ID = -(1 << 63)
BATCH_BYTES = 1 << 20
SHARD_BYTES = 128 << 20


def _writer(folder: str, tokenizer: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One shard: ids go to the file as they are made; only offsets and document ids are kept until its end."""
        shard = TaskContext.get().partitionId()
        off, docs, out, enc = array("q", [0]), array("q"), None, encoder(tokenizer)
        store, path = open_store(folder)
        name = f"{path}/{shard:06d}.ids"
        private = f"{name}.{uuid.uuid4().hex}.tmp"      # renamed when it is whole, as put_file does
        end = np.array([end_id], enc.width).tobytes()
        for batch in batches:
            texts = TextBytes(batch.column(1))
            for s in texts.slices(BATCH_BYTES):
                out = out or store.open_output_stream(private)
                for ids in enc.encode(texts[s]):
                    out.write(ids + end)
                    off.append(off[-1] + len(ids) // len(end) + 1)
            docs.extend(NULL_ID if x is None else x for x in batch.column(0).to_pylist())
        if not docs:
            return
        out.close()
        store.move(private, name)
        put_file(store, f"{path}/{shard:06d}.off", np.frombuffer(off, np.int64).astype("<i8").tobytes())
        put_file(store, f"{path}/{shard:06d}.doc", np.frombuffer(docs, np.int64).astype("<i8").tobytes())
        yield pa.RecordBatch.from_pydict({"shard": [shard], "n_docs": [len(docs)], "n_tokens": [off[-1]],
                                          "width": [int(enc.width[-1])]})
    return write


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """Encode every text, append ``end_id``, write the shard files to ``folder``.

    One range shuffle by document id; each task sorts and writes one shard, as
    many as the size of the files read asks for (``SHARD_BYTES`` each). Rows that
    share an id are cut by their texts and, where these repeat, by row, so no id fills a shard.
    Files appear by rename, so lost or repeated tasks are harmless. Returns the
    ``shards`` table.
    """
    spark = docs.sparkSession
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    order = ["id", F.substring("text", 1, 16), F.xxhash64("text"), "row"]
    n = shards or max(partitions(spark), input_bytes(docs) // SHARD_BYTES)
    made = (rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order)
            .select("id", "text").mapInArrow(_writer(folder, tokenizer, end_id), "shard long, n_docs long, n_tokens long, width long"))
    # one row a shard: sizes, then bases as a prefix sum
    sizes = spark.createDataFrame(made.collect(), made.schema)
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    (sizes.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
     .write.mode("overwrite").parquet(f"{folder}/shards"))
    return spark.read.parquet(f"{folder}/shards")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per stored document: doc_id, shard, start, n_tokens, ids_crc32.

    Each task maps one shard's files; ``start`` counts the ids of all earlier
    documents, ``ids_crc32`` covers the ids as little-endian 32-bit integers.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_store(folder)
        for batch in batches:
            for shard, width, base in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids = mapped(store, f"{path}/{shard:06d}.ids", f"<u{width}")
                off = mapped(store, f"{path}/{shard:06d}.off", "<i8")
                doc = mapped(store, f"{path}/{shard:06d}.doc", "<i8")
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(doc), mask=np.array(doc == NULL_ID)), pa.array(np.full(len(doc), shard, "i8")),
                     pa.array(off[:-1] + base), pa.array(np.diff(off)), pa.array(crc, pa.int64())],
                    names=["doc_id", "shard", "start", "n_tokens", "ids_crc32"])

    shards = spark.read.parquet(f"{folder}/shards").select("shard", "width", "base")
    return (shards.repartition(partitions(spark))
            .mapInArrow(read, "doc_id long, shard long, start long, n_tokens long, ids_crc32 long"))
