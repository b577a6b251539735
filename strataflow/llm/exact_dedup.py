"""Exact duplicates by content-defined chunk recipes.

Each text is cut where a rolling hash of its last 32 bytes says so, hence equal
texts are cut alike. A chunk is named by a 128-bit digest, a text by its recipe:
the ordered list of its chunks' names. Texts with different recipes differ, so
only the chunks of texts whose recipe another row may share are compared: all
contents of a name byte by byte, in the task with those it remembers (an equal
one does not move again), and after a shuffle over all tasks. A name that
stood for two contents would fail the check, and the whole job would be done
again with another digest seed; so the lists that are compared in the end hold
verified identifiers, and no text moves for a comparison.

Which recipes may be shared is a bitmap of fixed size (``MARK_BITS``, 8 MB) over
hashes of recipes: a bit that is set by chance costs movement, never a result.

Defined cases: null counts as empty text; empty texts are equal; of equal texts
the row with the largest id stays, a null id ranks below all others, and of rows
that repeat an id and a text exactly one stays; an empty table gives no rows.
Ids are cast to long. Other columns are not read. A long text is cut in windows of 4 MB,
so memory does not follow the square or a multiple of its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.common import TextBytes, mix64, stored

#: Chunks are of 256 to 8192 bytes; beyond the least size, one byte in 1024 ends a chunk.
SHORTEST, LONGEST, CUT_BITS = 256, 8192, 10
WINDOW = 1 << 22
MARK_BITS = 26
#: Bytes of the sent chunks that a task remembers, with what an entry takes besides; beyond that it may send a chunk again.
REMEMBERED, ENTRY_BYTES = 1 << 26, 256

_gear = (mix64(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)

Digest = Callable[[bytes, int], bytes]


def digest128(chunk: bytes, seed: int) -> bytes:
    import xxhash
    return xxhash.xxh3_128_digest(chunk, seed)


def _candidates(data: np.ndarray) -> np.ndarray:
    """Positions of the bytes that may end a chunk: the rolling hash of the 32 bytes up to there starts with zeros."""
    found = [np.empty(0, np.int64)]
    for start in range(0, len(data), WINDOW):
        first = max(0, start - 31)
        h = _gear[data[first:start + WINDOW]]
        for k in (1, 2, 4, 8, 16):      # the hash of 2k bytes from two hashes of k bytes
            longer = h.copy()
            longer[k:] += h[:-k] << np.uint32(k)
            h = longer
        at = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + first
        found.append(at[at >= start])
    return np.concatenate(found)


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[list[int]]:
    """Per text ``data[start:end]`` the ends of its chunks; they depend on the text alone."""
    candidates = _candidates(data)
    low = np.searchsorted(candidates, starts + (SHORTEST - 1))     # from there on the hash sees this text only
    high = np.searchsorted(candidates, ends)
    for a, b, i, j in zip(starts.tolist(), ends.tolist(), low.tolist(), high.tolist()):
        cuts, last = [], a
        for e in candidates[i:j].tolist() if j > i else ():
            e += 1
            while e - last > LONGEST:
                last += LONGEST
                cuts.append(last)
            if e - last >= SHORTEST:
                cuts.append(e)
                last = e
        while b - last > LONGEST:
            last += LONGEST
            cuts.append(last)
        if b > last:
            cuts.append(b)
        yield cuts


def _recipes(batch: pa.RecordBatch, column: int, seed: int, digest: Digest) -> Iterator[tuple[bytes, bytes, list[int]]]:
    """(text, recipe, chunk ends within the text) of every row of a batch."""
    texts = TextBytes(batch.column(column))
    for rows in texts.slices(WINDOW):
        several = texts[rows]
        sizes = texts.sizes[rows]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        data = np.frombuffer(b"".join(several), np.uint8)
        for text, start, cuts in zip(several, starts.tolist(), cut(data, starts, ends)):
            cuts = [c - start for c in cuts]
            yield text, b"".join(digest(text[a:b], seed) for a, b in zip([0, *cuts], cuts)), cuts


def _mark(recipe: bytes) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(recipe, 1) >> 1


def _name_rows(seed: int, digest: Digest):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            recipes, marks, shas = [], [], []
            for text, recipe, _ in _recipes(batch, 1, seed, digest):
                recipes.append(recipe)
                marks.append(_mark(recipe))
                shas.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shas, pa.string()), pa.array(marks, pa.int64()),
                                              pa.array(recipes, pa.binary())], names=["id", "sha", "mark", "recipe"])
    return run


def _send_chunks(seed: int, digest: Digest, shared):
    """(name, data) of the chunks of texts whose recipe's bit is set. A chunk is left out only after its bytes
    were compared with those that this task sent under its name; other bytes of the name are sent, too."""
    width = len(digest(b"", seed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        sent: dict[bytes, bytes] = {}
        held = 0
        for batch in batches:
            names, data, size = [], [], 0
            for text, recipe, cuts in _recipes(batch, 0, seed, digest):
                m = _mark(recipe) & ((1 << MARK_BITS) - 1)
                if not bits[m >> 3] >> (m & 7) & 1:
                    continue
                for i, (a, b) in enumerate(zip([0, *cuts], cuts)):
                    name, chunk = recipe[i * width:(i + 1) * width], text[a:b]
                    if sent.get(name) == chunk:
                        continue
                    if name not in sent:
                        if held >= REMEMBERED:
                            sent.clear()
                            held = 0
                        sent[name] = chunk
                        held += len(chunk) + ENTRY_BYTES
                    names.append(name)
                    data.append(chunk)
                    size += b - a
                if size > WINDOW:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(data, pa.binary())], names=["name", "data"])
                    names, data, size = [], [], 0
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(data, pa.binary())], names=["name", "data"])
    return run


def _shared_marks(spark: SparkSession, named: DataFrame):
    """The bitmap of marks that more than one row has: at most 2**MARK_BITS bits, whatever the input's size."""
    slot = F.col("mark").bitwiseAND((1 << MARK_BITS) - 1)
    pieces = (named.groupBy("mark").count().where("count > 1")
              .select(F.shiftright(slot, 15).alias("piece"), slot.bitwiseAND((1 << 15) - 1).alias("bit"))
              .groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    bits = bytearray(1 << (MARK_BITS - 3))
    for p in pieces:
        bits[p["piece"] << 12:(p["piece"] + 1) << 12] = p["bits"]
    return spark.sparkContext.broadcast(bytes(bits)), bool(pieces)


class UnverifiedChunks(RuntimeError):
    """No digest seed told all different chunks apart."""


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Digest = digest128, seeds: int = 3) -> DataFrame:
    """(row, id, sha, mark, recipe) of every row, stored; equal recipes are equal texts, checked byte by byte."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    for seed in range(seeds):
        named = stored(rows.mapInArrow(_name_rows(seed, digest), "id long, sha string, mark long, recipe binary")
                       .withColumn("row", F.monotonically_increasing_id()), "chunk_recipes")
        shared, some = _shared_marks(spark, named)
        if not some:
            return named
        chunks = rows.select("text").mapInArrow(_send_chunks(seed, digest, shared), "name binary, data binary")
        contents = chunks.groupBy("name").agg(F.min("data").alias("low"), F.max("data").alias("high"))
        if contents.where("low <> high").limit(1).count() == 0:
            return named
    raise UnverifiedChunks(f"different chunks share a name under each of {seeds} digest seeds")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Digest = digest128) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Groups are counted by partial aggregates; only groups of two or more rows
    are joined back, and Spark's skew join cuts the rows of a hot one.
    """
    named = recipes(docs, id_col, text_col, digest)
    rank = F.coalesce("id", F.lit(-(1 << 63)))
    groups = (named.groupBy("mark", "recipe").agg(F.max("id").alias("keep_id"), F.max_by("row", rank).alias("keep_row"), F.count("*").alias("n"))
              .where("n > 1"))
    out = named.join(groups, ["mark", "recipe"], "left")
    alone = F.col("n").isNull()
    return out.select(F.col("id").alias("doc_id"), F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
                      F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
                      F.col("sha").alias("text_sha256"))

