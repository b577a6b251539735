"""Shared helpers: shared-folder tables, task-side file access, connected components."""

from __future__ import annotations

import gc
import os
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import scratch_path



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Used where a result is read more than once: the rows are fixed, lineage is
    cut, and a lost executor costs nothing that was already written.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Drop ``stored`` tables that are no longer needed, and the shuffle files of finished steps.

    Spark removes shuffle files once the plans that made them are garbage; a
    long job that waits for that keeps all of them on disk at once.
    """
    jvm = spark.sparkContext._jvm
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    for _ in range(2):          # Python's handles first, then the plans they held, then Spark's cleaner
        gc.collect()
        time.sleep(0.2)
        jvm.System.gc()


def ship(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package (as ``spark-submit --py-files`` does), once per session."""
    import io
    import tempfile
    import zipfile
    from pathlib import Path

    import strataflow
    sc = spark.sparkContext
    if not getattr(sc, "_strataflow_shipped", False):
        root, data = Path(strataflow.__file__).parent, io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        path = Path(tempfile.mkdtemp(prefix="strataflow-package-")) / "strataflow_package.zip"   # the driver hands it out
        path.write_bytes(data.getvalue())
        sc.addPyFile(str(path))
        sc._strataflow_shipped = True
    return spark


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % divisor


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def open_store(uri: str):
    """(filesystem, path) of a folder or file that every node can reach."""
    from pyarrow import fs
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri[len("file:"):]
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def put_file(store, path: str, data) -> None:
    """Write under a private name, then rename: a retried or speculative task never leaves half a file."""
    temp = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(temp) as out:
        for part in data if isinstance(data, (list, tuple)) else [data]:
            out.write(part)
    store.move(temp, path)


def mapped(store, path: str, dtype: str) -> np.ndarray:
    """The file as an array: memory-mapped where the store is a mounted folder, else read."""
    from pyarrow import fs
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.empty(0, dtype)
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


class TextBytes:
    """UTF-8 bytes of a string column (null counts as empty), copied only as they are asked for."""

    def __init__(self, column: pa.Array) -> None:
        column = column.cast(pa.large_string())
        _, at, data = column.buffers()
        first, n = column.offset, len(column)
        self.at = np.frombuffer(at, np.int64)[first:first + n + 1] if n else np.zeros(1, np.int64)
        self.data = memoryview(data) if data else memoryview(b"")
        self.sizes = np.diff(self.at)
        if column.null_count:
            self.sizes = np.where(np.array(column.is_null()), 0, self.sizes)

    def __len__(self) -> int:
        return len(self.sizes)

    def __getitem__(self, s: slice) -> list[bytes]:
        return [bytes(self.data[a:a + n]) for a, n in zip(self.at[s].tolist(), self.sizes[s].tolist())]

    def __iter__(self) -> Iterator[bytes]:
        for i in range(len(self)):
            yield self[i:i + 1][0]

    def slices(self, most: int) -> Iterator[slice]:
        """Consecutive rows of about ``most`` bytes, at least one row each."""
        start = total = 0
        for i, n in enumerate(self.sizes.tolist()):
            if total and total + n > most:
                yield slice(start, i)
                start, total = i, 0
            total += n
        if start < len(self):
            yield slice(start, len(self))


#: Edges to a file of a components round; few edges make few files.
EDGES_A_FILE = 250_000


def connected(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge list (a long, b long).

    Returns (node, root) for every node that has an edge; root is the smallest
    node of its component. Alternating large-star and small-star rounds: each
    one replaces edges by edges to the smallest neighbour, so a component
    becomes a star in a logarithmic number of rounds. Every step is a grouped
    minimum (partial aggregate) and an equi-join that AQE can split when a
    centre is hot. Each round is stored in the shared folder.
    """
    def summary(t: DataFrame) -> tuple:
        return tuple(t.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    e = stored(edges.where(F.col("a") != F.col("b"))
               .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = summary(e)
    files = max(1, -(-before[0] // EDGES_A_FILE))       # a round never has more edges than the one before
    for _ in range(most_rounds):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select("b", "a"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(low, "u")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_low, "a")
        nxt = (small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
               .unionAll(small_low.select("a", F.col("m").alias("b"))).distinct())
        e = stored(nxt.coalesce(files) if files < partitions(e.sparkSession) else nxt, name)
        after = summary(e)
        if after == before:
            top = e.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return top.unionAll(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = after
    raise RuntimeError(f"{name}: components did not settle in {most_rounds} rounds")


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member of the group of each of 0..n-1, under the links (a[i], b[i])."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64, kept per process."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), base, np.uint64)
        step[0] = 1
        have = _powers[base] = np.multiply.accumulate(step)
    return have[:n]


def hash_words(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit hash of each space-separated word in a byte array.

    A polynomial hash from one running sum (differences of prefix sums, scaled
    back by the inverse power), then mixed with the word's length.
    """
    base = 0x9E3779B97F4A7C15
    space = _SPACE[text]
    starts = np.flatnonzero(~space & np.append(True, space[:-1])) if len(text) else np.empty(0, np.int64)
    ends = np.flatnonzero(~space & np.append(space[1:], True)) + 1 if len(text) else np.empty(0, np.int64)
    total = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _powers_of(base, len(text)), out=total[1:])
    inverse = _powers_of(pow(base, -1, 1 << 64), len(text))
    h = (total[ends] - total[starts]) * inverse[starts]
    return starts, ends, mix64(h ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))
