"""Table IO: partitioned idempotent writes, schema guard, verified writes,
append-only logs, snapshot reads and retention lists.

Parquet stands in for a transactional table format (none is on the class
path); the format is a parameter everywhere.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class SchemaMismatch(RuntimeError):
    """The frame to write does not match the stored table's schema."""


# ── filesystem helpers (Hadoop FileSystem through the session) ──────────────

def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def restore_path(spark: SparkSession, path: str) -> bool:
    """Put back the old content of a table whose replacement stopped between its two renames."""
    fs, p = _fs_path(spark, path)
    _, aside = _fs_path(spark, path.rstrip("/") + "__old")
    return bool(not fs.exists(p) and fs.exists(aside) and fs.rename(aside, p))


def replace_path(spark: SparkSession, staged: str, path: str) -> None:
    """Put a staged folder in the place of ``path`` (two renames; the old content goes last).

    Between the renames there is no table at the path. A run that stops just there leaves the old content
    beside it, and ``restore_path``, which the jobs call before they read or replace a table, puts it back.
    """
    restore_path(spark, path)
    fs, old = _fs_path(spark, path)
    _, new = _fs_path(spark, staged)
    _, aside = _fs_path(spark, path.rstrip("/") + "__old")
    fs.delete(aside, True)
    if fs.exists(old) and not fs.rename(old, aside):
        raise RuntimeError(f"cannot move {path} aside")
    if not fs.rename(new, old):
        fs.rename(aside, old)
        raise RuntimeError(f"cannot move {staged} to {path}")
    fs.delete(aside, True)


def input_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` reads (0 for inputs that are no files)."""
    spark, folders = df.sparkSession, {}
    for name in df.inputFiles():
        folder, _, leaf = name.rpartition("/")
        folders.setdefault(folder, set()).add(unquote(leaf))
    total = 0
    for folder, leaves in folders.items():
        fs, p = _fs_path(spark, unquote(folder))
        total += sum(st.getLen() for st in fs.listStatus(p) if st.getPath().getName() in leaves)
    return total


def measured_bytes(df: DataFrame) -> int:
    """An upper bound of ``df``'s in-memory size from a measurement: the row
    count times the fixed row width (null-bit word + 8 bytes a field) plus the
    summed lengths of its string columns. Costs one aggregate over ``df``."""
    from pyspark.sql.types import BinaryType, StringType
    var = [f.name for f in df.schema.fields if isinstance(f.dataType, (StringType, BinaryType))]
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.sum(F.octet_length(c)).alias(f"_v{i}") for i, c in enumerate(var)]
    row = df.agg(*aggs).first()
    n = int(row["_n"] or 0)
    var_bytes = sum(int(row[f"_v{i}"] or 0) for i in range(len(var)))
    return n * (8 + 8 * len(df.schema.fields)) + var_bytes


def broadcast_limit(spark: SparkSession) -> int:
    """The session's runtime (measured-size) broadcast limit in bytes."""
    raw = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) or \
        spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB")
    raw = str(raw).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for u in sorted(units, key=len, reverse=True):
        if raw.endswith(u):
            return int(float(raw[: -len(u)]) * units[u])
    return int(raw)


NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_dir(path: str, values: dict) -> str:
    """The folder of one partition, named as Spark names it (null and special characters included)."""
    return path.rstrip("/") + "/" + "/".join(f"{_escape(k)}={_escape(_text(v))}" for k, v in values.items())


def _text(value) -> str:
    if value is None or value == "":
        return NULL_PARTITION
    return str(value).lower() if isinstance(value, bool) else str(value)


def _escape(name: str) -> str:
    # Characters that Spark percent-encodes in partition folder names.
    special = set('"#%\'*/:=?\\\x7f{[]^') | {chr(c) for c in range(1, 32)}
    return "".join(f"%{ord(c):02X}" if c in special else c for c in name)


def partition_values(spark: SparkSession, path: str, part_col: str) -> list[str | None]:
    """Values of the leading partition column, from the folder names (no rows are read)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    raw = [n.partition("=")[2] for n in names if n.startswith(part_col + "=")]
    return [None if v == NULL_PARTITION else unquote(v) for v in raw]


# ── table schema that grows by columns ──────────────────────────────────────

SCHEMA_FILE = "_schema.json"


def write_json_file(spark: SparkSession, name: str, content: dict) -> None:
    """A small file beside a table (readers skip names that start with '_')."""
    fs, p = _fs_path(spark, name)
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()


def read_json_file(spark: SparkSession, name: str) -> dict | None:
    fs, p = _fs_path(spark, name)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def save_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    """Record the table's full schema beside its partitions."""
    write_json_file(spark, path.rstrip("/") + "/" + SCHEMA_FILE, schema.jsonValue())


def stored_schema(spark: SparkSession, path: str, fmt: str = "parquet") -> StructType | None:
    """The recorded schema; without a record what the format infers; None without a table."""
    if not path_exists(spark, path):
        return None
    recorded = read_json_file(spark, path.rstrip("/") + "/" + SCHEMA_FILE)
    return StructType.fromJson(recorded) if recorded else spark.read.format(fmt).load(path).schema


def load_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The table with its recorded schema: partitions older than a column hold null in it."""
    recorded = read_json_file(spark, path.rstrip("/") + "/" + SCHEMA_FILE)
    reader = spark.read.schema(StructType.fromJson(recorded)) if recorded else spark.read
    return reader.format(fmt).load(path)


def grow_schema(df: DataFrame, stored: StructType | None) -> tuple[DataFrame, list[str]]:
    """``df`` with every stored column (null where it lacks one), and its new columns' names.

    A column that changed its type raises ``SchemaMismatch``; a new one is kept.
    """
    if stored is None:
        return df, []
    have = {f.name: f.dataType for f in df.schema.fields}
    changed = sorted(f.name for f in stored.fields if f.name in have and have[f.name] != f.dataType)
    if changed:
        raise SchemaMismatch(f"schema changed: type={changed}")
    known = {f.name for f in stored.fields}
    missing = {f.name: F.lit(None).cast(f.dataType) for f in stored.fields if f.name not in have}
    new = [c for c in df.columns if c not in known]
    return df.withColumns(missing).select(*[f.name for f in stored.fields], *new) if missing or new else df, new


# ── writes ─────────────────────────────────────────────────────────────────

#: Ranges per column in a Z-order (2**bits), and the rows whose values choose them.
ZORDER_BITS, ZORDER_SAMPLE = 6, 20_000


def range_cuts(df: DataFrame, cols: Sequence[str], bits: int = ZORDER_BITS, sample: int = ZORDER_SAMPLE) -> dict[str, list]:
    """Per column, up to 2**bits - 1 values that cut its rows into even ranges (from a sample of bounded size)."""
    rows = df.select(*cols).orderBy(F.rand(7)).limit(sample).collect()
    cuts = {}
    for c in cols:
        values = sorted(r[c] for r in rows if r[c] is not None)
        cuts[c] = sorted({values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)}) if values else []
    return cuts


def _range_rank(c: str, cuts: Sequence) -> Column:
    """Number of cuts up to the value (nulls: 0), by halving."""
    def among(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(c) < F.lit(cuts[mid]), among(lo, mid)).otherwise(among(mid + 1, hi))
    return F.when(F.col(c).isNull(), F.lit(0)).otherwise(among(0, len(cuts)))


def zorder_value(cuts: dict[str, list], bits: int = ZORDER_BITS) -> Column:
    """Position on the Z curve: the bits of the columns' range ranks, interleaved, highest first."""
    z = F.lit(0).cast("long")
    for j, (c, values) in enumerate(reversed(cuts.items())):
        rank = _range_rank(c, values).cast("long")
        for i in range(bits):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(rank, i).bitwiseAND(F.lit(1)), i * len(cuts) + j))
    return z


def clustered(df: DataFrame, partition_cols: Sequence[str] = (), cluster_cols: Sequence[str] = (),
              num_partitions: int | None = None, zorder: bool = False) -> DataFrame:
    """Bring the rows of a table partition together before a write.

    With cluster columns: a range partitioning on (partition columns, cluster
    columns) and a sort inside each task. A partition that holds a large share
    of the rows is split over several tasks, and row groups come out sorted, so
    parquet min/max statistics skip row groups on point lookups of the first
    column. With ``zorder``, rows go along a Z curve through the columns' ranges
    instead: every row group covers a small box, so a filter on ANY of the
    cluster columns skips row groups.

    Without: a rebalance on the partition columns. Spark cuts every partition
    beyond the advisory size into several write tasks, so one hot day, month or
    "current" partition is never one task.
    """
    keys = list(partition_cols) + list(cluster_cols)
    if not keys:
        return df
    if not cluster_cols and not num_partitions:
        return df.hint("rebalance", *partition_cols)
    if zorder and len(cluster_cols) > 1:
        curve = "_zorder"
        df = df.withColumn(curve, zorder_value(range_cuts(df, cluster_cols)))
        keys = [*partition_cols, curve, *cluster_cols]
    # Without an explicit count AQE sizes the write tasks from the measured
    # shuffle (spark.sql.adaptive.advisoryPartitionSizeInBytes ~ file size).
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys).select(*[c for c in df.columns if c != "_zorder"])


def check_schema(df: DataFrame, expected: StructType, ignore: Sequence[str] = ()) -> None:
    """Raise ``SchemaMismatch`` when names or types differ (nullability ignored)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name not in ignore}
    want = {f.name: f.dataType.simpleString() for f in expected.fields if f.name not in ignore}
    if have != want:
        extra = sorted(set(have) - set(want))
        missing = sorted(set(want) - set(have))
        changed = sorted(c for c in set(have) & set(want) if have[c] != want[c])
        raise SchemaMismatch(f"schema changed: new={extra} missing={missing} type={changed}")


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str], fmt: str = "parquet",
                      guard: bool = True, cluster_cols: Sequence[str] = (), rebalance: bool = True,
                      finish: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Overwrite only the partitions present in ``df`` (dynamic overwrite),
    after checking the stored schema; returns the number of rows written
    (counted during the write by an ``Observation``, no extra pass).

    Without ``rebalance``, each task writes the rows it has: for few partitions
    whose rows already lie in even tasks, which saves a shuffle of all of them.
    ``finish``: as for ``write_table``."""
    spark = df.sparkSession
    if guard and path_exists(spark, path):
        check_schema(df, spark.read.format(fmt).load(path).schema)
    obs = Observation("write")
    laid_out = clustered(df, partition_cols, cluster_cols) if rebalance or cluster_cols else df
    out = (finish(laid_out) if finish else laid_out).observe(obs, F.count(F.lit(1)).alias("rows"))
    (out.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols).save(path))
    return int(obs.get["rows"])


def write_partitions_observed(df: DataFrame, path: str, partition_cols: Sequence[str],
                              fmt: str = "parquet", cluster_cols: Sequence[str] = (), rebalance: bool = True,
                              finish: Callable[[DataFrame], DataFrame] | None = None) -> tuple[int, set]:
    """Dynamic-overwrite write that also reports which partitions it wrote.

    The partition set is gathered by an ``Observation`` during the write (its
    size is the number of table partitions, not rows). Spark stages the new
    files and swaps the partitions at job commit, after every task has
    finished reading, so ``df`` may read the table it overwrites.
    ``rebalance``, ``finish``: as for ``write_partitioned``.
    """
    obs = Observation("write_parts")
    laid_out = clustered(df, partition_cols, cluster_cols) if rebalance or cluster_cols else df
    out = (finish(laid_out) if finish else laid_out).observe(
        obs, F.count(F.lit(1)).alias("rows"),
        F.collect_set(F.struct(*[F.col(c) for c in partition_cols])).alias("parts"))
    (out.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols).save(path))
    got = obs.get
    return int(got["rows"]), {tuple(r) for r in got["parts"]}


def write_table(df: DataFrame, path: str, fmt: str = "parquet", cluster_cols: Sequence[str] = (), zorder: bool = False,
                finish: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Full-table overwrite.

    ``finish``: a step over the rows where they will be written, such as a look-up in a broadcast table: the
    columns it adds do not travel. It must leave the rows' order.

    Along a Z curve, the rows are read more than once (for the cuts, the range
    bounds and the write), so they are made once and stored beside the table meanwhile."""
    spark, staged = df.sparkSession, path.rstrip("/") + "__unordered"
    on_curve = zorder and len(cluster_cols) > 1
    if on_curve:
        df.write.format(fmt).mode("overwrite").save(staged)
        df = spark.read.schema(df.schema).format(fmt).load(staged)
    obs = Observation("write_full")
    laid_out = clustered(df, (), cluster_cols, zorder=zorder)
    out = (finish(laid_out) if finish else laid_out).observe(obs, F.count(F.lit(1)).alias("rows"))
    out.write.format(fmt).mode("overwrite").save(path)
    if on_curve:
        delete_path(spark, staged)
    return int(obs.get["rows"])


def verify_partition(spark: SparkSession, path: str, part_col: str, value, expected: int,
                     fmt: str = "parquet") -> int:
    """Re-read one partition and compare its row count with what was written."""
    got = load_table(spark, path, fmt).filter(F.col(part_col) == F.lit(value)).count()
    if got != expected:
        raise RuntimeError(f"post-write verification failed: wrote {expected} rows, {got} readable "
                           f"in {part_col}={value}")
    return got


def append_records(spark: SparkSession, path: str, rows: Sequence[dict | tuple], schema: StructType,
                   fmt: str = "parquet") -> None:
    """Append a few bookkeeping records (audit, drift events, test results)."""
    append_frame(spark.createDataFrame(list(rows), schema), path, fmt)


#: Appends to one folder share its staging folder, so those of this driver's threads go one after another.
_appending = threading.Lock()


def append_frame(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    with _appending:
        df.write.format(fmt).mode("append").save(path)


# ── reads ──────────────────────────────────────────────────────────────────

def read_window(spark: SparkSession, path: str, part_col: str, start: dt.date, end: dt.date,
                fmt: str = "parquet") -> DataFrame:
    """Rows of partitions ``start..end`` (static partition pruning)."""
    return load_table(spark, path, fmt).filter(F.col(part_col).between(F.lit(start), F.lit(end)))


def read_partitions(spark: SparkSession, path: str, part_col: str, values: Sequence,
                    fmt: str = "parquet") -> DataFrame:
    """Rows of the listed partitions only (``IN`` list, static partition
    pruning), e.g. scattered dates being replayed."""
    return load_table(spark, path, fmt).filter(F.col(part_col).isin(list(values)))


def read_as_of(spark: SparkSession, path: str, as_of: dt.date, part_col: str = "ingestion_date",
               fmt: str = "parquet") -> DataFrame:
    """The latest snapshot partition on or before ``as_of``.

    The dates come from the partition folders, so nothing is scanned to find
    it; the returned read is pruned to that single partition.
    """
    df = load_table(spark, path, fmt)
    days = [v for v in partition_values(spark, path, part_col) if v and v <= as_of.isoformat()]
    return df.filter(F.col(part_col) == F.lit(max(days)).cast("date")) if days else df.filter(F.lit(False))


def expired_partitions(spark: SparkSession, path: str, part_col: str, as_of: dt.date, keep_days: int) -> DataFrame:
    """Partition values (dates) older than the retention period, from the folder names; the caller deletes."""
    cutoff = (as_of - dt.timedelta(days=keep_days)).isoformat()
    old = [(v,) for v in sorted(v for v in partition_values(spark, path, part_col) if v) if v < cutoff]
    name = "expired_" + part_col
    return spark.createDataFrame(old, f"{name} string").select(F.col(name).cast("date").alias(name))


def partition_folders(spark: SparkSession, path: str, cols: Sequence[str]) -> list[tuple[str | None, ...]]:
    """Values of the leading partition columns, level by level from the folder names (no rows are read)."""
    if not cols:
        return [()]
    out = []
    for v in partition_values(spark, path, cols[0]):
        out += [(v, *rest) for rest in partition_folders(spark, partition_dir(path, {cols[0]: v}), cols[1:])]
    return out


def expired_months(spark: SparkSession, path: str, as_of: dt.date, keep_days: int,
                   part_cols: Sequence[str] = ("year", "month")) -> DataFrame:
    """(year, month, last_day) of the year/month partitions whose last day is older than the retention
    period; partitions without a month never expire; the caller deletes."""
    cutoff, old = as_of - dt.timedelta(days=keep_days), []
    for y, m in partition_folders(spark, path, part_cols):
        if y is None or m is None:
            continue
        year, month = int(y), int(m)
        last = (dt.date(year + month // 12, month % 12 + 1, 1) if year < 9999 else dt.date.max) - dt.timedelta(days=1)
        if last < cutoff:
            old.append((year, month, last))
    return spark.createDataFrame(sorted(old), "year int, month int, last_day date")


# Retention per layer, in days.
RETENTION_DAYS = {"bronze": 90, "silver": 365}


def expired_for_layer(spark: SparkSession, path: str, layer: str, as_of: dt.date,
                      part_col: str = "ingestion_date") -> DataFrame:
    """(partition, last_day) of a table's partitions beyond its layer's retention: days of a raw table,
    months of a clean table (``partition`` is the folder's name below ``path``)."""
    keep = RETENTION_DAYS[layer]
    if partition_values(spark, path, part_col):
        days = expired_partitions(spark, path, part_col, as_of, keep)
        return days.select(F.concat(F.lit(part_col + "="), F.col(f"expired_{part_col}").cast("string")).alias("partition"),
                           F.col(f"expired_{part_col}").alias("last_day"))
    months = expired_months(spark, path, as_of, keep)
    return months.select(F.concat(F.lit("year="), "year", F.lit("/month="), "month").alias("partition"), "last_day")
