"""Raw-layer ingestion job: JSON -> checked, stamped, partitioned table.

``ingest_entity`` = parse the lines once (``json_source.parse_once``) -> drift of
the schema they imply against the contract and the table -> quarantine of lines
that do not fit -> typed columns -> stamp ``ingestion_date`` ->
row floor -> dynamic overwrite of that date's partition (new
columns kept, row count observed during the write) -> read-back verification ->
freshness -> audit record. Every outcome leaves an audit record, a halted load
one that says why. Running it twice for the same date leaves the same table.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strataflow.functions.columns import add_missing_columns
from strataflow.schemas import AUDIT_SCHEMA, ENTITIES, FRESHNESS_HOURS, SOURCE_TS_FORMAT
from strataflow.sources import json_source as J
from strataflow.sources.tables import (append_frame, append_records, delete_path, grow_schema, partition_dir,
                                       save_schema, stored_schema, verify_partition, write_partitioned)


class RowFloorError(RuntimeError):
    """Fewer rows than the entity must have."""

    def __init__(self, message: str, rows: int) -> None:
        super().__init__(message)
        self.rows = rows


@dataclass
class IngestResult:
    entity: str
    run_date: dt.date
    rows_written: int
    quarantined: int
    drift: J.DriftReport = field(default_factory=J.DriftReport)
    stale: bool = False
    new_columns: list = field(default_factory=list)


def ingest_entity(spark: SparkSession, entity: str, source_path: str, bronze_path: str, run_date: dt.date,
                  run_ts: dt.datetime, audit_path: str | None = None, quarantine_path: str | None = None,
                  drift_path: str | None = None, min_rows: int | None = None,
                  fmt: str = "parquet", rebalance: bool = True) -> IngestResult:
    """Ingest one entity's JSON export as the ``run_date`` partition.

    A column the contract does not know is logged as drift and kept: the
    table's recorded schema grows, and older partitions hold null in it. A
    changed type halts the load. The quarantine of the date is replaced, also
    by nothing. ``stale`` tells whether the latest record was older than the
    layer's freshness limit at ``run_ts`` (a warning in the audit log).

    ``rebalance``: spread the parsed rows over the cluster when the source
    could not be split into enough read tasks (e.g. a few gzip files); a
    splittable source is left as it is.
    """
    try:
        return _ingest(spark, entity, source_path, bronze_path, run_date, run_ts, audit_path, quarantine_path, drift_path, min_rows, fmt, rebalance)
    except Exception as exc:
        _audit(spark, audit_path, entity, getattr(exc, "rows", None), run_date, run_ts, "FAILED", f"{type(exc).__name__}: {exc}"[:500], fmt)
        raise


def _ingest(spark, entity, source_path, bronze_path, run_date, run_ts, audit_path, quarantine_path, drift_path, min_rows, fmt, rebalance) -> IngestResult:
    contract, stored = ENTITIES[entity], stored_schema(spark, bronze_path, fmt)
    declared = contract.schema
    lines = J.parse_once(spark, source_path, declared, contract.freshness_col, SOURCE_TS_FORMAT, rebalance)
    report = J.detect_drift(declared, lines.inferred, stored=stored)
    if report.drifted and drift_path:
        append_frame(J.drift_events(spark, entity, report, run_date, run_ts), drift_path, fmt)
    if report.changed:
        raise J.SchemaDriftError(f"[{entity}] breaking type change: {report.changed}")

    if quarantine_path:
        delete_path(spark, partition_dir(quarantine_path, {"ingestion_date": run_date}))
        if lines.n_bad:
            (lines.corrupt().withColumn("ingestion_date", F.lit(run_date))
                  .write.format(fmt).mode("append").partitionBy("ingestion_date").save(quarantine_path))

    floor = contract.min_rows if min_rows is None else min_rows
    if lines.n_good < floor:
        raise RowFloorError(f"[{entity}] {lines.n_good} rows below minimum {floor}", lines.n_good)

    typed = lines.typed(J.read_schema_for(declared, report, lines.inferred, stored))
    good, new = grow_schema(add_missing_columns(typed, declared).withColumn("ingestion_date", F.lit(run_date)), stored)
    # one date, in tasks as even as the copy's splits: nothing to bring together
    written = write_partitioned(good, bronze_path, ["ingestion_date"], fmt, guard=False, rebalance=False)
    save_schema(spark, bronze_path, good.schema)
    verify_partition(spark, bronze_path, "ingestion_date", run_date, written, fmt)
    age = age_hours(run_ts, lines.latest)
    stale = age is not None and age > FRESHNESS_HOURS["bronze"]
    _audit(spark, audit_path, entity, written, run_date, run_ts, "SUCCESS",
           f"stale: latest record {age:.1f} h old" if stale else "", fmt)
    return IngestResult(entity, run_date, written, lines.n_bad, report, stale, new)


def age_hours(run_ts: dt.datetime, latest_micros: int | None) -> float | None:
    """Hours from the latest record (microseconds since the epoch, UTC) to the run."""
    if latest_micros is None:
        return None
    now = (run_ts if run_ts.tzinfo else run_ts.replace(tzinfo=dt.timezone.utc)).timestamp()
    return (now - latest_micros / 1e6) / 3600


def _audit(spark, path, entity, rows, run_date, run_ts, status, error, fmt):
    if not path:
        return
    append_records(spark, path, [(entity, "bronze", rows, None, None, None, run_date, run_ts, status, error)],
                   AUDIT_SCHEMA, fmt)


def replay(spark: SparkSession, entity: str, sources: dict[dt.date, str], bronze_path: str,
           run_ts: dt.datetime, **kw) -> list[IngestResult]:
    """Re-ingest several dates (each one replaces only its own partition)."""
    return [ingest_entity(spark, entity, src, bronze_path, d, run_ts, **kw) for d, src in sorted(sources.items())]
