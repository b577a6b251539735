"""Layer jobs over table paths: what a scheduler calls once per run date.

``run_bronze`` ingests the five JSON sources, ``run_silver`` cleans the
lookback window of each raw table and checks it before it replaces the stored
one, ``run_tests`` runs and stores a layer's suite, ``run_gold`` rebuilds
dimensions, upserts what arrived into the facts and extends the two history tables. Every job takes its
run date / run time as parameters, writes idempotently and appends one audit
record per table, also for a table that fails. Entities of a layer run side by
side and do not stop each other (``run_isolated``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.columns import lookback_dates, ts_lit
from strataflow.operators import gold, history, quality, silver
from strataflow.operators.upsert import upsert
from strataflow.schemas import (AUDIT_SCHEMA, ENTITIES, FRESHNESS_HOURS, MAX_ROW_LOSS_PCT, REGRESSION_DROP_PCT,
                                TEST_RESULT_HISTORY_SCHEMA, ZERO_NULL_COLUMNS)
from strataflow.sources import bronze as B
from strataflow.sources.tables import (append_records, clustered, delete_path, expired_for_layer, partition_folders, partition_values, path_exists, read_window, replace_path, restore_path,
                                       write_table)

PARTITIONED = {"reviews": ("review_id",), "checkin_events": ("business_id",), "tips": ("business_id",)}


@dataclass(frozen=True)
class Paths:
    root: str

    def bronze(self, entity: str) -> str:
        return f"{self.root}/bronze/{entity}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def quarantine(self, entity: str) -> str:
        return f"{self.root}/quarantine/{entity}"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit/pipeline_audit"

    @property
    def drift(self) -> str:
        return f"{self.root}/audit_events/schema_drift"

    @property
    def test_results(self) -> str:
        return f"{self.root}/audit/test_results"


def _audit(spark, paths, entity, layer, inp, out, run_date, run_ts, status="SUCCESS", error=""):
    loss = None if (inp is None or out is None or not inp) else round((inp - out) / inp * 100.0, 2)
    append_records(spark, paths.audit, [(entity, layer, out, inp, out, loss, run_date, run_ts, status, error)],
                   AUDIT_SCHEMA)


class EntityRunsFailed(RuntimeError):
    """Some entities of a job failed (``failed``: entity -> error); the others are done (``done``: entity -> result)."""

    def __init__(self, job: str, done: dict, failed: dict) -> None:
        super().__init__(f"{job}: " + "; ".join(f"[{e}] {type(x).__name__}: {x}" for e, x in sorted(failed.items())))
        self.done, self.failed = done, failed


def run_isolated(spark: SparkSession, job: str, tasks: Mapping[str, Callable[[], object]], at_once: int = 4) -> dict[str, object]:
    """Run one task an entity, several at a time, each in its own scheduler pool and job group.

    A failure does not stop the others. When all have ended, failures raise one
    ``EntityRunsFailed`` that holds them and what the others returned. Pools share the
    executors fairly where the cluster runs with ``spark.scheduler.mode=FAIR``.
    """
    sc = spark.sparkContext

    def one(entity: str) -> object:
        sc.setLocalProperty("spark.scheduler.pool", f"{job}-{entity}")
        sc.setJobGroup(f"{job}-{entity}", f"{job} {entity}")
        try:
            return tasks[entity]()
        finally:
            sc.setLocalProperty("spark.scheduler.pool", None)

    done, failed = {}, {}
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(tasks)))) as pool:
        # a thread of Spark's own properties for each task, as the driver's threads share one JVM
        runs = {e: pool.submit(inheritable_thread_target(spark)(one), e) for e in tasks}
        for e, run in runs.items():
            try:
                done[e] = run.result()
            except Exception as exc:  # noqa: BLE001 - gathered and raised below
                failed[e] = exc
    if failed:
        raise EntityRunsFailed(job, done, failed)
    return done


def run_bronze(spark: SparkSession, paths: Paths, landing: dict[str, str], run_date: dt.date,
               run_ts: dt.datetime, at_once: int = 4, **kw) -> dict[str, B.IngestResult]:
    """L1 for every entity present in ``landing`` (entity -> JSON path). An entity that fails leaves a
    FAILED audit record and the others loaded; all failures are raised together at the end."""
    def ingest(e: str, src: str):
        return lambda: B.ingest_entity(spark, e, src, paths.bronze(e), run_date, run_ts, audit_path=paths.audit,
                                       quarantine_path=paths.quarantine(e), drift_path=paths.drift, **kw)
    return run_isolated(spark, "bronze", {e: ingest(e, src) for e, src in landing.items()}, at_once)


class SilverCheckError(RuntimeError):
    """A clean table came out empty; the stored one is left as it is."""


def run_silver(spark: SparkSession, paths: Paths, run_date: dt.date, run_ts: dt.datetime,
               lookback_days: int = 3, at_once: int = 4) -> dict[str, int]:
    """L2-L7: clean each raw table's lookback window into its clean table.

    A table is written beside its place and counted on the way (rows, nulls in
    critical columns, latest time). Only if it is not empty does it replace the
    stored one; loss, nulls, freshness and regression are warnings. All check
    rows go to the stored test results. Entities run side by side; one that
    fails leaves the others' tables replaced and is raised at the end.
    """
    start = lookback_dates(run_date, lookback_days)[0]

    def clean(entity: str) -> dict[str, int]:
        table, transform = silver.SILVER_TRANSFORMS[entity]
        raw = read_window(spark, paths.bronze(entity), "ingestion_date", start, run_date)
        # counted from the files' row counts: the transform itself may run its input twice (range bounds)
        counts = {table: _replace_checked(spark, paths, transform(raw), table, PARTITIONED.get(table), run_date, run_ts, raw.count())}
        if entity == "business":
            counts["business_categories"] = _replace_checked(
                spark, paths, silver.business_categories(raw), "business_categories", None, run_date, run_ts)
        return counts

    present = [e for e in silver.SILVER_TRANSFORMS if path_exists(spark, paths.bronze(e))]
    done = run_isolated(spark, "silver", {e: (lambda e=e: clean(e)) for e in present}, at_once)
    return {table: n for e in present for table, n in done[e].items()}


_FRESH = {"reviews": "review_date", "users": "yelping_since", "tips": "tip_date", "checkin_events": "checkin_ts"}


def _replace_checked(spark: SparkSession, paths: Paths, out: DataFrame, table: str, cluster_cols, run_date: dt.date,
                     run_ts: dt.datetime, n_in: int | None = None) -> int:
    path, staging = paths.silver(table), paths.silver(table) + "__staging"
    critical = [c for c in ZERO_NULL_COLUMNS["silver"].get(table, []) if c in out.columns]
    fresh = _FRESH.get(table)
    seen = Observation(f"silver_{table}")
    aggs = [F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in critical)]
    if fresh:
        aggs.append(F.max(F.unix_micros(F.col(fresh).cast("timestamp"))).alias("latest"))
    parts = ["year", "month"] if cluster_cols else []
    w = (clustered(out, parts, cluster_cols) if cluster_cols else out).observe(seen, *aggs).write.mode("overwrite")
    (w.option("partitionOverwriteMode", "static").partitionBy(*parts) if parts else w).parquet(staging)
    got = seen.get
    n = int(got["n"])
    previous = _previous_count(spark, paths, table)
    loss = (n_in - n) / n_in * 100 if n_in else None
    drop = (previous - n) / previous * 100 if previous else None
    age = B.age_hours(run_ts, got["latest"]) if fresh else None
    limit = float(FRESHNESS_HOURS["silver"])
    rows = [("non_empty", n > 0, f"{n} rows", float(n), None)]
    rows += [("zero_nulls", got[f"null_{c}"] == 0, f"column '{c}': {got[f'null_{c}']} null values", float(got[f"null_{c}"]), 0.0)
             for c in critical]
    if loss is not None and table != "checkin_events":
        rows.append(("row_loss", loss <= MAX_ROW_LOSS_PCT, f"input {n_in}, output {n}", round(loss, 2), MAX_ROW_LOSS_PCT))
    if age is not None:
        rows.append(("freshness", age <= limit, f"latest record {age:.1f} h old", round(age, 2), limit))
    if drop is not None:
        rows.append(("count_regression", drop <= REGRESSION_DROP_PCT, f"previous {previous}, current {n}", round(drop, 2),
                     REGRESSION_DROP_PCT))
    append_records(spark, paths.test_results,
                   [(name, table, "silver", ok, text, value, limit_, run_date, run_ts) for name, ok, text, value, limit_ in rows],
                   TEST_RESULT_HISTORY_SCHEMA)
    if not n:
        delete_path(spark, staging)
        _audit(spark, paths, table, "silver", n_in, n, run_date, run_ts, "FAILED", "empty result")
        raise SilverCheckError(f"[{table}] empty result: check the input and the filters")
    replace_path(spark, staging, path)
    _audit(spark, paths, table, "silver", n_in, n, run_date, run_ts)
    return n


def _previous_count(spark: SparkSession, paths: Paths, table: str) -> int | None:
    if not path_exists(spark, paths.audit):
        return None
    log = spark.read.schema(AUDIT_SCHEMA).parquet(paths.audit)
    return (log.filter((F.col("entity") == table) & (F.col("layer") == "silver") & (F.col("status") == "SUCCESS"))
            .agg(F.max_by("output_count", "run_timestamp")).first()[0])


class LayerTestsFailed(RuntimeError):
    """Some checks of a layer did not pass; all rows are stored."""


def run_tests(spark: SparkSession, paths: Paths, layer: str, run_date: dt.date, run_ts: dt.datetime,
              lookback_days: int = 3, floors: dict | None = None, stop: bool = True) -> DataFrame:
    """The layer's whole suite over its stored tables: readability, table checks and drift against
    the results of earlier runs. The rows are stored (they become the next runs' baseline);
    with ``stop``, a failed check then raises ``LayerTestsFailed``."""
    names = quality.layer_specs(layer)
    where = paths.bronze if layer == "bronze" else paths.silver
    tables, rows = {}, []
    for spec in names:
        df, row = quality.table_readable(spark, where(spec.entity), spec.entity, layer)
        rows.append(row)
        if df is not None:
            tables[spec.entity] = df
    raw = None
    if layer == "silver":
        start = lookback_dates(run_date, lookback_days)[0]
        raw = {e: read_window(spark, paths.bronze(e), "ingestion_date", start, run_date)
               for e in ("business", "reviews", "users", "tips") if path_exists(spark, paths.bronze(e))}
    history = quality.read_history(spark, paths.test_results)
    if tables:
        days = {e: [dt.date.fromisoformat(v) for v in partition_values(spark, paths.bronze(e), "ingestion_date") if v]
                for e in tables} if layer == "bronze" else None
        rows.append(quality.run_layer_suite(tables, layer, run_ts, run_date, lookback_days, raw, history, floors, days))
    out = quality.with_run(quality.union_all(rows), run_date, run_ts)
    # the rows are stored before anyone reads them: the suite itself runs once
    staging = paths.test_results + "__staging"
    out.write.mode("overwrite").parquet(staging)
    results = spark.read.parquet(staging)
    results.write.mode("append").parquet(paths.test_results)
    if stop and results.filter(~F.col("passed")).limit(1).count():
        raise LayerTestsFailed(f"{layer} checks failed on {run_date}")
    return spark.read.parquet(paths.test_results).filter(F.col("run_timestamp") == ts_lit(run_ts))


def run_gold(spark: SparkSession, paths: Paths, run_ts: dt.datetime,
             date_start: dt.date | None = None, date_end: dt.date | None = None, fact_buckets: int | None = None) -> dict[str, object]:
    """L8, L9, L13, L14: dimensions (full refresh), facts (keyed upsert of what
    arrived), histories (one SCD2 step at ``run_ts``).

    The clean tables hold what was ingested in the lookback window, so late
    events and corrections of old ones reach the facts, and an event dated in
    the future does no harm. The calendar covers every event time: its bounds
    are those of the data, widened by ``date_start`` and ``date_end``.
    ``fact_buckets``: key buckets of the facts when they are created (see ``upsert``).

    Every table leaves an audit record with its size, also the facts and
    histories (counted from Parquet footers), and a table that fails one that says why: day-over-day
    volume checks (``quality.audit_volume``) work on all layers.
    """
    rd = spark.read.parquet
    out: dict[str, object] = {}
    for table in ("business", "business_categories", "users", "reviews", "checkin_events"):
        restore_path(spark, paths.silver(table))

    def build(table: str, make: Callable[[], object], size: Callable[[object], int]) -> object:
        try:
            out[table] = got = make()
            n = size(got)
        except Exception as exc:
            _audit(spark, paths, table, "gold", None, None, run_ts.date(), run_ts, "FAILED", f"{type(exc).__name__}: {exc}"[:500])
            raise
        _audit(spark, paths, table, "gold", None, n, run_ts.date(), run_ts)
        return got

    def stored_rows(table: str) -> Callable[[object], int]:
        return lambda _: rd(paths.gold(table)).count()

    lo, hi = _event_bounds(spark, paths)
    date_start, date_end = min(d for d in (lo, date_start) if d), max(d for d in (hi, date_end) if d)
    build("dim_date", lambda: write_table(gold.dim_date(spark, date_start, date_end), paths.gold("dim_date")), int)
    dates = rd(paths.gold("dim_date"))
    prim = silver.primary_category(rd(paths.silver("business_categories")))
    build("dim_business", lambda: write_table(gold.dim_business(rd(paths.silver("business")), prim), paths.gold("dim_business"),
                                              cluster_cols=["city", "state"], zorder=True), int)
    build("dim_user", lambda: write_table(gold.dim_user(rd(paths.silver("users"))), paths.gold("dim_user")), int)

    def load_fact(name: str, table: str, fact: Callable[..., DataFrame], at: str, key: str) -> dict:
        # A fact row is a clean row with its date key: clean tables are read again rather than staged, and a clean
        # table that lies by year and month already has the fact's layout.
        rows, finish = gold.date_id_last(fact(rd(paths.silver(table)), dates, date_start, date_end), at, dates, date_start, date_end)
        laid_out = bool(finish and partition_folders(spark, paths.silver(table), ["year", "month"]))
        return upsert(spark, rows, paths.gold(name), [key], ["year", "month"], buckets=fact_buckets, finish=finish,
                      from_files=finish is not None, laid_out=laid_out)

    for name, *how in (("fact_reviews", "reviews", gold.fact_reviews, "reviewed_at", "review_id"),
                       ("fact_checkins", "checkin_events", gold.fact_checkins, "checkin_ts", "checkin_id")):
        build(name, lambda: load_fact(name, *how), stored_rows(name))

    for name, dim, key, tracked, cols in (
            ("dim_business_history", paths.gold("dim_business"), "business_id", history.BUSINESS_TRACKED,
             ["business_id", "name", "city", "state", "stars", "review_count", "is_open", "primary_category",
              "latitude", "longitude"]),
            ("dim_user_history", paths.gold("dim_user"), "user_id", history.USER_TRACKED,
             ["user_id", "name", "review_count", "average_stars", "is_elite", "elite_years_count", "fan_count",
              "yelping_since_year", "total_useful_votes", "total_funny_votes", "total_cool_votes"])):
        build(name, lambda: history.scd2_store(spark, paths.gold(name), rd(dim).select(*cols), key, tracked, run_ts), stored_rows(name))
    return out


def expired(spark: SparkSession, paths: Paths, as_of: dt.date) -> DataFrame:
    """(layer, table, partition, last_day) of all raw and clean partitions beyond their layer's retention.
    Nothing is deleted: the list is small and the caller decides."""
    lists = [("bronze", e, paths.bronze(e)) for e in ENTITIES] + [("silver", t, paths.silver(t)) for t in PARTITIONED]
    found = [expired_for_layer(spark, at, layer, as_of).select(F.lit(layer).alias("layer"), F.lit(t).alias("table"), "partition", "last_day")
             for layer, t, at in lists if path_exists(spark, at)]
    return quality.union_all(found)


def edge_months(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the first and the last month of a year/month table, which hold its first and last event: two
    partitions are read, however many there are. A table without such folders is read whole."""
    months = sorted((int(y), int(m)) for y, m in partition_folders(spark, path, ["year", "month"]) if y and m)
    rows = spark.read.parquet(path)
    if not months:
        return rows
    (y0, m0), (y1, m1) = months[0], months[-1]
    year, month = F.col("year"), F.col("month")
    return rows.filter(((year == y0) & (month == m0)) | ((year == y1) & (month == m1)))


def _event_bounds(spark: SparkSession, paths: Paths) -> tuple[dt.date, dt.date]:
    """First and last event day, of the clean tables and of the calendar that is already stored."""
    days = (edge_months(spark, paths.silver("reviews")).select(F.to_date("review_date").alias("d"))
            .unionAll(edge_months(spark, paths.silver("checkin_events")).select(F.to_date("checkin_ts"))))
    if path_exists(spark, paths.gold("dim_date")):
        days = days.unionAll(spark.read.parquet(paths.gold("dim_date")).select("full_date"))
    return tuple(days.agg(F.min("d"), F.max("d")).first())


def materialize(df: DataFrame, kind: str, name: str, path: str | None = None, **upsert_kw):
    """Model materialisation kinds: ``view`` (temp view, recomputed on every
    query), ``ephemeral`` (the DataFrame itself, inlined into its consumers),
    ``table`` (full overwrite), ``incremental`` (keyed upsert)."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind == "ephemeral":
        return df
    if kind == "table":
        return write_table(df, path)
    if kind == "incremental":
        return upsert(df.sparkSession, df, path, **upsert_kw)
    raise ValueError(kind)
