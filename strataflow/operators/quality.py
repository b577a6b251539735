"""Data-quality checks that return result rows instead of raising.

Result shape (``TEST_RESULT_SCHEMA``): test_name, entity, layer, passed,
message, value, threshold. Each check is a lazy DataFrame:

* all scalar checks of one table (row floor, null counts, null rates, star
  range, freshness, drift figures) come from ONE aggregate pass, duplicate keys from a second;
* a layer's suite is one plan (``fused_rows``): the figures of all tables, of
  raw inputs and of the stored history are united and folded into one
  small map a table, from which the result rows are built — no joins, nothing
  collected to the driver;
* messages carry integers only, numeric details live in ``value``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow import schemas as S
from strataflow.functions.columns import hours_between, lookback_dates, round_half_up

RESULT_COLS = [f.name for f in S.TEST_RESULT_SCHEMA.fields]


# ── building blocks ────────────────────────────────────────────────────────

def _s(x) -> Column:
    return F.coalesce(F.col(x).cast("string") if isinstance(x, str) else x.cast("string"), F.lit("null"))


def result(test_name: str, entity: str, layer: str, passed: Column, message: Column,
           value: Column | None = None, threshold: float | Column | None = None) -> Column:
    thr = threshold if isinstance(threshold, Column) else F.lit(threshold)
    val = value if value is not None else F.lit(None)
    return F.struct(F.lit(test_name).alias("test_name"), F.lit(entity).alias("entity"),
                    F.lit(layer).alias("layer"), F.coalesce(passed, F.lit(False)).alias("passed"),
                    message.alias("message"), val.cast("double").alias("value"),
                    thr.cast("double").alias("threshold"))


def rows_from(metrics: DataFrame, structs: Sequence[Column]) -> DataFrame:
    """Turn a one-row metrics frame into one result row per struct."""
    return metrics.select(F.inline(F.array(*structs))).select(*RESULT_COLS)


def static_results(spark: SparkSession, structs: Sequence[Column]) -> DataFrame:
    return rows_from(spark.range(1), structs)


def skipped(spark: SparkSession, test_name: str, entity: str, layer: str, why: str) -> DataFrame:
    return static_results(spark, [result(test_name, entity, layer, F.lit(True), F.lit(why))])


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _tagged_counts(**frames: DataFrame) -> DataFrame:
    """One row with ``count(*)`` of each named frame (union + global fold)."""
    parts = [df.select(F.lit(tag).alias("_tag")) for tag, df in frames.items()]
    u = union_all(parts)
    return u.agg(*[F.count(F.when(F.col("_tag") == tag, 1)).alias(tag) for tag in frames])


# ── single-table checks (one pass) ─────────────────────────────────────────

@dataclass
class TableChecks:
    """What to check on one table. Absent columns are reported as skipped."""
    entity: str
    layer: str
    min_rows: int | None = None
    zero_null_cols: Sequence[str] = ()
    null_rate_cols: Sequence[str] = ()
    stars_col: str | None = None
    freshness_col: str | None = None
    freshness_format: str | None = None
    freshness_hours: float | None = None
    key_col: str | None = None
    extra: dict = field(default_factory=dict)


Get = Callable[[str], Column]


@dataclass
class Scalars:
    """Scalar checks of one table: named aggregates of one pass, and builders of result rows that get a figure by its name."""
    aggs: dict[str, Column] = field(default_factory=dict)
    rows: list[Callable[[Get], Column]] = field(default_factory=list)
    skipped: list[tuple[str, str]] = field(default_factory=list)        # (test, why)


def scalar_checks(spec: TableChecks, columns: Iterable[str], as_of_ts: dt.datetime | None = None) -> Scalars:
    """Row floor, zero nulls, null rates, star range and freshness of ``spec``."""
    e, lay, have = spec.entity, spec.layer, set(columns)
    out = Scalars({"_n": F.count(F.lit(1))})

    if spec.min_rows is not None:
        floor = spec.min_rows

        def floor_row(get: Get) -> Column:
            n = get("_n")
            return result(
                "row_count_minimum", e, lay, n >= floor,
                F.when(n >= floor, F.concat(F.lit("row count "), _s(n), F.lit(" >= minimum "), F.lit(str(floor))))
                 .otherwise(F.concat(F.lit("FAIL - row count "), _s(n), F.lit(" below minimum "), F.lit(str(floor)))),
                n, float(floor))
        out.rows.append(floor_row)

    for c in spec.zero_null_cols:
        if c not in have:
            out.skipped.append(("zero_nulls", f"column '{c}' not in table - skipped"))
            continue
        out.aggs[f"_null_{c}"] = F.count_if(F.col(c).isNull())
        out.rows.append(lambda get, c=c: result(
            "zero_nulls", e, lay, get(f"_null_{c}") == 0,
            F.concat(F.lit(f"column '{c}': "), _s(get(f"_null_{c}")), F.lit(" null values")), get(f"_null_{c}"), 0.0))

    for c in spec.null_rate_cols:
        if c not in have:
            continue
        out.aggs[f"_null_{c}"] = F.count_if(F.col(c).isNull())
        out.rows.append(lambda get, c=c: result(
            "null_rate", e, lay, get(f"_null_{c}") == 0,
            F.concat(F.lit(f"column '{c}': "), _s(get(f"_null_{c}")), F.lit(" of "), _s(get("_n")), F.lit(" rows null")),
            round_half_up(F.when(get("_n") > 0, get(f"_null_{c}") / get("_n")).otherwise(F.lit(0.0)), 4), 0.0))

    if spec.stars_col:
        if spec.stars_col not in have:
            out.skipped.append(("star_rating_range", "no stars column - skipped"))
        else:
            out.aggs["_bad_stars"] = F.count_if(~F.col(spec.stars_col).between(1, 5))
            out.rows.append(lambda get: result(
                "star_rating_range", e, lay, get("_bad_stars") == 0,
                F.concat(_s(get("_bad_stars")), F.lit(" rows with stars outside 1-5")), get("_bad_stars"), 0.0))

    if spec.freshness_col:
        if spec.freshness_col not in have or as_of_ts is None:
            out.skipped.append(("freshness", f"no date column '{spec.freshness_col}' - skipped"))
        else:
            ts = F.col(spec.freshness_col)
            if spec.freshness_format:
                ts = F.try_to_timestamp(ts, F.lit(spec.freshness_format))
            out.aggs["_latest"] = F.max(F.unix_micros(ts.cast("timestamp")))
            thr = float(spec.freshness_hours or 0)

            def fresh_row(get: Get) -> Column:
                latest = F.timestamp_micros(get("_latest"))
                age = hours_between(as_of_ts, latest)
                return result(
                    "freshness", e, lay, latest.isNotNull() & (age <= thr),
                    F.when(latest.isNull(), F.lit("FAIL - no latest timestamp"))
                     .when(age <= thr, F.lit(f"latest record within {int(thr)}h"))
                     .otherwise(F.lit(f"FAIL - latest record older than {int(thr)}h")),
                    round_half_up(age, 2), thr)
            out.rows.append(fresh_row)
    return out


def check_table(df: DataFrame, spec: TableChecks, as_of_ts: dt.datetime | None = None) -> DataFrame:
    """Row floor, zero nulls, null rates, star range and freshness in one
    aggregate; duplicate keys in one more (group by key, then fold)."""
    spark = df.sparkSession
    checks = scalar_checks(spec, df.columns, as_of_ts)
    out = [skipped(spark, test, spec.entity, spec.layer, why) for test, why in checks.skipped]
    if checks.rows:
        metrics = df.agg(*[c.alias(name) for name, c in checks.aggs.items()])
        out.insert(0, rows_from(metrics, [row(F.col) for row in checks.rows]))
    if spec.key_col:
        out.append(no_duplicate_keys(df, spec.entity, spec.layer, spec.key_col))
    if not out:
        return static_results(spark, [result("no_checks", spec.entity, spec.layer, F.lit(True), F.lit("nothing to check"))])
    return union_all(out)


def _key_counts(df: DataFrame, key_col: str) -> DataFrame:
    """(_rows, _keys) of a table; null counts as one key. A partial aggregate on the key."""
    per = df.groupBy(key_col).agg(F.count(F.lit(1)).alias("_c"))
    return per.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("_rows"), F.count(F.lit(1)).alias("_keys"))


def _duplicates_row(entity: str, layer: str, key_col: str, get: Get) -> Column:
    dup = get("_rows") - get("_keys")
    return result("no_duplicate_keys", entity, layer, dup == 0,
                  F.concat(F.lit(f"key '{key_col}': "), _s(dup), F.lit(" duplicate rows")), dup, 0.0)


def no_duplicate_keys(df: DataFrame, entity: str, layer: str, key_col: str) -> DataFrame:
    """``count - count(distinct key)`` (null counts as one value), via a
    partial aggregate on the key."""
    if key_col not in df.columns:
        return skipped(df.sparkSession, "no_duplicate_keys", entity, layer, f"key column '{key_col}' not found - skipped")
    return rows_from(_key_counts(df, key_col), [_duplicates_row(entity, layer, key_col, F.col)])


def non_empty(df: DataFrame, entity: str, layer: str) -> DataFrame:
    m = df.agg(F.count(F.lit(1)).alias("_n"))
    return rows_from(m, [result("non_empty", entity, layer, F.col("_n") > 0,
                                F.concat(_s("_n"), F.lit(" rows")), F.col("_n"), 0.0)])


# ── partitions, loss, readability ──────────────────────────────────────────

def lookback_partitions_present(df: DataFrame, entity: str, layer: str, run_date: dt.date,
                                lookback_days: int, part_col: str = "ingestion_date",
                                present: Iterable[dt.date] | None = None) -> DataFrame:
    """Every date of the lookback window has a partition.

    ``present``: the stored partitions' dates (``tables.partition_values``: folder names, no rows are read).
    Without them the values are gathered from the rows into one set (bounded by
    the calendar) and compared with the expected dates; no join."""
    spark = df.sparkSession
    if part_col not in df.columns:
        return skipped(spark, "lookback_partitions_present", entity, layer,
                       f"no {part_col} partition column - skipped")
    missing = _missing_dates(run_date, lookback_days, part_col, present)
    m = spark.range(1).select(missing.alias("_missing")) if present is not None else df.agg(missing.alias("_missing"))
    return rows_from(m, [_lookback_row(entity, layer, lookback_days, F.col)])


def _missing_dates(run_date: dt.date, lookback_days: int, part_col: str, present: Iterable[dt.date] | None) -> Column:
    """Number of expected dates without a partition; an aggregate over the rows where ``present`` is not given."""
    expected = lookback_dates(run_date, lookback_days)
    if present is not None:
        return F.lit(len(set(expected) - set(present))).cast("long")
    there = F.collect_set(F.when(F.col(part_col).cast("date").between(F.lit(expected[0]), F.lit(run_date)), F.col(part_col).cast("date")))
    return F.size(F.array_except(F.sequence(F.lit(expected[0]), F.lit(run_date)), there)).cast("long")


def _lookback_row(entity: str, layer: str, lookback_days: int, get: Get) -> Column:
    return result("lookback_partitions_present", entity, layer, get("_missing") == 0,
                  F.concat(_s(get("_missing")), F.lit(f" of {lookback_days} lookback partitions missing")), get("_missing"), 0.0)


def row_loss(before: DataFrame, after: DataFrame, entity: str, max_loss_pct: float = S.MAX_ROW_LOSS_PCT,
             test_name: str = "bronze_silver_row_ratio", layer: str = "silver",
             before_keys: Sequence[str] | None = None) -> DataFrame:
    """Loss from ``before`` to ``after`` in percent; ``before_keys`` counts
    distinct keys of the input (raw snapshots repeat keys across days)."""
    b = before.select(*before_keys).distinct() if before_keys else before
    m = _tagged_counts(_before=b, _n=after)
    return rows_from(m, [_loss_row(entity, layer, test_name, max_loss_pct, F.col)])


def _loss_row(entity: str, layer: str, test_name: str, max_loss_pct: float, get: Get) -> Column:
    before, after = get("_before"), get("_n")
    loss = F.when(before > 0, (before - after) / before * 100.0).otherwise(F.lit(0.0))
    return result(test_name, entity, layer, loss <= max_loss_pct, F.concat(F.lit("input "), _s(before), F.lit(", output "), _s(after)),
                  round_half_up(loss, 2), max_loss_pct)


def table_readable(spark: SparkSession, path: str, entity: str, layer: str, fmt: str = "parquet") -> tuple[DataFrame | None, DataFrame]:
    """(table or None, result row). Reading only resolves the schema here."""
    try:
        df = spark.read.format(fmt).load(path)
        return df, static_results(spark, [result("table_readable", entity, layer, F.lit(True), F.lit("readable"))])
    except Exception as exc:  # noqa: BLE001 - the failure is the result
        msg = f"FAIL - could not read table: {type(exc).__name__}"
        return None, static_results(spark, [result("table_readable", entity, layer, F.lit(False), F.lit(msg))])


# ── generic column tests (not_null / unique / accepted_values / relationships) ──

def _generic(test_name: str, model: str, col: str, failing: Column, layer: str = "gold") -> Column:
    return result(test_name, model, layer, failing == 0,
                  F.concat(F.lit(f"{col}: "), _s(failing), F.lit(" failing rows")), failing, 0.0)


def test_unique(df: DataFrame, model: str, col: str, layer: str = "gold") -> DataFrame:
    """Number of non-null values that occur more than once."""
    per = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    m = per.agg(F.count_if(F.col("_c") > 1).alias("_x"))
    return rows_from(m, [_generic("unique", model, col, F.col("_x"), layer)])


def test_relationships(df: DataFrame, model: str, col: str, parent: DataFrame, parent_col: str,
                       layer: str = "gold") -> DataFrame:
    """Child rows whose non-null key has no parent row.

    Both sides are reduced to one row per key first (partial aggregates, so a
    hot child key is collapsed map-side); the anti-join then compares keys
    and the orphan rows are summed back from the per-key counts."""
    child = (df.select(F.col(col).alias("_k")).filter(F.col("_k").isNotNull())
               .groupBy("_k").agg(F.count(F.lit(1)).alias("_rows")))
    orphans = child.join(parent.select(F.col(parent_col).alias("_k")).distinct(), "_k", "left_anti")
    m = orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("_x"))
    return rows_from(m, [_generic("relationships", model, col, F.col("_x"), layer)])


# Column tests declared for the star schema (model, column, test, argument).
GOLD_COLUMN_TESTS = [
    ("fact_reviews", "review_id", "unique", None),
    ("fact_reviews", "review_id", "not_null", None),
    ("fact_reviews", "business_id", "not_null", None),
    ("fact_reviews", "business_id", "relationships", ("dim_business", "business_id")),
    ("fact_reviews", "user_id", "not_null", None),
    ("fact_reviews", "user_id", "relationships", ("dim_user", "user_id")),
    ("fact_reviews", "date_id", "not_null", None),
    ("fact_reviews", "date_id", "relationships", ("dim_date", "date_id")),
    ("fact_reviews", "review_stars", "not_null", None),
    ("fact_reviews", "review_stars", "accepted_values", [1.0, 2.0, 3.0, 4.0, 5.0]),
    ("fact_reviews", "useful_votes", "not_null", None),
    ("fact_reviews", "funny_votes", "not_null", None),
    ("fact_reviews", "cool_votes", "not_null", None),
    ("fact_checkins", "checkin_id", "unique", None),
    ("fact_checkins", "checkin_id", "not_null", None),
    ("fact_checkins", "business_id", "not_null", None),
    ("fact_checkins", "business_id", "relationships", ("dim_business", "business_id")),
    ("fact_checkins", "date_id", "not_null", None),
    ("fact_checkins", "date_id", "relationships", ("dim_date", "date_id")),
    ("dim_business", "business_id", "unique", None),
    ("dim_business", "business_id", "not_null", None),
    ("dim_business", "name", "not_null", None),
    ("dim_business", "is_open", "accepted_values", [True, False]),
    ("dim_user", "user_id", "unique", None),
    ("dim_user", "user_id", "not_null", None),
    ("dim_user", "is_elite", "not_null", None),
    ("dim_user", "is_elite", "accepted_values", [True, False]),
    ("dim_date", "date_id", "unique", None),
    ("dim_date", "date_id", "not_null", None),
    ("dim_date", "full_date", "unique", None),
    ("dim_date", "full_date", "not_null", None),
    ("dim_date", "year", "not_null", None),
    ("dim_date", "month", "not_null", None),
    ("dim_date", "is_weekend", "accepted_values", [True, False]),
]


def _not_null(model: str, *cols: str) -> list[tuple]:
    return [(model, c, "not_null", None) for c in cols]


# Column tests declared for the other layers.
LAYER_COLUMN_TESTS = {
    "staging": [
        ("stg_reviews", "review_id", "unique", None),
        *_not_null("stg_reviews", "review_id", "business_id", "user_id", "review_stars", "reviewed_at"),
        ("stg_reviews", "review_stars", "accepted_values", [1.0, 2.0, 3.0, 4.0, 5.0]),
        ("stg_business", "business_id", "unique", None),
        *_not_null("stg_business", "business_id", "business_name"),
        ("stg_users", "user_id", "unique", None),
        *_not_null("stg_users", "user_id", "is_elite"),
        ("stg_users", "is_elite", "accepted_values", [True, False]),
        ("stg_checkins", "checkin_id", "unique", None),
        *_not_null("stg_checkins", "checkin_id", "business_id", "checkin_ts"),
    ],
    "intermediate": [
        ("int_reviews_with_dates", "review_id", "unique", None),
        *_not_null("int_reviews_with_dates", "review_id", "date_id"),
        ("int_business_categories", "business_id", "unique", None),
        *_not_null("int_business_categories", "business_id", "primary_category"),
        ("int_rising_star_candidates", "business_id", "unique", None),
        *_not_null("int_rising_star_candidates", "business_id", "avg_stars_recent", "avg_stars_historical",
                   "rating_improvement", "review_count_recent"),
    ],
    "reporting": [
        ("vw_rising_stars", "business_id", "unique", None),
        *_not_null("vw_rising_stars", "business_id", "business_name", "avg_stars_recent", "avg_stars_historical",
                   "rating_improvement", "review_count_recent"),
        ("vw_rising_stars", "improvement_tier", "accepted_values", ["Major improvement", "Strong improvement", "Improvement"]),
        *_not_null("vw_top_businesses_by_city", "business_id", "business_name", "city", "year", "avg_rating", "total_reviews"),
        ("vw_review_trends", "year_month", "unique", None),
        *_not_null("vw_review_trends", "year", "month", "year_month", "total_reviews", "avg_rating"),
    ],
    "history": [
        *_not_null("dim_business_history", "business_id", "valid_from", "is_current", "record_hash"),
        *_not_null("dim_user_history", "user_id", "valid_from", "is_current", "is_elite", "record_hash"),
    ],
}


def run_column_tests(models: Mapping[str, DataFrame], tests=GOLD_COLUMN_TESTS, layer: str = "gold") -> DataFrame:
    """All declared column tests over the given models, one result row each, as one plan.

    A model is read at most twice: ``not_null`` and ``accepted_values`` tests share one aggregate;
    for ``unique`` and ``relationships`` tests the values of all key columns
    are counted in one grouping by (column, value), a partial aggregate that collapses hot keys before the
    shuffle, and these counts meet the tagged keys of all parents in one join.
    """
    figures, rows = [], {}
    for model in dict.fromkeys(m for m, _, _, _ in tests):
        df = models.get(model)
        if df is None:
            continue
        mine = [(i, c, k, a) for i, (c, k, a) in enumerate((c, k, a) for m, c, k, a in tests if m == model)
                if k != "relationships" or models.get(a[0]) is not None]
        plain = {f"_x{i}": F.count_if(F.col(c).isNull()) if k == "not_null" else F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(a)))
                 for i, c, k, a in mine if k in ("not_null", "accepted_values")}
        if plain:
            figures.append(Figures(model, df.agg(*[x.alias(n) for n, x in plain.items()])))
        keyed = [(i, c, k, a) for i, c, k, a in mine if k in ("unique", "relationships")]
        if keyed:
            keys = list(dict.fromkeys(c for _, c, _, _ in keyed))
            each = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("key")) for c in keys]))
            counts = (df.select(each.alias("_v")).select("_v.*").filter(F.col("key").isNotNull())
                        .groupBy("col", "key").agg(F.count(F.lit(1)).alias("n")))
            which = None        # the tests of a column
            for c in keys:
                ids = F.array(*[F.lit(i) for i, col, _, _ in keyed if col == c])
                which = F.when(F.col("col") == c, ids) if which is None else which.when(F.col("col") == c, ids)
            values = counts.select(F.explode(which).alias("test"), "key", "n")
            linked = [(i, a) for i, _, k, a in keyed if k == "relationships"]
            found = F.lit(False)
            if linked:
                parents = union_all([models[a[0]].select(F.lit(i).alias("test"), F.col(a[1]).cast("string").alias("key")).distinct() for i, a in linked])
                values, found = values.join(parents.withColumn("there", F.lit(True)), ["test", "key"], "left"), F.coalesce("there", F.lit(False))
            bad = F.when(F.col("test").isin([i for i, _, k, _ in keyed if k == "unique"]), (F.col("n") > 1).cast("long")).otherwise(
                F.when(~found, F.col("n")).otherwise(0))
            figures.append(Figures(model, values.agg(*[F.coalesce(F.sum(F.when(F.col("test") == i, bad)), F.lit(0)).alias(f"_x{i}") for i, _, _, _ in keyed])))
        rows[model] = [lambda get, i=i, c=c, k=k, model=model: _generic(k, model, c, get(f"_x{i}"), layer) for i, c, k, _ in mine]
    return fused_rows(figures, rows)


def grain_violations(df: DataFrame, table_name: str, key_col: str) -> DataFrame:
    """Rows returned = failures: keys that occur more than once."""
    return (df.groupBy(F.col(key_col).alias("key_value")).agg(F.count(F.lit(1)).alias("duplicate_count"))
              .filter(F.col("duplicate_count") > 1)
              .select(F.lit(table_name).alias("table_name"), F.lit(key_col).alias("grain_key"),
                      "key_value", "duplicate_count"))


def assert_not_empty(df: DataFrame, reason: str, count_alias: str = "row_count") -> DataFrame:
    """One failure row when ``df`` is empty, none otherwise."""
    return (df.agg(F.count(F.lit(1)).alias(count_alias)).filter(F.col(count_alias) == 0)
              .select(F.lit(reason).alias("failure_reason"), count_alias))


# ── freshness with warn / error levels ─────────────────────────────────────

def source_freshness(df: DataFrame, entity: str, ts_col: str, as_of_ts: dt.datetime,
                     warn_hours: float = 25, error_hours: float = 48) -> DataFrame:
    m = df.agg(F.max(F.col(ts_col).cast("timestamp")).alias("_latest"))
    age = hours_between(as_of_ts, F.col("_latest"))
    status = (F.when(F.col("_latest").isNull() | (age > error_hours), F.lit("error"))
               .when(age > warn_hours, F.lit("warn")).otherwise(F.lit("pass")))
    return rows_from(m, [result("source_freshness", entity, "source", status != "error", status,
                                round_half_up(age, 2), float(error_hours))])


# ── checks against history ─────────────────────────────────────────────────

def history_baselines(history: DataFrame, layer: str, as_of: dt.date, runs: int = S.ANOMALY_LOOKBACK_RUNS) -> DataFrame:
    """(entity, test_name, _base, _hist): avg(value) and number of the latest ``runs`` passed results before
    ``as_of`` of every table and test of a layer. One pass; a window spans one metric's runs only."""
    h = history.filter((F.col("layer") == layer) & F.col("passed") & (F.col("run_date") < F.lit(as_of)))
    w = Window.partitionBy("test_name", "entity").orderBy(F.col("run_date").desc(), F.col("run_timestamp").desc())
    latest = h.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= runs)
    return latest.groupBy("entity", "test_name").agg(F.avg("value").alias("_base"), F.count(F.lit(1)).alias("_hist"))


@dataclass(frozen=True)
class Drift:
    """A drift rule: today's figure (from named aggregates), the stored test whose values are its baseline, and the limit."""
    test_name: str
    baseline_test: str
    kind: str           # row_count (percent), metric (absolute) or null_rate (one-sided)
    today: Callable[[Get], Column]
    aggs: Mapping[str, Column]

    def row(self, entity: str, layer: str, get: Get) -> Column:
        today, base, hist = self.today(get).cast("double"), get(f"_base_{self.baseline_test}"), get(f"_hist_{self.baseline_test}")
        if self.kind == "row_count":
            dev, thr, value, always = F.when(base != 0, F.abs(today - base) / base * 100.0), S.ROW_COUNT_DRIFT_PCT, None, False
        elif self.kind == "metric":
            dev, thr, value, always = F.abs(today - base), S.METRIC_DRIFT_THRESHOLD, today, True
        else:
            dev, thr, value, always = today - base, S.NULL_RATE_DRIFT_THRESHOLD, today, True
        value = round_half_up(dev, 2) if value is None else round_half_up(value, 4)
        hist = F.coalesce(hist, F.lit(0))
        enough = (hist >= S.MIN_HISTORY_ROWS) & base.isNotNull() & today.isNotNull()
        # a metric's value is recorded also while history is short, so that a baseline can form
        return result(
            self.test_name, entity, layer, ~enough | (dev <= thr),
            F.when(~enough, F.concat(F.lit("insufficient history ("), _s(hist), F.lit(" runs) - skipped")))
             .when(dev <= thr, F.lit("within threshold")).otherwise(F.lit("FAIL - drift above threshold")),
            value if always else F.when(enough, value), thr)


def count_drift() -> Drift:
    """Today's count vs the mean of recent passed ``row_count_minimum`` values (percent)."""
    return Drift("row_count_drift", "row_count_minimum", "row_count", lambda get: get("_n"), {"_n": F.count(F.lit(1))})


def average_drift(col: str) -> Drift:
    """Absolute shift of ``avg(col)`` vs the mean of its own recent passed values."""
    return Drift("metric_drift", "metric_drift", "metric", lambda get: get("_avg"), {"_avg": F.avg(col)})


def null_drift(col: str) -> Drift:
    """One-sided: today's null rate may exceed the baseline by at most 0.02."""
    return Drift("null_rate_drift", "null_rate_drift", "null_rate", lambda get: get(f"_null_{col}") / F.greatest(get("_n"), F.lit(1)),
                 {"_n": F.count(F.lit(1)), f"_null_{col}": F.count_if(F.col(col).isNull())})


def _drift_of(df: DataFrame, history: DataFrame, entity: str, layer: str, as_of: dt.date, rule: Drift) -> DataFrame:
    """One rule of one table on its own."""
    return fused_rows([Figures(entity, df.agg(*[c.alias(n) for n, c in rule.aggs.items()]))],
                      {entity: [lambda get: rule.row(entity, layer, get)]}, history_baselines(history, layer, as_of))


def row_count_drift(df: DataFrame, history: DataFrame, entity: str, layer: str, as_of: dt.date) -> DataFrame:
    return _drift_of(df, history, entity, layer, as_of, count_drift())


def metric_drift(df: DataFrame, history: DataFrame, entity: str, layer: str, metric_col: str, as_of: dt.date) -> DataFrame:
    return _drift_of(df, history, entity, layer, as_of, average_drift(metric_col))


def null_rate_drift(df: DataFrame, history: DataFrame, entity: str, layer: str, col: str, as_of: dt.date) -> DataFrame:
    return _drift_of(df, history, entity, layer, as_of, null_drift(col))


# ── many tables in one plan ────────────────────────────────────────────────

@dataclass(frozen=True)
class Figures:
    """A one-row frame of named figures of a table."""
    entity: str
    row: DataFrame


WHOLE = ("bigint", "int", "smallint", "tinyint")


def _as_entries(f: Figures) -> DataFrame:
    """(name, n, x): one row a figure; whole numbers in ``n``, others in ``x``."""
    entries = [F.struct(F.lit(c).alias("name"), (F.col(c) if t in WHOLE else F.lit(None)).cast("long").alias("n"),
                        (F.lit(None) if t in WHOLE else F.col(c)).cast("double").alias("x")) for c, t in f.row.dtypes]
    return f.row.select(F.inline(F.array(*entries)))


def fused_rows(figures: Sequence[Figures], rows: Mapping[str, Sequence[Callable[[Get], Column]]],
               baselines: DataFrame | None = None) -> DataFrame:
    """Result rows of many tables from one plan.

    A table's figures, those of its raw input and the baselines of its drift checks are
    united and folded into one small map, from which its rows are built: no
    join, and no figure is computed twice. The tables' rows are united, so Spark runs all their scans as one job.
    """
    out = []
    for entity, builders in rows.items():
        mine = [f for f in figures if f.entity == entity]
        entries = [_as_entries(f) for f in mine]
        kinds = {c: "n" if t in WHOLE else "x" for f in mine for c, t in f.row.dtypes}
        if baselines is not None:
            b = baselines.filter(F.col("entity") == entity)
            entries.append(b.select(F.inline(F.array(
                F.struct(F.concat(F.lit("_base_"), "test_name").alias("name"), F.lit(None).cast("long").alias("n"), F.col("_base").alias("x")),
                F.struct(F.concat(F.lit("_hist_"), "test_name").alias("name"), F.col("_hist").alias("n"), F.lit(None).cast("double").alias("x"))))))
        folded = union_all(entries).agg(F.map_from_entries(F.collect_list(F.struct("name", F.struct("n", "x")))).alias("_m"))

        def get(name: str, kinds=kinds) -> Column:
            return F.try_element_at("_m", F.lit(name))[kinds.get(name) or ("x" if name.startswith("_base_") else "n")]
        if builders:
            out.append(rows_from(folded, [build(get) for build in builders]))
    return union_all(out)


def drift_backtest(series: DataFrame, kind: str, runs: int = S.ANOMALY_LOOKBACK_RUNS,
                   group_cols: Sequence[str] = ("entity", "layer")) -> DataFrame:
    """Evaluate a drift rule for every run of a metric history at once.

    ``series``: (group_cols..., run_date, value) of recorded, passed runs. Each
    run is compared with the mean of the ``runs`` runs before it; at least 3
    are required. ``kind``: 'row_count' (percent deviation, 15), 'metric'
    (absolute, 0.5) or 'null_rate' (one-sided increase, 0.02). The window
    holds one metric's runs, so its size is the number of runs, not rows.
    """
    w = Window.partitionBy(*group_cols).orderBy("run_date").rowsBetween(-runs, -1)
    s = (series.withColumn("_base", F.avg("value").over(w))
               .withColumn("_hist", F.count("value").over(w)))
    v, b = F.col("value"), F.col("_base")
    if kind == "row_count":
        dev, thr = F.when(b != 0, F.abs(v - b) / b * 100.0), S.ROW_COUNT_DRIFT_PCT
    elif kind == "metric":
        dev, thr = F.abs(v - b), S.METRIC_DRIFT_THRESHOLD
    elif kind == "null_rate":
        dev, thr = v - b, S.NULL_RATE_DRIFT_THRESHOLD
    else:
        raise ValueError(kind)
    enough = (F.col("_hist") >= S.MIN_HISTORY_ROWS) & b.isNotNull()
    return s.select(*group_cols, "run_date", F.col("value").cast("double").alias("value"),
                    F.when(enough, round_half_up(b, 4)).alias("baseline"),
                    F.when(enough, round_half_up(dev, 4)).alias("deviation"),
                    F.lit(float(thr)).alias("threshold"),
                    (~enough | F.coalesce(dev <= thr, F.lit(True))).alias("passed"))


def count_regression(series: DataFrame, max_drop_pct: float = S.REGRESSION_DROP_PCT,
                     group_cols: Sequence[str] = ("entity", "layer")) -> DataFrame:
    """Each successful run's count vs the previous successful run (warn when
    it dropped more than ``max_drop_pct``)."""
    w = Window.partitionBy(*group_cols).orderBy("run_timestamp")
    s = series.filter(F.col("status") == "SUCCESS").withColumn("previous_count", F.lag("row_count").over(w))
    drop = F.when(F.col("previous_count") > 0,
                  (F.col("previous_count") - F.col("row_count")) / F.col("previous_count") * 100.0)
    return s.select(*group_cols, "run_timestamp", "row_count", "previous_count",
                    round_half_up(drop, 2).alias("drop_pct"),
                    F.coalesce(drop > max_drop_pct, F.lit(False)).alias("regressed"))


def volume_change(series: DataFrame, growth_pct: float = 20.0, shrink_pct: float = 5.0,
                  group_cols: Sequence[str] = ("entity", "layer")) -> DataFrame:
    """Day-over-day change of a daily count; flags raw-layer growth above
    ``growth_pct`` and star-schema shrink above ``shrink_pct``."""
    w = Window.partitionBy(*group_cols).orderBy("run_date")
    s = series.withColumn("previous_count", F.lag("row_count").over(w))
    chg = F.when(F.col("previous_count") > 0,
                 (F.col("row_count") - F.col("previous_count")) / F.col("previous_count") * 100.0)
    flag = (F.when((F.col("layer") == "bronze") & (chg > growth_pct), F.lit("growth"))
             .when((F.col("layer") == "gold") & (chg < -shrink_pct), F.lit("shrink")))
    return s.select(*group_cols, "run_date", "row_count", "previous_count",
                    round_half_up(chg, 2).alias("change_pct"), flag.alias("alert"))


def audit_volume(audit: DataFrame, layer: str | None = None, growth_pct: float = 20.0, shrink_pct: float = 5.0) -> DataFrame:
    """``volume_change`` of the stored audit log: the last successful run of each table and day against
    that of its previous day, with the alert that its layer raises."""
    log = audit.filter((F.col("status") == "SUCCESS") & F.col("row_count").isNotNull())
    if layer:
        log = log.filter(F.col("layer") == layer)
    daily = log.groupBy("entity", "layer", "run_date").agg(F.max_by("row_count", "run_timestamp").alias("row_count"))
    return volume_change(daily, growth_pct, shrink_pct)


def summarize(results: DataFrame) -> DataFrame:
    """passed / failed counts and the overall verdict (one row)."""
    return results.agg(F.count_if(F.col("passed")).alias("passed_count"),
                       F.count_if(~F.col("passed")).alias("failed_count"),
                       (F.count_if(~F.col("passed")) == 0).alias("all_passed"))


# ── suites ─────────────────────────────────────────────────────────────────

def layer_specs(layer: str) -> list[TableChecks]:
    """The fixed per-layer check configuration."""
    floors = ({k: v.min_rows for k, v in S.ENTITIES.items()} if layer == "bronze" else S.SILVER_MIN_ROWS)
    fresh = ({"reviews": ("date", S.SOURCE_TS_FORMAT), "users": ("yelping_since", S.SOURCE_TS_FORMAT),
              "tips": ("date", S.SOURCE_TS_FORMAT)} if layer == "bronze" else
             {"reviews": ("review_date", None), "users": ("yelping_since", None),
              "tips": ("tip_date", None), "checkin_events": ("checkin_ts", None)})
    null_rate = NULL_DRIFT_COLUMNS
    specs = []
    for ent, floor in floors.items():
        fc = fresh.get(ent)
        specs.append(TableChecks(
            entity=ent, layer=layer, min_rows=floor,
            zero_null_cols=S.ZERO_NULL_COLUMNS[layer].get(ent, []),
            null_rate_cols=[null_rate[ent]] if ent in null_rate else [],
            stars_col="stars" if ent == "reviews" else None,
            freshness_col=fc[0] if fc else None, freshness_format=fc[1] if fc else None,
            freshness_hours=S.FRESHNESS_HOURS[layer],
            key_col=S.PRIMARY_KEYS.get(ent)))
    return specs


def run_layer_suite(tables: Mapping[str, DataFrame], layer: str, as_of_ts: dt.datetime,
                    run_date: dt.date | None = None, lookback_days: int = 3,
                    bronze: Mapping[str, DataFrame] | None = None, history: DataFrame | None = None,
                    floors: Mapping[str, int] | None = None, partitions: Mapping[str, Sequence[dt.date]] | None = None) -> DataFrame:
    """All checks of a layer over ``tables`` (entity -> DataFrame), as one plan.

    A table is read at most twice: every scalar figure, today's drift figures
    included, comes from one aggregate, the duplicate keys from a second.
    ``partitions``: dates of the stored partitions, where the caller can list them.

    ``history`` (stored results of earlier runs) adds the drift checks: row
    count of every table, average stars of the reviews, null rates of one
    column each. ``floors`` replaces row floors (0 where a table is not named).

    Raw tables hold one full snapshot per ``ingestion_date``, so the duplicate
    check looks at the latest snapshot only, and the lookback check lists the
    partitions. For the clean layer, ``bronze`` enables the loss check
    (distinct raw keys vs clean rows).
    """
    figures, rows, out = [], {}, []
    for spec in layer_specs(layer):
        e, df = spec.entity, tables.get(spec.entity)
        if df is None:
            continue
        if floors is not None:
            spec.min_rows = floors.get(e, 0)
        checks = scalar_checks(spec, df.columns, as_of_ts)
        aggs, build = dict(checks.aggs), list(checks.rows)
        out += [skipped(df.sparkSession, test, e, layer, why) for test, why in checks.skipped]
        if history is not None and run_date is not None:
            for rule in drift_rules(e, df.columns):
                aggs |= rule.aggs
                build.append(lambda get, rule=rule, e=e: rule.row(e, layer, get))
        raw = layer == "bronze" and run_date is not None
        if raw and "ingestion_date" in df.columns:
            aggs["_missing"] = _missing_dates(run_date, lookback_days, "ingestion_date", (partitions or {}).get(e))
            build.append(lambda get, e=e: _lookback_row(e, layer, lookback_days, get))
        elif raw:
            out.append(lookback_partitions_present(df, e, layer, run_date, lookback_days))
        figures.append(Figures(e, df.agg(*[c.alias(name) for name, c in aggs.items()])))
        key = spec.key_col
        if key and key not in df.columns:
            out.append(no_duplicate_keys(df, e, layer, key))
        elif key:
            one_day = raw and "ingestion_date" in df.columns
            figures.append(Figures(e, _key_counts(df.filter(F.col("ingestion_date") == F.lit(run_date)) if one_day else df, key)))
            build.append(lambda get, e=e, key=key: _duplicates_row(e, layer, key, get))
        if layer == "silver" and bronze and e in bronze and e in ("business", "reviews", "users", "tips"):
            figures.append(Figures(e, bronze[e].select(*S.ENTITIES[e].keys).distinct().agg(F.count(F.lit(1)).alias("_before"))))
            build.append(lambda get, e=e: _loss_row(e, layer, "bronze_silver_row_ratio", S.MAX_ROW_LOSS_PCT, get))
        rows[e] = build
    baselines = history_baselines(history, layer, run_date) if history is not None and run_date is not None else None
    return union_all(([fused_rows(figures, rows, baselines)] if rows else []) + out)


# The column whose null rate is followed, per table.
NULL_DRIFT_COLUMNS = {"reviews": "stars", "business": "city", "users": "average_stars"}


def drift_rules(entity: str, columns: Iterable[str]) -> list[Drift]:
    """The drift checks of a table."""
    rules = [count_drift()]
    if entity == "reviews":
        rules.append(average_drift("stars"))
    if NULL_DRIFT_COLUMNS.get(entity) in set(columns):
        rules.append(null_drift(NULL_DRIFT_COLUMNS[entity]))
    return rules


def read_history(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stored results of earlier runs (none yet: an empty frame)."""
    from strataflow.sources.tables import path_exists
    if not path_exists(spark, path):
        return spark.createDataFrame([], S.TEST_RESULT_HISTORY_SCHEMA)
    return spark.read.schema(S.TEST_RESULT_HISTORY_SCHEMA).format(fmt).load(path)


# ── single-run checks against the audit log, and result persistence ────────

def regression_vs_previous(current: DataFrame, audit: DataFrame, entity: str, layer: str,
                           max_drop_pct: float = S.REGRESSION_DROP_PCT) -> DataFrame:
    """Warn (failed row) when this run's count dropped more than ``max_drop_pct``
    below the latest successful run of the same table in the audit log."""
    prev = (audit.filter((F.col("entity") == entity) & (F.col("layer") == layer) & (F.col("status") == "SUCCESS"))
                 .agg(F.max_by("row_count", "run_timestamp").alias("_prev")))
    now = current.agg(F.count(F.lit(1)).alias("_now"))
    u = (now.select(F.col("_now").cast("long").alias("_now"), F.lit(None).cast("long").alias("_prev"))
            .unionByName(prev.select(F.lit(None).cast("long").alias("_now"), F.col("_prev").cast("long"))))
    m = u.agg(F.max("_now").alias("_now"), F.max("_prev").alias("_prev"))
    drop = F.when(F.col("_prev") > 0, (F.col("_prev") - F.col("_now")) / F.col("_prev") * 100.0)
    return rows_from(m, [result("count_regression", entity, layer, F.coalesce(drop <= max_drop_pct, F.lit(True)),
                                F.concat(F.lit("previous "), _s("_prev"), F.lit(", current "), _s("_now")),
                                round_half_up(drop, 2), max_drop_pct)])


def input_output_drop(before: DataFrame, after: DataFrame, entity: str, layer: str,
                      max_drop_pct: float = 10.0) -> DataFrame:
    """Rows lost between a job's input and output (alert above 10%)."""
    return row_loss(before, after, entity, max_drop_pct, test_name="input_output_drop", layer=layer)


def with_run(results: DataFrame, run_date: dt.date, run_ts: dt.datetime) -> DataFrame:
    from strataflow.functions.columns import ts_lit
    return results.select(*RESULT_COLS, F.lit(run_date).alias("run_date"), ts_lit(run_ts).alias("run_timestamp"))


def write_test_results(results: DataFrame, path: str, run_date: dt.date, run_ts: dt.datetime,
                       fmt: str = "parquet") -> None:
    """Append this run's results; they become the next runs' drift baseline."""
    with_run(results, run_date, run_ts).write.format(fmt).mode("append").save(path)
