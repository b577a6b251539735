"""Reusable Column expressions: keys, hashes, parsing, date windows, tiers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strataflow.schemas import SOURCE_TS_FORMAT


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def surrogate_key(*cols) -> Column:
    """md5 over the columns as strings, nulls as '' and '||' between parts.

    For a single column this is ``md5(coalesce(cast(x as string), ''))``.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]
    if len(parts) == 1:
        return F.md5(parts[0])
    return F.md5(F.concat_ws("||", *parts))


def record_hash(*cols) -> Column:
    """Change-detection hash over tracked attributes: md5 of '|'-joined strings,
    each null replaced by '' (so null and '' hash alike)."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]))


def ts_lit(value) -> Column:
    """Timestamp literal read in the session time zone (not the Python
    process's): datetimes and 'yyyy-MM-dd HH:mm:ss' text alike."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast("timestamp")


def scd2_columns(run_ts) -> list[Column]:
    """Metadata of a freshly opened history version."""
    ts = ts_lit(run_ts)
    return [ts.alias("valid_from"),
            F.lit(None).cast("timestamp").alias("valid_to"),
            F.lit(True).alias("is_current")]


def parse_source_ts(col, fmt: str = SOURCE_TS_FORMAT) -> Column:
    """Parse source timestamp text; malformed text becomes null (never raises)."""
    return F.try_to_timestamp(_c(col), F.lit(fmt))


def round_half_up(col, digits: int = 0) -> Column:
    """Round half up in binary arithmetic: ``floor(x * 10^d + 0.5) / 10^d``.

    Spark's ``round`` rounds the decimal text of a double while other engines
    round its binary value; this form gives the same answer everywhere.
    """
    scale = 10 ** digits
    return (F.floor(_c(col) * F.lit(float(scale)) + F.lit(0.5)).cast("double") / F.lit(float(scale)))


def improvement_tier(col) -> Column:
    # Tier labels and their lower bounds.
    c = _c(col)
    return (F.when(c >= 2.0, F.lit("Major improvement"))
             .when(c >= 1.5, F.lit("Strong improvement"))
             .otherwise(F.lit("Improvement")))


def elite_flags(elite_col="elite") -> tuple[Column, Column]:
    """(is_elite, elite_years_count) of a packed ``"2015,2016"`` string: one year more than commas."""
    packed = _c(elite_col)
    is_elite = F.coalesce(F.length(F.trim(packed)) > 0, F.lit(False))
    commas = F.length(packed) - F.length(F.translate(packed, ",", ""))
    return is_elite, F.when(is_elite, commas + 1).otherwise(0)


def lookback_dates(run_date: dt.date, days: int) -> list[dt.date]:
    """``[run_date-(days-1) ... run_date]`` (a handful of driver-side dates)."""
    return [run_date - dt.timedelta(days=days - 1 - i) for i in range(days)]


def lookback_predicate(col, run_date: dt.date, days: int) -> Column:
    """Partition filter ``col between run_date-(days-1) and run_date``; prunes
    date partitions statically."""
    start = run_date - dt.timedelta(days=days - 1)
    return _c(col).between(F.lit(start), F.lit(run_date))


def as_of_window(ts_col, as_of: dt.date, months: int = 12) -> tuple[Column, Column]:
    """(recent, historical) predicates around ``as_of``.

    recent = [as_of - months, as_of + 1 day); historical = before as_of - months.
    """
    ts = _c(ts_col)
    cut = F.add_months(F.lit(as_of), -months).cast("timestamp")
    end = F.date_add(F.lit(as_of), 1).cast("timestamp")
    return (ts >= cut) & (ts < end), ts < cut


def hours_between(later, earlier) -> Column:
    """Fractional hours from ``earlier`` to ``later`` (timestamps)."""
    later = ts_lit(later) if not isinstance(later, (str, Column)) else _c(later).cast("timestamp")
    earlier = ts_lit(earlier) if not isinstance(earlier, (str, Column)) else _c(earlier).cast("timestamp")
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3_600_000_000.0)


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, both ends inclusive (``explode(sequence(...))``)."""
    return (spark.range(1)
            .select(F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day")))
                    .alias("full_date")))


def add_missing_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Add every column of ``schema`` that ``df`` lacks as a typed null."""
    have = set(df.columns)
    for f in schema.fields:
        if f.name not in have:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df
