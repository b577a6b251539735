"""Entity registry (source contracts) and the schemas of the bookkeeping tables.

The source schemas are declared, never inferred: they are the contract the raw
layer enforces. Types and nullability follow the source contract of the five
review-platform entities.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType,
                               TimestampType)

S, D, L, I = StringType(), DoubleType(), LongType(), IntegerType()

# Declared source schemas (name, type, declared non-null).
BUSINESS_SCHEMA = StructType([
    StructField("business_id", S, False),
    StructField("name", S, True),
    StructField("city", S, True),
    StructField("state", S, True),
    StructField("postal_code", S, True),
    StructField("latitude", D, True),
    StructField("longitude", D, True),
    StructField("stars", D, True),
    StructField("review_count", L, True),
    StructField("is_open", I, True),
    StructField("categories", S, True),
    StructField("hours", S, True),
    StructField("attributes", S, True),
])

REVIEWS_SCHEMA = StructType([
    StructField("review_id", S, False),
    StructField("business_id", S, False),
    StructField("user_id", S, False),
    StructField("stars", I, True),
    StructField("date", S, True),
    StructField("text", S, True),
    StructField("useful", L, True),
    StructField("funny", L, True),
    StructField("cool", L, True),
])

USERS_SCHEMA = StructType([
    StructField("user_id", S, False),
    StructField("name", S, True),
    StructField("review_count", L, True),
    StructField("yelping_since", S, True),
    StructField("elite", S, True),
    StructField("fans", L, True),
    StructField("average_stars", D, True),
    StructField("useful", L, True),
    StructField("funny", L, True),
    StructField("cool", L, True),
])

CHECKINS_SCHEMA = StructType([
    StructField("business_id", S, False),
    StructField("date", S, True),
])

TIPS_SCHEMA = StructType([
    StructField("business_id", S, False),
    StructField("user_id", S, False),
    StructField("text", S, True),
    StructField("date", S, True),
    StructField("compliment_count", L, True),
])

# Timestamp text format of every source date field.
SOURCE_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class Entity:
    """One source entity: its contract, file name, row floor and freshness column."""
    name: str
    schema: StructType
    source_file: str
    min_rows: int
    freshness_col: str | None = None
    keys: tuple = field(default_factory=tuple)


# Source files, raw-layer row floors and freshness columns.
ENTITIES: dict[str, Entity] = {
    "business": Entity("business", BUSINESS_SCHEMA, "business.json", 100_000, None, ("business_id",)),
    "reviews": Entity("reviews", REVIEWS_SCHEMA, "review.json", 500_000, "date", ("review_id",)),
    "users": Entity("users", USERS_SCHEMA, "user.json", 100_000, "yelping_since", ("user_id",)),
    "checkins": Entity("checkins", CHECKINS_SCHEMA, "checkin.json", 50_000, None, ("business_id",)),
    "tips": Entity("tips", TIPS_SCHEMA, "tip.json", 50_000, "date", ("business_id", "user_id", "date")),
}

# Clean-layer row floors (exploded tables hold more rows than their source).
SILVER_MIN_ROWS = {
    "business": 100_000,
    "reviews": 500_000,
    "users": 100_000,
    "checkin_events": 200_000,
    "tips": 50_000,
    "business_categories": 200_000,
}

# Freshness thresholds in hours per layer.
FRESHNESS_HOURS = {"bronze": 26, "silver": 28}

# Columns that must hold no nulls, per layer and table.
ZERO_NULL_COLUMNS = {
    "bronze": {
        "business": ["business_id"],
        "reviews": ["review_id", "business_id", "user_id"],
        "users": ["user_id"],
        "checkins": ["business_id"],
        "tips": ["business_id", "user_id"],
    },
    "silver": {
        "business": ["business_id"],
        "reviews": ["review_id", "business_id", "user_id", "review_date"],
        "users": ["user_id", "is_elite"],
        "checkin_events": ["checkin_id", "business_id", "checkin_ts"],
        "tips": ["business_id", "user_id"],
        "business_categories": ["business_id", "category"],
    },
}

# Primary keys checked for duplicates.
PRIMARY_KEYS = {
    "business": "business_id",
    "reviews": "review_id",
    "users": "user_id",
    "checkin_events": "checkin_id",
}

# Drift thresholds.
ANOMALY_LOOKBACK_RUNS = 7
ROW_COUNT_DRIFT_PCT = 15.0
METRIC_DRIFT_THRESHOLD = 0.5
NULL_RATE_DRIFT_THRESHOLD = 0.02
MIN_HISTORY_ROWS = 3
MAX_ROW_LOSS_PCT = 5.0
REGRESSION_DROP_PCT = 10.0

# One audit record shape for every layer (nullable where a layer has no value).
AUDIT_SCHEMA = StructType([
    StructField("entity", S, True),
    StructField("layer", S, True),
    StructField("row_count", L, True),
    StructField("input_count", L, True),
    StructField("output_count", L, True),
    StructField("loss_pct", D, True),
    StructField("run_date", DateType(), True),
    StructField("run_timestamp", TimestampType(), True),
    StructField("status", S, True),
    StructField("error", S, True),
])

DRIFT_EVENT_SCHEMA = StructType([
    StructField("entity", S, True),
    StructField("layer", S, True),
    StructField("event_type", S, True),
    StructField("change_kind", S, True),
    StructField("column_name", S, True),
    StructField("expected_type", S, True),
    StructField("actual_type", S, True),
    StructField("run_date", DateType(), True),
    StructField("run_timestamp", TimestampType(), True),
])

TEST_RESULT_SCHEMA = StructType([
    StructField("test_name", S, False),
    StructField("entity", S, True),
    StructField("layer", S, True),
    StructField("passed", BooleanType(), False),
    StructField("message", S, True),
    StructField("value", D, True),
    StructField("threshold", D, True),
])

TEST_RESULT_HISTORY_SCHEMA = StructType(TEST_RESULT_SCHEMA.fields + [
    StructField("run_date", DateType(), True),
    StructField("run_timestamp", TimestampType(), True),
])
