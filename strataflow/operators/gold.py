"""Star schema: staging projections, dimensions and facts.

Dimension joins follow one rule: ``dim_date`` has a size fixed by its two
bounds (one row per day), so it is broadcast after that bound is checked;
business and user dimensions grow with the data and are left to the planner
(AQE turns a join into a broadcast at run time only when the measured side is small).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.columns import date_spine, surrogate_key

# Broadcast bound for the date dimension: ~64 bytes a row in memory.
DATE_DIM_ROW_BYTES = 64
DATE_DIM_BROADCAST_BYTES = 32 * 1024 * 1024


# ── staging projections ────────────────────────────────────────────────────
# The columns each staging model keeps and the names they get, which are the star schema's contract.

def stg_business(silver_business: DataFrame) -> DataFrame:
    return (silver_business.filter(F.col("business_id").isNotNull())
            .select("business_id", F.col("name").alias("business_name"), "city", "state",
                    "postal_code", "latitude", "longitude",
                    F.col("stars").alias("overall_stars"),
                    F.col("review_count").alias("total_review_count"),
                    F.col("is_open").alias("is_currently_open")))


def stg_reviews(silver_reviews: DataFrame) -> DataFrame:
    return (silver_reviews.filter(F.col("review_id").isNotNull() & F.col("review_date").isNotNull())
            .select("review_id", "business_id", "user_id",
                    F.col("stars").cast("double").alias("review_stars"),
                    F.col("review_date").alias("reviewed_at"),
                    F.col("useful").alias("useful_votes"),
                    F.col("funny").alias("funny_votes"),
                    F.col("cool").alias("cool_votes"),
                    F.length("text").alias("review_length_chars"),
                    "year", "month"))


def stg_users(silver_users: DataFrame) -> DataFrame:
    return (silver_users.filter(F.col("user_id").isNotNull())
            .select("user_id",
                    F.col("name").alias("user_name"),
                    F.col("review_count").alias("lifetime_review_count"),
                    F.col("average_stars").alias("lifetime_avg_stars"),
                    "is_elite", "elite_years_count",
                    F.col("fans").alias("fan_count"),
                    F.year("yelping_since").alias("yelping_since_year"),
                    "useful", "funny", "cool"))


def stg_checkins(silver_checkins: DataFrame) -> DataFrame:
    return (silver_checkins
            .filter(F.col("checkin_id").isNotNull() & F.col("business_id").isNotNull()
                    & F.col("checkin_ts").isNotNull())
            .select("checkin_id", "business_id", "checkin_ts", "checkin_hour",
                    "checkin_day_of_week", "year", "month"))


# ── dimensions ─────────────────────────────────────────────────────────────

def dim_date(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Calendar dimension, one row per day in ``[start, end]`` (end inclusive)."""
    d = F.col("full_date")
    return (date_spine(spark, start, end)
            .select(surrogate_key("full_date").alias("date_id"), "full_date",
                    F.year(d).alias("year"), F.month(d).alias("month"),
                    F.quarter(d).alias("quarter"),
                    F.dayofweek(d).alias("day_of_week"),
                    F.date_format(d, "EEEE").alias("day_name"),
                    F.weekofyear(d).alias("week_of_year"),
                    F.dayofweek(d).isin(1, 7).alias("is_weekend")))


def date_dim_fits_broadcast(start: dt.date, end: dt.date) -> bool:
    """The date dimension's size is known from its bounds: check it before broadcasting."""
    days = (end - start).days + 1
    return days * DATE_DIM_ROW_BYTES <= DATE_DIM_BROADCAST_BYTES


def bounded_dates(dates: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return F.broadcast(dates) if date_dim_fits_broadcast(start, end) else dates


def dim_business(silver_business: DataFrame, primary: DataFrame) -> DataFrame:
    """Business dimension (latest state) with its primary category."""
    b = stg_business(silver_business)
    return (b.join(primary, "business_id", "left")
             .select("business_id", F.col("business_name").alias("name"), "city", "state",
                     "postal_code", "latitude", "longitude",
                     F.col("overall_stars").alias("stars"),
                     F.col("total_review_count").alias("review_count"),
                     F.col("is_currently_open").alias("is_open"),
                     F.coalesce("primary_category", F.lit("Unknown")).alias("primary_category")))


def dim_user(silver_users: DataFrame) -> DataFrame:
    """User dimension (latest state). ``name`` is tagged as personal data."""
    u = stg_users(silver_users)
    return u.select(
        "user_id",
        F.col("user_name").alias("name", metadata={"pii": True}),
        F.col("lifetime_review_count").alias("review_count"),
        F.col("lifetime_avg_stars").alias("average_stars"),
        "is_elite", "elite_years_count", "fan_count", "yelping_since_year",
        F.col("useful").alias("total_useful_votes"),
        F.col("funny").alias("total_funny_votes"),
        F.col("cool").alias("total_cool_votes"))


# ── facts ──────────────────────────────────────────────────────────────────

def with_date_id(df: DataFrame, ts_col: str, dates: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    d = bounded_dates(dates.select("date_id", "full_date"), start, end)
    return df.join(d, F.to_date(F.col(ts_col)) == d.full_date, "left").drop("full_date")


def date_id_last(fact: DataFrame, ts_col: str, dates: DataFrame, start: dt.date, end: dt.date):
    """``fact`` without its date key, and the step that looks it up again where the rows are written, so that the
    key does not travel with them. With a calendar too long to broadcast: ``fact`` itself and None."""
    if not date_dim_fits_broadcast(start, end):
        return fact, None

    def finish(df: DataFrame) -> DataFrame:
        return with_date_id(df, ts_col, dates, start, end).select(*fact.columns, *[c for c in df.columns if c not in fact.columns])
    return fact.drop("date_id"), finish


def fact_reviews(silver_reviews: DataFrame, dates: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """One row per review. Keeps ``reviewed_at`` so incremental loads can slice on it."""
    r = stg_reviews(silver_reviews)
    return (with_date_id(r, "reviewed_at", dates, start, end)
            .filter(F.col("review_id").isNotNull())
            .select("review_id", "business_id", "user_id", "date_id", "review_stars",
                    "useful_votes", "funny_votes", "cool_votes", "review_length_chars",
                    "reviewed_at", "year", "month"))


def fact_checkins(silver_checkins: DataFrame, dates: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """One row per check-in event. Keeps ``checkin_ts`` for incremental loads."""
    c = stg_checkins(silver_checkins)
    return (with_date_id(c, "checkin_ts", dates, start, end)
            .filter(F.col("checkin_id").isNotNull())
            .select("checkin_id", "business_id", "date_id", "checkin_hour",
                    "checkin_day_of_week", "checkin_ts", "year", "month"))
