"""Business reports over the star schema (and one over the clean layer).

Pattern used throughout: aggregate the fact by its own foreign key first
(partial, map-side aggregation shrinks a hot key to one row per task), then
join the much smaller result to the dimension, then re-aggregate by the
dimension's attributes. Averages travel as (sum, count) pairs so the
two-level result equals a one-level ``avg``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions.columns import as_of_window, improvement_tier, round_half_up
from strataflow.operators.running import running_totals

# Reference defaults of the reports.
MIN_RECENT_REVIEWS = 10
MIN_IMPROVEMENT = 1.0
TOP_BY_CITY_LIMIT = 100
ACTIVE_REVIEWERS_LIMIT = 50
MIN_REVIEWS_PER_GROUP = 10


def _add_months(d: dt.date, months: int) -> dt.date:
    """Calendar month shift, clamping the day (29 Feb -> 28 Feb)."""
    import calendar
    m = d.month - 1 + months
    y, m = d.year + m // 12, m % 12 + 1
    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def _avg(sum_col: str, cnt_col: str) -> F.Column:
    return F.col(sum_col) / F.col(cnt_col)


# ── rising stars ───────────────────────────────────────────────────────────

def rising_star_candidates(reviews: DataFrame, as_of: dt.date, min_reviews: int = MIN_RECENT_REVIEWS,
                           min_improvement: float = MIN_IMPROVEMENT, ts_col: str = "reviewed_at",
                           stars_col: str = "review_stars", id_col: str = "review_id") -> DataFrame:
    """Businesses whose last-12-month average beats their earlier average.

    One pass over the reviews computes both windows (conditional aggregates)
    instead of two scans and a join; requiring both averages to exist keeps
    the inner-join meaning (no earlier reviews -> no baseline -> excluded).
    """
    recent, hist = as_of_window(ts_col, as_of)
    stars = F.col(stars_col)
    agg = reviews.groupBy("business_id").agg(
        F.avg(F.when(recent, stars)).alias("_recent"),
        F.count(F.when(recent, F.col(id_col))).alias("review_count_recent"),
        F.avg(F.when(hist, stars)).alias("_hist"))
    cand = agg.filter((F.col("review_count_recent") >= min_reviews)
                      & F.col("_recent").isNotNull() & F.col("_hist").isNotNull()
                      & (F.col("_recent") >= F.col("_hist") + F.lit(min_improvement)))
    return cand.select(
        "business_id",
        round_half_up("_recent", 2).alias("avg_stars_recent"),
        round_half_up("_hist", 2).alias("avg_stars_historical"),
        round_half_up(F.col("_recent") - F.col("_hist"), 2).alias("rating_improvement"),
        "review_count_recent")


def _ordered(df: DataFrame, ordered: bool, *cols) -> DataFrame:
    """Reports are small aggregates: sorting them globally is cheap."""
    return df.orderBy(*cols) if ordered else df


def rising_stars(fact: DataFrame, dim_business: DataFrame, as_of: dt.date,
                 min_reviews: int = MIN_RECENT_REVIEWS, min_improvement: float = MIN_IMPROVEMENT,
                 ordered: bool = True) -> DataFrame:
    """Rising-star report with business attributes and an improvement tier."""
    cand = rising_star_candidates(fact, as_of, min_reviews, min_improvement)
    b = dim_business.select("business_id", F.col("name").alias("business_name"), "city", "state",
                            "primary_category")
    out = (cand.join(b, "business_id", "inner")
               .select("business_id", "business_name", "city", "state", "primary_category",
                       "avg_stars_recent", "avg_stars_historical", "rating_improvement",
                       "review_count_recent",
                       improvement_tier("rating_improvement").alias("improvement_tier")))
    return _ordered(out, ordered, F.col("rating_improvement").desc(), "business_id")


def rising_stars_from_silver(silver_reviews: DataFrame, silver_business: DataFrame, as_of: dt.date,
                             min_reviews: int = MIN_RECENT_REVIEWS,
                             min_improvement: float = MIN_IMPROVEMENT, ordered: bool = True) -> DataFrame:
    """The same question answered straight from the clean layer."""
    cand = rising_star_candidates(silver_reviews, as_of, min_reviews, min_improvement,
                                  ts_col="review_date", stars_col="stars")
    out = (cand.join(silver_business.select("business_id", "name"), "business_id", "inner")
               .select("business_id", "name", "avg_stars_recent", "avg_stars_historical",
                       "rating_improvement", "review_count_recent"))
    return _ordered(out, ordered, F.col("rating_improvement").desc(), "business_id")


# ── trends ─────────────────────────────────────────────────────────────────

def review_trends(fact: DataFrame, dates: DataFrame, ordered: bool = True) -> DataFrame:
    """Monthly review volume, rating, useful votes and length."""
    d = dates.select("date_id", "year", "month")
    j = fact.select("date_id", "review_id", "review_stars", "useful_votes", "review_length_chars").join(d, "date_id")
    return (j.groupBy("year", "month")
             .agg(F.count("review_id").alias("total_reviews"),
                  F.avg("review_stars").alias("_r"), F.avg("useful_votes").alias("_u"),
                  F.avg("review_length_chars").alias("_l"))
             .select("year", "month",
                     F.date_format(F.make_date("year", "month", F.lit(1)), "yyyy-MM").alias("year_month"),
                     "total_reviews",
                     round_half_up("_r", 2).alias("avg_rating"),
                     round_half_up("_u", 2).alias("avg_useful_votes"),
                     round_half_up("_l", 0).alias("avg_review_length"))
             .transform(lambda df: _ordered(df, ordered, "year", "month")))


def review_volume(fact: DataFrame, dates: DataFrame, ordered: bool = True) -> DataFrame:
    """Reviews and average rating per calendar month."""
    d = dates.select("date_id", "year", "month")
    return (fact.select("date_id", "review_id", "review_stars").join(d, "date_id")
                .groupBy("year", "month")
                .agg(F.count("review_id").alias("total_reviews"), F.avg("review_stars").alias("_r"))
                .select("year", "month", "total_reviews", round_half_up("_r", 2).alias("avg_rating"))
                .transform(lambda df: _ordered(df, ordered, "year", "month")))


# ── top lists ──────────────────────────────────────────────────────────────

def _per_business(fact: DataFrame, *extra_keys: str) -> DataFrame:
    return (fact.groupBy("business_id", *extra_keys)
                .agg(F.count("review_id").alias("_n"), F.sum("review_stars").alias("_s"),
                     F.count("review_stars").alias("_sc")))


def top_businesses_by_year(fact: DataFrame, dim_business: DataFrame, dates: DataFrame,
                           min_reviews: int = MIN_REVIEWS_PER_GROUP) -> DataFrame:
    """Per business and review year: average rating, with at least ``min_reviews``."""
    d = dates.select("date_id", "year")
    per = (_per_business(fact.select("business_id", "date_id", "review_id", "review_stars").join(d, "date_id"), "year")
           .filter(F.col("_n") >= min_reviews))
    b = dim_business.select("business_id", F.col("name").alias("business_name"), "city", "primary_category")
    return (per.join(b, "business_id")
               .select("business_id", "business_name", "city", "primary_category", "year",
                       round_half_up(_avg("_s", "_sc"), 2).alias("avg_rating"),
                       F.col("_n").alias("total_reviews")))


def top_by_city_category(fact: DataFrame, dim_business: DataFrame, dates: DataFrame, year: int,
                         min_reviews: int = MIN_REVIEWS_PER_GROUP, limit: int | None = TOP_BY_CITY_LIMIT) -> DataFrame:
    """Best-rated (city, category, name) groups in one year; a top-k report.

    The fact's own ``year`` column is filtered too: on a year/month partitioned
    fact that prunes partitions, which a filter on the date dimension alone
    cannot (the join key is ``date_id``)."""
    d = dates.filter(F.col("year") == year).select("date_id")
    f = fact.filter(F.col("year") == year) if "year" in fact.columns else fact
    per = _per_business(f.select("business_id", "date_id", "review_id", "review_stars").join(d, "date_id"))
    b = dim_business.filter(F.col("primary_category").isNotNull()).select("business_id", "city", "primary_category", "name")
    g = (per.join(b, "business_id")
            .groupBy("city", "primary_category", "name")
            .agg(F.sum("_n").alias("total_reviews"), F.sum("_s").alias("_s"), F.sum("_sc").alias("_sc"))
            .filter(F.col("total_reviews") >= min_reviews)
            .select("city", "primary_category", "name",
                    round_half_up(_avg("_s", "_sc"), 2).alias("avg_rating"), "total_reviews"))
    ordered = g.orderBy(F.col("avg_rating").desc(), F.col("total_reviews").desc(), "city",
                        "primary_category", "name")
    return ordered.limit(limit) if limit is not None else ordered


# ── users ──────────────────────────────────────────────────────────────────

def _per_user(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("user_id")
                .agg(F.count("review_id").alias("_n"),
                     F.sum("review_stars").alias("_s"), F.count("review_stars").alias("_sc"),
                     F.sum("useful_votes").alias("_u"), F.count("useful_votes").alias("_uc"),
                     F.sum("review_length_chars").alias("_l"), F.count("review_length_chars").alias("_lc")))


def elite_behaviour(fact: DataFrame, dim_user: DataFrame, ordered: bool = True) -> DataFrame:
    """Elite vs non-elite reviewers: volume, stars given, useful votes, length."""
    g = (_per_user(fact).join(dim_user.select("user_id", "is_elite"), "user_id")
         .groupBy("is_elite")
         .agg(*[F.sum(c).alias(c) for c in ("_n", "_s", "_sc", "_u", "_uc", "_l", "_lc")]))
    out = g.select("is_elite", F.col("_n").alias("total_reviews"),
                   round_half_up(_avg("_s", "_sc"), 2).alias("avg_stars_given"),
                   round_half_up(_avg("_u", "_uc"), 2).alias("avg_useful_votes"),
                   round_half_up(_avg("_l", "_lc"), 0).alias("avg_review_length_chars"))
    return _ordered(out, ordered, F.col("is_elite").desc())


def active_reviewers(fact: DataFrame, dim_user: DataFrame, limit: int = ACTIVE_REVIEWERS_LIMIT) -> DataFrame:
    """Top reviewers by reviews written (ties broken by user id)."""
    u = dim_user.select("user_id", "name", "is_elite", "fan_count")
    g = (_per_user(fact).join(u, "user_id")
         .select("user_id", "name", "is_elite", "fan_count", F.col("_n").alias("reviews_written"),
                 round_half_up(_avg("_s", "_sc"), 2).alias("avg_stars_given")))
    return g.orderBy(F.col("reviews_written").desc(), F.col("user_id")).limit(limit)


# ── check-ins ──────────────────────────────────────────────────────────────

def peak_checkins(fact_checkins: DataFrame, dim_business: DataFrame, ordered: bool = True) -> DataFrame:
    """Check-ins per (primary category, day of week, hour)."""
    per = (fact_checkins.groupBy("business_id", "checkin_day_of_week", "checkin_hour")
                        .agg(F.count("checkin_id").alias("_n")))
    b = dim_business.filter(F.col("primary_category").isNotNull()).select("business_id", "primary_category")
    return (per.join(b, "business_id")
               .groupBy("primary_category", "checkin_day_of_week", "checkin_hour")
               .agg(F.sum("_n").alias("total_checkins"))
               .transform(lambda df: _ordered(df, ordered, "primary_category", F.col("total_checkins").desc(),
                                              "checkin_day_of_week", "checkin_hour")))


# ── activity gaps ──────────────────────────────────────────────────────────

def no_recent_reviews(fact: DataFrame, dim_business: DataFrame, dates: DataFrame, as_of: dt.date,
                      ordered: bool = True) -> DataFrame:
    """Open businesses without a review in the 12 months up to ``as_of``.

    ``distinct`` before the anti-join collapses the fact side map-side to one
    row per business and task; the anti-join itself never fans out.
    """
    recent, _ = as_of_window(F.col("full_date").cast("timestamp"), as_of)
    d = dates.select("date_id", "full_date").filter(recent).select("date_id")
    f = fact
    if "year" in fact.columns and "month" in fact.columns:
        # coarse (year, month) bounds of the window: partition pruning on a stored fact
        first = _add_months(as_of, -12)
        last = as_of + dt.timedelta(days=1)
        ym = F.col("year") * 100 + F.col("month")
        f = fact.filter(ym.between(first.year * 100 + first.month, last.year * 100 + last.month))
    reviewed = f.select("business_id", "date_id").join(d, "date_id").select("business_id").distinct()
    return (dim_business.filter(F.col("is_open") == F.lit(True))
                        .join(reviewed, "business_id", "left_anti")
                        .select("business_id", "name", "city", "primary_category",
                                F.col("review_count").alias("total_lifetime_reviews"))
                        .transform(lambda df: _ordered(df, ordered, F.col("total_lifetime_reviews").desc(),
                                                       "business_id")))


# ── running rating ─────────────────────────────────────────────────────────

def running_rating(fact: DataFrame, dim_business: DataFrame, dates: DataFrame, ordered: bool = False) -> DataFrame:
    """Per business, each review with the running average rating and count so
    far, ordered by review date then review id (a total order).

    The output has one row per review, so a global sort of it is a full range
    shuffle of fact-sized data; it is opt-in (``ordered=True``) rather than
    the default."""
    d = dates.select("date_id", F.col("full_date").alias("review_date"))
    base = fact.select("business_id", "review_id", "date_id", "review_stars").join(d, "date_id").drop("date_id")
    run = running_totals(base, ["business_id"], ["review_date", "review_id"],
                         sums={"_rs": "review_stars"},
                         counts={"_rc": "review_stars", "cumulative_review_count": "review_id"})
    b = dim_business.select("business_id", "name")
    out = (run.join(b, "business_id")
              .select("business_id", "name", "review_id", "review_date", "review_stars",
                      round_half_up(F.col("_rs") / F.col("_rc"), 2).alias("running_avg_stars"),
                      "cumulative_review_count"))
    return _ordered(out, ordered, "business_id", "review_date", "review_id")
