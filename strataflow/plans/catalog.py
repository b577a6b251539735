"""Registered queries: name -> Spark job over a benchmark directory, and the
matching reference SQL.

Fixture parameters (``AS_OF`` and the thresholds below) size the reports for
the benchmark's few thousand businesses; the library defaults stay those of
the reference (10 recent reviews, 10 reviews per group).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from strataflow.plans import oracle_sql as O
from strataflow.plans import reports
from strataflow.plans.layers import Layers
from strataflow.sources.driver_tables import landing_files, reviews_bronze, table

AS_OF = dt.date(2001, 6, 1)
AS_OF_GAP = dt.date(2002, 1, 1)
MIN_RECENT = 3
MIN_IMPROVEMENT = 1.0
MIN_PER_YEAR = 5
MIN_CITY_GROUP = 3
TOP_YEAR = 1999

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def present(df: DataFrame) -> DataFrame:
    """Render timestamps as 'yyyy-MM-dd HH:mm:ss' and dates as 'yyyy-MM-dd' text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss").alias(f.name))
        elif isinstance(f.dataType, DateType):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


_LAYERS: dict[tuple, Layers] = {}


def layers_for(spark: SparkSession, sf_dir: str) -> Layers:
    """One lazy layer graph per (session, input folder).

    It holds plans only, no data: every action still reads the tables, but
    the Python-side plan building over the read-only inputs is paid once.
    """
    key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _LAYERS:
        _LAYERS[key] = Layers(spark, sf_dir)
    L = _LAYERS[key]
    L.__post_init__()           # re-apply the session settings
    return L


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: present(fn(layers_for(spark, sf_dir)))
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


TS = O.ts_text
W = O.with_

# ── reports ────────────────────────────────────────────────────────────────

_RISING_SQL = W(*O.REVIEWS_CHAIN, *O.BUSINESS_CHAIN) + f"""
select a.business_id, b.name as business_name, b.city, b.state, b.primary_category,
       {O.r2('a.r')} as avg_stars_recent, {O.r2('a.h')} as avg_stars_historical,
       {O.r2('a.r - a.h')} as rating_improvement, a.n as review_count_recent,
       case when {O.r2('a.r - a.h')} >= 2.0 then 'Major improvement'
            when {O.r2('a.r - a.h')} >= 1.5 then 'Strong improvement'
            else 'Improvement' end as improvement_tier
from (select business_id,
             avg(case when reviewed_at >= {O.d(AS_OF)} - interval 12 month
                       and reviewed_at < {O.d(AS_OF)} + interval 1 day then review_stars end) as r,
             count(case when reviewed_at >= {O.d(AS_OF)} - interval 12 month
                         and reviewed_at < {O.d(AS_OF)} + interval 1 day then review_id end) as n,
             avg(case when reviewed_at < {O.d(AS_OF)} - interval 12 month then review_stars end) as h
      from fact_reviews group by business_id) a
join dim_business b on a.business_id = b.business_id
where a.n >= {MIN_RECENT} and a.r is not null and a.h is not null and a.r >= a.h + {MIN_IMPROVEMENT}
"""


@register("rising_stars", _RISING_SQL)
def q_rising_stars(L: Layers) -> DataFrame:
    return reports.rising_stars(L.fact_reviews(), L.dim_business(), AS_OF, MIN_RECENT, MIN_IMPROVEMENT)


_RISING_SILVER_SQL = W(O.BRONZE_REVIEWS, O.SILVER_REVIEWS, O.BRONZE_BUSINESS, O.silver_business()) + f"""
select a.business_id, b.name,
       {O.r2('a.r')} as avg_stars_recent, {O.r2('a.h')} as avg_stars_historical,
       {O.r2('a.r - a.h')} as rating_improvement, a.n as review_count_recent
from (select business_id,
             avg(case when review_date >= {O.d(AS_OF)} - interval 12 month
                       and review_date < {O.d(AS_OF)} + interval 1 day then stars end) as r,
             count(case when review_date >= {O.d(AS_OF)} - interval 12 month
                         and review_date < {O.d(AS_OF)} + interval 1 day then review_id end) as n,
             avg(case when review_date < {O.d(AS_OF)} - interval 12 month then stars end) as h
      from silver_reviews group by business_id) a
join silver_business b on a.business_id = b.business_id
where a.n >= {MIN_RECENT} and a.r is not null and a.h is not null and a.r >= a.h + {MIN_IMPROVEMENT}
"""


@register("rising_stars_silver", _RISING_SILVER_SQL)
def q_rising_stars_silver(L: Layers) -> DataFrame:
    return reports.rising_stars_from_silver(L.silver("reviews"), L.silver("business"), AS_OF,
                                            MIN_RECENT, MIN_IMPROVEMENT)


@register("review_trends", W(O.BRONZE_REVIEWS, O.SILVER_REVIEWS) + f"""
select cast(year(review_date) as integer) as year, cast(month(review_date) as integer) as month, strftime(min(review_date), '%Y-%m') as year_month,
       count(*) as total_reviews, {O.r2('sum(stars) / count(stars)')} as avg_rating, {O.r2('sum(useful) / count(useful)')} as avg_useful_votes,
       {O.r2('sum(length(text)) / count(text)', 0)} as avg_review_length
from silver_reviews group by year(review_date), month(review_date)
""")
def q_review_trends(L: Layers) -> DataFrame:
    return reports.review_trends(L.fact_reviews(), L.dates())


@register("review_volume", W(O.BRONZE_REVIEWS, O.SILVER_REVIEWS) + f"""
select year, month, count(*) as total_reviews, {O.r2('sum(stars) / count(stars)')} as avg_rating
from silver_reviews group by all
""")
def q_review_volume(L: Layers) -> DataFrame:
    return reports.review_volume(L.fact_reviews(), L.dates())


@register("top_businesses_by_year", W(*O.REVIEWS_CHAIN, *O.BUSINESS_CHAIN) + f"""
select f.business_id, b.name as business_name, b.city, b.primary_category, dd.year,
       {O.r2('avg(f.review_stars)')} as avg_rating, count(f.review_id) as total_reviews
from fact_reviews f
join dim_business b on f.business_id = b.business_id
join dim_date dd on f.date_id = dd.date_id
group by f.business_id, b.name, b.city, b.primary_category, dd.year
having count(f.review_id) >= {MIN_PER_YEAR}
""")
def q_top_businesses_by_year(L: Layers) -> DataFrame:
    return reports.top_businesses_by_year(L.fact_reviews(), L.dim_business(), L.dates(), MIN_PER_YEAR)


# Rankings and behaviour, checked against the clean layer directly: totals per business or
# user first, then the attributes.
_CLEAN = (O.BRONZE_REVIEWS, O.SILVER_REVIEWS, O.BRONZE_BUSINESS, O.silver_business(), O.categories())
_FIRST_CATEGORY = "coalesce((select min(category) from business_categories c where c.business_id = b.business_id), 'Unknown')"
_CITY_GROUPS = f"""
, sums as (select business_id, count(*) as n, sum(stars) as s from silver_reviews where year = {TOP_YEAR} group by business_id),
labelled as (select b.city, {_FIRST_CATEGORY} as primary_category, b.name, n, s from sums join silver_business b using (business_id)),
city_groups as (select city, primary_category, name, {O.r2('sum(s) / sum(n)')} as avg_rating,
                       cast(sum(n) as bigint) as total_reviews from labelled group by all)
"""


@register("top_by_city_category", W(*_CLEAN) + _CITY_GROUPS + f"""
select * from city_groups where total_reviews >= {MIN_CITY_GROUP}
qualify row_number() over (order by avg_rating desc, total_reviews desc, city, primary_category, name) <= 100
""")
def q_top_by_city_category(L: Layers) -> DataFrame:
    return reports.top_by_city_category(L.fact_reviews(), L.dim_business(), L.dates(), TOP_YEAR,
                                        MIN_CITY_GROUP, 100)


@register("city_category_ratings", W(*_CLEAN) + _CITY_GROUPS + "select * from city_groups\n")
def q_city_category_ratings(L: Layers) -> DataFrame:
    """The scenario form of the city ranking: every group, no floor, no limit."""
    return reports.top_by_city_category(L.fact_reviews(), L.dim_business(), L.dates(), TOP_YEAR, 0, None)


_PER_USER = """
, per_user as (select user_id, count(*) as n, sum(stars) as s, sum(useful) as u, sum(length(text)) as chars
               from silver_reviews group by user_id)
"""
_CLEAN_USERS = (O.BRONZE_REVIEWS, O.SILVER_REVIEWS, O.ELITE, O.BRONZE_USERS, O.silver_users())


@register("elite_behaviour", W(*_CLEAN_USERS) + _PER_USER + f"""
select is_elite, cast(sum(n) as bigint) as total_reviews, {O.r2('sum(s) / sum(n)')} as avg_stars_given,
       {O.r2('sum(u) / sum(n)')} as avg_useful_votes, {O.r2('sum(chars) / sum(n)', 0)} as avg_review_length_chars
from per_user join silver_users using (user_id) group by is_elite
""")
def q_elite_behaviour(L: Layers) -> DataFrame:
    return reports.elite_behaviour(L.fact_reviews(), L.dim_user())


@register("active_reviewers", W(*_CLEAN_USERS) + _PER_USER + f"""
select user_id, name, is_elite, fans as fan_count, n as reviews_written, {O.r2('s / n')} as avg_stars_given
from silver_users join per_user using (user_id)
qualify row_number() over (order by n desc, user_id) <= 50
""")
def q_active_reviewers(L: Layers) -> DataFrame:
    return reports.active_reviewers(L.fact_reviews(), L.dim_user(), 50)


@register("peak_checkins", W(O.CHECKIN_ITEMS, O.SILVER_CHECKINS, O.BRONZE_BUSINESS, O.silver_business(), O.categories()) + f"""
, hourly as (select business_id, checkin_day_of_week, checkin_hour, count(*) as n from checkin_events group by all)
select {_FIRST_CATEGORY} as primary_category, checkin_day_of_week, checkin_hour, cast(sum(n) as bigint) as total_checkins
from hourly join silver_business b using (business_id) group by all
""")
def q_peak_checkins(L: Layers) -> DataFrame:
    return reports.peak_checkins(L.fact_checkins(), L.dim_business())


@register("no_recent_reviews", W(*_CLEAN) + f"""
select b.business_id, b.name, b.city, {_FIRST_CATEGORY} as primary_category, b.review_count as total_lifetime_reviews
from silver_business b
where b.is_open and not exists (
  select 1 from silver_reviews r where r.business_id = b.business_id
     and cast(r.review_date as date) between {O.d(AS_OF_GAP)} - interval 12 month and {O.d(AS_OF_GAP)})
""")
def q_no_recent_reviews(L: Layers) -> DataFrame:
    return reports.no_recent_reviews(L.fact_reviews(), L.dim_business(), L.dates(), AS_OF_GAP)


_RUNNING_SQL = W(*_CLEAN) + f"""
, totals as (select business_id, review_id, cast(review_date as date) as day, stars,
                    sum(stars) over so_far as s, row_number() over so_far as k
             from silver_reviews window so_far as (partition by business_id order by cast(review_date as date), review_id))
select business_id, b.name, review_id, cast(day as varchar) as review_date, t.stars as review_stars,
       {O.r2('s / k')} as running_avg_stars, k as cumulative_review_count
from silver_business b join totals t using (business_id)
"""


@register("running_rating", _RUNNING_SQL)
def q_running_rating(L: Layers) -> DataFrame:
    return reports.running_rating(L.fact_reviews(), L.dim_business(), L.dates())


# ── clean layer ────────────────────────────────────────────────────────────

@register("dedup_latest", W(O.BRONZE_REVIEWS) + """
select review_id, business_id, user_id, stars, date, text, useful, funny, cool,
       cast(ingestion_date as varchar) as ingestion_date
from (select *, row_number() over (partition by review_id order by ingestion_date desc nulls last,
             business_id desc nulls last, user_id desc nulls last, stars desc nulls last, date desc nulls last,
             text desc nulls last, useful desc nulls last, funny desc nulls last, cool desc nulls last) as rn
      from bronze_reviews) t
where rn = 1
""")
def q_dedup_latest(L: Layers) -> DataFrame:
    """Latest snapshot wins per review id over the raw window (no cleaning)."""
    from strataflow.operators.dedup import latest_wins
    return latest_wins(L.window("reviews"), ["review_id"], ["ingestion_date"])


@register("clean_reviews", W(O.BRONZE_REVIEWS, O.SILVER_REVIEWS) + f"""
select review_id, business_id, user_id, stars, text, useful, funny, cool,
       {TS('review_date')} as review_date, year, month from silver_reviews
""")
def q_clean_reviews(L: Layers) -> DataFrame:
    return L.silver("reviews")


@register("clean_business", W(O.BRONZE_BUSINESS, O.silver_business()) + """
select * from silver_business
""")
def q_clean_business(L: Layers) -> DataFrame:
    return L.silver("business").drop("hours", "attributes")


@register("explode_categories", W(O.BRONZE_BUSINESS, O.categories()) + """
select business_id, category from business_categories
""")
def q_explode_categories(L: Layers) -> DataFrame:
    return L.silver("business_categories")


@register("primary_category", W(O.BRONZE_BUSINESS, O.categories()) + """
select business_id, min(category) as primary_category from business_categories group by business_id
""")
def q_primary_category(L: Layers) -> DataFrame:
    return L.primary_category()


@register("clean_users", W(O.ELITE, O.BRONZE_USERS, O.silver_users()) + f"""
select user_id, name, review_count, {TS('yelping_since')} as yelping_since, fans, average_stars,
       useful, funny, cool, is_elite, elite_years_count from silver_users
""")
def q_clean_users(L: Layers) -> DataFrame:
    return L.silver("users")


@register("explode_checkins", W(O.CHECKIN_ITEMS, O.SILVER_CHECKINS) + f"""
select checkin_id, business_id, {TS('checkin_ts')} as checkin_ts, checkin_hour, checkin_day_of_week,
       year, month from checkin_events
""")
def q_explode_checkins(L: Layers) -> DataFrame:
    return L.silver("checkin_events")


@register("clean_tips", W(O.BRONZE_TIPS, O.SILVER_TIPS) + f"""
select business_id, user_id, text, compliment_count, {TS('tip_date')} as tip_date, year, month
from silver_tips
""")
def q_clean_tips(L: Layers) -> DataFrame:
    return L.silver("tips")


# ── star schema ────────────────────────────────────────────────────────────

@register("date_dim", W(O.DIM_DATE) + """
select date_id, cast(full_date as varchar) as full_date, year, month, quarter, day_of_week, day_name,
       week_of_year, is_weekend from dim_date
""")
def q_date_dim(L: Layers) -> DataFrame:
    return L.dim_date()


@register("dim_business", W(*O.BUSINESS_CHAIN) + "select * from dim_business\n")
def q_dim_business(L: Layers) -> DataFrame:
    return L.dim_business()


@register("dim_user", W(*O.USERS_CHAIN) + "select * from dim_user\n")
def q_dim_user(L: Layers) -> DataFrame:
    return L.dim_user()


@register("fact_reviews", W(*O.REVIEWS_CHAIN) + f"""
select review_id, business_id, user_id, date_id, review_stars, useful_votes, funny_votes, cool_votes,
       review_length_chars, {TS('reviewed_at')} as reviewed_at, year, month from fact_reviews
""")
def q_fact_reviews(L: Layers) -> DataFrame:
    return L.fact_reviews()


@register("fact_checkins", W(*O.CHECKINS_CHAIN) + f"""
select checkin_id, business_id, date_id, checkin_hour, checkin_day_of_week,
       {TS('checkin_ts')} as checkin_ts, year, month from fact_checkins
""")
def q_fact_checkins(L: Layers) -> DataFrame:
    return L.fact_checkins()


# ── data quality ───────────────────────────────────────────────────────────

from strataflow import schemas as S  # noqa: E402
from strataflow.operators import quality  # noqa: E402

AS_OF_TS = dt.datetime(2001, 6, 2, 0, 0, 0)
AS_OF_TS_TEXT = "2001-06-02 00:00:00"
RUN_DATE = O.RUN_DATE
LOOKBACK = 3

_SILVER_TABLES = {"business": "silver_business", "reviews": "silver_reviews", "users": "silver_users",
                  "checkin_events": "checkin_events", "tips": "silver_tips",
                  "business_categories": "business_categories"}
_BRONZE_TABLES = {"business": "bronze_business", "reviews": "bronze_reviews", "users": "bronze_users",
                  "checkins": "bronze_checkins", "tips": "bronze_tips"}


def _suite_sql(layer: str) -> str:
    names = _SILVER_TABLES if layer == "silver" else _BRONZE_TABLES
    parts = []
    for spec in quality.layer_specs(layer):
        t = names[spec.entity]
        key, key_table = spec.key_col, None
        if layer == "bronze" and key:
            key_table = f"(select * from {t} where ingestion_date = {O.d(RUN_DATE)})"
        parts += O.check_rows_sql(t, spec.entity, layer, spec.min_rows, spec.zero_null_cols,
                                  spec.null_rate_cols, spec.stars_col, spec.freshness_col,
                                  spec.freshness_format, spec.freshness_hours, AS_OF_TS_TEXT,
                                  key, key_table)
        if layer == "bronze":
            parts.append(O.lookback_rows_sql(t, spec.entity, layer, RUN_DATE, LOOKBACK))
    if layer == "silver":
        for ent in ("business", "reviews", "users", "tips"):
            parts.append(O.loss_row_sql(_BRONZE_TABLES[ent], _SILVER_TABLES[ent], ent,
                                        list(S.ENTITIES[ent].keys)))
    return O.union(parts)


_ALL_SILVER = (O.BRONZE_REVIEWS, O.SILVER_REVIEWS, O.BRONZE_BUSINESS, O.silver_business(), O.categories(),
               O.ELITE, O.BRONZE_USERS, O.silver_users(), O.CHECKIN_ITEMS, O.SILVER_CHECKINS,
               O.BRONZE_TIPS, O.SILVER_TIPS)


def _silver_tables(L: Layers) -> dict:
    return {k: L.silver(k) for k in _SILVER_TABLES}


@register("dq_silver_suite", W(*_ALL_SILVER) + _suite_sql("silver"))
def q_dq_silver_suite(L: Layers) -> DataFrame:
    bronze = {e: L.window(e) for e in ("business", "reviews", "users", "tips")}
    return quality.run_layer_suite(_silver_tables(L), "silver", AS_OF_TS, bronze=bronze)


@register("dq_bronze_suite", W(O.BRONZE_REVIEWS, O.BRONZE_BUSINESS, O.ELITE, O.BRONZE_USERS,
                               O.BRONZE_CHECKINS, O.BRONZE_TIPS) + _suite_sql("bronze"))
def q_dq_bronze_suite(L: Layers) -> DataFrame:
    tables = {e: L.bronze(e) for e in _BRONZE_TABLES}
    return quality.run_layer_suite(tables, "bronze", AS_OF_TS, run_date=RUN_DATE, lookback_days=LOOKBACK)


@register("dq_summary", W(*_ALL_SILVER) + f"""
select count(*) filter (where passed) as passed_count, count(*) filter (where not passed) as failed_count,
       count(*) filter (where not passed) = 0 as all_passed
from ({_suite_sql('silver')}) r
""")
def q_dq_summary(L: Layers) -> DataFrame:
    return quality.summarize(q_dq_silver_suite(L))


_GOLD_CTES = (*O.REVIEWS_CHAIN, *O.BUSINESS_CHAIN, *O.USERS_CHAIN, O.CHECKIN_ITEMS, O.SILVER_CHECKINS,
              O.FACT_CHECKINS)


@register("dq_gold_tests", W(*_GOLD_CTES) + O.union(
    [O.generic_test_sql(m, c, k, a) for m, c, k, a in quality.GOLD_COLUMN_TESTS]))
def q_dq_gold_tests(L: Layers) -> DataFrame:
    models = {"fact_reviews": L.fact_reviews(), "fact_checkins": L.fact_checkins(),
              "dim_business": L.dim_business(), "dim_user": L.dim_user(), "dim_date": L.dim_date()}
    return quality.run_column_tests(models)


@register("dq_grain", W(*O.REVIEWS_CHAIN, O.CHECKIN_ITEMS, O.SILVER_CHECKINS, O.FACT_CHECKINS) + """
select *, count(*) as duplicate_count
from (select unnest([{'table_name': 'fact_reviews', 'grain_key': 'review_id', 'key_value': review_id}], recursive := true) from fact_reviews
      union all select 'fact_checkins', 'checkin_id', checkin_id from fact_checkins) tagged
group by all having duplicate_count > 1
""")
def q_dq_grain(L: Layers) -> DataFrame:
    return (quality.grain_violations(L.fact_reviews(), "fact_reviews", "review_id")
            .unionByName(quality.grain_violations(L.fact_checkins(), "fact_checkins", "checkin_id")))


@register("dq_grain_raw", W(O.BRONZE_REVIEWS) + """
select 'bronze_reviews' as table_name, 'review_id' as grain_key, review_id as key_value, count(*) as duplicate_count
from bronze_reviews group by review_id having count(*) > 1
""")
def q_dq_grain_raw(L: Layers) -> DataFrame:
    return quality.grain_violations(L.bronze("reviews"), "bronze_reviews", "review_id")


@register("dq_rising_not_empty", W(*O.REVIEWS_CHAIN) + f"""
select 'rising star candidates returned zero rows' as failure_reason, count(*) as rising_star_count
from (select business_id from fact_reviews group by business_id
      having count(case when reviewed_at >= {O.d(AS_OF)} - interval 12 month
                         and reviewed_at < {O.d(AS_OF)} + interval 1 day then review_id end) >= {MIN_RECENT}
         and avg(case when reviewed_at >= {O.d(AS_OF)} - interval 12 month
                       and reviewed_at < {O.d(AS_OF)} + interval 1 day then review_stars end)
             >= avg(case when reviewed_at < {O.d(AS_OF)} - interval 12 month then review_stars end) + {MIN_IMPROVEMENT}) c
having count(*) = 0
""")
def q_dq_rising_not_empty(L: Layers) -> DataFrame:
    cand = reports.rising_star_candidates(L.fact_reviews(), AS_OF, MIN_RECENT, MIN_IMPROVEMENT)
    return quality.assert_not_empty(cand, "rising star candidates returned zero rows", "rising_star_count")


_FRESH_AS_OF = "2024-01-31 12:00:00"


def _age(latest: str) -> str:
    return f"((epoch_us(timestamp '{_FRESH_AS_OF}') - epoch_us(cast({latest} as timestamp))) / 3600000000.0)"


@register("dq_source_freshness", W(O.BRONZE_REVIEWS, O.SILVER_REVIEWS, O.ELITE, O.BRONZE_USERS, O.silver_users(), O.CHECKIN_ITEMS, O.SILVER_CHECKINS,
                                   O.BRONZE_TIPS, O.SILVER_TIPS, O.BRONZE_BUSINESS) + O.union([
    O._row("source_freshness", ent, "source", "status <> 'error'", "status", O.r2("age", 2), 48.0)
    + f" from (select age, case when age is null or age > 48 then 'error' when age > 25 then 'warn' else 'pass' end as status "
      f"from (select {_age(f'max({col})')} as age from {t}) m) s"
    for ent, t, col in [("reviews", "silver_reviews", "review_date"), ("users", "silver_users", "yelping_since"),
                        ("checkin_events", "checkin_events", "checkin_ts"), ("tips", "silver_tips", "tip_date"),
                        ("business", "bronze_business", "ingestion_date"),
                        ("business_categories", "bronze_business where categories is not null", "ingestion_date")]]))
def q_dq_source_freshness(L: Layers) -> DataFrame:
    """All sources; those without an event time go by the day their raw rows arrived."""
    ts, raw = dt.datetime(2024, 1, 31, 12, 0, 0), L.bronze("business")
    sources = {"reviews": (L.silver("reviews"), "review_date"), "users": (L.silver("users"), "yelping_since"),
               "checkin_events": (L.silver("checkin_events"), "checkin_ts"), "tips": (L.silver("tips"), "tip_date"),
               "business": (raw, "ingestion_date"), "business_categories": (raw.filter("categories is not null"), "ingestion_date")}
    return quality.union_all([quality.source_freshness(df, e, col, ts) for e, (df, col) in sources.items()])


# ── checks against history (every day of a derived daily history) ─────────

def _daily_series(L: Layers, value: F.Column, entity: str = "events", layer: str = "bronze",
                  source: DataFrame | None = None) -> DataFrame:
    ev = source if source is not None else table(L.spark, L.sf_dir, "events")
    return (ev.groupBy(F.to_date("ts").alias("run_date")).agg(value.alias("value"))
              .select(F.lit(entity).alias("entity"), F.lit(layer).alias("layer"), "run_date", "value"))


def _backtest_sql(series_sql: str, kind: str) -> str:
    thr = {"row_count": 15.0, "metric": 0.5, "null_rate": 0.02}[kind]
    dev = {"row_count": "case when base <> 0 then abs(value - base) / base * 100.0 end",
           "metric": "abs(value - base)", "null_rate": "value - base"}[kind]
    enough = "(hist >= 3 and base is not null)"
    return f"""
with s as ({series_sql}),
b as (select *, avg(value) over w as base, count(value) over w as hist from s
      window w as (partition by entity, layer order by run_date rows between 7 preceding and 1 preceding))
select entity, layer, cast(run_date as varchar) as run_date, cast(value as double) as value,
       case when {enough} then {O.r2('base', 4)} end as baseline,
       case when {enough} then {O.r2(dev, 4)} end as deviation,
       cast({thr} as double) as threshold,
       (not {enough}) or coalesce(({dev}) <= {thr}, true) as passed
from b
"""


_EV_DAY = "cast(ts as date)"


@register("dq_count_drift", _backtest_sql(
    f"select 'events' as entity, 'bronze' as layer, {_EV_DAY} as run_date, count(*) as value from events group by {_EV_DAY}",
    "row_count"))
def q_dq_count_drift(L: Layers) -> DataFrame:
    return quality.drift_backtest(_daily_series(L, F.count(F.lit(1))), "row_count")


@register("dq_metric_drift", _backtest_sql(
    f"select 'events' as entity, 'bronze' as layer, {_EV_DAY} as run_date, "
    f"avg(1 + cast(floor(value) as bigint) % 5) as value from events group by {_EV_DAY}", "metric"))
def q_dq_metric_drift(L: Layers) -> DataFrame:
    return quality.drift_backtest(
        _daily_series(L, F.avg(F.lit(1) + F.floor("value") % 5)), "metric")


@register("dq_null_drift", _backtest_sql(
    f"select 'tips' as entity, 'bronze' as layer, cast(try_strptime(date, '%Y-%m-%d %H:%M:%S') as date) as run_date, "
    f"count(*) filter (where user_id is null) / count(*) as value from ({O.BRONZE_TIPS.split(' as (', 1)[1].rsplit(')', 1)[0]}) t "
    f"group by cast(try_strptime(date, '%Y-%m-%d %H:%M:%S') as date)", "null_rate"))
def q_dq_null_drift(L: Layers) -> DataFrame:
    tips = L.bronze("tips").withColumn("ts", F.try_to_timestamp("date", F.lit(S.SOURCE_TS_FORMAT)))
    series = _daily_series(L, F.count_if(F.col("user_id").isNull()) / F.count(F.lit(1)),
                           entity="tips", source=tips)
    return quality.drift_backtest(series, "null_rate")


@register("dq_regression", f"""
with s as (select 'events' as entity, 'bronze' as layer, cast({_EV_DAY} as timestamp) as run_timestamp,
                  count(*) as row_count from events group by {_EV_DAY}),
p as (select *, lag(row_count) over (partition by entity, layer order by run_timestamp) as previous_count from s)
select entity, layer, {O.ts_text('run_timestamp')} as run_timestamp, row_count, previous_count,
       {O.r2('case when previous_count > 0 then (previous_count - row_count) / previous_count * 100.0 end', 2)} as drop_pct,
       coalesce(case when previous_count > 0 then (previous_count - row_count) / previous_count * 100.0 end > 10.0, false) as regressed
from p
""")
def q_dq_regression(L: Layers) -> DataFrame:
    ev = table(L.spark, L.sf_dir, "events")
    series = (ev.groupBy(F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("row_count"))
                .select(F.lit("events").alias("entity"), F.lit("bronze").alias("layer"),
                        F.col("d").cast("timestamp").alias("run_timestamp"), "row_count",
                        F.lit("SUCCESS").alias("status")))
    return quality.count_regression(series)


@register("dq_volume_change", f"""
with s as (select 'events' as entity, 'bronze' as layer, {_EV_DAY} as run_date, count(*) as row_count
           from events group by {_EV_DAY}),
p as (select *, lag(row_count) over (partition by entity, layer order by run_date) as previous_count from s)
select entity, layer, cast(run_date as varchar) as run_date, row_count, previous_count,
       {O.r2('case when previous_count > 0 then (row_count - previous_count) / previous_count * 100.0 end', 2)} as change_pct,
       case when layer = 'bronze' and (row_count - previous_count) / previous_count * 100.0 > 20.0 then 'growth'
            when layer = 'gold' and (row_count - previous_count) / previous_count * 100.0 < -5.0 then 'shrink' end as alert
from p
""")
def q_dq_volume_change(L: Layers) -> DataFrame:
    ev = table(L.spark, L.sf_dir, "events")
    series = (ev.groupBy(F.to_date("ts").alias("run_date")).agg(F.count(F.lit(1)).alias("row_count"))
                .select(F.lit("events").alias("entity"), F.lit("bronze").alias("layer"), "run_date", "row_count"))
    return quality.volume_change(series)


# ── upsert and history ─────────────────────────────────────────────────────

from strataflow.functions.columns import surrogate_key  # noqa: E402
from strataflow.operators import history as hist  # noqa: E402
from strataflow.operators.upsert import incremental_slice, read_keyed, upsert  # noqa: E402
from strataflow.session import scratch_path, shuffles_dropped  # noqa: E402
from strataflow.sources.tables import write_table  # noqa: E402

_FACT_COLS = ["review_id", "business_id", "user_id", "date_id", "review_stars", "useful_votes", "funny_votes",
              "cool_votes", "review_length_chars", "reviewed_at", "year", "month"]


# Two loads by the day a review arrived. First load: all but the late ones (useful_votes 2); 3 is dated far in the
# future, 6 has no month. Second load: 1 corrected and moved 40 days, 2 late (old event times), 4 moved to no month;
# 5 is corrected, too, but arrived before the lookback and must not be taken again.
_MOVED = "interval 40 day"
_UPSERT_COLS = ("review_id, business_id, user_id, date_id, review_stars, useful_votes, funny_votes, cool_votes, "
                f"review_length_chars, {TS('reviewed_at')} as reviewed_at, year, month")


@register("fact_upsert", W(*O.REVIEWS_CHAIN) + f"""
, dated as (select * replace (case useful_votes when 3 then reviewed_at + interval 100 year when 1 then reviewed_at + {_MOVED}
                                    else reviewed_at end as reviewed_at,
                               case when useful_votes in (1, 4) then 6.0 - review_stars else review_stars end as review_stars)
             from fact_reviews)
select review_id, business_id, user_id, md5(cast(cast(reviewed_at as date) as varchar)) as date_id, review_stars, useful_votes,
       funny_votes, cool_votes, review_length_chars, {TS('reviewed_at')} as reviewed_at,
       case when useful_votes in (4, 6) then null else cast(year(reviewed_at) as integer) end as year,
       case when useful_votes in (4, 6) then null else cast(month(reviewed_at) as integer) end as month
from dated
""")
def q_fact_upsert(L: Layers) -> DataFrame:
    spark, f = L.spark, L.fact_reviews()
    base = scratch_path(spark, "fact_upsert")
    path = base + "/fact_reviews"
    # both loads are slices of the same rows, which are made once
    write_table(f.drop("date_id"), base + "/rows")
    f = spark.read.schema(f.drop("date_id").schema).parquet(base + "/rows")
    votes, at = F.col("useful_votes"), F.col("reviewed_at")

    def dated(df: DataFrame, no_month) -> DataFrame:
        return df.withColumn("year", F.when(~no_month, F.year(at))).withColumn("month", F.when(~no_month, F.month(at)))

    def dated_key(df: DataFrame) -> DataFrame:
        return df.withColumn("date_id", surrogate_key(F.to_date(at)))

    first = f.filter(votes != 2).withColumn("reviewed_at", F.when(votes == 3, at + F.expr("INTERVAL 100 YEARS")).otherwise(at))
    upsert(spark, dated(first, votes == 6), path, ["review_id"], ["year", "month"], buckets=2, finish=dated_key, from_files=True)
    changed = (f.filter(votes.isin(1, 2, 4, 5))
                .withColumn("reviewed_at", F.when(votes == 1, at + F.expr("INTERVAL 40 DAYS")).otherwise(at))
                .withColumn("review_stars", F.when(votes == 2, F.col("review_stars")).otherwise(6.0 - F.col("review_stars")))
                .withColumn("ingestion_date", F.when(votes == 5, F.lit(RUN_DATE - dt.timedelta(days=10))).otherwise(F.lit(RUN_DATE))))
    arrived = incremental_slice(dated(changed, votes == 4), RUN_DATE, LOOKBACK).drop("ingestion_date")
    upsert(spark, arrived, path, ["review_id"], ["year", "month"], finish=dated_key, from_files=True)
    return read_keyed(spark, path).select(*_FACT_COLS)


_BIZ_COLS = ["business_id", "name", "city", "state", "stars", "review_count", "is_open", "primary_category",
             "latitude", "longitude"]
_USER_COLS = ["user_id", "name", "review_count", "average_stars", "is_elite", "elite_years_count", "fan_count",
              "yelping_since_year", "total_useful_votes", "total_funny_votes", "total_cool_votes"]
_META_SQL = f"record_hash, {TS('valid_from')} as valid_from, {TS('valid_to')} as valid_to, is_current"


def _two_runs(L: Layers, build, key: str, cols, tracked, t1: str, t2: str, name: str) -> DataFrame:
    """Apply two snapshots, persisting the history table between the runs."""
    spark = L.spark
    path = scratch_path(spark, name) + "/history"
    hist.scd2_store(spark, path, build("previous").select(*cols), key, tracked, t1)
    hist.scd2_store(spark, path, build("latest").select(*cols), key, tracked, t2)
    return hist.read_history(spark, path)


_BIZ_SNAPSHOTS = (O.BRONZE_BUSINESS_PREV, O.silver_business("bronze_business_prev", "sb_prev"),
                  O.categories("bronze_business_prev", "cat_prev"), O.dim_business("sb_prev", "cat_prev", "db_prev"),
                  O.BRONZE_BUSINESS_LATEST, O.silver_business("bronze_business_latest", "sb_latest"),
                  O.categories("bronze_business_latest", "cat_latest"),
                  O.dim_business("sb_latest", "cat_latest", "db_latest"))
_USER_SNAPSHOTS = (O.ELITE, O.BRONZE_USERS_PREV, O.silver_users("bronze_users_prev", "su_prev"),
                   O.dim_user("su_prev", "du_prev"), O.BRONZE_USERS_LATEST,
                   O.silver_users("bronze_users_latest", "su_latest"), O.dim_user("su_latest", "du_latest"))


@register("business_history", W(*_BIZ_SNAPSHOTS, O.scd2_two_runs_sql(
    "db_prev", "db_latest", "business_id", _BIZ_COLS, hist.BUSINESS_TRACKED,
    "2001-05-31 00:00:00", "2001-06-01 00:00:00")) + f"select {', '.join(_BIZ_COLS)}, {_META_SQL} from history\n")
def q_business_history(L: Layers) -> DataFrame:
    return _two_runs(L, L.dim_business, "business_id", _BIZ_COLS, hist.BUSINESS_TRACKED,
                     "2001-05-31 00:00:00", "2001-06-01 00:00:00", "business_history")


@register("user_history", W(*_USER_SNAPSHOTS, O.scd2_two_runs_sql(
    "du_prev", "du_latest", "user_id", _USER_COLS, hist.USER_TRACKED,
    "2001-05-31 00:00:00", "2001-06-01 00:00:00")) + f"select {', '.join(_USER_COLS)}, {_META_SQL} from history\n")
def q_user_history(L: Layers) -> DataFrame:
    return _two_runs(L, L.dim_user, "user_id", _USER_COLS, hist.USER_TRACKED,
                     "2001-05-31 00:00:00", "2001-06-01 00:00:00", "user_history")


@register("asof_elite", W(*O.REVIEWS_CHAIN, *_USER_SNAPSHOTS, O.scd2_two_runs_sql(
    "du_prev", "du_latest", "user_id", _USER_COLS, hist.USER_TRACKED,
    "1998-01-01 00:00:00", "2000-01-01 00:00:00")) + f"""
select f.review_id, f.user_id, {TS('f.reviewed_at')} as reviewed_at, h.is_elite, h.fan_count,
       {TS('h.valid_from')} as valid_from, {TS('h.valid_to')} as valid_to
from fact_reviews f
left join history h on f.user_id = h.user_id and h.valid_from <= f.reviewed_at
                   and (h.valid_to is null or f.reviewed_at < h.valid_to)
""")
def q_asof_elite(L: Layers) -> DataFrame:
    h = _two_runs(L, L.dim_user, "user_id", _USER_COLS, hist.USER_TRACKED,
                  "1998-01-01 00:00:00", "2000-01-01 00:00:00", "asof_history")
    facts = L.fact_reviews().select("review_id", "user_id", "reviewed_at")
    return hist.as_of_join(facts, h, "user_id", "reviewed_at", ["is_elite", "fan_count"]) \
               .select("review_id", "user_id", "reviewed_at", "is_elite", "fan_count", "valid_from", "valid_to")


# ── raw-layer ingestion ────────────────────────────────────────────────────

from strataflow.schemas import BUSINESS_SCHEMA, REVIEWS_SCHEMA, USERS_SCHEMA  # noqa: E402
from strataflow.sources import bronze as B  # noqa: E402
from strataflow.sources import json_source as J  # noqa: E402

_RUN_TS = dt.datetime(2001, 6, 1, 6, 0, 0)


@register("bronze_roundtrip", W(O.BRONZE_REVIEWS) + f"""
select review_id, business_id, user_id, stars, date, text, useful, funny, cool,
       '{O.RUN_DATE.isoformat()}' as ingestion_date
from bronze_reviews where review_id not like '%-7'
""")
def q_bronze_roundtrip(L: Layers) -> DataFrame:
    """Raw reviews written as JSON lines (lines of line-number-7 reviews
    truncated), ingested with quarantine and drift check, read back."""
    spark = L.spark
    base = scratch_path(spark, "bronze_roundtrip")
    raw = L.bronze("reviews")
    js = F.to_json(F.struct(*REVIEWS_SCHEMA.fieldNames()))
    line = F.when(F.col("review_id").endswith("-7"), F.expr("substring(_js, 1, length(_js) - 7)")).otherwise(F.col("_js"))
    # gzip files cannot be split, so their rows are bounded
    (raw.select(js.alias("_js"), "review_id").select(line.alias("value")).write.mode("overwrite")
     .option("maxRecordsPerFile", 500_000).text(base + "/landing", compression="gzip"))
    B.ingest_entity(spark, "reviews", base + "/landing", base + "/bronze", RUN_DATE, _RUN_TS,
                    audit_path=base + "/audit", quarantine_path=base + "/quarantine",
                    drift_path=base + "/drift", min_rows=0)
    return spark.read.parquet(base + "/bronze")


def _contract_sql(schema) -> str:
    return ", ".join(f"('{f.name}', '{f.dataType.simpleString()}')" for f in schema.fields)


def _present_sql(cte: str, cols: list[str]) -> str:
    """(name, kind) of every column of a text export that holds a value, typed as its values read."""
    one = ("select '{c}' as name, case when count(*) filter (where {c} is not null and try_cast({c} as double) is null) > 0 "
           "then 'string' else 'number' end as kind from {t} where {c} is not null having count(*) > 0")
    return " union all ".join(one.format(c=c, t=cte) for c in cols)


_BIZ_EXPORT = [f.name for f in BUSINESS_SCHEMA.fields if f.name not in ("postal_code", "hours", "attributes")]
_USER_EXPORT = [f.name for f in USERS_SCHEMA.fields]


@register("schema_drift", W(O.BRONZE_BUSINESS_LATEST, O.ELITE, O.BRONZE_USERS_LATEST) + f"""
, business_text as (select {', '.join(f'{c}::varchar as {c}' for c in _BIZ_EXPORT)}, 'web' as rating_source from bronze_business_latest),
users_text as (select {', '.join(f"{c}::varchar{' || chr(32) || chr(102)' if c == 'fans' else ''} as {c}" for c in _USER_EXPORT)}
               from bronze_users_latest),
there as (select 'business' as entity, * from ({_present_sql('business_text', [*_BIZ_EXPORT, 'rating_source'])}) b
          union all select 'users', * from ({_present_sql('users_text', _USER_EXPORT)}) u),
declared as (select 'business' as entity, * from (values {_contract_sql(BUSINESS_SCHEMA)}) b(name, type)
             union all select 'users', * from (values {_contract_sql(USERS_SCHEMA)}) u(name, type))
select entity, case when type is null then 'new' when kind is null then 'missing' else 'type_change' end as change_kind,
       name as column_name, type as expected_type, case when kind is not null then 'string' end as actual_type
from declared full join there using (entity, name)
where type is null or kind is null or (kind = 'string' and type <> 'string')
""")
def q_schema_drift(L: Layers) -> DataFrame:
    """Drift between the declared contracts and JSON exports derived from the
    tables: business gains a field and loses postal_code (hours/attributes are
    never present); users' fans arrive as text."""
    spark = L.spark
    base = scratch_path(spark, "schema_drift")
    bcols = [c for c in BUSINESS_SCHEMA.fieldNames() if c != "postal_code"]
    (L.bronze("business", "latest")
      .select(F.to_json(F.struct(*bcols, F.lit("web").alias("rating_source"))).alias("value"))
      .write.mode("overwrite").text(base + "/business"))
    ucols = [F.concat(F.col("fans").cast("string"), F.lit(" fans")).alias("fans") if c == "fans" else F.col(c)
             for c in USERS_SCHEMA.fieldNames()]
    (L.bronze("users", "latest").select(F.to_json(F.struct(*ucols)).alias("value"))
      .write.mode("overwrite").text(base + "/users"))
    events = []
    for entity, schema, sub in (("business", BUSINESS_SCHEMA, "business"), ("users", USERS_SCHEMA, "users")):
        rep = J.detect_drift(schema, J.infer_source_schema(spark, f"{base}/{sub}"))
        events.append(J.drift_events(spark, entity, rep, RUN_DATE, _RUN_TS))
    return quality.union_all(events).select("entity", "change_kind", "column_name", "expected_type", "actual_type")


# ── streaming ──────────────────────────────────────────────────────────────

from strataflow.operators.silver import clean_reviews as _clean_reviews  # noqa: E402
from strataflow.streaming import streams as ST  # noqa: E402

_EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value"]


def _events_landing(L: Layers, base: str, with_duplicates: bool) -> str:
    # Watermarks need TIMESTAMP (not TIMESTAMP_NTZ): cast at the source boundary
    # (the session time zone is UTC, so wall-clock values are unchanged).
    ev = (table(L.spark, L.sf_dir, "events").select(*_EVENT_COLS)
           .withColumn("ts", F.col("ts").cast("timestamp")))
    if with_duplicates:
        ev = ev.unionByName(ev.filter(F.col("event_id") % 10 == 0))
    ev.write.mode("overwrite").parquet(base + "/landing")
    return base + "/landing"


@register("stream_dedup_events", f"""
select event_id, {TS('ts')} as ts, user_id, event_type, value from events
""")
def q_stream_dedup_events(L: Layers) -> DataFrame:
    """Events with planted duplicates, de-duplicated by a streaming query
    (watermark 3 days) into a parquet sink."""
    spark = L.spark
    base = scratch_path(spark, "stream_dedup")
    landing = _events_landing(L, base, with_duplicates=True)
    schema = spark.read.parquet(landing).schema
    s = ST.dedup_within_watermark(ST.file_stream(spark, landing, schema, fmt="parquet"), "ts", ["event_id"])
    q = ST.start(s, base + "/checkpoint", sink_path=base + "/sink", available_now=True)
    q.awaitTermination()
    return spark.read.parquet(base + "/sink").select(*_EVENT_COLS)


@register("stream_daily_events", """
select cast(cast(ts as date) as varchar) as day, count(*) as events, max(value) as max_value
from events group by cast(ts as date)
""")
def q_stream_daily_events(L: Layers) -> DataFrame:
    """Daily event counts from a windowed streaming aggregate, upserted per
    micro-batch (update mode) into a table keyed by window start."""
    spark = L.spark
    base = scratch_path(spark, "stream_daily")
    landing = _events_landing(L, base, with_duplicates=False)
    schema = spark.read.parquet(landing).schema
    agg = (ST.windowed_counts(ST.file_stream(spark, landing, schema, fmt="parquet"), "ts",
                              extra_aggs=[F.max("value").alias("max_value")])
             .withColumn("month", F.date_format("window_start", "yyyy-MM")))
    handler = ST.upsert_batches(base + "/daily", ["window_start"], ["month"])
    q = ST.start(agg, base + "/checkpoint", foreach_batch=handler, output_mode="update", available_now=True)
    q.awaitTermination()
    return (spark.read.parquet(base + "/daily")
                 .select(F.to_date("window_start").cast("string").alias("day"), "events", "max_value"))


@register("stream_upsert", SQL["clean_reviews"])
def q_stream_upsert(L: Layers) -> DataFrame:
    """Raw review snapshots streamed as JSON files in several micro-batches;
    each batch goes through the batch cleaning function and a latest-wins
    upsert, so the table equals the batch result whatever the file order."""
    spark = L.spark
    base = scratch_path(spark, "stream_upsert")
    # At least two files per daily snapshot (range bounds split a large day over
    # several tasks), more of a larger input, so that no task's share grows; a
    # third of them per trigger -> several micro-batches.
    raw = L.bronze("reviews")
    files = landing_files(raw, 6)
    # Dealt out before they are texts, and compressed: as JSON, they are many times the tables.
    rows = reviews_bronze(spark, L.sf_dir, lambda j: j.repartitionByRange(files, "ingestion_date", "l_orderkey", "l_linenumber"))
    with shuffles_dropped(spark):
        rows.write.mode("overwrite").partitionBy("ingestion_date").json(base + "/landing", compression="gzip")
    from pyspark.sql.types import DateType, StructField, StructType
    schema = StructType(REVIEWS_SCHEMA.fields + [StructField("ingestion_date", DateType(), True)])
    src = ST.file_stream(spark, base + "/landing", schema, fmt="json", max_files_per_trigger=-(-files // 3))
    handler = ST.upsert_batches(base + "/silver", ["review_id"], ["year", "month"],
                                transform=lambda b: _clean_reviews(b, keep_ingestion_date=True),
                                order_cols=["ingestion_date"], resolve="latest", buckets=2)
    q = ST.start(src, base + "/checkpoint", foreach_batch=handler, available_now=True)
    q.awaitTermination()
    return read_keyed(spark, base + "/silver").drop("ingestion_date")


# ── end-to-end layer jobs ──────────────────────────────────────────────────

from strataflow.plans import jobs  # noqa: E402
from strataflow.sources.tables import write_partitioned  # noqa: E402


@register("layered_build", SQL["fact_reviews"])
def q_layered_build(L: Layers) -> DataFrame:
    """Raw partitions written from the derived sources, then the clean and
    star-schema jobs over table paths; returns the stored review fact."""
    spark = L.spark
    paths = jobs.Paths(scratch_path(spark, "layered_build"))
    for e in ("business", "reviews", "users", "checkins", "tips"):
        # few days, which all tasks have rows of: each writes its own
        write_partitioned(L.bronze(e), paths.bronze(e), ["ingestion_date"], guard=False, rebalance=False)
    jobs.run_silver(spark, paths, RUN_DATE, _RUN_TS, LOOKBACK)
    jobs.run_gold(spark, paths, _RUN_TS)
    return spark.read.parquet(paths.gold("fact_reviews")).select(*_FACT_COLS)


# ── snapshot reads and retention over a written raw table ──────────────────

from strataflow.sources.tables import (  # noqa: E402
    expired_partitions, load_table, partition_values, read_as_of, read_partitions, read_window)


def _raw_table(L: Layers, entity: str, name: str) -> str:
    path = scratch_path(L.spark, name) + "/" + entity
    write_partitioned(L.bronze(entity), path, ["ingestion_date"], guard=False, rebalance=False)
    return path


@register("snapshot_as_of", W(O.BRONZE_BUSINESS_PREV) + """
select business_id, name, city, state, postal_code, latitude, longitude, stars, review_count, is_open,
       categories, cast(null as varchar) as hours, cast(null as varchar) as attributes,
       cast(ingestion_date as varchar) as ingestion_date
from bronze_business_prev
""")
def q_snapshot_as_of(L: Layers) -> DataFrame:
    """The raw business table as it stood on 2001-05-31 (latest partition on or
    before that day), read from the written, date-partitioned table."""
    path = _raw_table(L, "business", "snapshot_as_of")
    return read_as_of(L.spark, path, dt.date(2001, 5, 31))


@register("retention_expired", W(O.BRONZE_REVIEWS) + """
select distinct cast(ingestion_date as varchar) as expired_ingestion_date
from bronze_reviews where ingestion_date < date '2001-05-31'
""")
def q_retention_expired(L: Layers) -> DataFrame:
    """Raw review partitions past a one-day retention on 2001-06-01."""
    path = _raw_table(L, "reviews", "retention_expired")
    return expired_partitions(L.spark, path, "ingestion_date", RUN_DATE, keep_days=1)


# ── running totals that keep other columns ─────────────────────────────────

from strataflow.operators.running import running_totals  # noqa: E402


@register("running_votes", W(*O.REVIEWS_CHAIN) + f"""
select review_id, business_id, user_id, review_stars, useful_votes, funny_votes, {TS('reviewed_at')} as reviewed_at,
       cast(sum(useful_votes) over w as bigint) as useful_so_far, count(review_stars) over w as reviews_so_far
from fact_reviews window w as (partition by business_id order by reviewed_at, review_id rows unbounded preceding)
""")
def q_running_votes(L: Layers) -> DataFrame:
    """Running votes per business; columns the totals do not need are kept."""
    f = L.fact_reviews().select("review_id", "business_id", "user_id", "review_stars", "useful_votes", "funny_votes", "reviewed_at")
    return running_totals(f, ["business_id"], ["reviewed_at", "review_id"], sums={"useful_so_far": "useful_votes"},
                          counts={"reviews_so_far": "review_stars"})


# ── ingestion over several dates ───────────────────────────────────────────

def _tips_landing(L: Layers, base: str) -> dict[dt.date, str]:
    """Tips as JSON lines for two dates; the second export has a new column and some truncated lines."""
    tips = L.bronze("tips")
    cols = [F.col(c) for c in S.TIPS_SCHEMA.fieldNames()]
    first, second = RUN_DATE - dt.timedelta(days=1), RUN_DATE
    tips.select(F.to_json(F.struct(*cols)).alias("value")).write.mode("overwrite").text(base + "/landing/1")
    js = tips.select(F.to_json(F.struct(*cols, F.concat(F.lit("app"), F.col("compliment_count").cast("string")).alias("client"))).alias("j"),
                     "compliment_count")
    (js.select(F.when(F.col("compliment_count") == 6, F.expr("substring(j, 1, length(j) - 5)")).otherwise(F.col("j")).alias("value"))
     .write.mode("overwrite").text(base + "/landing/2"))
    return {first: base + "/landing/1", second: base + "/landing/2"}


@register("ingest_two_dates", W(O.BRONZE_TIPS) + f"""
select business_id, user_id, text, date, compliment_count, null as client, '{RUN_DATE - dt.timedelta(days=1)}' as ingestion_date from bronze_tips
union all
select business_id, user_id, text, date, compliment_count, 'app' || compliment_count, '{RUN_DATE}' from bronze_tips where compliment_count <> 6
""")
def q_ingest_two_dates(L: Layers) -> DataFrame:
    """Two dates ingested, then both replayed: the new column of the second date is kept and null on
    the first, truncated lines are quarantined, the replay changes nothing."""
    base = scratch_path(L.spark, "ingest_two_dates")
    days = _tips_landing(L, base)
    for ts in (_RUN_TS, _RUN_TS + dt.timedelta(hours=1)):
        B.replay(L.spark, "tips", days, base + "/bronze", ts, quarantine_path=base + "/quarantine", audit_path=base + "/audit",
                 drift_path=base + "/drift", min_rows=0)
    return load_table(L.spark, base + "/bronze").select("business_id", "user_id", "text", "date", "compliment_count", "client",
                                                        "ingestion_date")


@register("ingest_logs", W(O.BRONZE_TIPS) + f"""
select 'audit' as log, 'SUCCESS' as kind, '{RUN_DATE - dt.timedelta(days=1)}' as run_date, cast((select count(*) from bronze_tips) as bigint) as n
union all select 'audit', 'SUCCESS', '{RUN_DATE}', count(*) from bronze_tips where compliment_count <> 6
union all select 'quarantine', 'corrupt', '{RUN_DATE}', count(*) from bronze_tips where compliment_count = 6
union all select 'drift', 'new client', '{RUN_DATE}', case when count(*) > 0 then 1 else 0 end from bronze_tips
""")
def q_ingest_logs(L: Layers) -> DataFrame:
    """What one ingestion of each date leaves in the audit log, the quarantine and the drift log."""
    spark, base = L.spark, scratch_path(L.spark, "ingest_logs")
    B.replay(spark, "tips", _tips_landing(L, base), base + "/bronze", _RUN_TS, quarantine_path=base + "/quarantine",
             audit_path=base + "/audit", drift_path=base + "/drift", min_rows=0)
    rd = spark.read.parquet
    parts = [rd(base + "/audit").select(F.lit("audit").alias("log"), F.col("status").alias("kind"), "run_date", F.col("row_count").alias("n")),
             rd(base + "/quarantine").groupBy("ingestion_date").count()
             .select(F.lit("quarantine"), F.lit("corrupt"), "ingestion_date", "count"),
             rd(base + "/drift").groupBy("change_kind", "column_name", "run_date").count()
             .select(F.lit("drift"), F.concat_ws(" ", "change_kind", "column_name"), "run_date", "count")]
    return parts[0].union(parts[1]).union(parts[2])


@register("lookback_read", W(O.BRONZE_REVIEWS) + f"""
select review_id, stars, cast(ingestion_date as varchar) as ingestion_date, 'window' as how from bronze_reviews
where ingestion_date between {O.d(RUN_DATE - dt.timedelta(days=1))} and {O.d(RUN_DATE)}
union all
select review_id, stars, cast(ingestion_date as varchar), 'list' from bronze_reviews
where ingestion_date in ({O.d(RUN_DATE - dt.timedelta(days=2))}, {O.d(RUN_DATE)})
""")
def q_lookback_read(L: Layers) -> DataFrame:
    """Raw reviews read back by a date range and by a list of dates (both prune partitions)."""
    path = _raw_table(L, "reviews", "lookback_read")
    cols = ["review_id", "stars", "ingestion_date"]
    ranged = read_window(L.spark, path, "ingestion_date", RUN_DATE - dt.timedelta(days=1), RUN_DATE)
    listed = read_partitions(L.spark, path, "ingestion_date", [RUN_DATE - dt.timedelta(days=2), RUN_DATE])
    return ranged.select(*cols, F.lit("window").alias("how")).union(listed.select(*cols, F.lit("list")))


@register("materialize_kinds", W(O.BRONZE_BUSINESS, O.silver_business()) + """
, kinds as (select unnest(['view', 'ephemeral', 'table', 'incremental']) as kind)
select kind, city, count(*) as businesses, sum(stars) as stars from kinds, silver_business group by kind, city
""")
def q_materialize_kinds(L: Layers) -> DataFrame:
    """The same model as a view, inline, as a table and as an incremental table."""
    spark, base = L.spark, scratch_path(L.spark, "materialize")
    df = L.silver("business").select("business_id", "city", "stars")
    jobs.materialize(df, "view", "model_view")
    jobs.materialize(df, "table", "model", base + "/table")
    for part in (F.col("stars") <= 3, F.col("stars") > 2):       # overlapping loads: the key decides
        jobs.materialize(df.filter(part), "incremental", "model", base + "/incremental", keys=["business_id"], partition_cols=["city"])
    frames = {"view": spark.table("model_view"), "ephemeral": jobs.materialize(df, "ephemeral", "model"),
              "table": spark.read.parquet(base + "/table"), "incremental": spark.read.parquet(base + "/incremental")}
    out = [d.groupBy("city").agg(F.count("*").alias("businesses"), F.sum("stars").alias("stars"))
           .select(F.lit(k).alias("kind"), "city", "businesses", "stars") for k, d in frames.items()]
    return quality.union_all(out)


@register("clustered_layout", W(*O.BUSINESS_CHAIN) + """
select city, state, count(*) as businesses from dim_business where city >= 'NATION_1' and city < 'NATION_2' group by city, state
""")
def q_clustered_layout(L: Layers) -> DataFrame:
    """The business dimension written in (city, state) order and read by a range of cities (row groups are skipped)."""
    path = scratch_path(L.spark, "clustered") + "/dim_business"
    write_table(L.dim_business(), path, cluster_cols=["city", "state"])
    return (L.spark.read.parquet(path).filter((F.col("city") >= "NATION_1") & (F.col("city") < "NATION_2"))
            .groupBy("city", "state").agg(F.count("*").alias("businesses")))


# ── checks over several runs, from stored results ──────────────────────────

def _drift_sql() -> str:
    return f"""
, runs as (select distinct year as y, make_date(year, 12, 31) as run_date from silver_reviews),
m as (select run_date, 'row_count_drift' as test_name, count(*) as today from runs join silver_reviews on year <= y group by run_date
      union all select run_date, 'metric_drift', avg(stars) from runs join silver_reviews on year <= y group by run_date
      union all select run_date, 'null_rate_drift', count(*) filter (where stars is null) / count(*)
                from runs join silver_reviews on year <= y group by run_date),
stored as (select *, case when test_name = 'row_count_drift' then today else {O.r2('today', 4)} end as recorded from m),
b as (select *, avg(recorded) over w as base, count(*) over w as hist from stored
      window w as (partition by test_name order by run_date rows between 7 preceding and 1 preceding)),
d as (select *, case test_name when 'row_count_drift' then abs(today - base) / base * 100.0 when 'metric_drift' then abs(today - base)
                               else today - base end as dev,
             case test_name when 'row_count_drift' then 15.0 when 'metric_drift' then 0.5 else 0.02 end as threshold from b)
select test_name, 'reviews' as entity, hist < 3 or dev <= threshold as passed,
       case when test_name = 'row_count_drift' then case when hist >= 3 then {O.r2('dev')} end else recorded end as value,
       cast(threshold as double) as threshold, cast(run_date as varchar) as run_date
from d
"""


@register("dq_drift_runs", W(O.BRONZE_REVIEWS, O.SILVER_REVIEWS) + _drift_sql())
def q_dq_drift_runs(L: Layers) -> DataFrame:
    """The clean-layer suite run once a year on the reviews up to then; every run stores its rows and
    takes the rows of earlier runs as its baseline."""
    spark, path = L.spark, scratch_path(L.spark, "dq_drift") + "/test_results"
    reviews_path = scratch_path(L.spark, "dq_drift") + "/reviews"
    write_partitioned(L.silver("reviews"), reviews_path, ["year"], guard=False)
    for y in sorted(int(v) for v in partition_values(spark, reviews_path, "year")):
        day = dt.date(y, 12, 31)
        so_far = spark.read.parquet(reviews_path).filter(F.col("year") <= y)
        rows = quality.run_layer_suite({"reviews": so_far}, "silver", dt.datetime(y, 12, 31), day,
                                       history=quality.read_history(spark, path), floors={})
        quality.write_test_results(rows, path, day, dt.datetime(y, 12, 31))
    return (quality.read_history(spark, path).filter(F.col("test_name").endswith("_drift"))
            .select("test_name", "entity", "passed", "value", "threshold", "run_date"))


@register("dq_job_checks", W(*_ALL_SILVER) + O.union(
    [O._row("non_empty", e, "silver", "n > 0", f"{O._sv('n')} || ' rows'", "n", 0.0) + f" from (select count(*) as n from {t})"
     for e, t in _SILVER_TABLES.items()]
    + [O._row("input_output_drop", e, "silver", "loss <= 10.0", f"'input ' || {O._sv('b')} || ', output ' || {O._sv('a')}", O.r2("loss"), 10.0)
       + f" from (select *, case when b > 0 then (b - a) / b * 100.0 else 0.0 end as loss from (select (select count(*) from {_BRONZE_TABLES[e]}) as b, "
         f"(select count(*) from {_SILVER_TABLES[e]}) as a))" for e in ("reviews", "users", "tips")]
    + [O._row("table_readable", e, "silver", ok, msg, "null", "null") + " from (select count(*) as n from part)"
       for e, ok, msg in (("business", "n > 0", "'readable'"), ("nowhere", "n < 0", "'FAIL - could not read table: AnalysisException'"))]))
def q_dq_job_checks(L: Layers) -> DataFrame:
    """Checks a job makes on its own output: not empty, rows lost on the way, readable."""
    base = scratch_path(L.spark, "dq_job_checks")
    write_table(L.silver("business"), base + "/business")
    out = [quality.non_empty(L.silver(e), e, "silver") for e in _SILVER_TABLES]
    out += [quality.input_output_drop(L.window(e), L.silver(e), e, "silver") for e in ("reviews", "users", "tips")]
    out += [quality.table_readable(L.spark, f"{base}/{e}", e, "silver")[1] for e in ("business", "nowhere")]
    return quality.union_all(out)


# ── streaming with malformed lines and late rows ───────────────────────────

@register("stream_quarantine", W(O.BRONZE_TIPS) + f"""
select business_id, user_id, compliment_count, false as quarantined from bronze_tips where compliment_count <> 3
union all select null, null, null, true from bronze_tips where compliment_count = 3
""")
def q_stream_quarantine(L: Layers) -> DataFrame:
    """Tips streamed as JSON files in several micro-batches; truncated lines go to the quarantine."""
    spark, base = L.spark, scratch_path(L.spark, "stream_quarantine")
    cols = S.TIPS_SCHEMA.fieldNames()
    js = L.bronze("tips").select(F.to_json(F.struct(*cols)).alias("j"), "compliment_count")
    (js.select(F.when(F.col("compliment_count") == 3, F.expr("substring(j, 1, length(j) - 4)")).otherwise(F.col("j")).alias("value"))
     .repartition(4).write.mode("overwrite").text(base + "/landing"))
    src = ST.file_stream(spark, base + "/landing", S.TIPS_SCHEMA, fmt="json", max_files_per_trigger=2, corrupt=True)

    def keep(batch: DataFrame, epoch_id: int) -> None:
        (batch.withColumn("batch", F.lit(epoch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(base + "/tips"))
    ST.start(src, base + "/checkpoint", foreach_batch=ST.quarantine_batches(base + "/quarantine", keep), available_now=True).awaitTermination()
    good = spark.read.parquet(base + "/tips").select("business_id", "user_id", "compliment_count", F.lit(False).alias("quarantined"))
    bad = spark.read.parquet(base + "/quarantine").select(*[F.lit(None).cast(t).alias(c) for c, t in good.dtypes[:3]], F.lit(True))
    return good.union(bad)


@register("stream_late_events", f"""
with split as (select *, cast(ts as timestamp) < (select max(cast(ts as timestamp)) from events) - interval 10 day and event_id % 5 = 0 as late from events)
select cast(cast(ts as date) as varchar) as day, count(*) as events from split where not late group by cast(ts as date)
""")
def q_stream_late_events(L: Layers) -> DataFrame:
    """Daily counts over three micro-batches; rows that arrive far behind the 3-day watermark are left out."""
    spark, base = L.spark, scratch_path(L.spark, "stream_late")
    ev = table(spark, L.sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    last = ev.agg(F.max("ts")).select(F.col("max(ts)").alias("last"))
    late = (F.col("ts") < F.col("last") - F.expr("INTERVAL 10 DAYS")) & (F.col("event_id") % 5 == 0)
    marked = ev.join(F.broadcast(last), F.lit(True)).withColumn("late", late).select("event_id", "ts", "late")   # one row
    for n, part in enumerate((~F.col("late"), F.col("late") & (F.col("event_id") % 2 == 0), F.col("late") & (F.col("event_id") % 2 == 1))):
        marked.filter(part).select("event_id", "ts").write.parquet(f"{base}/landing/{n}")
    schema = spark.read.parquet(base + "/landing/0").schema
    # one run a delivery, all its files in one batch, so that the watermark has moved when the late rows arrive, and not before
    for n in range(3):
        src = ST.file_stream(spark, f"{base}/landing/{{{','.join(map(str, range(n + 1)))}}}", schema, fmt="parquet")
        counts = ST.windowed_counts(src, "ts").withColumn("month", F.date_format("window_start", "yyyy-MM"))
        ST.start(counts, base + "/checkpoint", foreach_batch=ST.upsert_batches(base + "/daily", ["window_start"], ["month"]),
                 output_mode="update", available_now=True).awaitTermination()
    return spark.read.parquet(base + "/daily").select(F.to_date("window_start").cast("string").alias("day"), "events")


# ── column tests of the other layers ───────────────────────────────────────

from strataflow.operators import gold  # noqa: E402


def _layer_tests_sql(layer: str) -> str:
    return O.union([O.generic_test_sql(m, c, k, a, layer) for m, c, k, a in quality.LAYER_COLUMN_TESTS[layer]])


def _layer_tests(layer: str, models: dict) -> DataFrame:
    return quality.run_column_tests(models, quality.LAYER_COLUMN_TESTS[layer], layer)


@register("dq_staging_tests", W(*_ALL_SILVER, """
stg_reviews as (select review_id, business_id, user_id, stars as review_stars, review_date as reviewed_at from silver_reviews),
stg_business as (select business_id, name as business_name from silver_business),
stg_users as (select user_id, is_elite from silver_users),
stg_checkins as (select checkin_id, business_id, checkin_ts from checkin_events)""") + _layer_tests_sql("staging"))
def q_dq_staging_tests(L: Layers) -> DataFrame:
    return _layer_tests("staging", {
        "stg_reviews": gold.stg_reviews(L.silver("reviews")), "stg_business": gold.stg_business(L.silver("business")),
        "stg_users": gold.stg_users(L.silver("users")), "stg_checkins": gold.stg_checkins(L.silver("checkin_events"))})


@register("dq_intermediate_tests", W(*O.REVIEWS_CHAIN, O.BRONZE_BUSINESS, O.categories(), f"""
int_reviews_with_dates as (select review_id, date_id from fact_reviews),
int_business_categories as (select business_id, min(category) as primary_category from business_categories group by business_id),
int_rising_star_candidates as (select business_id, avg_stars_recent, avg_stars_historical, rating_improvement, review_count_recent
                               from ({SQL['rising_stars']}) r)""") + _layer_tests_sql("intermediate"))
def q_dq_intermediate_tests(L: Layers) -> DataFrame:
    return _layer_tests("intermediate", {
        "int_reviews_with_dates": L.fact_reviews(), "int_business_categories": L.primary_category(),
        "int_rising_star_candidates": reports.rising_star_candidates(L.fact_reviews(), AS_OF, MIN_RECENT, MIN_IMPROVEMENT)})


@register("dq_reporting_tests", f"""
with vw_rising_stars as ({SQL['rising_stars']}), vw_top_businesses_by_city as ({SQL['top_businesses_by_year']}),
vw_review_trends as ({SQL['review_trends']})
""" + _layer_tests_sql("reporting"))
def q_dq_reporting_tests(L: Layers) -> DataFrame:
    return _layer_tests("reporting", {
        "vw_rising_stars": q_rising_stars(L), "vw_top_businesses_by_city": q_top_businesses_by_year(L),
        "vw_review_trends": q_review_trends(L)})


@register("dq_history_tests", f"""
with dim_business_history as ({SQL['business_history']}), dim_user_history as ({SQL['user_history']})
""" + _layer_tests_sql("history"))
def q_dq_history_tests(L: Layers) -> DataFrame:
    return _layer_tests("history", {"dim_business_history": q_business_history(L), "dim_user_history": q_user_history(L)})
