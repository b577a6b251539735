"""Reference SQL (DuckDB dialect) for the registered queries.

Each query is re-derived from the benchmark tables with plain SQL — window
``row_number`` dedup, one join per dimension, straightforward aggregates —
so it checks the Spark jobs' results without sharing their plans. Timestamps
and dates are rendered as text, as the registered Spark queries do.
"""

from __future__ import annotations

import datetime as dt

RUN_DATE = dt.date(2001, 6, 1)
PREVIOUS_DATE = dt.date(2001, 5, 31)
TS_FMT = "%Y-%m-%d %H:%M:%S"


def d(x: dt.date) -> str:
    return f"date '{x.isoformat()}'"


def r2(x: str, digits: int = 2) -> str:
    s = float(10 ** digits)
    return f"(floor(({x}) * {s} + 0.5) / {s})"


def ts_text(x: str) -> str:
    return f"strftime({x}, '{TS_FMT}')"


# ── raw layer ──────────────────────────────────────────────────────────────

BRONZE_REVIEWS = f"""
bronze_reviews as (
  select cast(l.l_orderkey as varchar) || '-' || cast(l.l_linenumber as varchar) as review_id,
         cast(l.l_partkey as varchar) as business_id,
         cast(o.o_custkey as varchar) as user_id,
         cast(case when l.l_suppkey % 50 = 0 then 6 else 1 + cast(l.l_quantity as integer) % 5 end as integer) as stars,
         case when l.l_partkey % 97 = 0 then 'n/a'
              else strftime(l.l_shipdate + to_seconds(l.l_orderkey % 86400), '{TS_FMT}') end as date,
         p.p_name as text,
         cast(l.l_linenumber as bigint) as useful,
         l.l_orderkey % 3 as funny,
         l.l_partkey % 4 as cool,
         {d(RUN_DATE)} - cast(l.l_suppkey % 3 as integer) as ingestion_date
  from lineitem l
  join orders o on l.l_orderkey = o.o_orderkey
  join part p on l.l_partkey = p.p_partkey)"""


def _business_snapshot(previous: bool) -> str:
    if previous:
        where, day = "p.p_partkey % 10 <> 9", PREVIOUS_DATE
        stars = "case when p.p_partkey % 7 = 0 then 1 + (p.p_size + 1) % 5 else 1 + p.p_size % 5 end"
    else:
        where, day = "(p.p_partkey % 17 <> 5 or p.p_partkey % 10 = 9)", RUN_DATE
        stars = "1 + p.p_size % 5"
    return f"""
  select cast(p.p_partkey as varchar) as business_id, p.p_name as name,
         case when p.p_partkey % 11 = 0 then null
              when p.p_partkey % 11 = 1 then '  ' || n.n_name || ' ' else n.n_name end as city,
         case when p.p_partkey % 6 = 0 then null else lower(r.r_name) end as state,
         cast(10000 + p.p_partkey % 90000 as varchar) as postal_code,
         cast(n.n_nationkey as double) as latitude, cast(r.r_regionkey as double) as longitude,
         cast({stars} as double) as stars,
         cast(p.p_size as bigint) as review_count,
         case when p.p_size % 5 = 0 then 0 else 1 end as is_open,
         case when p.p_partkey % 13 = 0 then null
              else p.p_type || ', ' || replace(p.p_name, ' ', ', ') end as categories,
         {d(day)} as ingestion_date
  from part p join nation n on p.p_partkey % 25 = n.n_nationkey
  join region r on n.n_regionkey = r.r_regionkey
  where {where}"""


BRONZE_BUSINESS = f"""
bronze_business as ({_business_snapshot(True)}
  union all {_business_snapshot(False)})"""

BRONZE_BUSINESS_PREV = f"""
bronze_business_prev as ({_business_snapshot(True)})"""

BRONZE_BUSINESS_LATEST = f"""
bronze_business_latest as ({_business_snapshot(False)})"""


ELITE = """
elite as (
  select o_custkey as e_custkey, string_agg(y, ',' order by y) as elite_years
  from (select distinct o_custkey, cast(year(o_orderdate) as varchar) as y
        from orders where o_orderpriority = '1-URGENT') t
  group by o_custkey)"""


def _users_snapshot(previous: bool) -> str:
    if previous:
        where, day = "where c.c_custkey % 10 <> 9", PREVIOUS_DATE
        name = "case when c.c_custkey % 5 = 0 then c.c_name || ' Sr' else c.c_name end"
        fans = "case when c.c_custkey % 7 = 0 then c.c_nationkey + 1 else c.c_nationkey end"
    else:
        where, day, name, fans = "", RUN_DATE, "c.c_name", "c.c_nationkey"
    return f"""
  select cast(c.c_custkey as varchar) as user_id, {name} as name,
         cast(c.c_custkey % 100 as bigint) as review_count,
         case when c.c_custkey % 53 = 0 then 'unknown'
              else strftime(timestamp '2000-01-01 00:00:00' + to_hours(c.c_custkey % 87600), '{TS_FMT}') end as yelping_since,
         case when c.c_custkey % 9 = 0 then '  ' else e.elite_years end as elite,
         cast({fans} as bigint) as fans,
         cast(1 + c.c_nationkey % 5 as double) as average_stars,
         cast(c.c_custkey % 10 as bigint) as useful,
         cast(c.c_custkey % 5 as bigint) as funny,
         cast(c.c_custkey % 3 as bigint) as cool,
         {d(day)} as ingestion_date
  from customer c left join elite e on c.c_custkey = e.e_custkey
  {where}"""


BRONZE_USERS = f"""
bronze_users as ({_users_snapshot(True)}
  union all {_users_snapshot(False)})"""

BRONZE_USERS_PREV = f"""
bronze_users_prev as ({_users_snapshot(True)})"""

BRONZE_USERS_LATEST = f"""
bronze_users_latest as ({_users_snapshot(False)})"""

# One row per event (the packed strings only regroup these).
CHECKIN_ITEMS = f"""
checkin_items as (
  select cast(user_id as varchar) as business_id,
         case when event_id % 101 = 0 then 'garbage' else strftime(ts, '{TS_FMT}') end as item
  from events)"""

BRONZE_TIPS = f"""
bronze_tips as (
  select cast(event_id % 100 as varchar) as business_id,
         case when event_id % 89 = 0 then null else cast(user_id as varchar) end as user_id,
         props as text, strftime(ts, '{TS_FMT}') as date,
         event_id % 7 as compliment_count, {d(RUN_DATE)} as ingestion_date
  from events where event_type = 'view')"""


# ── clean layer ────────────────────────────────────────────────────────────

SILVER_REVIEWS = """
silver_reviews as (
  select review_id, business_id, user_id, stars, text, useful, funny, cool, review_date,
         cast(year(review_date) as integer) as year, cast(month(review_date) as integer) as month
  from (
    select *, row_number() over (partition by review_id order by ingestion_date desc nulls last,
             business_id desc nulls last, user_id desc nulls last, stars desc nulls last,
             text desc nulls last, useful desc nulls last, funny desc nulls last,
             cool desc nulls last, review_date desc nulls last) as rn
    from (select review_id, business_id, user_id, cast(stars as double) as stars, text, useful, funny,
                 cool, ingestion_date, try_strptime(date, '%Y-%m-%d %H:%M:%S') as review_date
          from bronze_reviews) b
    where review_id is not null and review_date is not null and stars between 1 and 5) t
  where rn = 1)"""


def silver_business(src: str = "bronze_business", name: str = "silver_business") -> str:
    return f"""
{name} as (
  select business_id, name, city, state, postal_code, latitude, longitude, stars, review_count,
         is_open, categories
  from (
    select business_id, name, coalesce(trim(city), 'UNKNOWN') as city,
           coalesce(upper(state), 'UNKNOWN') as state, postal_code, latitude, longitude,
           cast(stars as double) as stars, cast(review_count as integer) as review_count,
           cast(is_open as boolean) as is_open, categories,
           row_number() over (partition by business_id order by ingestion_date desc) as rn
    from {src} where business_id is not null) t
  where rn = 1)"""


def categories(src: str = "bronze_business", name: str = "business_categories") -> str:
    return f"""
{name} as (
  select distinct business_id, category from (
    select business_id, trim(unnest(regexp_split_to_array(trim(categories), ',\\s*'))) as category
    from {src} where business_id is not null and categories is not null) t
  where category <> '')"""


def dim_business(biz: str = "silver_business", cats: str = "business_categories",
                 name: str = "dim_business") -> str:
    return f"""
{name} as (
  select b.business_id, b.name, b.city, b.state, b.postal_code, b.latitude, b.longitude,
         b.stars, b.review_count, b.is_open, coalesce(c.primary_category, 'Unknown') as primary_category
  from {biz} b
  left join (select business_id, min(category) as primary_category from {cats} group by business_id) c
    on b.business_id = c.business_id)"""


def silver_users(src: str = "bronze_users", name: str = "silver_users") -> str:
    return f"""
{name} as (
  select user_id, name, review_count, yelping_since, fans, average_stars, useful, funny, cool,
         is_elite, elite_years_count
  from (
    select user_id, name, review_count, try_strptime(yelping_since, '%Y-%m-%d %H:%M:%S') as yelping_since,
           fans, cast(average_stars as double) as average_stars, useful, funny, cool,
           coalesce(regexp_matches(elite, '[^ ]'), false) as is_elite,
           cast(coalesce(length(elite) - length(replace(elite, ',', '')) + 1, 0) * coalesce(regexp_matches(elite, '[^ ]'), false)::int as integer)
             as elite_years_count,
           row_number() over (partition by user_id order by ingestion_date desc) as rn
    from {src} where user_id is not null) t
  where rn = 1)"""


def dim_user(src: str = "silver_users", name: str = "dim_user") -> str:
    return f"""
{name} as (
  select user_id, name, review_count, average_stars, is_elite, elite_years_count,
         fans as fan_count, cast(year(yelping_since) as integer) as yelping_since_year,
         useful as total_useful_votes, funny as total_funny_votes, cool as total_cool_votes
  from {src})"""


SILVER_CHECKINS = f"""
checkin_events as (
  select distinct md5(business_id || '||' || strftime(checkin_ts, '{TS_FMT}')) as checkin_id,
         business_id, checkin_ts,
         cast(hour(checkin_ts) as integer) as checkin_hour,
         dayname(checkin_ts) as checkin_day_of_week,
         cast(year(checkin_ts) as integer) as year, cast(month(checkin_ts) as integer) as month
  from (select business_id, try_strptime(trim(item), '%Y-%m-%d %H:%M:%S') as checkin_ts
        from checkin_items where business_id is not null) t
  where checkin_ts is not null)"""

SILVER_TIPS = """
silver_tips as (
  select business_id, user_id, text, compliment_count, tip_date,
         cast(year(tip_date) as integer) as year, cast(month(tip_date) as integer) as month
  from (
    select *, row_number() over (partition by business_id, user_id, tip_date
             order by ingestion_date desc nulls last, text desc nulls last,
                      compliment_count desc nulls last) as rn
    from (select business_id, user_id, text, compliment_count, ingestion_date,
                 try_strptime(date, '%Y-%m-%d %H:%M:%S') as tip_date from bronze_tips) b
    where business_id is not null and user_id is not null and tip_date is not null) t
  where rn = 1)"""


# ── star schema ────────────────────────────────────────────────────────────

DIM_DATE = f"""
bounds as (
  select (select min(cast(l_shipdate as date)) from lineitem) as l, (select max(cast(l_shipdate as date)) + 1 from lineitem) as m,
         (select min(cast(ts as date)) from events) as e, (select max(cast(ts as date)) from events) as e2),
dim_date as (
  select md5(cast(full_date as varchar)) as date_id, full_date,
         cast(year(full_date) as integer) as year, cast(month(full_date) as integer) as month,
         cast(quarter(full_date) as integer) as quarter,
         cast(dayofweek(full_date) + 1 as integer) as day_of_week,
         dayname(full_date) as day_name,
         cast(weekofyear(full_date) as integer) as week_of_year,
         dayofweek(full_date) in (0, 6) as is_weekend
  from (select cast(unnest(generate_series(
        (select least(l, e) from bounds), (select greatest(m, e2) from bounds), interval 1 day)) as date) as full_date) s)"""

FACT_REVIEWS = """
fact_reviews as (
  select r.review_id, r.business_id, r.user_id, dd.date_id, r.stars as review_stars,
         r.useful as useful_votes, r.funny as funny_votes, r.cool as cool_votes,
         cast(length(r.text) as integer) as review_length_chars, r.review_date as reviewed_at,
         r.year, r.month
  from silver_reviews r left join dim_date dd on cast(r.review_date as date) = dd.full_date)"""

FACT_CHECKINS = """
fact_checkins as (
  select c.checkin_id, c.business_id, dd.date_id, c.checkin_hour, c.checkin_day_of_week,
         c.checkin_ts, c.year, c.month
  from checkin_events c left join dim_date dd on cast(c.checkin_ts as date) = dd.full_date)"""


def with_(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


REVIEWS_CHAIN = (BRONZE_REVIEWS, SILVER_REVIEWS, DIM_DATE, FACT_REVIEWS)
BUSINESS_CHAIN = (BRONZE_BUSINESS, silver_business(), categories(), dim_business())
USERS_CHAIN = (ELITE, BRONZE_USERS, silver_users(), dim_user())
CHECKINS_CHAIN = (CHECKIN_ITEMS, SILVER_CHECKINS, DIM_DATE, FACT_CHECKINS)


# ── data-quality results ───────────────────────────────────────────────────

BRONZE_CHECKINS = f"""
bronze_checkins as (
  select cast(user_id as varchar) as business_id,
         string_agg(case when event_id % 101 = 0 then 'garbage' else strftime(ts, '{TS_FMT}') end, ', ') as date,
         {d(RUN_DATE)} as ingestion_date
  from events group by user_id, floor(event_id / 16))"""


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _row(test, entity, layer, passed, message, value, threshold) -> str:
    return (f"select {q(test)} as test_name, {q(entity)} as entity, {q(layer)} as layer, "
            f"coalesce({passed}, false) as passed, {message} as message, "
            f"cast({value} as double) as value, cast({threshold} as double) as threshold")


def _sv(x: str) -> str:
    return f"coalesce(cast({x} as varchar), 'null')"


def check_rows_sql(table: str, entity: str, layer: str, min_rows=None, zero_null=(), null_rate=(),
                   stars=None, fresh=None, fresh_fmt=None, fresh_hours=None, as_of_ts=None,
                   key=None, key_table=None) -> list[str]:
    out = []
    if min_rows is not None:
        out.append(_row("row_count_minimum", entity, layer, f"n >= {min_rows}",
                        f"case when n >= {min_rows} then 'row count ' || {_sv('n')} || ' >= minimum {min_rows}' "
                        f"else 'FAIL - row count ' || {_sv('n')} || ' below minimum {min_rows}' end",
                        "n", float(min_rows)) + f" from (select count(*) as n from {table})")
    for c in zero_null:
        out.append(_row("zero_nulls", entity, layer, "x = 0", f"{q(f'column {chr(39)}{c}{chr(39)}: ')} || {_sv('x')} || ' null values'",
                        "x", 0.0) + f" from (select count(*) filter (where {c} is null) as x from {table})")
    for c in null_rate:
        out.append(_row("null_rate", entity, layer, "x = 0",
                        f"{q(f'column {chr(39)}{c}{chr(39)}: ')} || {_sv('x')} || ' of ' || {_sv('n')} || ' rows null'",
                        r2("case when n > 0 then x / n else 0.0 end", 4), 0.0)
                   + f" from (select count(*) filter (where {c} is null) as x, count(*) as n from {table})")
    if stars:
        out.append(_row("star_rating_range", entity, layer, "x = 0", f"{_sv('x')} || ' rows with stars outside 1-5'",
                        "x", 0.0) + f" from (select count(*) filter (where not ({stars} between 1 and 5)) as x from {table})")
    if fresh:
        col = f"try_strptime({fresh}, '%Y-%m-%d %H:%M:%S')" if fresh_fmt else fresh
        h = int(fresh_hours)
        age = f"((epoch_us(timestamp '{as_of_ts}') - epoch_us(latest)) / 3600000000.0)"
        out.append(_row("freshness", entity, layer, f"latest is not null and {age} <= {float(h)}",
                        f"case when latest is null then 'FAIL - no latest timestamp' when {age} <= {float(h)} "
                        f"then 'latest record within {h}h' else 'FAIL - latest record older than {h}h' end",
                        r2(age, 2), float(h)) + f" from (select max({col}) as latest from {table})")
    if key:
        kt = key_table or table
        out.append(_row("no_duplicate_keys", entity, layer, "total - dist = 0",
                        f"{q(f'key {chr(39)}{key}{chr(39)}: ')} || {_sv('total - dist')} || ' duplicate rows'",
                        "total - dist", 0.0)
                   + f" from (select coalesce(sum(c), 0) as total, count(*) as dist from "
                     f"(select {key}, count(*) as c from {kt} group by {key}) g)")
    return out


def lookback_rows_sql(table: str, entity: str, layer: str, run_date: dt.date, days: int) -> str:
    start = run_date - dt.timedelta(days=days - 1)
    return (_row("lookback_partitions_present", entity, layer, "m = 0",
                 f"{_sv('m')} || ' of {days} lookback partitions missing'", "m", 0.0)
            + f" from (select count(*) as m from (select cast(unnest(generate_series({d(start)}, {d(run_date)}, "
              f"interval 1 day)) as date) as p) e where p not in (select distinct ingestion_date from {table}))")


def loss_row_sql(bronze: str, silver: str, entity: str, keys: list[str], max_loss=5.0) -> str:
    loss = "(case when b > 0 then (b - a) / b * 100.0 else 0.0 end)"
    return (_row("bronze_silver_row_ratio", entity, "silver", f"{loss} <= {max_loss}",
                 f"'input ' || {_sv('b')} || ', output ' || {_sv('a')}", r2(loss, 2), max_loss)
            + f" from (select (select count(*) from (select distinct {', '.join(keys)} from {bronze}) k) as b, "
              f"(select count(*) from {silver}) as a)")


def generic_test_sql(model: str, col: str, kind: str, arg, layer: str = "gold") -> str:
    msg = f"{q(col + ': ')} || {_sv('x')} || ' failing rows'"
    if kind == "not_null":
        src = f"(select count(*) filter (where {col} is null) as x from {model})"
    elif kind == "unique":
        src = f"(select count(*) as x from (select {col} from {model} where {col} is not null group by {col} having count(*) > 1) g)"
    elif kind == "accepted_values":
        vals = ", ".join("true" if v is True else "false" if v is False else repr(v) for v in arg)
        src = f"(select count(*) filter (where {col} is not null and {col} not in ({vals})) as x from {model})"
    else:
        src = (f"(select count(*) as x from {model} c where c.{col} is not null and not exists "
               f"(select 1 from {arg[0]} p where p.{arg[1]} = c.{col}))")
    return _row(kind, model, layer, "x = 0", msg, "x", 0.0) + f" from {src}"


def union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


# ── history ────────────────────────────────────────────────────────────────

def hash_sql(cols: list[str]) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(cast({c} as varchar), '')" for c in cols) + "))"


def scd2_two_runs_sql(prev: str, latest: str, key: str, cols: list[str], tracked: list[str],
                      t1: str, t2: str) -> str:
    """History after loading snapshot ``prev`` at t1 and then ``latest`` at t2."""
    sel = ", ".join(cols)
    h = hash_sql(tracked)
    return f"""
hp as (select {sel}, {h} as record_hash from {prev}),
hl as (select {sel}, {h} as record_hash from {latest}),
history as (
  select {', '.join('p.' + c for c in cols)}, p.record_hash, timestamp '{t1}' as valid_from,
         case when l.{key} is not null and l.record_hash <> p.record_hash then timestamp '{t2}' end as valid_to,
         not (l.{key} is not null and l.record_hash <> p.record_hash) as is_current
  from hp p left join hl l on p.{key} = l.{key}
  union all
  select {', '.join('l.' + c for c in cols)}, l.record_hash, timestamp '{t2}' as valid_from,
         cast(null as timestamp) as valid_to, true as is_current
  from hl l left join hp p on p.{key} = l.{key}
  where p.{key} is null or p.record_hash <> l.record_hash)"""
