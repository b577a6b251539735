"""Registered queries over whole runs: tables that several loads, late rows and failures go through."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from strataflow import schemas as S
from strataflow.operators import history as hist
from strataflow.operators import gold, quality, silver
from strataflow.operators.running import running_totals
from strataflow.operators.upsert import read_keyed, upsert
from strataflow.plans import jobs
from strataflow.plans import oracle_sql as O
from strataflow.plans.catalog import _RUN_TS, _USER_COLS, _USER_SNAPSHOTS, TS, W, register
from strataflow.plans.layers import Layers
from strataflow.session import scratch_path, shuffles_dropped
from strataflow.sources.driver_tables import RUN_DATE, landing_files, reviews_bronze, table
from strataflow.sources.tables import SchemaMismatch, expired_for_layer, write_partitioned, write_table
from strataflow.streaming import streams as ST

# ── null keys ──────────────────────────────────────────────────────────────


@register("running_null_keys", W(*O.REVIEWS_CHAIN) + f"""
select case when useful_votes <> 3 then business_id end as business_id, review_id, {TS('reviewed_at')} as reviewed_at,
       cast(sum(useful_votes) over w as bigint) as useful_so_far, count(*) over w as reviews_so_far
from fact_reviews window w as (partition by case when useful_votes <> 3 then business_id end order by reviewed_at, review_id rows unbounded preceding)
""")
def q_running_null_keys(L: Layers) -> DataFrame:
    """Running votes where a share of the rows has no business: they are one partition like any other."""
    f = L.fact_reviews().select(F.when(F.col("useful_votes") != 3, F.col("business_id")).alias("business_id"), "review_id", "reviewed_at", "useful_votes")
    out = running_totals(f, ["business_id"], ["reviewed_at", "review_id"], sums={"useful_so_far": "useful_votes"}, counts={"reviews_so_far": "review_id"})
    return out.drop("useful_votes")


@register("upsert_null_keys", W(O.BRONZE_TIPS, O.SILVER_TIPS) + f"""
select user_id, business_id, {TS('tip_date')} as tip_date, year, month
from (select *, row_number() over (partition by user_id order by tip_date desc, business_id desc) as place
      from (select case when compliment_count <> 2 then user_id end as user_id, business_id, tip_date, year, month from silver_tips) t) p
where place = 1
""")
def q_upsert_null_keys(L: Layers) -> DataFrame:
    """The latest tip of each user, some without a user, upserted into a bucketed table; every load is replayed."""
    spark, path = L.spark, scratch_path(L.spark, "upsert_null_keys") + "/latest_tips"
    tips = L.silver("tips").select(F.when(F.col("compliment_count") != 2, F.col("user_id")).alias("user_id"), "business_id", "tip_date", "year", "month")
    for part in (F.col("month") <= 6, F.col("month") > 4, F.col("month") <= 6):
        upsert(spark, tips.filter(part), path, ["user_id"], ["year", "month"], ["tip_date", "business_id"], resolve="latest", buckets=2)
    return read_keyed(spark, path).select("user_id", "business_id", "tip_date", "year", "month")


# ── histories ──────────────────────────────────────────────────────────────

_TIMES = {"prev": "2001-05-30 00:00:00", "mid": "2001-05-31 00:00:00", "latest": "2001-06-01 00:00:00"}
_H = "user_id, " + ", ".join(hist.USER_TRACKED)


@register("history_any_order", W(*_USER_SNAPSHOTS, f"""
du_mid as (select * replace (case when fan_count % 3 = 0 then fan_count + 1 else fan_count end as fan_count) from du_latest where fan_count % 7 <> 0),
said as (select {_H}, {O.hash_sql(hist.USER_TRACKED)} as record_hash, timestamp '{_TIMES['prev']}' as said_at from du_prev
         union all select {_H}, {O.hash_sql(hist.USER_TRACKED)}, timestamp '{_TIMES['mid']}' from du_mid
         union all select {_H}, {O.hash_sql(hist.USER_TRACKED)}, timestamp '{_TIMES['latest']}' from du_latest),
changes as (select * from (select *, lag(record_hash) over (partition by user_id order by said_at) as was from said) x where was is null or was <> record_hash),
versions as (select *, lead(said_at) over (partition by user_id order by said_at) as until from changes)""") + f"""
select {_H}, record_hash, {TS('said_at')} as valid_from, {TS('until')} as valid_to, until is null as is_current from versions
""")
def q_history_any_order(L: Layers) -> DataFrame:
    """Three snapshots of the users, stored in the order latest, first, middle; the middle one is then run again."""
    spark, path = L.spark, scratch_path(L.spark, "history_any_order") + "/history"
    latest = L.dim_user("latest").select(*_USER_COLS)
    fans = F.col("fan_count")
    snaps = {"prev": L.dim_user("previous").select(*_USER_COLS), "latest": latest,
             "mid": latest.filter(fans % 7 != 0).withColumn("fan_count", F.when(fans % 3 == 0, fans + 1).otherwise(fans))}
    for name in ("latest", "prev", "mid", "mid"):
        hist.scd2_store(spark, path, snaps[name], "user_id", hist.USER_TRACKED, _TIMES[name])
    return hist.read_history(spark, path).select("user_id", *hist.USER_TRACKED, "record_hash", "valid_from", "valid_to", "is_current")


# ── layer jobs ─────────────────────────────────────────────────────────────

@register("isolated_runs", W(O.BRONZE_BUSINESS_LATEST, O.ELITE, O.BRONZE_USERS_LATEST, O.BRONZE_TIPS) + """
select 'business' as entity, 'SUCCESS' as status, cast(count(*) as bigint) as row_count, '' as error, count(*) as loaded from bronze_business_latest
union all select 'tips', 'SUCCESS', count(*), '', count(*) from bronze_tips
union all select 'users', 'FAILED', null, 'SchemaDriftError', 0 from bronze_users_latest having count(*) > 0
""")
def q_isolated_runs(L: Layers) -> DataFrame:
    """Three entities ingested side by side; the users' fans arrive as text, which halts that entity alone."""
    spark, paths = L.spark, jobs.Paths(scratch_path(L.spark, "isolated_runs"))
    landing = {}
    for e, df in (("business", L.bronze("business", "latest")), ("tips", L.bronze("tips")),
                  ("users", L.bronze("users", "latest").withColumn("fans", F.concat(F.col("fans").cast("string"), F.lit(" fans"))))):
        landing[e] = f"{paths.root}/landing/{e}"
        df.drop("ingestion_date").select(F.to_json(F.struct("*")).alias("value")).write.text(landing[e])
    try:
        jobs.run_bronze(spark, paths, landing, RUN_DATE, _RUN_TS + dt.timedelta(days=20 * 365), min_rows=0)
    except jobs.EntityRunsFailed as failed:
        if set(failed.failed) != {"users"}:
            raise
    audit = spark.read.parquet(paths.audit).select("entity", "status", "row_count", F.when(F.col("status") == "FAILED", F.substring_index("error", ":", 1))
                                                   .otherwise(F.lit("")).alias("error"))
    loaded = quality.union_all([spark.read.parquet(paths.bronze(e)).groupBy(F.lit(e).alias("e")).count() for e in ("business", "tips")])
    return audit.join(loaded, audit["entity"] == loaded["e"], "left").select(*audit.columns, F.coalesce("count", F.lit(0)).alias("loaded"))


_SHRUNK = "business_id not like '%3'"


@register("gold_volume_alert", W(*O.REVIEWS_CHAIN, *O.BUSINESS_CHAIN, *O.USERS_CHAIN, O.CHECKIN_ITEMS, O.SILVER_CHECKINS, O.FACT_CHECKINS, f"""
sizes as (select 'dim_business' as entity, (select count(*) from dim_business) as n1, (select count(*) from dim_business where {_SHRUNK}) as n2
          union all select 'dim_user', (select count(*) from dim_user), (select count(*) from dim_user)
          union all select 'fact_reviews', (select count(*) from fact_reviews), (select count(*) from fact_reviews)
          union all select 'fact_checkins', (select count(*) from fact_checkins), (select count(*) from fact_checkins)
          union all select 'dim_business_history', (select count(*) from dim_business), (select count(*) from dim_business)
          union all select 'dim_user_history', (select count(*) from dim_user), (select count(*) from dim_user))""") + f"""
select entity, 'gold' as layer, '{RUN_DATE}' as run_date, n1 as row_count, cast(null as bigint) as previous_count, cast(null as double) as change_pct,
       cast(null as varchar) as alert from sizes
union all
select entity, 'gold', '{RUN_DATE + dt.timedelta(days=1)}', n2, n1, {O.r2('(n2 - n1) / n1 * 100.0')}, case when (n2 - n1) / n1 * 100.0 < -5 then 'shrink' end from sizes
""")
def q_gold_volume_alert(L: Layers) -> DataFrame:
    """The star schema built on two days from clean tables; a tenth of the businesses is gone on the second,
    which the audit log shows and the day-over-day check reports."""
    spark, paths = L.spark, jobs.Paths(scratch_path(L.spark, "gold_volume"))
    for t in ("business", "business_categories", "users", "reviews", "checkin_events"):
        if t in jobs.PARTITIONED:       # as run_silver lays them out, by year and month
            write_partitioned(L.silver(t), paths.silver(t), ["year", "month"], guard=False)
        else:
            L.silver(t).write.parquet(paths.silver(t))
    jobs.run_gold(spark, paths, _RUN_TS)
    L.silver("business").filter(_SHRUNK).write.mode("overwrite").parquet(paths.silver("business"))
    jobs.run_gold(spark, paths, _RUN_TS + dt.timedelta(days=1))
    return quality.audit_volume(spark.read.parquet(paths.audit), "gold").filter("entity <> 'dim_date'")


# ── table layouts ──────────────────────────────────────────────────────────

@register("retention_clean", W(O.BRONZE_REVIEWS, O.SILVER_REVIEWS) + f"""
select 'year=' || year || '/month=' || month as partition, cast(last_day(make_date(year, month, 1)) as varchar) as last_day
from silver_reviews group by year, month having last_day(make_date(year, month, 1)) < {O.d(RUN_DATE)} - interval 365 day
""")
def q_retention_clean(L: Layers) -> DataFrame:
    """Months of the stored clean reviews beyond the clean layer's year, from the folder names."""
    path = scratch_path(L.spark, "retention_clean") + "/reviews"
    write_partitioned(L.silver("reviews"), path, ["year", "month"], guard=False)
    return expired_for_layer(L.spark, path, "silver", RUN_DATE)


@register("zorder_layout", W(*O.REVIEWS_CHAIN) + """
select business_id, user_id, count(*) as reviews from fact_reviews where user_id >= '5' and user_id < '6' group by business_id, user_id
""")
def q_zorder_layout(L: Layers) -> DataFrame:
    """The review fact along a Z curve through (business, user), read by a range of users (row groups are skipped)."""
    path = scratch_path(L.spark, "zorder") + "/fact_reviews"
    fact, finish = L.fact_reviews(), None
    rows = fact
    if gold.date_dim_fits_broadcast(L.date_start, L.date_end):      # then the look-up leaves the order
        rows = fact.drop("date_id")
        finish = lambda df: gold.with_date_id(df, "reviewed_at", L.dim_date(), L.date_start, L.date_end).select(*fact.columns)
    write_table(rows, path, cluster_cols=["business_id", "user_id"], zorder=True, finish=finish)
    return (L.spark.read.parquet(path).filter((F.col("user_id") >= "5") & (F.col("user_id") < "6"))
            .groupBy("business_id", "user_id").agg(F.count("*").alias("reviews")))


@register("schema_guard", W(O.BRONZE_TIPS, O.SILVER_TIPS) + """
select attempt, attempt <> 'same columns' as refused, (select count(*) from silver_tips) as rows_after
from (select unnest(['same columns', 'other type', 'new column', 'missing column']) as attempt)
""")
def q_schema_guard(L: Layers) -> DataFrame:
    """Writes into a stored table under other schemas are refused and leave it as it was."""
    spark, path, tips = L.spark, scratch_path(L.spark, "schema_guard") + "/tips", L.silver("tips")
    write_partitioned(tips, path, ["year", "month"], guard=False)
    attempts = {"same columns": tips, "other type": tips.withColumn("compliment_count", F.col("compliment_count").cast("string")),
                "new column": tips.withColumn("client", F.lit("app")), "missing column": tips.drop("text")}
    out = []
    for name, df in attempts.items():
        try:
            write_partitioned(df, path, ["year", "month"])
            refused = False
        except SchemaMismatch:
            refused = True
        out.append(spark.read.parquet(path).agg(F.count("*").alias("rows_after")).select(F.lit(name).alias("attempt"), F.lit(refused).alias("refused"), "rows_after"))
    return quality.union_all(out)


@register("personal_columns", W(*O.USERS_CHAIN) + """
select 'name' as column_name, count(name) as filled, count(distinct md5(name)) as pseudonyms from dim_user
""")
def q_personal_columns(L: Layers) -> DataFrame:
    """Columns of the stored user dimension that are tagged as personal data, with their values replaced by pseudonyms."""
    path = scratch_path(L.spark, "personal") + "/dim_user"
    write_table(L.dim_user(), path)
    users = L.spark.read.parquet(path)
    tagged = [f.name for f in users.schema.fields if f.metadata.get("pii")]
    return quality.union_all([users.select(F.md5(c).alias("p")).agg(F.lit(c).alias("column_name"), F.count("p").alias("filled"), F.countDistinct("p").alias("pseudonyms"))
                              for c in tagged])


# ── streams ────────────────────────────────────────────────────────────────

_LATE = ("cast(ts as timestamp) < (select max(cast(ts as timestamp)) from events) - interval 10 day and event_id % 5 = 0")


@register("stream_late_replayed", f"""
select cast(cast(ts as date) as varchar) as day, count(*) as events, count(*) filter (where {_LATE}) as late_events from events group by cast(ts as date)
""")
def q_stream_late_replayed(L: Layers) -> DataFrame:
    """Daily counts over three deliveries. Rows far behind the 3-day watermark go to the replay table, and a
    batch step takes them: stream plus replay are the batch answer."""
    spark, base = L.spark, scratch_path(L.spark, "stream_late_replayed")
    ev = table(spark, L.sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    last = ev.agg(F.max("ts").alias("last"))
    late = (F.col("ts") < F.col("last") - F.expr("INTERVAL 10 DAYS")) & (F.col("event_id") % 5 == 0)
    marked = ev.join(F.broadcast(last), F.lit(True)).withColumn("late", late).select("event_id", "ts", "late")   # one row
    for n, part in enumerate((~F.col("late"), F.col("late") & (F.col("event_id") % 2 == 0), F.col("late") & (F.col("event_id") % 2 == 1))):
        marked.filter(part).select("event_id", "ts").write.parquet(f"{base}/landing/{n}")
    handler = ST.split_late("ts", base + "/replay", ST.window_parts(base + "/daily", "ts"), window="1 day")
    for n in range(3):
        src = ST.file_stream(spark, f"{base}/landing/{{{','.join(map(str, range(n + 1)))}}}", ev.schema, fmt="parquet")
        ST.start(src, base + "/checkpoint", foreach_batch=handler, available_now=True).awaitTermination()
    for _ in range(2):      # the second finds nothing left to take
        ST.take_late(spark, base + "/replay", ST.window_parts(base + "/daily", "ts", prefix="replay"))
    return ST.merged_windows(spark, base + "/daily").select(F.to_date("window_start").cast("string").alias("day"), "events", "late_events")


class Stopped(RuntimeError):
    """The planted stop of ``stream_three_topics``."""


@register("stream_three_topics", W(O.BRONZE_REVIEWS, O.SILVER_REVIEWS, O.CHECKIN_ITEMS, O.SILVER_CHECKINS, O.BRONZE_TIPS, O.SILVER_TIPS) + f"""
select 'reviews' as topic, review_id as id, {TS('review_date')} as at, cast(stars as varchar) as detail from silver_reviews
union all select 'checkins', checkin_id, {TS('checkin_ts')}, checkin_day_of_week from checkin_events
union all select 'tips', business_id || '/' || user_id, {TS('tip_date')}, text from silver_tips
""")
def q_stream_three_topics(L: Layers) -> DataFrame:
    """Reviews, check-ins and tips as one stream of messages, routed to three clean tables by one handler with the batch
    jobs' own cleaning functions. The first run is stopped between two sinks of a batch; the restarted one completes it."""
    spark, base = L.spark, scratch_path(L.spark, "three_topics")
    dated = StructType([*S.REVIEWS_SCHEMA.fields, StructField("ingestion_date", DateType(), True)])
    files = 0
    for topic, df, schema in (("reviews", L.bronze("reviews"), dated), ("checkins", L.bronze("checkins"), S.CHECKINS_SCHEMA), ("tips", L.bronze("tips"), S.TIPS_SCHEMA)):
        n = landing_files(df, 3)
        # dealt out before they are texts, and compressed: as JSON, they are many times the tables
        rows = (reviews_bronze(spark, L.sf_dir, lambda j: j.repartition(n, "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"))
                if topic == "reviews" else df.repartition(n))
        with shuffles_dropped(spark):
            rows.select(F.to_json(F.struct(*schema.fieldNames())).alias("value")).write.text(f"{base}/landing/topic={topic}", compression="gzip")
        files += n

    def table_of(topic: str, keys: list[str], clean, order: list[str]) -> list:
        return [ST.batch_partition(f"{base}/raw/{topic}"),
                ST.upsert_batches(f"{base}/clean/{topic}", keys, ["year"], clean, order, "latest", buckets=2)]

    topics = {"reviews": ST.Topic(dated, table_of("reviews", ["review_id"], lambda b: silver.clean_reviews(b, keep_ingestion_date=True), ["ingestion_date"])),
              "checkins": ST.Topic(S.CHECKINS_SCHEMA, table_of("checkins", ["checkin_id"], silver.checkin_events, [])),
              "tips": ST.Topic(S.TIPS_SCHEMA, table_of("tips", ["business_id", "user_id", "tip_date"], silver.clean_tips, []))}
    handler = ST.route_topics(topics, base + "/quarantine", staging=base + "/batch")

    def stop(batch: DataFrame, epoch_id: int) -> None:
        if epoch_id == 1:
            raise Stopped("between two sinks")
    stopping = ST.route_topics({t: ST.Topic(x.schema, [*x.sinks[:1], stop, *x.sinks[1:]]) for t, x in topics.items()}, base + "/quarantine", staging=base + "/batch")

    def run(handle: ST.Handler) -> None:
        # three batches, however many files there are
        src = ST.topic_files(spark, base + "/landing", max_files_per_trigger=-(-files * 4 // 9))
        ST.start(src, base + "/checkpoint", foreach_batch=handle, available_now=True).awaitTermination()
    try:
        run(stopping)
    except Exception as e:  # noqa: BLE001 - Spark wraps what the handler raised
        if Stopped.__name__ not in str(e):
            raise
    run(handler)
    clean = {t: read_keyed(spark, f"{base}/clean/{t}") for t in topics}
    return quality.union_all([
        clean["reviews"].select(F.lit("reviews").alias("topic"), F.col("review_id").alias("id"), F.col("review_date").alias("at"),
                                F.col("stars").cast("string").alias("detail")),
        clean["checkins"].select(F.lit("checkins").alias("topic"), F.col("checkin_id").alias("id"), F.col("checkin_ts").alias("at"),
                                 F.col("checkin_day_of_week").alias("detail")),
        clean["tips"].select(F.lit("tips").alias("topic"), F.concat_ws("/", "business_id", "user_id").alias("id"), F.col("tip_date").alias("at"),
                             F.col("text").alias("detail"))])
