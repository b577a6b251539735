"""Raw-layer entities derived from the benchmark parquet tables.

The review platform's five source entities are not shipped with any data, so
the test and benchmark inputs are derived, by Spark, from the TPC-H-style
tables: lineitem/orders/part become reviews, part/nation/region businesses,
customer/orders users, and events check-ins and tips. Each function returns a
DataFrame in the entity's declared source schema plus ``ingestion_date`` (the
raw-layer partition column), so every job downstream runs on data whose size
grows with the scale factor.

Deliberate defects are planted (out-of-range stars, malformed dates, padded or
missing cities, blank elite strings, duplicate keys across snapshots) so the
cleaning rules have something to remove.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.schemas import SOURCE_TS_FORMAT
from strataflow.sources.tables import input_bytes

# Fixed parameters of the derived data set.
RUN_DATE = dt.date(2001, 6, 1)          # latest raw snapshot
PREVIOUS_DATE = dt.date(2001, 5, 31)    # earlier snapshot for business/users


# Large inputs and the column that spreads their rows evenly.
REBALANCE_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey", "events": "event_id"}


# Read-only inputs: their parquet schema and split count are looked up once per
# path (each lookup is otherwise a footer-reading job / a physical plan).
_SCHEMAS: dict[str, object] = {}
_SPLITS: dict[tuple, int] = {}


def rebalance_if_unsplit(df: DataFrame, key: str, path: str | None = None) -> DataFrame:
    """Even redistribution of a large input that the scan cannot split.

    A file written as one row group is read by a single task however large
    it is; then everything up to the first shuffle runs serially. Only in
    that case the rows are hash-distributed over the session's parallelism.
    A scan that already yields enough splits (any input written in normal
    row groups) is returned unchanged, so this costs nothing at scale.
    """
    spark = df.sparkSession
    want = spark.sparkContext.defaultParallelism
    memo = (path, want, spark.conf.get("spark.sql.files.maxPartitionBytes"),
            spark.conf.get("spark.sql.files.openCostInBytes")) if path else None
    splits = _SPLITS.get(memo) if memo else None
    if splits is None:
        splits = df.rdd.getNumPartitions()
        if memo:
            _SPLITS[memo] = splits
    if splits >= want:
        return df
    return df.repartition(want, key)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    _SCHEMAS.setdefault(path, df.schema)
    key = REBALANCE_KEYS.get(name)
    return rebalance_if_unsplit(df, key, path) if key else df


#: Bytes of table files behind one landing file of a stream: its task's share does not grow with the input.
LANDING_FILE_BYTES = 16 << 20


def landing_files(df: DataFrame, least: int) -> int:
    """Number of landing files for ``df``: in proportion to the files it reads, ``least`` for a small input."""
    return max(least, -(-input_bytes(df) // LANDING_FILE_BYTES))


def _fmt(ts_col) -> F.Column:
    return F.date_format(ts_col, SOURCE_TS_FORMAT)


def reviews_bronze(spark: SparkSession, sf_dir: str, layout: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One raw review per lineitem row (keys repeat, so there are duplicates),
    spread over three daily snapshots ending at RUN_DATE.

    ``layout`` deals the rows out over tasks; it gets them while they are numbers and times, which
    travel narrower than their texts."""
    # What depends on the line alone is derived before the joins: few values travel instead of many.
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate",
        F.when(F.col("l_suppkey") % 50 == 0, F.lit(6))
         .otherwise(F.lit(1) + F.col("l_quantity").cast("int") % 5).cast("int").alias("stars"),
        F.date_sub(F.lit(RUN_DATE), (F.col("l_suppkey") % 3).cast("int")).alias("ingestion_date"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    # Orders come last: the lines of an order, and with them a review's copies, then leave the join in one task,
    # where a de-duplication by review merges them before it moves any.
    j = (li.join(part, li.l_partkey == part.p_partkey)
           .join(orders, li.l_orderkey == orders.o_orderkey))
    j = layout(j) if layout else j
    shifted = F.expr("timestampadd(SECOND, l_orderkey % 86400, l_shipdate)")
    return j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("review_id"),
        F.col("l_partkey").cast("string").alias("business_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        "stars",
        F.when(F.col("l_partkey") % 97 == 0, F.lit("n/a"))
         .otherwise(_fmt(shifted)).alias("date"),
        F.col("p_name").alias("text"),
        F.col("l_linenumber").cast("bigint").alias("useful"),
        (F.col("l_orderkey") % 3).alias("funny"),
        (F.col("l_partkey") % 4).alias("cool"),
        "ingestion_date",
    )


def _business_snapshot(spark: SparkSession, sf_dir: str, previous: bool) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size")
    # nation (25 rows) and region (5 rows) are fixed-size by the benchmark's
    # definition, so broadcasting them is bounded.
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    region = F.broadcast(table(spark, sf_dir, "region"))
    j = (part.join(nation, (part.p_partkey % 25) == nation.n_nationkey)
             .join(region, nation.n_regionkey == region.r_regionkey))
    k = F.col("p_partkey")
    if previous:
        j = j.filter(k % 10 != 9)           # these businesses appear only later
        stars = F.when(k % 7 == 0, F.lit(1) + (F.col("p_size") + 1) % 5).otherwise(F.lit(1) + F.col("p_size") % 5)
        day = PREVIOUS_DATE
    else:
        # these vanish from the latest export; none that is new in it, so every part is in some snapshot
        j = j.filter((k % 17 != 5) | (k % 10 == 9))
        stars = F.lit(1) + F.col("p_size") % 5
        day = RUN_DATE
    return j.select(
        k.cast("string").alias("business_id"),
        F.col("p_name").alias("name"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
         .when(k % 11 == 1, F.concat(F.lit("  "), F.col("n_name"), F.lit(" ")))
         .otherwise(F.col("n_name")).alias("city"),
        F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(F.lower("r_name")).alias("state"),
        (F.lit(10000) + k % 90000).cast("string").alias("postal_code"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("r_regionkey").cast("double").alias("longitude"),
        stars.cast("double").alias("stars"),
        F.col("p_size").cast("bigint").alias("review_count"),
        F.when(F.col("p_size") % 5 == 0, F.lit(0)).otherwise(F.lit(1)).cast("int").alias("is_open"),
        F.when(k % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("p_type"), F.lit(", "),
                             F.regexp_replace("p_name", " ", ", "))).alias("categories"),
        F.lit(None).cast("string").alias("hours"),
        F.lit(None).cast("string").alias("attributes"),
        F.lit(day).alias("ingestion_date"),
    )


def business_bronze(spark: SparkSession, sf_dir: str, snapshot: str = "all") -> DataFrame:
    """Businesses from part; two daily snapshots (``previous``, ``latest`` or ``all``)."""
    if snapshot == "previous":
        return _business_snapshot(spark, sf_dir, True)
    if snapshot == "latest":
        return _business_snapshot(spark, sf_dir, False)
    return _business_snapshot(spark, sf_dir, True).unionByName(_business_snapshot(spark, sf_dir, False))


def elite_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, packed elite years): distinct years of a customer's urgent orders.

    The set per customer is bounded by the number of calendar years, and
    ``collect_set`` de-duplicates map-side before the shuffle.
    """
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return (o.groupBy("o_custkey")
             .agg(F.concat_ws(",", F.sort_array(F.collect_set(
                 F.year("o_orderdate").cast("string")))).alias("elite_years"))
             .withColumnRenamed("o_custkey", "e_custkey"))


def _users_snapshot(spark: SparkSession, sf_dir: str, previous: bool) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    e = elite_years(spark, sf_dir)
    j = c.join(e, c.c_custkey == e.e_custkey, "left")
    k = F.col("c_custkey")
    name, fans, day = F.col("c_name"), F.col("c_nationkey"), RUN_DATE
    if previous:
        j = j.filter(k % 10 != 9)
        name = F.when(k % 5 == 0, F.concat(F.col("c_name"), F.lit(" Sr"))).otherwise(F.col("c_name"))
        fans = F.when(k % 7 == 0, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey"))
        day = PREVIOUS_DATE
    since = F.expr("timestampadd(HOUR, c_custkey % 87600, timestamp'2000-01-01 00:00:00')")
    return j.select(
        k.cast("string").alias("user_id"),
        name.alias("name"),
        (k % 100).cast("bigint").alias("review_count"),
        F.when(k % 53 == 0, F.lit("unknown")).otherwise(_fmt(since)).alias("yelping_since"),
        F.when(k % 9 == 0, F.lit("  ")).otherwise(F.col("elite_years")).alias("elite"),
        fans.cast("bigint").alias("fans"),
        (F.lit(1) + F.col("c_nationkey") % 5).cast("double").alias("average_stars"),
        (k % 10).cast("bigint").alias("useful"),
        (k % 5).cast("bigint").alias("funny"),
        (k % 3).cast("bigint").alias("cool"),
        F.lit(day).alias("ingestion_date"),
    )


def users_bronze(spark: SparkSession, sf_dir: str, snapshot: str = "all") -> DataFrame:
    """Users from customer (+ elite years from orders); two daily snapshots."""
    if snapshot == "previous":
        return _users_snapshot(spark, sf_dir, True)
    if snapshot == "latest":
        return _users_snapshot(spark, sf_dir, False)
    return _users_snapshot(spark, sf_dir, True).unionByName(_users_snapshot(spark, sf_dir, False))


def checkins_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed check-in strings: events of one user (as business) grouped in
    blocks of 16 consecutive event ids, timestamps joined by ', '.

    Packing per bounded block keeps every packed row small even for a user that
    owns a large share of all events.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    item = F.when(F.col("event_id") % 101 == 0, F.lit("garbage")).otherwise(_fmt(F.col("ts")))
    return (ev.groupBy(F.col("user_id"), F.floor(F.col("event_id") / 16).alias("blk"))
              .agg(F.concat_ws(", ", F.collect_list(item)).alias("date"))
              .select(F.col("user_id").cast("string").alias("business_id"), "date",
                      F.lit(RUN_DATE).alias("ingestion_date")))


def tips_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tips from 'view' events."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "view")
    return ev.select(
        (F.col("event_id") % 100).cast("string").alias("business_id"),
        F.when(F.col("event_id") % 89 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.col("props").alias("text"),
        _fmt(F.col("ts")).alias("date"),
        (F.col("event_id") % 7).alias("compliment_count"),
        F.lit(RUN_DATE).alias("ingestion_date"),
    )


def event_bounds(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    """First and last day of any review or check-in (review times lie within a day after the ship date)."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("a"),
                                                 F.date_add(F.col("l_shipdate").cast("date"), 1).alias("b"))
    ev = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("a"), F.col("ts").cast("date").alias("b"))
    lo, hi = li.unionAll(ev).agg(F.min("a"), F.max("b")).first()
    return (lo, hi) if lo else (RUN_DATE, RUN_DATE)
