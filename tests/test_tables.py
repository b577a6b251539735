"""Table IO helpers: replay, retention, readability, materialisation kinds,
audit-based regression, personal-data tags."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from strataflow.operators import quality as Q
from strataflow.plans import jobs
from strataflow.schemas import AUDIT_SCHEMA
from strataflow.sources import bronze as B
from strataflow.sources.tables import append_records, expired_partitions, write_partitioned


def test_replay_and_retention(spark, tmp_dir):
    srcs = {}
    for i, day in enumerate((dt.date(2024, 1, 1), dt.date(2024, 1, 2))):
        d = f"{tmp_dir}/land{i}"
        os.makedirs(d)
        with open(d + "/c.json", "w") as f:
            f.write("\n".join(json.dumps({"business_id": f"b{j}", "date": "2020-01-01 00:00:00"})
                              for j in range(3 + i)))
        srcs[day] = d
    out = tmp_dir + "/bronze"
    res = B.replay(spark, "checkins", srcs, out, dt.datetime(2024, 1, 3), min_rows=0)
    assert [r.rows_written for r in res] == [3, 4]
    exp = expired_partitions(spark, out, "ingestion_date", dt.date(2024, 1, 3), keep_days=1)
    assert [r[0] for r in exp.collect()] == [dt.date(2024, 1, 1)]


def test_table_readable(spark, tmp_dir):
    spark.range(3).write.parquet(tmp_dir + "/ok")
    df, res = Q.table_readable(spark, tmp_dir + "/ok", "x", "silver")
    assert df is not None and res.first().passed
    df, res = Q.table_readable(spark, tmp_dir + "/missing", "x", "silver")
    assert df is None and not res.first().passed


def test_materialize_kinds(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1, 1)], "k string, v int, month int")
    assert jobs.materialize(df, "ephemeral", "m") is df
    jobs.materialize(df, "view", "m_view")
    assert spark.table("m_view").count() == 1
    assert jobs.materialize(df, "table", "m", tmp_dir + "/t") == 1
    jobs.materialize(df, "incremental", "m", tmp_dir + "/i", keys=["k"], partition_cols=["month"])
    assert spark.read.parquet(tmp_dir + "/i").count() == 1


def test_regression_against_audit(spark, tmp_dir):
    rows = [("reviews", "silver", 100, None, None, None, dt.date(2024, 1, d), dt.datetime(2024, 1, d), s, "")
            for d, s in ((1, "SUCCESS"), (2, "SUCCESS"), (3, "FAILED"))]
    append_records(spark, tmp_dir + "/audit", rows, AUDIT_SCHEMA)
    audit = spark.read.parquet(tmp_dir + "/audit")
    cur = spark.range(85)
    r = Q.regression_vs_previous(cur, audit, "reviews", "silver").first()
    assert not r.passed and r.value == 15.0
    assert Q.regression_vs_previous(spark.range(95), audit, "reviews", "silver").first().passed
    drop = Q.input_output_drop(spark.range(100), spark.range(89), "reviews", "silver").first()
    assert not drop.passed and drop.test_name == "input_output_drop"


def test_results_append_and_pii_tag(spark, tmp_dir):
    res = Q.non_empty(spark.range(2), "x", "silver")
    Q.write_test_results(res, tmp_dir + "/r", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1, 6))
    Q.write_test_results(res, tmp_dir + "/r", dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 6))
    assert spark.read.parquet(tmp_dir + "/r").select("run_date").distinct().count() == 2
    from strataflow.operators.gold import dim_user
    users = spark.createDataFrame([("u", "N", 1, None, 1, 4.0, 0, 0, 0, True, 0)],
                                  "user_id string, name string, review_count long, yelping_since timestamp, "
                                  "fans long, average_stars double, useful long, funny long, cool long, "
                                  "is_elite boolean, elite_years_count int")
    assert dim_user(users).schema["name"].metadata.get("pii") is True


def part_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_one_partition_value_is_many_write_tasks(spark, tmp_dir):
    """A day, a month or the current versions of a history are not one task."""
    from pyspark.sql import functions as F

    from strataflow.operators.history import scd2_store
    from strataflow.operators.upsert import upsert
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    df = spark.range(60_000).select(F.col("id").cast("string").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"),
                                    F.lit(dt.date(2024, 1, 1)).alias("ingestion_date"), F.lit(1).alias("month"))
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        write_partitioned(df, tmp_dir + "/day", ["ingestion_date"])
        upsert(spark, df, tmp_dir + "/month", ["k"], ["month"])
        upsert(spark, df.withColumn("v", F.upper("v")), tmp_dir + "/month", ["k"], ["month"])
        scd2_store(spark, tmp_dir + "/history", df.select("k", "v"), "k", ["v"], "2024-01-01 00:00:00")
        for name in ("day", "month", "history"):
            assert len(part_files(f"{tmp_dir}/{name}")) >= 4, name
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def row_groups_met(path, column, low, high):
    """(row groups whose footer range meets [low, high], all row groups)."""
    import pyarrow.parquet as pq
    met = total = 0
    for root, _, names in os.walk(path):
        for f in (n for n in names if n.endswith(".parquet")):
            meta = pq.ParquetFile(os.path.join(root, f)).metadata
            for g in range(meta.num_row_groups):
                stats = next(meta.row_group(g).column(i).statistics for i in range(meta.num_columns)
                             if meta.row_group(g).column(i).path_in_schema == column)
                total += 1
                met += not (stats.max < low or stats.min > high)
    return met, total


def test_zorder_skips_on_the_second_column(spark, tmp_dir):
    from pyspark.sql import functions as F

    from strataflow.sources.tables import write_table
    df = spark.range(120_000).select(F.concat(F.lit("c"), F.lpad((F.xxhash64("id") % 5000 + 5000).cast("string"), 5, "0")).alias("city"),
                                     (F.xxhash64(F.col("id") + 1) % 100_000).alias("score"), F.col("id"))
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "24k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
            "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        write_table(df, tmp_dir + "/lex", cluster_cols=["city", "score"])
        write_table(df, tmp_dir + "/z", cluster_cols=["city", "score"], zorder=True)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert spark.read.parquet(tmp_dir + "/z").exceptAll(df).count() == 0 and spark.read.parquet(tmp_dir + "/z").count() == 120_000
    met, total = row_groups_met(tmp_dir + "/lex", "score", 1000, 3000)
    assert met > 0.9 * total and total >= 30                    # lexicographic: the first column alone can skip
    met, total = row_groups_met(tmp_dir + "/z", "score", 1000, 3000)
    assert met < 0.35 * total and total >= 30
    met, total = row_groups_met(tmp_dir + "/z", "city", "c01000", "c01200")
    assert met < 0.35 * total


def test_zorder_of_nulls_ties_and_empty(spark, tmp_dir):
    from strataflow.sources.tables import range_cuts, write_table, zorder_value
    df = spark.createDataFrame([(None, 1.5, dt.date(2024, 1, 1)), ("a", None, None), ("a", 2.5, dt.date(2024, 1, 2))] * 20, "a string, b double, c date")
    assert write_table(df, tmp_dir + "/t", cluster_cols=["a", "b", "c"], zorder=True) == 60
    assert write_table(df.limit(0), tmp_dir + "/e", cluster_cols=["a", "b"], zorder=True) == 0
    z = df.select("a", "b", zorder_value(range_cuts(df, ["a", "b"])).alias("z")).distinct().collect()
    assert next(r.z for r in z if r.a is None) < next(r.z for r in z if r.a == "a" and r.b == 2.5)


def test_retention_of_year_month_tables(spark, tmp_dir):
    from strataflow.sources.tables import expired_for_layer
    rows = [("2010", 1, 12), ("x", 2023, 1), ("x", 2023, 2), ("x", 2024, 1), ("x", None, None), ("x", 2023, 12)]
    df = spark.createDataFrame(rows, "k string, year int, month int").filter("k <> '2010'").unionByName(
        spark.createDataFrame([("k", 2010, 12)], "k string, year int, month int"))
    write_partitioned(df, tmp_dir + "/silver", ["year", "month"])
    got = [tuple(r) for r in expired_for_layer(spark, tmp_dir + "/silver", "silver", dt.date(2024, 2, 15)).collect()]
    assert got == [("year=2010/month=12", dt.date(2010, 12, 31)), ("year=2023/month=1", dt.date(2023, 1, 31))]
    write_partitioned(df.selectExpr("k", "date'2023-10-01' as ingestion_date"), tmp_dir + "/bronze", ["ingestion_date"])
    got = [tuple(r) for r in expired_for_layer(spark, tmp_dir + "/bronze", "bronze", dt.date(2024, 2, 15)).collect()]
    assert got == [("ingestion_date=2023-10-01", dt.date(2023, 10, 1))]


def test_replacement_that_stopped_between_its_renames_is_undone(spark, tmp_dir):
    from strataflow.sources.tables import replace_path, restore_path
    t, staged = tmp_dir + "/t", tmp_dir + "/t__staging"
    spark.range(3).write.parquet(t)
    os.rename(t, t + "__old")                   # the first rename, then the run is gone
    assert restore_path(spark, t) and spark.read.parquet(t).count() == 3 and not restore_path(spark, t)
    os.rename(t, t + "__old")
    spark.range(5).write.parquet(staged)
    replace_path(spark, staged, t)              # a run that goes on puts it back first, so nothing is lost if it stops, too
    assert spark.read.parquet(t).count() == 5 and not os.path.exists(t + "__old")


def test_zorder_makes_its_rows_once(spark, tmp_dir):
    from strataflow.sources.tables import write_table
    made = spark.sparkContext.accumulator(0)

    def counted(row):
        made.add(1)
        return row.id % 17, row.id % 5, str(row.id)
    df = spark.createDataFrame(spark.range(300).rdd.map(counted), "a long, b long, c string")
    assert write_table(df, tmp_dir + "/z", cluster_cols=["a", "b"], zorder=True) == 300
    assert made.value == 300
    assert sorted(map(tuple, spark.read.parquet(tmp_dir + "/z").collect())) == sorted(map(tuple, df.collect()))
    assert [f for f in os.listdir(tmp_dir) if not f.startswith(".")] == ["z"]


def test_a_write_without_rebalance_keeps_its_tasks(spark, tmp_dir):
    from strataflow.sources.tables import write_partitioned
    df = spark.range(400).repartition(4).withColumn("day", F.lit(dt.date(2024, 1, 1)))
    assert write_partitioned(df, tmp_dir + "/t", ["day"], rebalance=False) == 400
    assert len([f for f in os.listdir(tmp_dir + "/t/day=2024-01-01") if f.endswith(".parquet")]) == 4
    assert spark.read.parquet(tmp_dir + "/t").select("id").distinct().count() == 400
