"""Layer jobs over table paths: reruns are idempotent, history grows by versions."""

import datetime as dt

from strataflow.plans import jobs
from strataflow.plans.layers import Layers
from strataflow.sources.tables import write_partitioned

SF = "/root/testdata/sf0.001"
RUN_TS = dt.datetime(2001, 6, 1, 6, 0)


def snapshot(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).collect()), key=repr)


def test_rerun_is_idempotent_and_history_versions(spark, tmp_dir):
    L = Layers(spark, SF)
    paths = jobs.Paths(tmp_dir)
    for e in ("business", "reviews", "users", "checkins", "tips"):
        snap = "previous" if e in ("business", "users") else "all"
        write_partitioned(L.bronze(e, snap), paths.bronze(e), ["ingestion_date"], guard=False)
    jobs.run_silver(spark, paths, dt.date(2001, 6, 1), RUN_TS)
    jobs.run_gold(spark, paths, RUN_TS)
    fact1 = snapshot(spark, paths.gold("fact_reviews"))
    hist1 = snapshot(spark, paths.gold("dim_business_history"))
    # same inputs, same run: nothing changes
    jobs.run_silver(spark, paths, dt.date(2001, 6, 1), RUN_TS)
    jobs.run_gold(spark, paths, RUN_TS)
    assert snapshot(spark, paths.gold("fact_reviews")) == fact1
    assert snapshot(spark, paths.gold("dim_business_history")) == hist1
    # the next export changes some businesses: old versions close, one current per key
    write_partitioned(L.bronze("business", "latest"), paths.bronze("business"), ["ingestion_date"], guard=False)
    jobs.run_silver(spark, paths, dt.date(2001, 6, 1), RUN_TS)
    jobs.run_gold(spark, paths, RUN_TS + dt.timedelta(days=1))
    h = spark.read.parquet(paths.gold("dim_business_history"))
    assert h.count() > len(hist1)
    per_key = h.groupBy("business_id").agg({"is_current": "count"}).collect()
    current = h.filter("is_current").groupBy("business_id").count()
    assert current.filter("count <> 1").count() == 0
    assert current.count() == len(per_key)
    audit = spark.read.parquet(paths.audit)
    assert audit.filter("layer = 'silver'").count() == 3 * 6


def test_empty_clean_table_does_not_replace_the_stored_one(spark, tmp_dir):
    import pytest
    L, paths, day = Layers(spark, SF), jobs.Paths(tmp_dir), dt.date(2001, 6, 1)
    write_partitioned(L.bronze("tips"), paths.bronze("tips"), ["ingestion_date"], guard=False)
    n = jobs.run_silver(spark, paths, day, RUN_TS)["tips"]
    write_partitioned(L.bronze("tips").selectExpr("null business_id", "user_id", "text", "date", "compliment_count", "ingestion_date"),
                      paths.bronze("tips"), ["ingestion_date"], guard=False)
    with pytest.raises(jobs.EntityRunsFailed, match="SilverCheckError"):
        jobs.run_silver(spark, paths, day, RUN_TS + dt.timedelta(hours=1))
    assert spark.read.parquet(paths.silver("tips")).count() == n
    rows = spark.read.parquet(paths.test_results).filter("test_name = 'non_empty'").orderBy("run_timestamp").collect()
    assert [r.passed for r in rows] == [True, False]


def test_layer_tests_store_rows_stop_on_failure_and_build_a_baseline(spark, tmp_dir):
    import pytest
    L, paths = Layers(spark, SF), jobs.Paths(tmp_dir)
    for e in ("business", "reviews", "users", "checkins", "tips"):
        write_partitioned(L.bronze(e), paths.bronze(e), ["ingestion_date"], guard=False)
    day = dt.date(2001, 6, 1)
    jobs.run_silver(spark, paths, day, RUN_TS)
    with pytest.raises(jobs.LayerTestsFailed):
        jobs.run_tests(spark, paths, "silver", day, RUN_TS)                       # floors of a full load
    for d in range(1, 5):
        rows = jobs.run_tests(spark, paths, "silver", day + dt.timedelta(days=d), RUN_TS + dt.timedelta(days=d), floors={}, stop=False)
    drift = {(r.test_name, r.entity): r for r in rows.collect() if r.test_name.endswith("_drift")}
    assert drift["row_count_drift", "reviews"].value == 0.0 and drift["metric_drift", "reviews"].message == "within threshold"


def test_entities_run_side_by_side_and_do_not_stop_each_other(spark):
    import threading
    import time

    import pytest
    meet, seen = threading.Barrier(3, timeout=30), {}

    def task(name, fail=False):
        def run():
            meet.wait()                         # all three are at work at once
            seen[name] = (spark.sparkContext.getLocalProperty("spark.scheduler.pool"), spark.sparkContext.getLocalProperty("spark.jobGroup.id"),
                          spark.range(10).count())
            if fail:
                raise ValueError("no good")
            time.sleep(0.1)
            return name.upper()
        return run
    with pytest.raises(jobs.EntityRunsFailed) as e:
        jobs.run_isolated(spark, "t", {"a": task("a"), "b": task("b", True), "c": task("c")})
    assert e.value.done == {"a": "A", "c": "C"} and list(e.value.failed) == ["b"] and "[b] ValueError: no good" in str(e.value)
    assert seen["a"] == ("t-a", "t-a", 10) and seen["b"] == ("t-b", "t-b", 10)
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    assert jobs.run_isolated(spark, "t", {}) == {}


def test_failed_clean_table_leaves_the_others_replaced(spark, tmp_dir):
    import pytest
    L, paths, day = Layers(spark, SF), jobs.Paths(tmp_dir), dt.date(2001, 6, 1)
    for e in ("tips", "checkins", "users"):
        write_partitioned(L.bronze(e), paths.bronze(e), ["ingestion_date"], guard=False)
    write_partitioned(L.bronze("tips").selectExpr("null business_id", "user_id", "text", "date", "compliment_count", "ingestion_date"),
                      paths.bronze("tips"), ["ingestion_date"], guard=False)
    with pytest.raises(jobs.EntityRunsFailed) as e:
        jobs.run_silver(spark, paths, day, RUN_TS)
    assert list(e.value.failed) == ["tips"] and isinstance(e.value.failed["tips"], jobs.SilverCheckError)
    status = {r.entity: r.status for r in spark.read.parquet(paths.audit).collect()}
    assert status == {"tips": "FAILED", "checkin_events": "SUCCESS", "users": "SUCCESS"}


def test_gold_audit_covers_facts_histories_and_failures(spark, tmp_dir):
    import pytest
    L, paths = Layers(spark, SF), jobs.Paths(tmp_dir)
    for t in ("business", "business_categories", "users", "reviews", "checkin_events"):
        L.silver(t).write.parquet(paths.silver(t))
    jobs.run_gold(spark, paths, RUN_TS, fact_buckets=2)
    rows = {r.entity: r for r in spark.read.parquet(paths.audit).collect()}
    assert set(rows) == {"dim_date", "dim_business", "dim_user", "fact_reviews", "fact_checkins", "dim_business_history", "dim_user_history"}
    assert rows["fact_reviews"].row_count == L.silver("reviews").count() and all(r.status == "SUCCESS" for r in rows.values())
    L.silver("users").withColumnRenamed("fans", "followers").write.mode("overwrite").parquet(paths.silver("users"))
    with pytest.raises(Exception):
        jobs.run_gold(spark, paths, RUN_TS + dt.timedelta(days=1))
    failed = spark.read.parquet(paths.audit).filter("status = 'FAILED'").collect()
    assert [(r.entity, r.row_count) for r in failed] == [("dim_user", None)] and failed[0].error


def test_calendar_bounds_read_two_months(spark, tmp_dir):
    """The first and the last event lie in the first and the last month's folder; rows without a month count for nothing."""
    paths = jobs.Paths(tmp_dir)
    L = Layers(spark, SF)
    reviews, checkins = L.silver("reviews"), L.silver("checkin_events")
    undated = reviews.limit(3).selectExpr(*[c if c not in ("review_date", "year", "month") else f"cast(null as {t}) {c}" for c, t in reviews.dtypes])
    write_partitioned(reviews.unionByName(undated), paths.silver("reviews"), ["year", "month"], guard=False)
    checkins.write.parquet(paths.silver("checkin_events"))          # no month folders: read whole
    stored = spark.read.parquet(paths.silver("reviews"))
    months = sorted(map(tuple, stored.select("year", "month").distinct().dropna().collect()))
    assert len(months) > 10
    read = jobs.edge_months(spark, paths.silver("reviews"))
    assert sorted(map(tuple, read.select("year", "month").distinct().collect())) == [months[0], months[-1]]
    plan = read.select("review_date")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((" in plan and "DataFilters: []" in plan
    want = reviews.selectExpr("to_date(review_date) d").unionAll(checkins.selectExpr("to_date(checkin_ts)")).selectExpr("min(d)", "max(d)").first()
    assert jobs._event_bounds(spark, paths) == tuple(want)
    # a calendar that is stored already is never cut
    spark.sql("select date'1990-01-01' full_date union all select date'2090-01-01'").write.parquet(paths.gold("dim_date"))
    assert jobs._event_bounds(spark, paths) == (dt.date(1990, 1, 1), dt.date(2090, 1, 1))
