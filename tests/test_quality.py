"""Check results on tables with planted violations."""

import datetime as dt

from strataflow.operators import quality as Q

AS_OF = dt.datetime(2024, 1, 2, 0, 0)


def results(df):
    return {(r.test_name, r.message.split(":")[0] if r.test_name in ("zero_nulls", "null_rate") else None): r
            for r in df.collect()}


def test_check_table(spark):
    df = spark.createDataFrame(
        [("r1", 1.0, dt.datetime(2024, 1, 1, 12)), ("r1", 6.0, None), (None, None, dt.datetime(2023, 1, 1))],
        "review_id string, stars double, review_date timestamp")
    spec = Q.TableChecks("reviews", "silver", min_rows=5, zero_null_cols=["review_id", "absent"],
                         null_rate_cols=["stars"], stars_col="stars", freshness_col="review_date",
                         freshness_hours=28, key_col="review_id")
    res = Q.check_table(df, spec, AS_OF).collect()
    by = {}
    for r in res:
        by.setdefault(r.test_name, []).append(r)
    assert by["row_count_minimum"][0].passed is False and by["row_count_minimum"][0].value == 3
    z = sorted(by["zero_nulls"], key=lambda r: r.message)
    assert [r.passed for r in z] == [True, False]       # absent column skipped, review_id has a null
    assert by["star_rating_range"][0].value == 1         # 6.0 out of range, null ignored
    assert by["freshness"][0].passed and by["freshness"][0].value == 12.0
    assert by["no_duplicate_keys"][0].value == 1
    assert by["null_rate"][0].value == round(1 / 3, 4)


def test_column_tests_and_grain(spark):
    fact = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 7.0), ("b", None, 2.0)],
                                 "review_id string, business_id string, review_stars double")
    dim = spark.createDataFrame([("x",)], "business_id string")
    tests = [("fact_reviews", "review_id", "unique", None), ("fact_reviews", "business_id", "not_null", None),
             ("fact_reviews", "business_id", "relationships", ("dim_business", "business_id")),
             ("fact_reviews", "review_stars", "accepted_values", [1.0, 2.0, 3.0, 4.0, 5.0])]
    res = {r.test_name: r.value for r in Q.run_column_tests({"fact_reviews": fact, "dim_business": dim}, tests).collect()}
    assert res == {"unique": 1.0, "not_null": 1.0, "relationships": 1.0, "accepted_values": 1.0}
    g = Q.grain_violations(fact, "fact_reviews", "review_id").collect()
    assert [(r.key_value, r.duplicate_count) for r in g] == [("a", 2)]
    assert Q.assert_not_empty(fact, "empty").count() == 0
    assert Q.assert_not_empty(fact.limit(0), "empty").count() == 1


def history(spark, values, test_name):
    rows = [(test_name, "reviews", "silver", True, "", float(v), None, dt.date(2024, 1, 1) + dt.timedelta(days=i),
             dt.datetime(2024, 1, 1) + dt.timedelta(days=i)) for i, v in enumerate(values)]
    from strataflow.schemas import TEST_RESULT_HISTORY_SCHEMA
    return spark.createDataFrame(rows, TEST_RESULT_HISTORY_SCHEMA)


def test_drift_needs_three_runs(spark):
    df = spark.createDataFrame([(i,) for i in range(200)], "x int")
    as_of = dt.date(2024, 2, 1)
    two = Q.row_count_drift(df, history(spark, [100, 100], "row_count_minimum"), "reviews", "silver", as_of).first()
    assert two.passed and two.value is None
    three = Q.row_count_drift(df, history(spark, [100, 100, 100], "row_count_minimum"), "reviews", "silver", as_of).first()
    assert not three.passed and three.value == 100.0
    # only the latest 7 runs count
    h = history(spark, [1000] * 5 + [200] * 7, "row_count_minimum")
    assert Q.row_count_drift(df, h, "reviews", "silver", as_of).first().passed


def test_null_rate_drift_one_sided(spark):
    df = spark.createDataFrame([(None,), (1,), (1,), (1,)], "stars int")
    as_of = dt.date(2024, 2, 1)
    up = Q.null_rate_drift(df, history(spark, [0.0, 0.0, 0.0], "null_rate_drift"), "reviews", "silver", "stars", as_of)
    assert not up.first().passed
    down = Q.null_rate_drift(df, history(spark, [0.9, 0.9, 0.9], "null_rate_drift"), "reviews", "silver", "stars", as_of)
    assert down.first().passed


def test_loss_and_partitions(spark):
    b = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "k string")
    s = spark.createDataFrame([("a",), ("b",)], "k string")
    r = Q.row_loss(b, s, "x", before_keys=["k"]).first()
    assert r.value == 33.33 and not r.passed
    raw = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 3),)], "ingestion_date date")
    p = Q.lookback_partitions_present(raw, "x", "bronze", dt.date(2024, 1, 3), 3).first()
    assert p.value == 1 and not p.passed
    assert Q.summarize(Q.union_all([Q.non_empty(b, "x", "y"), Q.non_empty(b.limit(0), "x", "y")])).first().failed_count == 1


# ── a layer's suite in one plan ────────────────────────────────────────────

def scans(df, path):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count(f"Location: InMemoryFileIndex(1 paths)[file:{path}]")


def _stored_silver(spark, base, n=300):
    from pyspark.sql import functions as F
    t = F.timestamp_seconds(F.lit(1704067200) - F.col("id") * 600)
    spark.range(n).select(F.concat(F.lit("r"), F.col("id") % (n - 5)).alias("review_id"), F.concat(F.lit("b"), F.col("id") % 7).alias("business_id"),
                          F.lit("u").alias("user_id"), F.when(F.col("id") % 10 != 0, (F.col("id") % 7).cast("double")).alias("stars"),
                          t.alias("review_date")).write.parquet(base + "/reviews")
    spark.range(n).select(F.concat(F.lit("u"), F.col("id")).alias("user_id"), t.alias("yelping_since"),
                          F.col("id").cast("double").alias("average_stars")).write.parquet(base + "/users")
    return {e: spark.read.parquet(f"{base}/{e}") for e in ("reviews", "users")}


def test_suite_reads_a_table_twice_at_most_and_equals_single_checks(spark, tmp_dir):
    tables = _stored_silver(spark, tmp_dir)
    raw = {e: df.unionByName(df.limit(3)) for e, df in tables.items()}
    hist = history(spark, [100, 100, 100], "row_count_minimum").unionByName(history(spark, [3.0, 3.1, 3.2], "metric_drift"))
    day = dt.date(2024, 2, 1)
    got = Q.run_layer_suite(tables, "silver", AS_OF, day, bronze=None, history=hist)
    assert scans(got, tmp_dir + "/reviews") == 2 and scans(got, tmp_dir + "/users") == 2
    want = []
    for spec in Q.layer_specs("silver"):
        if spec.entity in tables:
            df = tables[spec.entity]
            want.append(Q.check_table(df, spec, AS_OF))
            want.append(Q.row_count_drift(df, hist, spec.entity, "silver", day))
            want.append(Q.null_rate_drift(df, hist, spec.entity, "silver", Q.NULL_DRIFT_COLUMNS[spec.entity], day))
    want.append(Q.metric_drift(tables["reviews"], hist, "reviews", "silver", "stars", day))
    assert sorted(map(str, got.collect())) == sorted(map(str, Q.union_all(want).collect()))
    loss = [r for r in Q.run_layer_suite(tables, "silver", AS_OF, day, bronze=raw).collect() if r.test_name == "bronze_silver_row_ratio"]
    single = [Q.row_loss(raw[e], tables[e], e, before_keys=[k]).first() for e, k in (("reviews", "review_id"), ("users", "user_id"))]
    assert sorted(map(str, loss)) == sorted(map(str, single))


def test_suite_of_empty_tables(spark, tmp_dir):
    tables = {e: df.limit(0) for e, df in _stored_silver(spark, tmp_dir).items()}
    rows = {(r.entity, r.test_name): r for r in Q.run_layer_suite(tables, "silver", AS_OF, dt.date(2024, 2, 1), history=history(spark, [], "x")).collect()}
    assert not rows["reviews", "row_count_minimum"].passed and rows["reviews", "no_duplicate_keys"].passed
    assert not rows["users", "freshness"].passed and rows["users", "row_count_drift"].passed


def test_listed_partitions_replace_the_scan(spark, tmp_dir):
    spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 3))], "business_id string, ingestion_date date") \
         .write.partitionBy("ingestion_date").parquet(tmp_dir + "/checkins")
    df = spark.read.parquet(tmp_dir + "/checkins")
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 3)]
    one = Q.lookback_partitions_present(df, "checkins", "bronze", dt.date(2024, 1, 3), 3, present=days)
    assert scans(one, tmp_dir + "/checkins") == 0 and one.first().value == 1.0
    for given in (None, {"checkins": days}):
        rows = Q.run_layer_suite({"checkins": df}, "bronze", AS_OF, dt.date(2024, 1, 3), 3, floors={}, partitions=given).collect()
        assert next(r.value for r in rows if r.test_name == "lookback_partitions_present") == 1.0


def test_audit_volume_takes_the_last_run_of_a_day(spark):
    from strataflow.schemas import AUDIT_SCHEMA
    row = lambda day, hour, n, status="SUCCESS", layer="gold": ("fact", layer, n, None, None, None, dt.date(2024, 1, day), dt.datetime(2024, 1, day, hour), status, "")
    log = spark.createDataFrame([row(1, 1, 50), row(1, 2, 100), row(2, 1, 94), row(2, 2, None, "FAILED"), row(3, 1, 200), row(1, 1, 100, layer="bronze"),
                                 row(2, 1, 121, layer="bronze")], AUDIT_SCHEMA)
    got = {(r.layer, r.run_date.day): (r.row_count, r.change_pct, r.alert) for r in Q.audit_volume(log).collect()}
    assert got == {("gold", 1): (100, None, None), ("gold", 2): (94, -6.0, "shrink"), ("gold", 3): (200, 112.77, None),
                   ("bronze", 1): (100, None, None), ("bronze", 2): (121, 21.0, "growth")}


def test_column_tests_read_a_model_twice(spark, tmp_dir):
    spark.createDataFrame([("a", "x", "p", 1.0), ("a", "y", "p", 7.0), ("b", None, "q", 2.0), (None, "x", "r", None)],
                          "id string, b string, u string, stars double").write.parquet(tmp_dir + "/fact")
    fact = spark.read.parquet(tmp_dir + "/fact")
    b, u = spark.createDataFrame([("x",)], "b string"), spark.createDataFrame([("p",), ("p",), ("q",)], "u string")
    tests = [("fact", "id", "unique", None), ("fact", "id", "not_null", None), ("fact", "b", "unique", None), ("fact", "b", "relationships", ("b", "b")),
             ("fact", "u", "relationships", ("u", "u")), ("fact", "stars", "accepted_values", [1.0, 2.0]), ("fact", "stars", "relationships", ("gone", "x"))]
    got = Q.run_column_tests({"fact": fact, "b": b, "u": u}, tests)
    assert scans(got, tmp_dir + "/fact") == 2
    assert {(r.test_name, r.message.split(":")[0]): r.value for r in got.collect()} == {
        ("unique", "id"): 1.0, ("not_null", "id"): 1.0, ("unique", "b"): 1.0, ("relationships", "b"): 1.0, ("relationships", "u"): 1.0,
        ("accepted_values", "stars"): 1.0}
    single = Q.union_all([Q.test_unique(fact, "fact", "b"), Q.test_relationships(fact, "fact", "u", u, "u")])
    assert sorted(map(str, single.collect())) == sorted(str(r) for r in got.collect() if (r.test_name, r.message[0]) in (("unique", "b"), ("relationships", "u")))
